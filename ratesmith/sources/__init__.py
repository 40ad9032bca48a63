"""Scans, reference relations and sinks."""
