"""Whole monthly runs composed from the operators."""
