"""The engine bound to the given tables: views, registered queries and their check SQL."""

from __future__ import annotations

from importlib import import_module

AREAS = ("values", "cohorts", "networks", "rates", "activity", "publishing", "checks", "synthetic")


def load():
    """The catalogue with every area's queries registered."""
    for area in AREAS:
        import_module(f"registry.{area}")
    return import_module("registry.catalogue")
