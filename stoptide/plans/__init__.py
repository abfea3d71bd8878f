"""Collects the modules that register queries."""

from __future__ import annotations

import importlib

from stoptide.catalog import CATALOG, Query

MODULES = ("tabs", "feed", "study", "forensics", "more", "edge", "places", "lists", "daily", "results")


def load_catalog() -> dict[str, Query]:
    """Imports every query module once and returns the catalogue."""
    for name in MODULES:
        importlib.import_module(f"stoptide.plans.{name}")
    return CATALOG
