"""Registered queries over the test tables, each with its reference SQL where SQL can say it."""

from importlib import import_module

from .base import ORACLES, QUERIES

for _name in ("scans", "filters", "joins", "aggregates", "toplists", "sets", "scalars", "analytics", "people"):
    import_module(f"{__name__}.{_name}")

__all__ = ["ORACLES", "QUERIES"]
