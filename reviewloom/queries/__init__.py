"""Named queries over the test tables, each with an equivalent DuckDB statement where SQL can say it."""

from importlib import import_module

from reviewloom.queries.base import ORACLES, QUERIES

for _area in ("prepare", "quality", "sampling", "measures", "exact_tests", "language", "models", "moderation"):
    import_module(f"reviewloom.queries.{_area}")

__all__ = ["ORACLES", "QUERIES"]
