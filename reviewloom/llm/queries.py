"""All queries of the subpackage."""

from importlib import import_module

from reviewloom.llm.base import ORACLES, QUERIES

for _area in ("shards", "contamination", "mixing", "chat", "html", "tokens", "packing", "centroids", "collocations", "toxicity", "topk", "neardup", "repeats"):
    import_module(f"reviewloom.llm.{_area}")

__all__ = ["ORACLES", "QUERIES"]
