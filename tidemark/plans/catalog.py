"""Imports every query module so that the registry is complete."""

from importlib import import_module

from tidemark.plans.registry import QUERIES

for _module in ("queries_research", "queries_candidates", "queries_collections",
                "queries_quality", "queries_privacy", "queries_tagging", "queries_landed"):
    import_module(f"tidemark.plans.{_module}")

__all__ = ["QUERIES"]
