"""Registered queries: each family module adds to one registry."""

from importlib import import_module

from panelweave.plans.registry import REGISTRY

FAMILIES = (
    "sources",
    "projections",
    "filters",
    "joins",
    "aggregations",
    "windows",
    "ordering",
    "sets",
    "reshaping",
    "scalars",
    "series",
    "allocations",
    "trade",
    "curves",
    "regions",
    "checks",
)

for family in FAMILIES:
    import_module(f"panelweave.plans.{family}")

__all__ = ["REGISTRY"]
