"""All registered queries."""

from importlib import import_module

from .registry import REGISTRY, Query, Tables

# modules register their queries on import
_MODULES = ["sources", "filters", "cleaning", "joins", "aggregates", "ordered", "scalars", "inference", "learning", "facts"]
for _name in _MODULES:
    import_module(f"{__name__}.{_name}")

__all__ = ["REGISTRY", "Query", "Tables"]
