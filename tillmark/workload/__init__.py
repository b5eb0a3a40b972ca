"""The retail operators run over the given analytic tables."""

from importlib import import_module

MODULES = ("star", "cleaning", "state", "ingest", "quality", "audit", "upkeep", "streams")


def load_all() -> None:
    """Import every module that registers queries."""
    for name in MODULES:
        import_module(f"tillmark.workload.{name}")
