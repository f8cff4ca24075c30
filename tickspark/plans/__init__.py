"""Registered whole-table reports (one per SURVEY §8 key) and their DuckDB oracles."""

from tickspark.plans.registry import REGISTRY, Query  # noqa: F401


def load_all():
    """Import every plan module so the registry is complete."""
    import importlib
    for m in ("notebook", "dashboard", "catalog", "ingest", "lakejobs", "streams"):
        try:
            importlib.import_module(f"tickspark.plans.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"tickspark.plans.{m}":
                raise
    return REGISTRY
