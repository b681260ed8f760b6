"""Composed queries over the shared test tables, with their SQL checks."""


def load():
    """Import every query module and return the registry."""
    from importlib import import_module
    for name in MODULES:
        import_module(f"lakeledger.plans.{name}")
    return import_module("lakeledger.plans.registry")


MODULES = ["balance_queries", "series_queries", "pixel_queries", "grid_queries", "flow_queries"]
