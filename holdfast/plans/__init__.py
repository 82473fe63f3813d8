"""Registered queries: each binds operators to the warehouse tables, with a SQL oracle."""

from importlib import import_module

_MODULES = ("valuation", "quality", "controls", "history", "serving", "retrieval", "ingest")


def load_all() -> None:
    """Import every module that registers queries."""
    for name in _MODULES:
        import_module(f"{__name__}.{name}")
