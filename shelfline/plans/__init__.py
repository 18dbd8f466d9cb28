"""Queries over the given tables, and the end-to-end jobs."""

import importlib

_MODULES = ("inventory", "state", "quiet", "routes", "messages", "read_model", "shop", "activity", "social", "end_to_end", "streams", "history")


def load_all() -> None:
    """Import every module that registers queries."""
    for name in _MODULES:
        importlib.import_module(f"shelfline.plans.{name}")
