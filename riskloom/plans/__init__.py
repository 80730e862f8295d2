"""Registered queries (one per operator of the inventory) and their DuckDB twins."""

from importlib import import_module

from .registry import ORACLE, QUERIES

_MODULES = ["q_eval", "q_profile", "q_features", "q_drift", "q_registry", "q_misc", "q_models", "q_logs"]


def load_all() -> None:
    for m in _MODULES:
        import_module(f"{__name__}.{m}")


__all__ = ["ORACLE", "QUERIES", "load_all"]
