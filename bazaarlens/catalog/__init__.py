"""Named queries: each one a plan over the tables and, where SQL can say it, its SQL twin."""

from __future__ import annotations

from importlib import import_module

from .registry import ENTRIES, runner, with_views

GROUPS = ("reports", "ingest", "filters", "joins", "aggregates", "windows", "ordering", "scalars", "extensions")


def _loaded():
    for group in GROUPS:
        import_module(f"{__name__}.{group}")
    return ENTRIES


def runners():
    return {name: runner(entry) for name, entry in _loaded().items()}


def oracle_texts():
    return {name: with_views(entry.sql) for name, entry in _loaded().items() if entry.sql}
