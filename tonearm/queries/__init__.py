"""Every operator run over the given tables, with the SQL that must give the same rows."""

from __future__ import annotations

import importlib

MODULES = ("warehouse", "columns", "relations", "merges", "storage", "documents", "streams")


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"tonearm.queries.{name}")


def all_queries() -> dict:
    from tonearm.queries.registry import QUERIES

    _load()
    return dict(sorted(QUERIES.items()))


def all_oracles() -> dict:
    from tonearm.queries.registry import ORACLES

    _load()
    return dict(sorted(ORACLES.items()))
