"""Checked queries: each name has a Spark callable and, where SQL can say the same, a SQL text."""

from __future__ import annotations

from importlib import import_module

from .check import Query

SUBJECTS = (
    "ledger",
    "silver",
    "features",
    "stores",
    "profile",
    "explore",
    "mlprep",
    "monitoring",
    "health",
)


def _merged(attribute: str) -> dict:
    merged: dict = {}
    for subject in SUBJECTS:
        entries = getattr(import_module(f"{__name__}.{subject}").registry, attribute)
        repeated = merged.keys() & entries.keys()
        if repeated:
            raise ValueError(f"registered twice: {sorted(repeated)}")
        merged.update(entries)
    return merged


def all_queries() -> dict[str, Query]:
    return _merged("queries")


def all_sql() -> dict[str, str]:
    return _merged("sql")
