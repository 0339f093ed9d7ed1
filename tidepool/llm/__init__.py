"""Operators for preparing language-model training data, and their queries.

Each operator module keeps a general interface (tables in, tables out) and
registers one thin ``opN_<name>`` query over the driver tables. Nothing else in
the library imports this subpackage.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

QUERIES: dict[str, tuple[Callable, str | None]] = {}

MODULES = (
    "warc",
    "secrets",
    "line_hash",
    "decontaminate",
    "chat",
    "toxicity",
    "simhash",
    "fuzzy_lines",
    "pieces",
    "exact",
    "merkle",
    "whiten",
    "flat_graph",
)


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` with its DuckDB SQL (None: not expressible)."""

    def wrap(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = (fn, sql)
        return fn

    return wrap


def load_all() -> dict[str, tuple[Callable, str | None]]:
    for m in MODULES:
        importlib.import_module(f"{__name__}.{m}")
    return QUERIES
