"""Where query modules register: a name, a function of (spark, sf_dir), and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable:
    def add(fn: Callable) -> Callable:
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLE[fn.__name__] = oracle
        return fn

    return add
