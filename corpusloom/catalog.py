"""All registered queries, and the SQL oracles of those that SQL can express."""

from __future__ import annotations

from .plans import checks, claims, corpus, course, events, folds, loop, passages, quality, sections, terms  # noqa: F401
from .registry import ORACLE, QUERIES  # noqa: F401
