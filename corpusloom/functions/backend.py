"""Model calls as a column: prompts go through a pluggable backend in Arrow batches. The default backend answers nothing, so
every caller falls back on its rules; a backend that calls a service is the user's."""

from __future__ import annotations

import re
import time
from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

Backend = Callable[[str], str]
_THINK = re.compile(r"<think>.*?</think>", re.DOTALL)


class Busy(Exception):
    """The service asks to come back later."""


class Unreachable(Exception):
    """No connection."""


def silent(prompt: str) -> str:
    """Answers nothing."""
    return ""


@dataclass(frozen=True)
class Settings:
    """Knobs of an engine; defaults are the fixed values that results depend on."""

    retries: int = 3
    busy_wait: float = 15.0
    connect_wait: float = 10.0
    other_wait: float = 5.0
    least_answer: int = 20
    long_waits: tuple[float, ...] = (15.0, 45.0)
    hamming: int = 4
    fingerprints: int = 50_000
    dedup_floor: int = 2_500
    candidates: int = 80
    workers: int = 3
    sleep: Callable[[float], None] = field(default=time.sleep, compare=False)


def ask(backend: Backend, prompt: str, s: Settings = Settings()) -> str:  # noqa: B008
    """An answer without its thinking; waits grow with each attempt, by the kind of failure; empty when all fail."""
    for attempt in range(1, s.retries + 1):
        try:
            return _THINK.sub("", backend(prompt) or "").strip()
        except Busy:
            s.sleep(s.busy_wait * attempt)
        except Unreachable:
            s.sleep(s.connect_wait * attempt)
        except Exception:  # a backend may raise anything; a failed prompt must not fail the job
            s.sleep(s.other_wait * attempt)
    return ""


def ask_firmly(backend: Backend, prompt: str, s: Settings = Settings()) -> str:  # noqa: B008
    """Asks again, after long waits, until an answer is longer than `least_answer` characters; else empty."""
    for wait in (*s.long_waits, None):
        answer = ask(backend, prompt, s)
        if len(answer) > s.least_answer:
            return answer
        if wait is not None:
            s.sleep(wait)
    return ""


def answers(prompt: Column, backend: Backend = silent, settings: Settings = Settings(), firmly: bool = False) -> Column:  # noqa: B008
    """The answers to prompts; null prompts get an empty answer."""
    call = ask_firmly if firmly else ask

    def run(p: pd.Series) -> pd.Series:
        return pd.Series(["" if x is None else call(backend, x, settings) for x in p], dtype=object)

    return F.pandas_udf(run, "string")(prompt)


def healthy(backend: Backend, settings: Settings = Settings()) -> bool:  # noqa: B008
    return bool(ask(backend, "Reply with just the word OK.", settings))
