"""Runs watched as a stream: life cycles and verdicts held in keyed state, which goes when a run ends.

cards() follows each run from its start marker to its end marker. A start resets the run's counters, an end writes its
card; a run that is silent for longer than `silence` is closed by a timer, or by its next event. Kinds of alerts are
held once a run, so nothing grows with the stream, and a closed run has no state left.

verdicts() re-opens a filter's verdict whenever one of the rows that it rests on arrives: the filter's counts in two
neighbouring cycles and the quality of both. Each change is a row with a version; the row of the highest version holds,
so the result doesn't depend on the order of arrival. The state of a run is its cycles' scores and counts; an end marker
drops it, and rows of a run that come later begin it anew. Each call to the store is a round trip out of Python, so a run's
scores, its counts and its verdicts are one value each, read and written once a batch.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ValueState
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType

PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
#: Rejections looked at, how many there must be, how many of them drift; errors that make a model unstable.
WINDOW, FEWEST, DRIFT, ERRORS = 20, 10, 7, 5
#: A filter's count, its growth and the fall in quality that make a verdict.
STRIPPED, GROWTH, FALL = 5, 2.0, 0.03


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """The store that arbitrary state needs, for queries started inside."""
    before = spark.conf.get(PROVIDER[0], None)
    spark.conf.set(*PROVIDER)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER[0], before) if before else spark.conf.unset(PROVIDER[0])


_KINDS = {"long": LongType, "string": StringType, "double": DoubleType, "boolean": BooleanType}


def _type(fields: str) -> StructType:
    """Of "name kind, ...": tasks have no session to parse one."""
    return StructType([StructField(n, _KINDS[k]()) for n, k in (f.split() for f in fields.split(", "))])


CARD = "run long, started long, ended long, events long, saves long, rejects long, alerts string"
STATE = _type("started long, events long, saves long, rejects long, errors long, recent string, alerts string, last long")


class Cards(StatefulProcessor):
    """Events of a run (seq, us: microseconds, kind: start, end, save, drift, reject, error, or another) to its cards."""

    def __init__(self, silence: float) -> None:
        self.silence = int(silence * 1_000_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("run", STATE)

    def _close(self, key, ended: int | None) -> Row:
        s = Row(*STATE.names)(*self.state.get())
        self.state.clear()
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer[0] if isinstance(timer, (tuple, list)) else timer)
        return Row(run=key[0], started=s.started, ended=ended, events=s.events, saves=s.saves, rejects=s.rejects, alerts=s.alerts)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        s = dict(zip(STATE.names, self.state.get())) if self.state.exists() else None
        for r in sorted(rows, key=lambda r: (r.us, r.seq)):
            if s is not None and r.us - s["last"] > self.silence:
                self.state.update(tuple(s[n] for n in STATE.names))
                yield self._close(key, None)
                s = None
            if r.kind == "start":
                s = dict(started=r.seq, events=0, saves=0, rejects=0, errors=0, recent="", alerts="", last=r.us)
            if s is None:
                continue
            s.update(events=s["events"] + 1, last=r.us)
            if r.kind == "save":
                s["saves"] += 1
            elif r.kind in ("drift", "reject"):
                s["rejects"] += 1
                s["recent"] = (s["recent"] + ("d" if r.kind == "drift" else "r"))[-WINDOW:]
                if len(s["recent"]) >= FEWEST and s["recent"].count("d") >= DRIFT:
                    self._alert(s, "pollution")
            elif r.kind == "error":
                s["errors"] += 1
                if s["errors"] >= ERRORS:
                    self._alert(s, "model unstable")
            elif r.kind == "end":
                self.state.update(tuple(s[n] for n in STATE.names))
                yield self._close(key, r.seq)
                s = None
        if s is not None:
            self.state.update(tuple(s[n] for n in STATE.names))
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer[0] if isinstance(timer, (tuple, list)) else timer)
            self.handle.registerTimer((s["last"] + self.silence) // 1000)

    @staticmethod
    def _alert(s: dict, kind: str) -> None:
        kinds = [k for k in s["alerts"].split(", ") if k]
        if kind not in kinds:
            s["alerts"] = ", ".join(sorted([*kinds, kind]))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.state.exists():
            yield self._close(key, None)

    def close(self) -> None:
        pass


def cards(events: DataFrame, silence: float = 7 * 86400.0, delay: str = "0 seconds") -> DataFrame:
    """Cards of runs (CARD) from a stream of run, seq, ts (timestamp), kind. Rows later than `delay` behind the newest
    of the batches before are dropped, as a watermark does."""
    return events.withColumn("us", F.unix_micros("ts")).withWatermark("ts", delay).groupBy("run").transformWithState(Cards(silence), _type(CARD), "Append", "EventTime")


VERDICT = "run long, cycle string, filter string, prev long, curr long, over boolean, version long"


class Verdicts(StatefulProcessor):
    """Rows of a run (kind: count with filter and n, quality with score, end) to changes of verdicts."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        # JSON lists: cycle, score; cycle, filter, n; cycle, filter, prev, curr, over, version.
        self.scores, self.counts, self.said = (handle.getValueState(name, _type("held string")) for name in ("scores", "counts", "said"))

    @staticmethod
    def _held(state: ValueState) -> list[list]:
        value = state.get()
        return json.loads(value[0]) if value else []

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        scores = {c: score for c, score in self._held(self.scores)}
        counts = {(c, f): n for c, f, n in self._held(self.counts)}
        said = {(c, f): tuple(v) for c, f, *v in self._held(self.said)}
        ended, changed = False, set()
        for r in rows:
            if r.kind == "quality":
                scores[r.cycle] = r.score
            elif r.kind == "count":
                counts[r.cycle, r.filter] = counts.get((r.cycle, r.filter), 0) + (r.n or 0)
            else:
                ended = True
            changed.add(r.kind)
        order = sorted({c for c, _ in counts} | set(scores))
        before = dict(zip(order[1:], order))
        for k in sorted({*counts} | {*said}):
            cycle, filter_ = k
            was = before.get(cycle)
            prev, curr = counts.get((was, filter_), 0), counts.get(k, 0)
            known = was is not None and None not in (scores.get(cycle), scores.get(was))
            over = known and curr >= STRIPPED and prev > 0 and curr / prev >= GROWTH and scores[cycle] < scores[was] - FALL
            old = said.get(k)
            if (old[:3] if old else (0, 0, False)) != ((prev, curr, True) if over else (0, 0, False)):
                version = (old[3] if old else 0) + 1
                value = (prev, curr, True, version) if over else (0, 0, False, version)
                said[k] = value
                changed.add("said")
                yield Row(run=key[0], cycle=cycle, filter=filter_, prev=value[0], curr=value[1], over=value[2], version=version)
        if ended:
            for state in (self.scores, self.counts, self.said):
                state.clear()
            return
        if "quality" in changed:
            self.scores.update((json.dumps(list(scores.items())),))
        if "count" in changed:
            self.counts.update((json.dumps([(*k, n) for k, n in counts.items()]),))
        if "said" in changed:
            self.said.update((json.dumps([(*k, *v) for k, v in said.items()]),))

    def close(self) -> None:
        pass


def verdicts(rows: DataFrame) -> DataFrame:
    """Changes of verdicts (VERDICT) from a stream of run, kind, cycle, filter, n, score."""
    return rows.groupBy("run").transformWithState(Verdicts(), _type(VERDICT), "Update", "None")


def collected(result: DataFrame, path: str, mode: str) -> None:
    """Runs a stream of cards or verdicts to the end of its input; rows go to a folder for each batch under path/rows,
    which a replay writes anew. Started again with the same path it goes on where it stopped."""

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/rows/batch={number}")

    with keyed_state(result.sparkSession):
        query = result.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", f"{path}/state")
        query.trigger(availableNow=True).start().awaitTermination()
