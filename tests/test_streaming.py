"""Streams with stored or keyed state: incremental dedup, life cycles of runs, late rows."""

import datetime
import itertools
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from corpusloom.operators import simhash
from corpusloom.sources.scratch import stored
from corpusloom.streaming import dedup, watch


def prints(n=240):
    r = random.Random(3)
    seen, out = [r.getrandbits(63) for _ in range(12)], []
    for i in range(n):
        fp = r.choice(seen) ^ sum(1 << b for b in r.sample(range(63), r.randrange(0, 6)))
        out.append((r.choice(["a", "b"]), i, None if i % 17 == 0 else fp))
    return out


def test_batches_keep_what_one_pass_keeps(spark, tmp_path):
    schema, rows = "topic string, doc_id long, fp long", prints()
    whole = spark.createDataFrame(rows, schema)
    want = {(r.topic, r.doc_id) for r in simhash.greedy_keep(whole.where("fp IS NOT NULL"), [F.col("doc_id")], stored).collect()} | {(t, i) for t, i, fp in rows if fp is None}
    index = dedup.Index(spark, f"file://{tmp_path}/index")
    for k in range(3):
        index.add(whole.where(f"doc_id >= {80 * k} AND doc_id < {80 * k + 80}"), k)
    got = sorted((r.topic, r.doc_id) for r in index.kept().collect())
    assert got == sorted(want)
    for k in (2, 1, 1):  # a replay, also of a batch that others came after
        index.add(whole.where(f"doc_id >= {80 * k} AND doc_id < {80 * k + 80}"), k)
    assert sorted((r.topic, r.doc_id) for r in index.kept().collect()) == got
    index.add(whole.limit(0), 3)
    assert index.kept().count() == len(got)


def test_a_stream_goes_on_where_it_stopped(spark, tmp_path):
    schema, rows, path = "topic string, doc_id long, fp long", prints(60), f"file://{tmp_path}"
    for k in range(2):
        spark.createDataFrame(rows[30 * k : 30 * k + 30], schema).write.mode("append").parquet(f"{path}/in")
        dedup.run(spark.readStream.schema(schema).parquet(f"{path}/in"), f"{path}/index")
    index = dedup.Index(spark, f"{path}/other")
    index.add(spark.createDataFrame(rows, schema), 0)
    both = [sorted(r.doc_id for r in i.kept().collect()) for i in (dedup.Index(spark, f"{path}/index"), index)]
    assert both[0] == both[1]


def at(hours):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=hours)


def test_a_run_lives_from_start_to_end(spark, tmp_path):
    path = f"file://{tmp_path}"
    rows = [(1, 0, at(0), "save"), (1, 1, at(1), "start"), (1, 2, at(2), "save"), (1, 3, at(3), "start"), (1, 4, at(4), "drift"), (2, 5, at(1), "start"), (2, 6, at(2), "save")]
    later = [(1, 20 + i, at(5 + i), "drift" if i % 4 else "reject") for i in range(12)] + [(1, 40, at(20), "end"), (1, 41, at(21), "save"), (3, 42, at(22), "start")] + [(3, 50 + i, at(23), "error") for i in range(5)] + [(4, 60, at(60), "start")]
    for part in (rows, later):
        spark.createDataFrame(part, "run long, seq long, ts timestamp, kind string").coalesce(1).write.mode("append").parquet(f"{path}/in")
        watch.collected(watch.cards(spark.readStream.schema("run long, seq long, ts timestamp, kind string").parquet(f"{path}/in"), 24 * 3600.0, "10 days"), path, "append")
    got = sorted(tuple(r) for r in spark.read.parquet(f"{path}/rows").select("run", "started", "ended", "events", "saves", "rejects", "alerts").collect())
    assert got == [(1, 3, 40, 15, 0, 13, "pollution")]  # 2, 3 and 4 wait: the watermark is ten days behind
    state = spark.read.format("statestore").option("path", f"{path}/state").option("stateVarName", "run").load()
    assert sorted(r.key.run for r in state.select("key").collect()) == [2, 3, 4]


@pytest.mark.parametrize("batches", [1, 3])
def test_a_silent_run_is_closed_by_its_timer(spark, tmp_path, batches):
    path = f"file://{tmp_path}"
    rows = [(3, 42, at(0), "start")] + [(3, 50 + i, at(1), "error") for i in range(5)] + [(4, 60, at(60), "start"), (4, 61, at(61), "end")]
    for k in range(batches):
        part = rows[k * len(rows) // batches : (k + 1) * len(rows) // batches]
        spark.createDataFrame(part, "run long, seq long, ts timestamp, kind string").coalesce(1).write.mode("append").parquet(f"{path}/in")
        watch.collected(watch.cards(spark.readStream.schema("run long, seq long, ts timestamp, kind string").parquet(f"{path}/in"), 24 * 3600.0, "1 hour"), path, "append")
    got = sorted(tuple(r) for r in spark.read.parquet(f"{path}/rows").select("run", "started", "ended", "events", "alerts").collect())
    assert got == [(3, 42, None, 6, "model unstable"), (4, 60, 61, 2, "")]
    state = spark.read.format("statestore").option("path", f"{path}/state").option("stateVarName", "run").load()
    assert state.count() == 0


LATE = "run long, kind string, cycle string, filter string, n long, score double"
PARTS = [(1, "count", "1", "f", 5, None), (1, "count", "2", "f", 12, None), (1, "quality", "1", None, None, 0.75), (1, "quality", "2", None, None, 0.62)]


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (3, 2, 1, 0), (2, 0, 3, 1), (1, 3, 0, 2)])
def test_a_verdict_does_not_depend_on_the_order_of_arrival(spark, tmp_path, order):
    path = f"file://{tmp_path}"
    for k in order:
        spark.createDataFrame([PARTS[k], (2, *PARTS[k][1:5], None if PARTS[k][5] is None else 0.7)], LATE).coalesce(1).write.mode("append").parquet(f"{path}/in")
        watch.collected(watch.verdicts(spark.readStream.schema(LATE).parquet(f"{path}/in")), path, "update")
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/rows").select("run", "cycle", "filter", "prev", "curr", "over").collect()]
    assert rows == [(1, "2", "f", 5, 12, True)]


def test_a_verdict_is_withdrawn_when_a_cycle_comes_between(spark, tmp_path):
    path = f"file://{tmp_path}"
    for part in (PARTS, [(1, "count", "15", "f", 8, None), (1, "quality", "15", None, None, 0.70)], [(1, "end", None, None, None, None)]):
        spark.createDataFrame(part, LATE).coalesce(1).write.mode("append").parquet(f"{path}/in")
        watch.collected(watch.verdicts(spark.readStream.schema(LATE).parquet(f"{path}/in")), path, "update")
    rows = sorted(((r.version, r.over) for r in spark.read.parquet(f"{path}/rows").where("cycle = '2'").collect()))
    assert rows == [(1, True), (2, False)]
    for name in ("scores", "counts", "said"):
        assert spark.read.format("statestore").option("path", f"{path}/state").option("stateVarName", name).load().count() == 0


class Store:
    """States of one run, which count what is asked of them."""

    def __init__(self):
        self.calls = 0

    def state(self, held):
        asked = self

        class State:
            def __getattr__(self, name):
                def call(*args):
                    asked.calls += 1
                    if name == "iterator":
                        return iter(list(held.items()))
                    if name == "updateValue":
                        held[args[0]] = args[1]
                    if name == "update":
                        held[()] = args[0]
                    if name == "clear":
                        held.clear()
                    return held.get(()) if name == "get" else None

                return call

        return State()

    def getValueState(self, name, schema):
        return self.state({})

    def getMapState(self, name, key, value):
        return self.state({})


def test_a_batch_asks_the_store_as_often_for_many_rows_as_for_few():
    """Before, each count, score and verdict of a run was a call of its own."""
    rows = lambda n: [Row(run=1, kind=k, cycle=f"{c:03}", filter=f if k == "count" else None, n=5 * 2 ** (c % 9) if k == "count" else None, score=3 - c / 20 if k == "quality" else None) for c in range(n) for k, f in (("count", "f"), ("count", "g"), ("quality", None))]
    calls, over = [], []
    for n in (2, 40):
        store, p = Store(), watch.Verdicts()
        p.init(store)
        got = list(p.handleInputRows((1,), iter(rows(n)[: n // 2 * 3]), None)) + list(p.handleInputRows((1,), iter(rows(n)[n // 2 * 3 :]), None))
        calls.append(store.calls)
        over.append(sum(r.over for r in got))
    assert over == [2, 70] and max(calls) <= 12
