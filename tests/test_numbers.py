"""Means and rounding of event rules against plain sums in order of time."""

import datetime
import random

import duckdb

from corpusloom import catalog

DAY = datetime.datetime(2024, 1, 1)


def saved(spark, path, rows):
    """events of (user, day, type, value) in order of time, written in files that hold them in another order."""
    e = [(i, DAY + datetime.timedelta(days=d, seconds=i), u, t, v, '{"k": 1}') for i, (u, d, t, v) in enumerate(rows)]
    random.Random(3).shuffle(e)
    spark.createDataFrame(e, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").repartition(5).write.parquet(f"{path}/events.parquet")
    return str(path)


def test_plateaus_at_the_threshold_go_by_the_order_of_time(spark, tmp_path):
    r, rows, want = random.Random(1), [], set()
    for user in range(600):
        a = [round(r.uniform(0, 90), 2) for _ in range(5)]
        b = [round(r.uniform(0, 90), 2) for _ in range(4)]
        b.append(round(sum(a) + 0.1 - sum(b), 2))  # the means differ by 0.02
        rows += [(user, day, "view", v) for day, values in enumerate((a, b)) for v in values]
        sums = []
        for values in (a, b):
            s = 0.0
            for v in values:
                s += v
            sums.append(s)
        if abs(sums[1] / 5 - sums[0] / 5) < 0.02:
            want.add(user)
    got = {x["user_id"] for x in catalog.QUERIES["plateau_alerts"](spark, saved(spark, tmp_path, rows)).collect()}
    assert 0 < len(want) < 600 and got == want


def test_stop_rules_round_as_their_sql(spark, tmp_path):
    rows = []
    for user in range(1500):  # a cent more each; half of the scores end in 5 at the fifth place
        for day, value in ((0, user / 100), (1, (user + 1000) / 100), (1, None)):
            rows += [(user, day, "view", value), (user, day, "signup", None)]
    path = saved(spark, tmp_path, rows)
    c = duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM '{path}/events.parquet/*.parquet'")
    cur = c.execute(catalog.ORACLE["stop_rules"])
    cols = [d[0] for d in cur.description]
    assert sorted(map(tuple, catalog.QUERIES["stop_rules"](spark, path).select(*cols).collect())) == sorted(cur.fetchall())
