"""Run health on written runs, and filter regressions."""

import pytest

from corpusloom.operators import health as H

CYCLES = "run string, cycle int, score double, facts double, pedagogy double"
EFFECTS = "run string, cycle int, filter string, stat string, n long"


def runs(spark):
    claims = [("forums", "reddit")] * 100 + [("low", "wikipedia")] * 80 + [("low", "reddit")] * 20 + [("fine", "wikipedia")] * 60 + [("fine", None)] * 40
    cycles = [("forums", 1, 0.75, None, None), ("forums", 2, 0.62, None, None), ("low", 1, 0.67, 0.51, 0.47), ("fine", 1, 0.70, None, None), ("fine", 2, 0.76, None, None)]
    effects = [("forums", 1, "claims", "stripped", 5), ("forums", 2, "claims", "stripped", 50), ("forums", 2, "claims", "new", 7), ("forums", 2, "terms", "replaced", 2), ("fine", 1, "claims", "stripped", 10), ("fine", 2, "claims", "stripped", 12), ("bare", 3, "x", "y", 1)]
    return spark.createDataFrame(claims, "run string, source_name string"), spark.createDataFrame(cycles, CYCLES), spark.createDataFrame(effects, EFFECTS)


def test_health(spark):
    got = {r.run: r for r in H.health(*runs(spark), ["wikipedia"]).collect()}
    assert got["forums"].verdict == "investigate" and got["forums"].reference_share == 0 and got["forums"].worst_delta == pytest.approx(-0.13)
    assert got["forums"].issues == ["reference share", "score drop", "claims.new", "terms.replaced", "claims.stripped", "score floor"]
    assert (got["low"].verdict, got["low"].issues, got["low"].worst_delta) == ("investigate", ["score floor", "facts floor"], None)
    assert (got["fine"].verdict, got["fine"].issues, got["fine"].reference_share) == ("healthy", [], 0.6)
    assert got["bare"].issues == ["reference share"] and got["bare"].worst_delta is None


def test_filters(spark):
    _, cycles, effects = runs(spark)
    got = {(r.run, r["filter"], r.stat): (r.prev, r.curr, r.ratio, r.quality_dropped) for r in H.filter_ratios(effects, cycles).collect()}
    assert got == {("forums", "claims", "stripped"): (5, 50, 10.0, True), ("forums", "claims", "new"): (0, 7, None, True), ("forums", "terms", "replaced"): (0, 2, None, True), ("fine", "claims", "stripped"): (10, 12, 1.2, False)}
    assert [tuple(r) for r in H.over_stripping(effects, cycles).collect()] == [("forums", 2, "claims", "stripped", 5, 50)]
    assert H.health(*(d.limit(0) for d in runs(spark)), []).count() == 0


def test_a_model_is_unstable_once_a_cycle_from_its_fifth_error_on(spark):
    from corpusloom.operators import health

    rows = [("a", 1, t, t) for t in (3, 1, 2)] + [("a", 2, t, t) for t in (10, 11, 11, 12)] + [("a", 3, 20, 20), ("b", 1, 1, 1), ("c", 1, None, 7)] + [("c", 1, 5, i) for i in range(6)]
    got = health.unstable(spark.createDataFrame(rows, "run string, cycle int, ts int, event int")).collect()
    assert sorted(map(tuple, got)) == [("a", 2, 5, 11), ("a", 3, 8, 20), ("c", 1, 5, 3)]
    assert health.unstable(spark.createDataFrame([], "run string, cycle int, ts int, event int")).count() == 0
