"""Quantities: all forms of pairs, implausible numbers, and sentences that convert wrongly."""

import pytest

from corpusloom.functions import markdown as M
from corpusloom.operators import quantities as Q


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id long, text string")


def test_pairs_of_all_forms(spark):
    texts = ["30 °C (86 °F)", "86°F/30°C", "25,4 mm, 1 inch", "1 in (25.4 mm) and 2 inches / 60 mm", "10 kg (22 lbs)", "2-3 oz / 0.8-1.0 mm", "1 mm (2.5 oz)", "2 oz / 0.8 mm / 0.03 in", "0 mm (1 in)", "2-5 kg (11 lb), 5 kg (10-12 lb)", "5 mm ( 9 oz)", "3 mm long (2 in)", None, "", "7 in, 2 in; 4 inx (100 mm)"]
    got = {}
    for r in Q.pairs(frame(spark, texts), "id").collect():
        got.setdefault(r.id, []).append((r["from"], r["to"], round(r.a, 3), round(r.b, 3), r.warn))
    assert got == {
        0: [("°C", "°F", 30, 86, False)], 1: [("°F", "°C", 86, 30, False)], 2: [("mm", "in", 25.4, 1, False)], 3: [("in", "mm", 1, 25.4, False), ("in", "mm", 2, 60, True)], 4: [("kg", "lb", 10, 22, False)],
        5: [("oz", "mm", 2.5, 0.9, False)], 6: [("mm", "oz", 1, 2.5, False)], 7: [("oz", "mm", 2, 0.8, False), ("mm", "in", 0.8, 0.03, False)], 9: [("kg", "lb", 5, 11, False)], 10: [("mm", "oz", 5, 9, True)],
    }


def test_implausible_numbers(spark):
    texts = ["It draws 60000 Watts. Then 5 W.", "At 0,1 V and 5mm, 3 in.", "A laser of 900mW here. A lamp of 2 mW.", "30-40 °C (86-104 °F). Or 30-40 °C (50-104 °F).", "6000 a day, 800 hours, 0.5 hr", "-300°C and 9001°F", "5 mmé 999999999 psi2 999999 psi", None]
    got = sorted((r.id, r.kind, r.value, r.unit) for r in Q.warnings(frame(spark, texts), "id").collect())
    assert got == [(0, "range", 60000.0, "W"), (1, "range", 0.1, "V"), (2, "machine", 900.0, "mW"), (3, "temperature", 30.0, "°C"), (4, "range", 800.0, "hr"), (4, "range", 6000.0, "A"), (5, "range", 9001.0, "°F"), (6, "range", 999999.0, "psi")]


@pytest.mark.parametrize("sentence, wrong", [("Cut it at 5 mm (0.2 in) from here.", False), ("Cut it at 5 mm (2 in) from here.", True), ("Take 2-3 oz / 0.8-1.0 mm or 0.8 mm / 1 in of hide.", True), ("Lift 2-5 kg (11 lb) of it, or 5 kg (1-12 lb).", False), ("Take 3 kg (1 in) of it.", False), ("0 °C / 90 °F is odd.", False)])
def test_sentences_that_convert_wrongly(sentence, wrong):
    assert M.misconverted(sentence) == wrong


def test_a_wrong_conversion_is_dropped():
    claims = ["cut 5 mm from the edge, 2 in long, 0.2 in"]
    text, seen, dropped, _ = M.drop_unsupported("Cut it at 5 mm (2 in) from here. Cut it at 5 mm (0.2 in) from there.", claims)
    assert (text, seen, dropped) == ("Cut it at 5 mm (0.2 in) from there.", 2, 1)


def test_what_a_pair_needs_is_searched_once(spark):
    """Before, the filters over the join repeated the searches for a pair's numbers: there were 20."""
    odd = ["2 - 3 mm (1 in)", "1,5 – 2,5 mm / 0.1 in", "٣5 kg (77 lb)", "٣ mm (1 in)", "0-4 kg (1 lb), 0-4 mm, 1 in", "-40 °F, -40 °C"]
    got = Q.pairs(frame(spark, odd), "id")
    assert sorted((r.id, r["from"], r["to"], r.a, r.b) for r in got.collect()) == [(0, "mm", "in", 2.0, 1.0), (1, "mm", "in", 2.0, 0.1), (2, "kg", "lb", 5.0, 77.0), (4, "kg", "lb", 4.0, 1.0)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract(") <= 5
