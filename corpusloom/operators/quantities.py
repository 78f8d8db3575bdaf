"""Quantities in texts: a number or range with its unit, found once, and the rules that look at them.

A number may have a decimal point or comma, a range a hyphen or dash; units may be spelled. Rules: neighbours in two units
must be conversions of each other within 15 %; a number must be plausible for its unit; milliwatts beside a laser or a
machine tool are taken for watts; a range in °C and its °F must agree within 15 °F. Unit tables are dimensions of fixed size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.lists import CONVERSIONS, MACHINES, RANGES, SPELLED_UNITS

TOLERANCE, DEGREES = 0.15, 15
NUMBER = X.NUMBER
COUNTED = rf"(?U)({NUMBER})(\s*)([a-zA-Z°µ]+)\b"
MILLIWATTS = rf"(?U)({NUMBER})\s*mW\b"
TEMPERATURES = rf"(?U)({NUMBER})\s*[-–]\s*({NUMBER})\s*°C\b\s*\(\s*({NUMBER})\s*[-–]\s*({NUMBER})\s*°F\b"


def _number(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit(".")).try_cast("double")


def found(text: Column, pattern: str, *names: str) -> Column:
    """The groups of each match as a struct."""
    groups = [F.regexp_extract_all(text, F.lit(pattern), i).alias(n) for i, n in enumerate(names, 1)]
    return F.arrays_zip(*groups)


def _unit(c: Column) -> Column:
    return F.when(c.startswith("inch"), "in").otherwise(c)


def pairs(texts: DataFrame, *keys: str) -> DataFrame:
    """keys, from, to, a, b, expected, error and warn of neighbouring quantities in two units that convert. Of ranges the means
    are compared, of kilograms and pounds single numbers. A number 0, or one that converts to 0, is no pair."""
    each = texts.select(*keys, F.inline(found(F.col("text"), X.PAIR, "a", "from", "b", "to"))).withColumns({"from": _unit(F.col("from")), "to": _unit(F.col("to"))})
    # What is taken out of a string is a column of its own below the join: filters over it repeat a name, not the search.
    ends = [c.alias(f"{name}_{end}") for name in ("a", "b") for end, c in zip(("low", "high"), X.range_ends(F.col(name)))]
    each = each.select(*keys, "from", "to", *ends, F.regexp_extract("a", rf"({NUMBER})\s*$", 1).alias("a_last"), F.col("b").rlike("[-–]").alias("ranged"))
    a_mean, y = (X.mean_of_ends(F.col(f"{name}_low"), F.col(f"{name}_high")) for name in ("a", "b"))
    each = each.select(*keys, "from", "to", "ranged", X.as_number(F.col("a_low")).alias("a"), a_mean.alias("a_mean"), y.alias("y"), X.as_number(F.replace("a_last", F.lit(","), F.lit("."))).alias("a_last"))
    rules = texts.sparkSession.createDataFrame(CONVERSIONS, "from string, to string, factor double, shift double, single boolean")
    first, x = F.when(F.col("single"), F.col("a_last")).otherwise(F.col("a")), F.when(F.col("single"), F.col("a_last")).otherwise(F.col("a_mean"))
    out = each.join(F.broadcast(rules), ["from", "to"]).where(~(F.col("single") & F.col("ranged")) & (first != 0)).withColumn("x", x)
    out = out.withColumn("expected", F.col("x") * F.col("factor") + F.col("shift")).where("expected <> 0").withColumn("error", F.abs(F.col("expected") - F.col("y")) / F.abs("expected"))
    return out.select(*keys, "from", "to", F.col("x").alias("a"), F.col("y").alias("b"), "expected", "error", (F.col("error") > TOLERANCE).alias("warn"))


def warnings(texts: DataFrame, *keys: str) -> DataFrame:
    """keys, kind (range, machine, temperature), value and unit of each quantity that isn't plausible."""
    s = texts.select(*keys, F.explode(F.split("text", r"(?<=[.!?])\s+(?=[A-Z])")).alias("s"))
    spelled = texts.sparkSession.createDataFrame([(w, u, glued) for u, words, glued in SPELLED_UNITS for w in words], "word string, unit string, glued boolean")
    limits = texts.sparkSession.createDataFrame(RANGES, "unit string, low double, high double")
    units = F.broadcast(spelled.join(limits, "unit"))
    counted = s.select(*keys, F.inline(found(F.col("s"), COUNTED, "n", "gap", "word"))).withColumn("word", F.lower("word")).join(units, "word")
    value = _number(F.col("n"))
    outside = counted.where((F.col("glued") | (F.col("gap") != "")) & ((value < F.col("low")) | (value > F.col("high")))).select(*keys, F.lit("range").alias("kind"), value.alias("value"), "unit")
    near = s.where(F.col("s").rlike(rf"(?i)(?U)\b({'|'.join(MACHINES)})\b"))
    machine = near.select(*keys, F.lit("machine").alias("kind"), F.explode(F.regexp_extract_all("s", F.lit(MILLIWATTS), 1)).alias("value")).select(*keys, "kind", _number(F.col("value")).alias("value"), F.lit("mW").alias("unit"))
    t = s.select(*keys, F.inline(found(F.col("s"), TEMPERATURES, "c1", "c2", "f1", "f2")))
    off = lambda c, f: F.abs(_number(F.col(f)) - (_number(F.col(c)) * 9 / 5 + 32)) > DEGREES
    degrees = t.where(off("c1", "f1") | off("c2", "f2")).select(*keys, F.lit("temperature").alias("kind"), _number(F.col("c1")).alias("value"), F.lit("°C").alias("unit"))
    return outside.unionByName(machine).unionByName(degrees)
