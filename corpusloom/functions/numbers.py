"""Means and rounding that depend on the rows alone, not on how a run deals them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rounded(x: Column, digits: int) -> Column:
    """The scaled double rounded half away from zero and scaled back, as databases do; F.round goes by the shortest
    decimal form, and takes 0.71 / 200 to 0.0035 instead of 0.0036."""
    return F.round(x * float(10**digits)) / float(10**digits)


def running(rows: DataFrame, value: str, keys: list[str], order: list[str]) -> DataFrame:
    """rows with place and total: the sum of a group's values up to each row. Doubles are added in the given order, so the
    last total doesn't hang on partitions or on which of them is merged first. A sort, no group is held."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumns({"place": F.row_number().over(w), "total": F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0))})


def last_mean(value: str) -> Column:
    """The mean of a group of rows that running() made."""
    return F.max_by("total", "place") / F.count(value)
