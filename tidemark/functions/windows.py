"""Ranked rows per group, written so that Catalyst can cut each group early."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, by: list[str], order: list[Column], n: int, rank: str | None = None) -> DataFrame:
    """The first ``n`` rows of each group; ``rank`` names a column that keeps their place."""
    name = rank or "_place"
    found = df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(name) <= n)
    return found if rank else found.drop(name)


def latest_by(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    return top_n(df, by, order, 1)


def gap(at: str, by: list[str], difference) -> Column:
    """Difference of ``at`` from the row before in its group."""
    return difference(F.lag(at).over(Window.partitionBy(*by).orderBy(at)), F.col(at))


def partition_total(value: str, by: list[str]) -> Column:
    return F.sum(value).over(Window.partitionBy(*by))
