"""Comparing snapshots, folding logs, and tables of differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reconcile(older: DataFrame, newer: DataFrame, key: str, expiry: DataFrame | None = None, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """(key, state[, removed_at]): closed, added or unchanged between two sweeps.

    A closed posting whose expiry date (table of key, expires_at) lies within
    the window is removed on that date, any other at the window's end.
    """
    old, new = older.select(key).distinct(), newer.select(key).distinct()
    closed = old.join(new, key, "left_anti").withColumn("state", F.lit("closed"))
    added = new.join(old, key, "left_anti").withColumn("state", F.lit("added"))
    same = new.join(old, key, "left_semi").withColumn("state", F.lit("unchanged"))
    out = closed.unionByName(added).unionByName(same)
    if expiry is None:
        return out
    told = out.join(expiry, key, "left")
    return told.withColumn("removed_at", F.when(F.col("state") == "closed", F.when(F.col("expires_at").between(start, end), F.col("expires_at")).otherwise(end))).drop("expires_at")


def fold_log(log: DataFrame, key: list[str], order: Column, values: list[str]) -> DataFrame:
    """Last entry per key with the number of entries."""
    last = log.groupBy(*key).agg(F.max_by(F.struct(*values), order).alias("last"), F.count(F.lit(1)).alias("entries"))
    return last.select(*key, "last.*", "entries")


def keep_first(log: DataFrame, key: list[str], order: Column, values: list[str]) -> DataFrame:
    """First entry per key, by an explicit order."""
    return log.groupBy(*key).agg(F.min_by(F.struct(*values), order).alias("first")).select(*key, "first.*")


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of one side only, with the side."""
    return a.subtract(b).withColumn("side", F.lit("left")).unionByName(b.subtract(a).withColumn("side", F.lit("right")))
