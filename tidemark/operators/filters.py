"""Filters that a reader may set: a row that lacks an attribute is never filtered out by it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def matching(rows: DataFrame, wanted: dict[str, str | None], since: str | None = None, until: str | None = None, bucket: str = "bucket") -> DataFrame:
    """Rows that the wanted values and bounds let through; None and '' want nothing. Values are parameters, never SQL text."""
    wanted = {k: v for k, v in wanted.items() if v not in (None, "")}
    tests = [f"(coalesce(`{k}`, '') = '' OR `{k}` = :{k})" for k in wanted]
    bounds = {"since": since, "until": until}
    if bucket in rows.columns:
        tests += [f"(coalesce(`{bucket}`, '') = '' OR `{bucket}` {sign} :{k})" for k, sign in (("since", ">="), ("until", "<=")) if bounds[k]]
    used = wanted | {k: v for k, v in bounds.items() if v and bucket in rows.columns}
    return rows.sparkSession.sql("SELECT * FROM {rows}" + (" WHERE " + " AND ".join(tests) if tests else ""), args=used, rows=rows)


def by_dimension(rows: DataFrame, region: bool) -> DataFrame:
    """The region rows, or all others."""
    return rows.sparkSession.sql("SELECT * FROM {rows} WHERE (dimension = 'region') = :region", args={"region": region}, rows=rows)


def filter_counts(rows: DataFrame, attributes: list[str]) -> DataFrame:
    """(attributes..., n): how many rows every occurring combination of filters lets through; null is a filter that is not set.

    One pass counts the rows by their attributes and their grouping sets. A
    combination's rows are then those that have its values or lack the
    attribute: at most two to the power of its set filters counts, looked up
    among the sets.
    """
    filled = rows.select(*(F.nullif(F.col(a), F.lit("")).alias(a) for a in attributes))
    counted = filled.groupBy(*attributes).agg(F.count(F.lit(1)).alias("n"))
    sets = counted.cube(*attributes).agg(F.sum("n").alias("n"), *(F.grouping(a).alias(f"_all_{a}") for a in attributes))
    # v...: a value, m: the attribute is missing, a: whatever it is
    token = lambda a: F.when(F.col(f"_all_{a}") == 1, "a").when(F.col(a).isNull(), "m").otherwise(F.concat(F.lit("v"), F.col(a)))
    told = sets.select(*(token(a).alias(a) for a in attributes), "n")
    asked = told.where(reduce(Column.__and__, (F.col(a) != "m" for a in attributes))).select(*(F.col(a).alias(f"_{a}") for a in attributes))
    for a in attributes:
        asked = asked.withColumn(a, F.explode(F.when(F.col(f"_{a}") == "a", F.array(F.col(f"_{a}"))).otherwise(F.array(F.col(f"_{a}"), F.lit("m")))))
    found = asked.join(told, attributes, "left").groupBy(*(f"_{a}" for a in attributes)).agg(F.sum("n").cast("long").alias("n"))
    return found.select(*(F.when(F.col(f"_{a}") != "a", F.expr(f"substring(`_{a}`, 2)")).alias(a) for a in attributes), "n")
