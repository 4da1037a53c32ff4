"""Rows as the publisher serves them: orders, top values, leaders, churn and trend gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.windows import top_n
from .marts import SCOPE

TOP_VALUES = 25
TREND_SWEEPS, TREND_DAYS = 14, 7
RANKS = {"day": 0, "week": 1, "month": 2}


def top_values(demand: DataFrame, n: int = TOP_VALUES) -> DataFrame:
    order = [F.desc("posting_count"), F.asc_nulls_last("value_label"), F.asc_nulls_last("value_uri")]
    return top_n(demand, [*SCOPE, "dimension"], order, n, "place").select(*SCOPE, "dimension", "value_uri", "value_label", "posting_count", F.col("place").cast("long").alias("place"))


def grain_rank(grain: Column) -> Column:
    """Custom sort order: day, week, month."""
    out = None
    for name, place in RANKS.items():
        out = F.when(grain == name, place) if out is None else out.when(grain == name, place)
    return out


def flows_in_order(flows: DataFrame) -> DataFrame:
    """Serving order of the flow rows, as a place from 1 within each scope."""
    order = Window.partitionBy(*SCOPE).orderBy(grain_rank(F.col("grain")), "bucket_start")
    return flows.select(*SCOPE, "grain", "bucket_start", F.row_number().over(order).cast("long").alias("place"))


def leader(demand: DataFrame, dimension: str) -> DataFrame:
    """The value that leads alone; a scope whose first two tie gives no row."""
    order = Window.partitionBy(*SCOPE).orderBy(F.desc("posting_count"), F.asc_nulls_last("value_label"), F.asc_nulls_last("value_uri"))
    ranked = demand.where(F.col("dimension") == dimension).select(*SCOPE, "value_uri", "value_label", "posting_count", F.row_number().over(order).alias("place"), F.lead("posting_count").over(order).alias("runner_up"))
    return ranked.where((F.col("place") == 1) & (F.col("runner_up").isNull() | (F.col("posting_count") > F.col("runner_up")))).drop("place")


def direction(flows: DataFrame) -> DataFrame:
    """First and last known stock of each scope's day buckets and what became of it, where at least two are known."""
    known = flows.where("grain = 'day' AND active_postings IS NOT NULL")
    ends = known.groupBy(*SCOPE).agg(F.count(F.lit(1)).alias("n"), F.min_by("active_postings", "bucket_start").alias("first_stock"), F.max_by("active_postings", "bucket_start").alias("last_stock")).where("n >= 2").drop("n")
    return ends.withColumn("direction", F.when(F.col("last_stock") > F.col("first_stock"), "rising").when(F.col("last_stock") < F.col("first_stock"), "falling").otherwise("flat"))


#: Orders in which the publisher serves its tables: columns to sort by, falling ones with a minus.
ORDERS = {
    "demand": ("-active_postings", "source", "country"),
    "coverage": ("source", "scope_id", "country", "-observed_at"),
    "breadth": ("source", "scope_id"),
    "dimension": ("source", "scope_id", "-posting_count", "dimension", "value_label", "value_uri"),
    "skill": ("source", "scope_id", "-posting_count", "value_label", "value_uri"),
    "mapping": ("source", "scope_id", "dimension", "mapping_status"),
    "requirement": ("source", "scope_id", "dimension", "-posting_count", "value_label", "value_code"),
    "frequency": ("source", "scope_id"),
    "mapping_coverage": ("source", "scope_id", "dimension"),
    "provenance": ("source", "scope_id"),
}


def in_order(table: DataFrame, name: str) -> DataFrame:
    """``table`` sorted as it is served; nulls come last either way."""
    return table.orderBy(*(F.col(c[1:]).desc_nulls_last() if c[0] == "-" else F.col(c).asc_nulls_last() for c in ORDERS[name]))


def places(table: DataFrame, name: str, by: list[str]) -> DataFrame:
    """The place of each row within its group, in the order that the table is served in."""
    order = [F.col(c[1:]).desc_nulls_last() if c[0] == "-" else F.col(c).asc_nulls_last() for c in ORDERS[name] if c.lstrip("-") not in by]
    return table.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long"))


def latest_coverage(coverage: DataFrame) -> DataFrame:
    """The newest sweep's coverage of each scope, by time and then by id."""
    return top_n(coverage, list(SCOPE), [F.desc("observed_at"), F.desc("sweep_id")], 1)


def outcomes_by_status(quality: DataFrame) -> DataFrame:
    """Mapping outcomes added up over methods, confidences and versions."""
    return quality.groupBy(*SCOPE, "dimension", "mapping_status").agg(F.sum("outcome_count").cast("long").alias("outcome_count"))


def bars(demand: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` regions of each scope with their share of its largest."""
    top = top_values(demand.where("dimension = 'region'"), n)
    return top.withColumn("share", F.col("posting_count") / F.max("posting_count").over(Window.partitionBy(*SCOPE)))


def scope_groups(demand: DataFrame) -> DataFrame:
    """Each source with its scopes in serving order: largest first, then by name."""
    ranked = F.struct((-F.col("active_postings")).alias("n"), "scope_id")
    grouped = demand.groupBy("source").agg(F.array_sort(F.collect_list(ranked)).alias("ranked"), F.sum("active_postings").alias("active_postings"))
    return grouped.select("source", F.array_join(F.transform("ranked", lambda r: r["scope_id"]), ",").alias("scopes"), "active_postings")


def dense_axis(flows: DataFrame) -> DataFrame:
    """Buckets of each scope and grain from first to last, in steps of the grain; those without a row have nulls."""
    rows = flows.select(*SCOPE, "grain", F.to_date("bucket_start").alias("bucket"), "openings", "closures", "active_postings")
    ends = rows.groupBy(*SCOPE, "grain").agg(F.min("bucket").alias("a"), F.max("bucket").alias("b"))
    step = F.expr("CASE grain WHEN 'day' THEN sequence(a, b, interval 1 day) WHEN 'week' THEN sequence(a, b, interval 7 days) ELSE sequence(a, b, interval 1 month) END")
    return ends.select(*SCOPE, "grain", F.explode(step).alias("bucket")).join(rows, [*SCOPE, "grain", "bucket"], "left")


def gap_markers(flows: DataFrame) -> DataFrame:
    """Day buckets that come more than a day after the one before."""
    before = F.lag("bucket_start").over(Window.partitionBy(*SCOPE).orderBy("bucket_start"))
    gaps = flows.where("grain = 'day'").select(*SCOPE, "bucket_start", F.datediff("bucket_start", before).cast("long").alias("gap_days"))
    return gaps.where("gap_days > 1")
