"""Mapping evaluation: precision and recall, strict and lenient; collision census."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

READINGS = ("strict", "lenient")


def _metrics(outcomes: DataFrame, inexact: Column) -> DataFrame:
    """One row of tallies of (hits, surplus, missed), precision and recall under both readings.

    An inexact match counts as a hit in the lenient reading; in the strict one
    precision pays for it and recall is left alone.
    """
    loose = F.coalesce(inexact, F.lit(False))
    counts = {
        "strict_tp": F.when(loose, 0).otherwise(F.col("hits")),
        "strict_fp": F.col("surplus") + F.when(loose, F.col("hits")).otherwise(0),
        "strict_fn": F.col("missed"),
        "lenient_tp": F.col("hits"),
        "lenient_fp": F.col("surplus"),
        "lenient_fn": F.col("missed"),
    }
    added = outcomes.agg(*(F.coalesce(F.sum(v), F.lit(0)).cast("long").alias(k) for k, v in counts.items()))
    rates = [F.try_divide(F.col(f"{r}_tp"), F.col(f"{r}_tp") + F.col(f"{r}_{other}")).alias(f"{r}_{name}") for r in READINGS for name, other in (("precision", "fp"), ("recall", "fn"))]
    return added.select("*", *rates)


def precision_recall(reviews: DataFrame) -> DataFrame:
    """Tallies over (produced, expected, verdict): what should have been refused costs precision if it was mapped; what was refused costs recall."""
    produced, expected = F.col("produced").isNotNull(), F.col("expected").isNotNull()
    same = F.coalesce(F.col("produced") == F.col("expected"), F.lit(False))
    one = lambda c: F.when(c, 1).otherwise(0)
    outcomes = reviews.select("verdict", one(same).alias("hits"), one(produced & ~same).alias("surplus"), one(expected & ~same).alias("missed"))
    return _metrics(outcomes, F.col("verdict") == "narrower-or-broader")


def set_tallies(reviews: DataFrame) -> DataFrame:
    """The same for sets of URIs per row (produced_set, expected_set, verdict)."""
    size = lambda a, b: F.size(F.array_except(F.array_compact(a), F.array_compact(b)))
    common = F.size(F.array_intersect(F.array_compact("produced_set"), F.array_compact("expected_set")))
    outcomes = reviews.select("verdict", common.alias("hits"), size("produced_set", "expected_set").alias("surplus"), size("expected_set", "produced_set").alias("missed"))
    return _metrics(outcomes, F.col("verdict") == "narrower-or-broader")


def refusals(reviews: DataFrame) -> DataFrame:
    """How often the mapper refused, rightly and wrongly."""
    refused, expected = F.col("produced").isNull(), F.col("expected").isNotNull()
    return reviews.agg(F.count_if(refused & ~expected).alias("correct_refusals"), F.count_if(refused & expected).alias("incorrect_refusals"))


def collision_census(candidates: DataFrame, audited: DataFrame) -> DataFrame:
    """Of the concepts (concept, target_uri, relation) whose sole exact match wins over other candidates: all, those whose target another concept matches exactly too, and of these the ones in ``audited`` (concept)."""
    exact = candidates.where("relation = 'exact-match'")
    claimed = exact.groupBy("target_uri").agg(F.countDistinct("concept").alias("claimants"))
    is_exact = F.col("relation") == "exact-match"
    sole = candidates.groupBy("concept").agg(F.count(F.lit(1)).alias("n"), F.count_if(is_exact).alias("n_exact"), F.min(F.when(is_exact, F.col("target_uri"))).alias("target_uri")).where("n > 1 AND n_exact = 1")
    seen = audited.select("concept").distinct().withColumn("audited", F.lit(True))
    rival = F.col("claimants") > 1
    told = sole.join(claimed, "target_uri").join(seen, "concept", "left")
    return told.agg(F.count(F.lit(1)).alias("tiebroken_concepts"), F.count_if(rival).alias("with_rival_exact_match"), F.count_if(rival & F.coalesce("audited", F.lit(False))).alias("in_review_sample"))
