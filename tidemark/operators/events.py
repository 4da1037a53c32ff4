"""The event log of presences and closures, and right-censored lifecycles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import day_boundaries, last_known
from .staging import IDENTITY

CALENDAR = ["source", "scope_id", "hmac_key_version"]


def _place() -> F.Column:
    return F.struct("observed_at", "sweep_id")


def last_seen(postings: DataFrame) -> DataFrame:
    return postings.groupBy(*IDENTITY).agg(F.max("observed_at").alias("last_seen_at"), F.max_by("sweep_id", _place()).alias("last_seen_sweep_id"), F.min("removed_at").alias("removed_at"))


def closure_calendar(sweeps: DataFrame) -> DataFrame:
    """For every sweep time the next one of the same source, scope and key version.

    A posting's last sighting is always the time of an admitted sweep, so the
    first later sweep is a lookup here: an equi-join with one match, where the
    inequality join would pair every posting with all later sweeps.
    """
    times = sweeps.groupBy(*CALENDAR, "observed_at").agg(F.min("sweep_id").alias("sweep_id"))
    order = Window.partitionBy(*CALENDAR).orderBy("observed_at")
    return times.select(*CALENDAR, F.col("observed_at").alias("last_seen_at"), F.lead("observed_at").over(order).alias("next_at"), F.lead("sweep_id").over(order).alias("next_sweep_id"))


def closures(postings: DataFrame, sweeps: DataFrame) -> DataFrame:
    """Closed postings: by the source's word, else by absence from the first later complete sweep."""
    found = last_seen(postings).join(closure_calendar(sweeps), [*CALENDAR, "last_seen_at"], "left")
    return _closures(found)


def closures_direct(postings: DataFrame, sweeps: DataFrame) -> DataFrame:
    """The same by the inequality join, to hold the calendar against."""
    seen = last_seen(postings)
    later = sweeps.select(*CALENDAR, F.col("observed_at").alias("later_at"), F.col("sweep_id").alias("later_sweep_id"))
    joined = seen.join(later, CALENDAR).where("later_at > last_seen_at").groupBy(*IDENTITY).agg(F.min("later_at").alias("next_at"), F.min_by("later_sweep_id", F.struct("later_at", "later_sweep_id")).alias("next_sweep_id"))
    return _closures(seen.join(joined, IDENTITY, "left"))


def _closures(found: DataFrame) -> DataFrame:
    reported = F.col("removed_at").isNotNull()
    return found.where(reported | F.col("next_at").isNotNull()).select(
        *IDENTITY,
        F.when(reported, F.col("last_seen_sweep_id")).otherwise(F.col("next_sweep_id")).alias("sweep_id"),
        F.coalesce("removed_at", "next_at").alias("event_at"),
        F.lit("closure").alias("event_type"),
        F.when(reported, "source_reported").otherwise("inferred_absence").alias("event_basis"),
    )


def posting_events(postings: DataFrame, sweeps: DataFrame) -> DataFrame:
    presences = postings.select(*IDENTITY, "sweep_id", F.col("observed_at").alias("event_at"), F.lit("presence").alias("event_type"), F.lit("observed").alias("event_basis"))
    return presences.unionByName(closures(postings, sweeps))


def posting_lifecycle(postings: DataFrame, sweeps: DataFrame) -> DataFrame:
    """One row per pseudonymous posting: first and last sighting, closure, censoring, duration in days."""
    seen = postings.groupBy(*IDENTITY).agg(
        F.min("observed_at").alias("first_seen_at"),
        F.min_by("sweep_id", _place()).alias("first_seen_sweep_id"),
        F.max("observed_at").alias("last_seen_at"),
        F.max_by("sweep_id", _place()).alias("last_seen_sweep_id"),
        F.countDistinct("sweep_id").alias("observation_count"),
        last_known("number_of_vacancies", _place()).cast("long").alias("advertised_vacancies"),
    )
    closed = closures(postings, sweeps).select(*IDENTITY, F.col("event_at").alias("closure_at"), F.col("event_basis").alias("closure_basis"))
    return seen.join(closed, IDENTITY, "left").select(
        *seen.columns,
        "closure_at",
        "closure_basis",
        F.coalesce("closure_basis", F.lit("active")).alias("lifecycle_status"),
        F.col("closure_at").isNull().alias("is_right_censored"),
        day_boundaries(F.col("first_seen_at"), F.coalesce("closure_at", "last_seen_at")).alias("posting_duration_days"),
    )
