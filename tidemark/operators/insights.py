"""Generated findings: each rule is a filter over one or two marts and says nothing when its gate is shut."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .marts import SCOPE
from .serving import TREND_DAYS, TREND_SWEEPS, leader, top_values

# The codes that the share rules read, and the wording of the findings.
EMPLOYMENT = ("kpPX_CNN_gDU", "sTu5_NBQ_udq")
WORKING_HOURS = ("6YE1_gAC_R2G", "947z_JGS_Uk2")
SENTENCES = {
    "latest_count": "The latest complete sweep observed %,d active posting(s) on %s.",
    "most_requested_occupation": "The most frequently mapped occupation is %s, in %,d of %,d mapped posting(s).",
    "most_requested_skill": "The most frequently mapped skill is %s, asked for in %,d of %,d posting(s) with a mapped skill.",
    "employment_type_shares": "Of %,d postings in the latest sweep, %,d are permanent employment and %,d are fixed-term employment.",
    "working_hours_type_shares": "Of %,d postings in the latest sweep, %,d are full-time and %,d are part-time.",
    "median_duration": "The median observed duration is %.1f days across the %,d closed posting(s); postings still open are right-censored and are excluded.",
    "region_concentration": "The leading region is %s, with %,d of %,d mapped posting(s) in this sweep.",
    "sweep_churn": "Between the two most recent daily buckets (%s), %,d posting(s) opened and %,d closed, leaving %,d active.",
    "trend": "Active postings %s from %,d on %s to %,d on %s.",
    "trend_flat": "Active postings were unchanged at %,d between %s and %s.",
}
CLOSED = ("source_reported", "inferred_absence")


def _said(rows: DataFrame, section: str, rule: str, text: Column, evidence: dict[str, Column]) -> DataFrame:
    facts = F.create_map(*(x for k, v in evidence.items() for x in (F.lit(k), v.cast("string"))))
    return rows.select(*SCOPE, F.lit(section).alias("section"), F.lit(rule).alias("rule"), text.alias("text"), facts.alias("evidence"))


def _day(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def latest_count(demand: DataFrame) -> DataFrame:
    n = F.col("active_postings")
    text = F.format_string(SENTENCES["latest_count"], n, _day("observed_at"))
    return _said(demand.where(n > 0), "overview", "latest_count", text, {"active_postings": n, "observed_at": _day("observed_at")})


def _ranked(values: DataFrame, coverage: DataFrame, dimension: str) -> DataFrame:
    """The unique leader with its totals, if its count fits within the mapped and all postings."""
    totals = coverage.where(F.col("dimension") == dimension).select(*SCOPE, "postings_total", "postings_mapped")
    fits = "posting_count > 0 AND posting_count <= postings_mapped AND postings_mapped <= postings_total AND value_label <> ''"
    return leader(values, dimension).join(totals, SCOPE).where(fits)


def most_requested(values: DataFrame, coverage: DataFrame, dimension: str) -> DataFrame:
    text = F.format_string(SENTENCES[f"most_requested_{dimension}"], "value_label", "posting_count", "postings_mapped")
    return _said(_ranked(values, coverage, dimension), "demand", f"most_requested_{dimension}", text, {c: F.col(c) for c in ("value_label", "posting_count", "postings_mapped", "postings_total")})


def requirement_shares(requirements: DataFrame, dimension: str, codes: tuple[str, str]) -> DataFrame:
    """Counts of two codes out of all, if both occur."""
    picked = [F.max(F.when(F.col("value_code") == c, F.col("posting_count"))).alias(f"n{i}") for i, c in enumerate(codes)]
    rows = requirements.where(F.col("dimension") == dimension).groupBy(*SCOPE).agg(F.sum("posting_count").alias("total"), *picked)
    n0, n1, total = F.col("n0"), F.col("n1"), F.col("total")
    text = F.format_string(SENTENCES[f"{dimension}_shares"], total, n0, n1)
    return _said(rows.where((n0 > 0) & (n1 > 0) & (n0 + n1 <= total)), "requirements", f"{dimension}_shares", text, {"total": total, "first": n0, "second": n1})


def median_duration(survival: DataFrame) -> DataFrame:
    """Median days of the one closed basis that a scope has, uncensored and unmasked."""
    closed = survival.where(F.col("lifecycle_status").isin(*CLOSED))
    single = closed.groupBy(*SCOPE).agg(F.count(F.lit(1)).alias("bases"), F.bool_or("any_right_censored").alias("censored"), F.max("median_duration_days").alias("days"), F.max("posting_count").alias("n"), F.max("lifecycle_status").alias("basis"))
    rows = single.where((F.col("bases") == 1) & ~F.col("censored") & F.col("days").isNotNull() & (F.col("n") > 0))
    return _said(rows, "survival", "median_duration", F.format_string(SENTENCES["median_duration"], "days", "n"), {"lifecycle_status": F.col("basis"), "posting_count": F.col("n"), "median_duration_days": F.col("days")})


def freshness_warning(coverage: DataFrame, latest: DataFrame) -> DataFrame:
    """Which condition of freshness or coverage the latest sweep fails; a fresh, covered one gives no row."""
    rows = coverage.join(latest.select(*SCOPE, "sweep_id"), [*SCOPE, "sweep_id"], "left_semi")
    age = F.col("freshness_age_hours")
    fresh = (
        F.when((F.col("freshness_status") == "stale") & age.isNotNull(), F.format_string("the latest sweep is %.0f hours old, past its freshness threshold", age))
        .when(F.col("freshness_status") == "stale", "the latest sweep is past its freshness threshold")
        .when(F.col("freshness_status") == "unknown", "the latest sweep has unknown freshness")
    )
    covered = F.when(F.col("coverage_status") == "invalid", F.format_string("it stored %,d of %,d expected row(s)", "observed_rows", "expected_rows")).when(F.col("coverage_status") == "unknown_metadata", "its coverage is uncertified because sweep approval or metadata is incomplete")
    clauses = F.array_compact(F.array(fresh, covered))
    text = F.concat(F.lit("Read the figures with care: "), F.array_join(clauses, "; "), F.lit("."))
    return _said(rows.where(F.size(clauses) > 0), "overview", "freshness_warning", text, {"freshness": F.col("freshness_status"), "coverage": F.col("coverage_status")})


def region_concentration(values: DataFrame, coverage: DataFrame) -> DataFrame:
    """The leading region out of all mapped postings, where at least two regions occur and one leads alone."""
    totals = values.where("dimension = 'region' AND posting_count > 0").groupBy(*SCOPE).agg(F.count(F.lit(1)).alias("regions")).where("regions >= 2")
    rows = _ranked(values, coverage, "region").join(totals, SCOPE)
    text = F.format_string(SENTENCES["region_concentration"], "value_label", "posting_count", "postings_mapped")
    return _said(rows, "regions", "region_concentration", text, {"region_label": F.col("value_label"), "leader_postings": F.col("posting_count"), "mapped_postings": F.col("postings_mapped")})


def newest_pair(flows: DataFrame) -> DataFrame:
    """The two newest day buckets of each scope in one row: bucket_start, openings, closures, active_postings of the newer, before and days_apart."""
    order = Window.partitionBy(*SCOPE).orderBy(F.desc("bucket_start"))
    days = flows.where("grain = 'day'")
    pair = days.select("*", F.row_number().over(order).alias("_place"), F.lead("bucket_start").over(order).alias("older"), F.lead("active_postings").over(order).alias("before"))
    return pair.where("_place = 1 AND older IS NOT NULL").withColumn("days_apart", F.datediff("bucket_start", "older").cast("long")).drop("_place")


def sweep_churn(flows: DataFrame) -> DataFrame:
    """Openings, closures and stock of the newest day bucket, whatever its distance from the one before; silent if any is masked."""
    rows = newest_pair(flows).where("openings IS NOT NULL AND closures IS NOT NULL AND active_postings IS NOT NULL")
    apart = F.when(F.col("days_apart") > 1, F.format_string("%d days apart", "days_apart")).otherwise("one day apart")
    text = F.format_string(SENTENCES["sweep_churn"], apart, "openings", "closures", "active_postings")
    return _said(rows, "flows", "sweep_churn", text, {c: F.col(c) for c in ("openings", "closures", "active_postings", "days_apart")} | {"newer_bucket": _day("bucket_start")})


def stock_trend(flows: DataFrame, frequency: DataFrame) -> DataFrame:
    """Change of the stock between the two newest day buckets, if they are adjacent and unmasked and the scope was swept often and long enough."""
    span = F.datediff("last_observed_at", "first_observed_at")
    enough = frequency.where((F.col("complete_sweeps") >= TREND_SWEEPS) & (span >= TREND_DAYS)).select(*SCOPE, "complete_sweeps", span.alias("span_days"))
    rows = newest_pair(flows).where("days_apart = 1 AND before IS NOT NULL AND active_postings IS NOT NULL").join(enough, SCOPE)
    before, after = F.col("before"), F.col("active_postings")
    direction = F.when(after > before, "rose").otherwise("fell")
    text = F.when(after == before, F.format_string(SENTENCES["trend_flat"], before, _day("older"), _day("bucket_start"))).otherwise(F.format_string(SENTENCES["trend"], direction, before, _day("older"), after, _day("bucket_start")))
    return _said(rows, "flows", "trend", text, {"before": before, "after": after, "before_date": _day("older"), "after_date": _day("bucket_start"), "complete_sweeps": F.col("complete_sweeps"), "span_days": F.col("span_days")})


def ranking_shortfall(values: DataFrame, coverage: DataFrame, dimension: str, listed: int = 25) -> DataFrame:
    """What a ranking is drawn from, and how much of it the listed values leave out."""
    shown = top_values(values.where(F.col("dimension") == dimension), listed).groupBy(*SCOPE).agg(F.sum("posting_count").alias("shown"), F.count(F.lit(1)).alias("n_listed"))
    rows = coverage.where((F.col("dimension") == dimension) & (F.col("postings_total") > 0)).join(shown, SCOPE)
    drawn = F.format_string(f"Ranked from %,d mapped posting(s) of %,d in the latest sweep; %,d carry a structured {dimension}.", "postings_mapped", "postings_total", "postings_with_source_value")
    tail = F.format_string(f" Only the %,d most frequent {dimension}s are listed below, accounting for %,d of those mapped postings; the rest sit in an unlisted tail.", "n_listed", "shown")
    text = F.when(F.col("shown") < F.col("postings_mapped"), F.concat(drawn, tail)).otherwise(drawn)
    return _said(rows, "demand", f"{dimension}_shortfall", text, {"shown": F.col("shown"), "mapped": F.col("postings_mapped")})


def empty_by_construction(coverage: DataFrame) -> DataFrame:
    """Dimensions on which a source tells nothing although it has postings."""
    rows = coverage.where("postings_total > 0 AND postings_with_source_value = 0")
    return _said(rows, "coverage", "empty_by_construction", F.format_string("The source tells nothing on %s.", "dimension"), {"postings": F.col("postings_total")})


def run_state(coverage: DataFrame) -> DataFrame:
    """One sentence a sweep on its age and on missing, surplus or foreign rows."""
    age, threshold = F.col("freshness_age_hours"), F.col("freshness_threshold_hours")
    aged = F.when(age.isNotNull(), F.format_string("is %.1f days old", age / 24)).otherwise("has an unknown age")
    late = F.when(threshold.isNotNull(), F.format_string("which is past the %s hour freshness threshold, so read it as out of date", threshold.cast("string"))).otherwise("which is past the source freshness threshold, so read it as out of date")
    fresh = F.when(F.col("freshness_status") == "fresh", "which is inside the source freshness threshold").when(F.col("freshness_status") == "stale", late).otherwise("and no freshness threshold is recorded for it")
    observed, expected = F.col("observed_rows"), F.col("expected_rows")
    stored = (
        F.when(observed < expected, F.format_string("It stored %,d of %,d expected row(s), so rows are missing.", observed, expected))
        .when(observed > expected, F.format_string("It stored %,d row(s) against %,d expected, so it holds more than its own manifest.", observed, expected))
        .when(F.col("coverage_status") == "invalid", F.format_string("It stored the expected %,d row(s), but some of them fall outside the expected country.", observed))
        .otherwise(F.format_string("It stored all %,d expected row(s).", observed))
    )
    more = F.when(F.col("coverage_status") == "unknown_metadata", " Coverage is uncertified because sweep approval or metadata is incomplete.").otherwise("")
    text = F.concat(F.lit("The last complete sweep "), aged, F.lit(", "), fresh, F.lit(". "), stored, more)
    return _said(coverage, "overview", "run_state", text, {"missing": expected - observed})


def every(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
