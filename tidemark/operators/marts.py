"""The published marts, one function each: pure, lazy, no side effects."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import bucket, hour_boundaries, is_suppressed, mask_small, second_boundaries
from ..functions.windows import gap, latest_by, partition_total
from .staging import POSTING_KEYS, SWEEP_KEYS

GRAINS = ("day", "week", "month")
REQUIREMENTS = ("employment_type", "working_hours_type", "duration")
SCOPE = ["source", "scope_id"]


#: Columns of the latest sweeps, by contract.
LATEST_COLUMNS = (
    "source", "scope_id", "partition_id", "sweep_id", "run_id", "observed_at", "started_at", "completed_at", "status", "row_count", "hmac_key_version", "source_version", "licence_reference", "access_method",
    "approval_status", "expected_country", "freshness_threshold_hours", "coverage_limitations", "reference_hashes", "nuts_version", "jobtech_taxonomy_version", "esco_version",
)
#: What a sweep tells about its source.
PROVENANCE = ("source_version", "licence_reference", "access_method", "approval_status")


def latest_sweeps(sweeps: DataFrame) -> DataFrame:
    return latest_by(sweeps.select(*LATEST_COLUMNS), SCOPE, [F.desc("observed_at"), F.desc("completed_at"), F.desc("sweep_id")])


def _of_latest(rows: DataFrame, latest: DataFrame) -> DataFrame:
    """Rows of the latest sweeps. Latest is one small row per scope, which Spark broadcasts by its own size check."""
    return rows.join(latest.select(*SWEEP_KEYS), SWEEP_KEYS, "left_semi")


def source_coverage(sweeps: DataFrame, postings: DataFrame, reference_time: Column) -> DataFrame:
    """Rows found against rows promised, freshness and coverage of every sweep, empty sweeps included."""
    countries = sweeps.select(*SWEEP_KEYS, F.col("expected_country").alias("wanted"))
    counted = postings.select(*SWEEP_KEYS, "source_id", "country").join(countries, SWEEP_KEYS).groupBy(*SWEEP_KEYS).agg(F.count("source_id").alias("observed_rows"), F.count(F.when(F.col("country") != F.col("wanted"), F.col("source_id"))).alias("wrong_country_rows"))
    rows = sweeps.join(counted, SWEEP_KEYS, "left").fillna(0, ["observed_rows", "wrong_country_rows"])
    age = second_boundaries(F.col("observed_at"), reference_time) / F.lit(3600.0)
    unknown = (F.col("approval_status") != "approved") | reduce(lambda a, b: a | b, [F.col(c).isNull() for c in ("source_version", "licence_reference", "access_method", "expected_country", "freshness_threshold_hours")])
    return rows.select(
        *SWEEP_KEYS,
        F.col("expected_country").alias("country"),
        "observed_at",
        F.col("row_count").alias("expected_rows"),
        "observed_rows",
        *PROVENANCE,
        "freshness_threshold_hours",
        "coverage_limitations",
        age.alias("freshness_age_hours"),
        F.when(F.col("freshness_threshold_hours").isNull(), "unknown").when(age > F.col("freshness_threshold_hours"), "stale").otherwise("fresh").alias("freshness_status"),
        F.when(unknown, "unknown_metadata").when((F.col("observed_rows") != F.col("row_count")) | (F.col("wrong_country_rows") > 0), "invalid").otherwise("covered").alias("coverage_status"),
    )


def labour_demand(latest: DataFrame, coverage: DataFrame) -> DataFrame:
    """Active postings of the latest sweeps that are covered; a sweep without rows counts zero."""
    facts = coverage.where("coverage_status = 'covered'").select(*SWEEP_KEYS, "freshness_age_hours", "freshness_status", "coverage_status", F.col("observed_rows").alias("active_postings"))
    told = ("partition_id", "run_id", "observed_at", "started_at", "completed_at", "status", "hmac_key_version", *PROVENANCE, "coverage_limitations")
    return latest.select(*SWEEP_KEYS, F.col("expected_country").alias("country"), *told).join(facts, SWEEP_KEYS)


def _demand(rows: DataFrame, dimension: str, uri: str, label: str, version: str) -> DataFrame:
    return rows.groupBy(*SWEEP_KEYS, "observed_at", F.lit(dimension).alias("dimension"), F.col(uri).alias("value_uri"), F.col(label).alias("value_label"), F.col(version).alias("taxonomy_version")).agg(F.countDistinct("source_id").alias("posting_count"))


def dimension_demand(postings: DataFrame, latest: DataFrame) -> DataFrame:
    base = _of_latest(postings, latest)
    region = _demand(base.where("region_mapping_status = 'mapped'"), "region", "nuts_code", "nuts_label", "nuts_version")
    return region.unionByName(_demand(base.where("occupation_mapping_status = 'mapped'"), "occupation", "esco_occupation_uri", "esco_occupation_label", "esco_version"))


def skill_demand(postings: DataFrame, skills: DataFrame, latest: DataFrame) -> DataFrame:
    mapped = skills.where("mapping_status = 'mapped'").select(*POSTING_KEYS, "esco_skill_uri", "esco_skill_label", "esco_version")
    rows = _of_latest(postings, latest).select(*POSTING_KEYS, "observed_at").join(mapped, POSTING_KEYS)
    return _demand(rows, "skill", "esco_skill_uri", "esco_skill_label", "esco_version")


def requirement_demand(postings: DataFrame, latest: DataFrame) -> DataFrame:
    """Postings by employment type, working hours and duration; a null status means not collected."""
    dimensions = F.explode(F.array(*(F.struct(F.lit(d).alias("dimension"), F.col(f"{d}_code").alias("value_code"), F.col(f"{d}_label").alias("value_label"), F.col(f"{d}_mapping_status").alias("mapping_status")) for d in REQUIREMENTS)))
    rows = _of_latest(postings, latest).select(*SWEEP_KEYS, "observed_at", "source_id", dimensions.alias("r")).select(*SWEEP_KEYS, "observed_at", "source_id", "r.*")
    return rows.where("mapping_status IS NOT NULL").groupBy(*SWEEP_KEYS, "observed_at", "dimension", "value_code", "value_label", "mapping_status").agg(F.countDistinct("source_id").alias("posting_count"))


def mapping_quality(postings: DataFrame, skills: DataFrame, latest: DataFrame) -> DataFrame:
    """Outcomes by status, method, confidence and version, with the total of each dimension."""
    base = _of_latest(postings, latest)
    keys = [*SWEEP_KEYS, "dimension", "mapping_status", "mapping_method", "mapping_confidence", "taxonomy_version"]

    def outcomes(rows, dimension, status, method, certainty, version, count):
        return rows.select(*SWEEP_KEYS, "source_id", F.lit(dimension).alias("dimension"), F.col(status).alias("mapping_status"), F.col(method).alias("mapping_method"), certainty.alias("mapping_confidence"), F.col(version).alias("taxonomy_version")).groupBy(*keys).agg(count.alias("outcome_count"))

    once = F.countDistinct("source_id")
    region = outcomes(base, "region", "region_mapping_status", "region_mapping_method", F.lit(None).cast("string"), "nuts_version", once)
    occupation = outcomes(base, "occupation", "occupation_mapping_status", "occupation_mapping_method", F.col("occupation_mapping_confidence"), "esco_version", once)
    skill = outcomes(_of_latest(skills, latest), "skill", "mapping_status", "mapping_method", F.col("mapping_confidence"), "esco_version", F.count(F.lit(1)))
    return region.unionByName(occupation).unionByName(skill).withColumn("total_outcomes", partition_total("outcome_count", [*SWEEP_KEYS, "dimension"]))


def mapping_coverage(postings: DataFrame, skills: DataFrame, latest: DataFrame) -> DataFrame:
    """Postings, those with a source value, and those mapped, per dimension.

    Postings are unique per sweep, so one pass of plain conditional counts
    replaces the distinct ones.
    """
    flags = _of_latest(skills, latest).groupBy(*POSTING_KEYS).agg(F.bool_or(F.col("mapping_status") != "not_present").alias("has_value"), F.bool_or(F.col("mapping_status") == "mapped").alias("has_mapped"))
    base = _of_latest(postings, latest).dropDuplicates(POSTING_KEYS).join(flags, POSTING_KEYS, "left")
    status = {"region": "region_mapping_status", "occupation": "occupation_mapping_status"}
    each = [F.struct(F.lit(d).alias("dimension"), (F.col(s) != "not_present").alias("valued"), (F.col(s) == "mapped").alias("mapped"), F.col("nuts_version" if d == "region" else "esco_version").alias("version")) for d, s in status.items()]
    each.append(F.struct(F.lit("skill").alias("dimension"), F.col("has_value").alias("valued"), F.col("has_mapped").alias("mapped"), F.col("esco_version").alias("version")))
    rows = base.select(*SWEEP_KEYS, F.explode(F.array(*each)).alias("d")).select(*SWEEP_KEYS, "d.*")
    return rows.groupBy(*SWEEP_KEYS, "dimension").agg(F.count(F.lit(1)).alias("postings_total"), F.count_if("valued").alias("postings_with_source_value"), F.count_if("mapped").alias("postings_mapped"), F.max("version").alias("taxonomy_version"))


def region_breadth(demand: DataFrame, latest: DataFrame, labels: DataFrame) -> DataFrame:
    countries = latest.select(*SCOPE, F.col("expected_country").alias("country"))
    found = demand.where("dimension = 'region'").join(countries, SCOPE).groupBy(*SCOPE, "country").agg(F.countDistinct("value_uri").alias("regions_with_postings"))
    frame = labels.where(F.length("nuts_code") == 5).groupBy(F.left("nuts_code", F.lit(2)).alias("country")).agg(F.countDistinct("nuts_code").alias("regions_in_frame"))
    return found.join(frame, "country", "left").select(*SCOPE, "country", "regions_with_postings", "regions_in_frame")


def posting_survival(lifecycle: DataFrame) -> DataFrame:
    """Duration quartiles by closure basis, masked where a group is small."""
    days, n = F.col("posting_duration_days"), F.col("postings")
    grouped = lifecycle.groupBy(*SCOPE, "lifecycle_status").agg(
        F.count(F.lit(1)).alias("postings"), F.sum(F.coalesce("advertised_vacancies", F.lit(0))).alias("vacancies"), F.bool_or("is_right_censored").alias("any_right_censored"),
        F.percentile(days, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("quartiles"), F.max(days).alias("longest"),
    )
    return grouped.select(
        *SCOPE, "lifecycle_status", is_suppressed(n).alias("is_suppressed"), "any_right_censored", mask_small(n, n).alias("posting_count"), mask_small(F.col("vacancies"), n).alias("advertised_vacancies"),
        *(mask_small(F.col("quartiles")[i], n).alias(f"{name}_duration_days") for i, name in ((1, "median"), (0, "p25"), (2, "p75"))), mask_small(F.col("longest"), n).alias("max_duration_days"),
    )


def sweep_stock(sweeps: DataFrame, postings: DataFrame, compat: bool = False) -> DataFrame:
    """Postings and vacancies of each sweep; ``compat`` adds up sweeps that share a time, as the reference does."""
    counted = postings.groupBy(*SWEEP_KEYS).agg(F.count("source_id").alias("n"), F.sum(F.coalesce("number_of_vacancies", F.lit(0))).alias("v"))
    each = sweeps.join(counted, SWEEP_KEYS, "left")
    keys = [*SCOPE, "observed_at"] if compat else [*SWEEP_KEYS, "observed_at", "completed_at"]
    return each.groupBy(*keys).agg(F.sum(F.coalesce("n", F.lit(0))).alias("active_postings"), F.sum(F.coalesce("v", F.lit(0))).alias("active_vacancies"))


def posting_flows(lifecycle: DataFrame, sweeps: DataFrame, postings: DataFrame, compat: bool = False) -> DataFrame:
    """Openings, closures and closing stock per bucket of three grains.

    The three tagged aggregates are united and grouped once, in place of a
    spine with three joins. Stock is null where a bucket has no sweep. With
    ``compat`` sweeps of one time are summed; otherwise the last one counts.
    """
    grains = F.explode(F.array(*map(F.lit, GRAINS))).alias("grain")

    def at(rows: DataFrame, time: str) -> DataFrame:
        return rows.withColumn("grain", grains).withColumn("bucket_start", bucket(F.col("grain"), F.col(time)))

    keys = [*SCOPE, "grain", "bucket_start"]
    nothing = F.lit(None).cast("long")
    opened = at(lifecycle, "first_seen_at").groupBy(*keys).agg(F.count(F.lit(1)).alias("opened")).withColumns({"closed": nothing, "stock": nothing, "vacancies": nothing})
    closed = at(lifecycle.where("closure_at IS NOT NULL"), "closure_at").groupBy(*keys).agg(F.count(F.lit(1)).alias("closed")).withColumns({"opened": nothing, "stock": nothing, "vacancies": nothing})
    order = F.struct("observed_at") if compat else F.struct("observed_at", "completed_at", "sweep_id")
    last = at(sweep_stock(sweeps, postings, compat), "observed_at").groupBy(*keys).agg(F.max_by("active_postings", order).alias("stock"), F.max_by("active_vacancies", order).alias("vacancies")).withColumns({"opened": nothing, "closed": nothing})
    both = opened.unionByName(closed).unionByName(last).groupBy(*keys).agg(F.coalesce(F.sum("opened"), F.lit(0)).alias("o"), F.coalesce(F.sum("closed"), F.lit(0)).alias("c"), F.max("stock").alias("s"), F.max("vacancies").alias("v"))
    return masked_flows(both, keys)


def masked_flows(both: DataFrame, keys: list[str]) -> DataFrame:
    """Openings o, closures c, stock s and vacancies v of each bucket, small counts masked."""
    o, c, s = F.col("o"), F.col("c"), F.col("s")
    return both.select(
        *keys, (is_suppressed(o) | is_suppressed(c) | is_suppressed(F.coalesce(s, F.lit(0)))).alias("is_suppressed"),
        mask_small(o, o).alias("openings"), mask_small(c, c).alias("closures"), mask_small(s, s).alias("active_postings"), mask_small(F.col("v"), s).alias("active_vacancies"),
    )


def collection_frequency(sweeps: DataFrame) -> DataFrame:
    gaps = sweeps.withColumn("gap_hours", gap("observed_at", SCOPE, hour_boundaries))
    return gaps.groupBy(*SCOPE).agg(
        F.count(F.lit(1)).alias("complete_sweeps"), F.min("observed_at").alias("first_observed_at"), F.max("observed_at").alias("last_observed_at"),
        F.median("gap_hours").alias("median_interval_hours"), F.max("freshness_threshold_hours").alias("freshness_threshold_hours"), F.max("coverage_limitations").alias("coverage_limitations"),
    )
