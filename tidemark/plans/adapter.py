"""The posting model derived from the driver's tables, in DataFrames and in SQL.

A sweep is a day of one event type and key version, a posting is a user, and
the number in ``props`` stands for what a source would have told: regions,
occupations, skills, requirements, and (from 95) a removal. Sweep ids begin with
a hash, so they are not in the order of time. On some days of a month sweeps
fail, or lack their end, a page or a row, so that every condition of the
admission gate has work; each region of the world is a scope with one sweep
without rows, every other one of them partial. Postings, sweeps and lifecycles
are written once a session for each state of the tables, and read by all.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import events as E
from ..operators import marts as M
from ..operators import staging as S
from ..sources.storage import file_state, written

REFERENCE_TIME = "2024-02-01 12:00:00"
EMPTY_TIME = "2024-01-20 00:00:00"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def band(k, pairs, otherwise):
    out = None
    for below, value in pairs:
        out = F.when(k < below, value) if out is None else out.when(k < below, value)
    return out.otherwise(otherwise)


@dataclass
class Model:
    """Inputs and the shared intermediate tables."""

    observations: DataFrame
    manifests: DataFrame
    labels: DataFrame
    sweeps: DataFrame
    postings: DataFrame
    skills: DataFrame
    latest: DataFrame
    lifecycles: DataFrame
    written_marts: dict[str, DataFrame] = field(default_factory=dict)

    def lifecycle(self) -> DataFrame:
        return self.lifecycles

    def marts(self) -> dict[str, DataFrame]:
        """The nine marts that checks and findings read, written once."""
        if not self.written_marts:
            coverage = written(self.coverage(), "coverage")
            made = {
                "demand": M.dimension_demand(self.postings, self.latest), "skills": M.skill_demand(self.postings, self.skills, self.latest), "requirements": M.requirement_demand(self.postings, self.latest), "quality": M.mapping_quality(self.postings, self.skills, self.latest),
                "mapped": M.mapping_coverage(self.postings, self.skills, self.latest), "labour": M.labour_demand(self.latest, coverage), "survival": M.posting_survival(self.lifecycle()), "flows": M.posting_flows(self.lifecycle(), self.sweeps, self.postings),
            }
            self.written_marts |= {"coverage": coverage} | {name: written(mart, name) for name, mart in made.items()}
        return self.written_marts

    def coverage(self) -> DataFrame:
        return M.source_coverage(self.sweeps, self.postings, F.lit(REFERENCE_TIME).cast("timestamp_ntz"))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events").select("ts", "user_id", "event_type", "value", F.regexp_extract("props", "([0-9]+)", 1).cast("long").alias("k"))
    cells = events.groupBy("event_type", "user_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("observed_at")).agg(
        F.min("k").alias("k"), F.max(F.floor(F.col("value") / 100).cast("long")).alias("number_of_vacancies"), F.min(F.when(F.col("k") >= 95, F.col("ts"))).alias("removed_at")
    )
    k, user = F.col("k"), F.col("user_id")
    version = F.concat(F.lit("v"), (1 + user % 2).cast("string"))
    scope = F.col("event_type")
    status = band(k, ((60, "mapped"), (70, "unmapped"), (80, "not_present"), (90, "ambiguous")), "low_confidence")
    region = F.concat(F.lit("SE"), F.lpad((k % 30 + 100).cast("string"), 3, "0"))
    skills = F.when(k % 7 == 0, F.lit(None)).when(k % 7 == 1, F.array()).otherwise(F.array(k % 10, k % 13 + 10))
    skill = F.transform(skills, lambda s: F.struct(F.concat(F.lit("urn:skill:"), s).alias("uri"), F.concat(F.lit("skill "), s).alias("label"), F.when(s % 3 == 0, "unmapped").when(s % 5 == 0, "not_present").otherwise("mapped").alias("status"), F.when(s % 2 == 0, "high").otherwise("low").alias("confidence"), F.lit("crosswalk").alias("method"), F.lit("30").alias("jobtech_taxonomy_version"), F.lit("1.2.1").alias("esco_version")))
    return cells.select(
        F.lit("events").alias("source"), scope.alias("scope_id"), version.alias("key_version"),
        _sweep_id(scope, version, F.date_format("observed_at", "yyyy-MM-dd")).alias("sweep_id"), "observed_at", user.cast("string").alias("source_id"), "k", "number_of_vacancies", "removed_at",
        F.when(k == 50, "DE").otherwise("SE").alias("country"), region.alias("nuts_code"), F.when(k % 4 == 0, F.concat(F.lit("collected "), k % 30)).alias("nuts_label"),
        status.alias("region_mapping_status"), F.when(k < 30, "municipality").otherwise("region").alias("region_mapping_method"), F.lit("2024").alias("nuts_version"),
        F.concat(F.lit("urn:occupation:"), k % 12).alias("esco_occupation_uri"), F.concat(F.lit("occupation "), k % 12).alias("esco_occupation_label"),
        F.when(k % 3 == 0, "unmapped").otherwise("mapped").alias("occupation_mapping_status"), F.when(k % 2 == 0, "high").alias("occupation_mapping_confidence"), F.lit("crosswalk").alias("occupation_mapping_method"), F.lit("1.2.1").alias("esco_version"),
        skill.alias("skill_mappings"),
        (k % 3).cast("string").alias("employment_type_code"), F.concat(F.lit("type "), k % 3).alias("employment_type_label"), F.when(k < 5, None).otherwise("mapped").alias("employment_type_mapping_status"),
        (k % 2).cast("string").alias("working_hours_type_code"), F.concat(F.lit("hours "), k % 2).alias("working_hours_type_label"), F.when(k > 90, "unmapped").otherwise("mapped").alias("working_hours_type_mapping_status"),
        F.when(k % 5 > 0, (k % 5).cast("string")).alias("duration_code"), F.when(k % 5 == 0, "Not stated").otherwise(F.concat(F.lit("duration "), k % 5)).alias("duration_label"), F.when(k % 5 == 0, "not_present").otherwise("mapped").alias("duration_mapping_status"),
    )


def _sweep_id(*parts):
    told = F.concat_ws("|", *parts)
    return F.concat(F.substring(F.md5(told), 1, 6), F.lit("|"), told)


def manifests(spark: SparkSession, sf_dir: str, observed: DataFrame) -> DataFrame:
    """Every sweep's manifest, admitted or not."""
    counted = observed.groupBy("source", "scope_id", F.col("key_version").alias("hmac_key_version"), "sweep_id", "observed_at").agg(F.count(F.lit(1)).alias("row_count")).withColumn("fails", F.lit(False))
    empty = read(spark, sf_dir, "region").select(
        F.lit("events").alias("source"), F.concat(F.lit("empty-"), "r_name").alias("scope_id"), F.lit("v1").alias("hmac_key_version"), _sweep_id(F.lit("empty"), "r_name").alias("sweep_id"), F.lit(EMPTY_TIME).cast("timestamp_ntz").alias("observed_at"),
        F.lit(0).cast("long").alias("row_count"), (F.col("r_regionkey") % 2 == 1).alias("fails"),
    )
    every, day = counted.unionByName(empty), F.day("observed_at")
    pages = F.ceil(F.col("row_count") / 25)
    text = {"nuts_version": "2024", "jobtech_taxonomy_version": "30", "esco_version": "1.2.1", "reference_hashes": "geography:1", "source_version": "1", "licence_reference": "open", "access_method": "api", "approval_status": "approved", "expected_country": "SE"}
    return every.select(
        *(c for c in every.columns if c != "fails"), F.when(F.col("fails"), "partial").when(day == 9, "failed").otherwise("complete").alias("status"),
        F.when(day != 12, F.col("row_count") + F.when(day == 21, 1).otherwise(0)).alias("expected_rows"), pages.alias("expected_pages"), (pages - F.when(day == 27, 1).otherwise(0)).alias("completed_pages"),
        F.when(day != 18, F.col("observed_at") + F.expr("interval 1 hour")).alias("completed_at"), F.col("observed_at").alias("started_at"), F.concat(F.lit("run-"), "sweep_id").alias("run_id"), F.col("sweep_id").alias("partition_id"),
        F.when(F.col("scope_id") != "signup", 48).alias("freshness_threshold_hours"), F.concat(F.lit("only "), "scope_id").alias("coverage_limitations"), *(F.lit(v).alias(k) for k, v in text.items()),
    )


def label_files(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Two reference files of region labels, one with a column more than the other."""
    nations = read(spark, sf_dir, "nation")
    code = F.concat(F.lit("SE"), (F.col("n_nationkey") + 100).cast("string")).alias("nuts_code")
    return [nations.select(code, F.col("n_name").alias("nuts_label")), nations.select(code, F.concat(F.lit("A "), F.col("n_name")).alias("nuts_label"), F.lit("2024").alias("source_version"))]


_written: dict[tuple, Model] = {}


def model(spark: SparkSession, sf_dir: str) -> Model:
    """The model over the tables in ``sf_dir``; written once for each state of the tables in a session."""
    key = (spark.sparkContext.applicationId, sf_dir, *(file_state(spark, f"{sf_dir}/{t}.parquet") for t in ("events", "nation", "region")))
    if key not in _written:
        observed = written(observations(spark, sf_dir), "observations")
        told = written(manifests(spark, sf_dir, observed), "manifests")
        labels = S.nuts_labels(label_files(spark, sf_dir))
        sweeps = S.admitted(told)
        postings = written(S.staged_postings(observed.drop("key_version"), sweeps, labels), "postings")
        lifecycle = written(E.posting_lifecycle(postings, sweeps), "lifecycle")
        _written[key] = Model(observed, told, labels, sweeps, postings, S.skill_mappings(postings), written(M.latest_sweeps(sweeps), "latest"), lifecycle)
    return _written[key]


#: The same in SQL: name of a common table expression to its text. Each may use those before it.
CTES = {
    "ev": "SELECT ts, user_id, event_type, value, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events",
    "cells": "SELECT event_type, user_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS observed_at, min(k) AS k, max(CAST(floor(value / 100) AS BIGINT)) AS number_of_vacancies, min(CASE WHEN k >= 95 THEN ts END) AS removed_at FROM ev GROUP BY 1, 2, 3",
    "observed": """SELECT 'events' AS source, event_type AS scope_id, 'v' || (1 + user_id % 2) AS key_version, substr(md5(event_type || '|v' || (1 + user_id % 2) || '|' || strftime(observed_at, '%Y-%m-%d')), 1, 6) || '|' || event_type || '|v' || (1 + user_id % 2) || '|' || strftime(observed_at, '%Y-%m-%d') AS sweep_id, observed_at, CAST(user_id AS VARCHAR) AS source_id, k, number_of_vacancies, removed_at,
CASE WHEN k = 50 THEN 'DE' ELSE 'SE' END AS country, 'SE' || (k % 30 + 100) AS nuts_code, CASE WHEN k % 4 = 0 THEN 'collected ' || (k % 30) END AS nuts_label,
CASE WHEN k < 60 THEN 'mapped' WHEN k < 70 THEN 'unmapped' WHEN k < 80 THEN 'not_present' WHEN k < 90 THEN 'ambiguous' ELSE 'low_confidence' END AS region_mapping_status, CASE WHEN k < 30 THEN 'municipality' ELSE 'region' END AS region_mapping_method, '2024' AS nuts_version,
'urn:occupation:' || (k % 12) AS esco_occupation_uri, 'occupation ' || (k % 12) AS esco_occupation_label, CASE WHEN k % 3 = 0 THEN 'unmapped' ELSE 'mapped' END AS occupation_mapping_status, CASE WHEN k % 2 = 0 THEN 'high' END AS occupation_mapping_confidence, 'crosswalk' AS occupation_mapping_method, '1.2.1' AS esco_version,
CAST(k % 3 AS VARCHAR) AS employment_type_code, 'type ' || (k % 3) AS employment_type_label, CASE WHEN k >= 5 THEN 'mapped' END AS employment_type_mapping_status,
CAST(k % 2 AS VARCHAR) AS working_hours_type_code, 'hours ' || (k % 2) AS working_hours_type_label, CASE WHEN k > 90 THEN 'unmapped' ELSE 'mapped' END AS working_hours_type_mapping_status,
CASE WHEN k % 5 > 0 THEN CAST(k % 5 AS VARCHAR) END AS duration_code, CASE WHEN k % 5 = 0 THEN 'Not stated' ELSE 'duration ' || (k % 5) END AS duration_label, CASE WHEN k % 5 = 0 THEN 'not_present' ELSE 'mapped' END AS duration_mapping_status FROM cells""",
    "counted": f"""SELECT source, scope_id, key_version AS hmac_key_version, sweep_id, observed_at, count(*) AS row_count, FALSE AS fails FROM observed GROUP BY 1, 2, 3, 4, 5
UNION ALL SELECT 'events', 'empty-' || r_name, 'v1', substr(md5('empty|' || r_name), 1, 6) || '|empty|' || r_name, TIMESTAMP '{EMPTY_TIME}', 0, r_regionkey % 2 = 1 FROM region""",
    "manifests": """SELECT source, scope_id, hmac_key_version, sweep_id, observed_at, row_count, CASE WHEN fails THEN 'partial' WHEN day(observed_at) = 9 THEN 'failed' ELSE 'complete' END AS status,
CASE WHEN day(observed_at) <> 12 THEN row_count + CASE WHEN day(observed_at) = 21 THEN 1 ELSE 0 END END AS expected_rows, CAST(ceil(row_count / 25) AS BIGINT) AS expected_pages, CAST(ceil(row_count / 25) AS BIGINT) - CASE WHEN day(observed_at) = 27 THEN 1 ELSE 0 END AS completed_pages,
CASE WHEN day(observed_at) <> 18 THEN observed_at + INTERVAL 1 HOUR END AS completed_at, observed_at AS started_at, 'run-' || sweep_id AS run_id, sweep_id AS partition_id, CASE WHEN scope_id <> 'signup' THEN 48 END AS freshness_threshold_hours, 'only ' || scope_id AS coverage_limitations,
'2024' AS nuts_version, '30' AS jobtech_taxonomy_version, '1.2.1' AS esco_version, 'geography:1' AS reference_hashes, '1' AS source_version, 'open' AS licence_reference, 'api' AS access_method, 'approved' AS approval_status, 'SE' AS expected_country FROM counted""",
    "sweeps": "SELECT * FROM manifests WHERE status = 'complete' AND completed_at IS NOT NULL AND completed_pages = expected_pages AND row_count = expected_rows",
    "labels": "SELECT nuts_code, min(nuts_label) AS nuts_label FROM (SELECT 'SE' || (n_nationkey + 100) AS nuts_code, n_name AS nuts_label FROM nation UNION ALL SELECT 'SE' || (n_nationkey + 100), 'A ' || n_name FROM nation) GROUP BY 1",
    "postings": "SELECT o.* EXCLUDE (nuts_label, key_version), coalesce(o.nuts_label, l.nuts_label) AS nuts_label, s.hmac_key_version FROM observed o JOIN sweeps s ON o.source = s.source AND o.scope_id = s.scope_id AND o.sweep_id = s.sweep_id AND o.observed_at = s.observed_at LEFT JOIN labels l ON o.nuts_code = l.nuts_code",
    "skill_rows": "SELECT source, scope_id, sweep_id, source_id, hmac_key_version, observed_at, esco_version, skill_ordinal, n FROM (SELECT *, k % 10 AS n, CAST(1 AS BIGINT) AS skill_ordinal FROM postings WHERE k % 7 > 1 UNION ALL SELECT *, k % 13 + 10, 2 FROM postings WHERE k % 7 > 1)",
    "skills": "SELECT source, scope_id, sweep_id, source_id, hmac_key_version, observed_at, '30' AS jobtech_taxonomy_version, skill_ordinal, 'urn:skill:' || n AS esco_skill_uri, 'skill ' || n AS esco_skill_label, CASE WHEN n % 3 = 0 THEN 'unmapped' WHEN n % 5 = 0 THEN 'not_present' ELSE 'mapped' END AS mapping_status, CASE WHEN n % 2 = 0 THEN 'high' ELSE 'low' END AS mapping_confidence, 'crosswalk' AS mapping_method, esco_version FROM skill_rows",
    "latest": "SELECT * FROM sweeps QUALIFY row_number() OVER (PARTITION BY source, scope_id ORDER BY observed_at DESC, completed_at DESC, sweep_id DESC) = 1",
    "seen": "SELECT source, scope_id, hmac_key_version, source_id, max(observed_at) AS last_seen_at, arg_max(sweep_id, observed_at) AS last_seen_sweep_id, min(removed_at) AS removed_at FROM postings GROUP BY 1, 2, 3, 4",
    "closures": """SELECT p.source, p.scope_id, p.hmac_key_version, p.source_id, CASE WHEN p.removed_at IS NOT NULL THEN p.last_seen_sweep_id ELSE arg_min(s.sweep_id, s.observed_at) END AS sweep_id, coalesce(p.removed_at, min(s.observed_at)) AS event_at, 'closure' AS event_type, CASE WHEN p.removed_at IS NOT NULL THEN 'source_reported' ELSE 'inferred_absence' END AS event_basis
FROM seen p LEFT JOIN sweeps s ON s.source = p.source AND s.scope_id = p.scope_id AND s.hmac_key_version = p.hmac_key_version AND s.observed_at > p.last_seen_at GROUP BY p.source, p.scope_id, p.hmac_key_version, p.source_id, p.last_seen_sweep_id, p.removed_at HAVING p.removed_at IS NOT NULL OR min(s.observed_at) IS NOT NULL""",
    "posting_events": "SELECT source, scope_id, hmac_key_version, source_id, sweep_id, observed_at AS event_at, 'presence' AS event_type, 'observed' AS event_basis FROM postings UNION ALL SELECT source, scope_id, hmac_key_version, source_id, sweep_id, event_at, event_type, event_basis FROM closures",
    "lifecycle": """SELECT s.*, c.event_at AS closure_at, c.event_basis AS closure_basis, coalesce(c.event_basis, 'active') AS lifecycle_status, c.event_at IS NULL AS is_right_censored, CAST(date_diff('day', s.first_seen_at, coalesce(c.event_at, s.last_seen_at)) AS BIGINT) AS posting_duration_days
FROM (SELECT source, scope_id, hmac_key_version, source_id, min(observed_at) AS first_seen_at, arg_min(sweep_id, observed_at) AS first_seen_sweep_id, max(observed_at) AS last_seen_at, arg_max(sweep_id, observed_at) AS last_seen_sweep_id, count(DISTINCT sweep_id) AS observation_count, arg_max(number_of_vacancies, observed_at) AS advertised_vacancies FROM postings GROUP BY 1, 2, 3, 4) s
LEFT JOIN closures c ON c.source = s.source AND c.scope_id = s.scope_id AND c.hmac_key_version = s.hmac_key_version AND c.source_id = s.source_id""",
    "coverage": f"""SELECT source, scope_id, sweep_id, country, observed_at, expected_rows, observed_rows, source_version, licence_reference, access_method, approval_status, freshness_threshold_hours, coverage_limitations, age AS freshness_age_hours, CASE WHEN freshness_threshold_hours IS NULL THEN 'unknown' WHEN age > freshness_threshold_hours THEN 'stale' ELSE 'fresh' END AS freshness_status,
CASE WHEN freshness_threshold_hours IS NULL THEN 'unknown_metadata' WHEN observed_rows <> expected_rows OR wrong > 0 THEN 'invalid' ELSE 'covered' END AS coverage_status
FROM (SELECT s.source, s.scope_id, s.sweep_id, s.expected_country AS country, s.observed_at, s.row_count AS expected_rows, s.source_version, s.licence_reference, s.access_method, s.approval_status, s.freshness_threshold_hours, s.coverage_limitations, count(p.source_id) AS observed_rows, count(p.source_id) FILTER (WHERE p.country <> s.expected_country) AS wrong, date_diff('second', s.observed_at, TIMESTAMP '{REFERENCE_TIME}') / 3600.0 AS age
FROM sweeps s LEFT JOIN postings p ON p.source = s.source AND p.scope_id = s.scope_id AND p.sweep_id = s.sweep_id GROUP BY ALL)""",
    "of_latest": "SELECT p.* FROM postings p JOIN latest l ON p.source = l.source AND p.scope_id = l.scope_id AND p.sweep_id = l.sweep_id",
    "latest_skills": "SELECT k.* FROM skills k JOIN latest l ON k.source = l.source AND k.scope_id = l.scope_id AND k.sweep_id = l.sweep_id",
    "dimension_demand": """SELECT source, scope_id, sweep_id, observed_at, 'region' AS dimension, nuts_code AS value_uri, nuts_label AS value_label, nuts_version AS taxonomy_version, count(DISTINCT source_id) AS posting_count FROM of_latest WHERE region_mapping_status = 'mapped' GROUP BY ALL
UNION ALL SELECT source, scope_id, sweep_id, observed_at, 'occupation', esco_occupation_uri, esco_occupation_label, esco_version, count(DISTINCT source_id) FROM of_latest WHERE occupation_mapping_status = 'mapped' GROUP BY ALL""",
    "flows": """SELECT source, scope_id, grain, bucket_start, (o > 0 AND o < 5) OR (c > 0 AND c < 5) OR (coalesce(s, 0) > 0 AND coalesce(s, 0) < 5) AS is_suppressed, CASE WHEN o > 0 AND o < 5 THEN NULL ELSE o END AS openings, CASE WHEN c > 0 AND c < 5 THEN NULL ELSE c END AS closures, CASE WHEN s > 0 AND s < 5 THEN NULL ELSE s END AS active_postings, CASE WHEN s > 0 AND s < 5 THEN NULL ELSE v END AS active_vacancies
FROM (SELECT sp.source, sp.scope_id, sp.grain, sp.bucket_start, coalesce(o.n, 0) AS o, coalesce(c.n, 0) AS c, st.s, st.v FROM (SELECT source, scope_id, grain, bucket_start FROM opened UNION SELECT source, scope_id, grain, bucket_start FROM closed UNION SELECT source, scope_id, grain, bucket_start FROM stock) sp
LEFT JOIN opened o USING (source, scope_id, grain, bucket_start) LEFT JOIN closed c USING (source, scope_id, grain, bucket_start) LEFT JOIN stock st USING (source, scope_id, grain, bucket_start))""",
}
GRAIN_ROWS = "(SELECT unnest(['day', 'week', 'month']) AS grain)"
FLOW_PARTS = {
    "opened": f"SELECT source, scope_id, grain, CAST(date_trunc(grain, first_seen_at) AS TIMESTAMP) AS bucket_start, count(*) AS n FROM lifecycle CROSS JOIN {GRAIN_ROWS} GROUP BY 1, 2, 3, 4",
    "closed": f"SELECT source, scope_id, grain, CAST(date_trunc(grain, closure_at) AS TIMESTAMP) AS bucket_start, count(*) AS n FROM lifecycle CROSS JOIN {GRAIN_ROWS} WHERE closure_at IS NOT NULL GROUP BY 1, 2, 3, 4",
    "stock_of_sweep": "SELECT s.source, s.scope_id, s.sweep_id, s.observed_at, s.completed_at, count(p.source_id) AS s, CAST(sum(coalesce(p.number_of_vacancies, 0)) AS BIGINT) AS v FROM sweeps s LEFT JOIN postings p ON p.source = s.source AND p.scope_id = s.scope_id AND p.sweep_id = s.sweep_id GROUP BY 1, 2, 3, 4, 5",
    "stock_of_time": "SELECT source, scope_id, CAST(NULL AS VARCHAR) AS sweep_id, observed_at, observed_at AS completed_at, CAST(sum(s) AS BIGINT) AS s, CAST(sum(v) AS BIGINT) AS v FROM stock_of_sweep GROUP BY 1, 2, 4",
}


def stock_cte(of: str) -> str:
    return f"SELECT source, scope_id, grain, CAST(date_trunc(grain, observed_at) AS TIMESTAMP) AS bucket_start, s, v FROM {of} CROSS JOIN {GRAIN_ROWS} QUALIFY row_number() OVER (PARTITION BY source, scope_id, grain, date_trunc(grain, observed_at) ORDER BY observed_at DESC, completed_at DESC, sweep_id DESC) = 1"


def with_ctes(query: str, extra: dict[str, str] | None = None) -> str:
    """``query`` behind all the model's common table expressions; unused ones cost nothing."""
    ctes = dict(CTES)
    flows = ctes.pop("flows")
    ctes |= extra or {}
    if "stock" in ctes:
        ctes["flows"] = flows
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in ctes.items()) + "\n" + query


def flows_sql(compat: bool) -> str:
    return with_ctes("SELECT * FROM flows", FLOW_PARTS | {"stock": stock_cte("stock_of_time" if compat else "stock_of_sweep")})
