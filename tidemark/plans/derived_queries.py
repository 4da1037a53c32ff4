"""Queries beyond the marts: serving, findings, mappings, comparisons, choices, functions, streams."""

from __future__ import annotations

import dataclasses
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import checks, mapping, panel, reconcile, serving
from ..operators import events as E
from ..operators import marts as M
from ..sources.storage import new_path
from ..streaming import fold
from . import posting_queries
from .adapter import FLOW_PARTS, REFERENCE_TIME, model, read, stock_cte, with_ctes

FLOWS = FLOW_PARTS | {"stock": stock_cte("stock_of_sweep")}


def _flows(m):
    return M.posting_flows(m.lifecycle(), m.sweeps, m.postings)


def top25_per_scope(spark, sf_dir):
    m = model(spark, sf_dir)
    return serving.top_values(M.dimension_demand(m.postings, m.latest))


def serving_orders(spark, sf_dir):
    return serving.flows_in_order(_flows(model(spark, sf_dir)))


def leader_runner_up(spark, sf_dir):
    m = model(spark, sf_dir)
    return serving.leader(M.dimension_demand(m.postings, m.latest), "occupation")


def gap_densified_axis(spark, sf_dir):
    return serving.dense_axis(_flows(model(spark, sf_dir)))


def gap_markers(spark, sf_dir):
    return serving.gap_markers(_flows(model(spark, sf_dir)))


def _candidates(spark, sf_dir):
    """Parts stand for source concepts by type, brands for targets; a size above 45 is an exact relation."""
    parts = read(spark, sf_dir, "part")
    return parts.where("p_size > 25").select(F.col("p_type").alias("concept"), F.concat(F.lit("urn:"), "p_brand", F.lit(":"), "p_size").alias("target_uri"), F.col("p_brand").alias("target_label"), F.when(F.col("p_size") > 49, "exact-match").otherwise("close-match").alias("relation")).distinct()


CANDIDATES_SQL = "SELECT DISTINCT p_type AS concept, 'urn:' || p_brand || ':' || p_size AS target_uri, p_brand AS target_label, CASE WHEN p_size > 49 THEN 'exact-match' ELSE 'close-match' END AS relation FROM part WHERE p_size > 25"


def crosswalk_summary(spark, sf_dir):
    found = mapping.crosswalk_summary(_candidates(spark, sf_dir))
    return found.select("concept", "n", "n_exact", F.col("pick.uri").alias("uri"))


def _places(spark, sf_dir):
    c, n = read(spark, sf_dir, "customer"), read(spark, sf_dir, "nation")
    return c.join(n, c["c_nationkey"] == n["n_nationkey"]).select(F.col("n_name").alias("region"), F.col("c_mktsegment").alias("place"), F.floor(F.col("c_acctbal") / 100).cast("long").alias("postcode"))


PLACES_SQL = "SELECT n_name AS region, c_mktsegment AS place, CAST(floor(c_acctbal / 100) AS BIGINT) AS postcode FROM customer JOIN nation ON c_nationkey = n_nationkey"


def postcode_regions(spark, sf_dir):
    return mapping.postcode_regions(_places(spark, sf_dir).select(F.col("postcode"), F.col("region").alias("nuts_code")))


def _halves(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    days = events.select("user_id", F.dayofmonth("ts").alias("d"))
    return days.where("d = 5").select("user_id"), days.where("d = 6").select("user_id")


def snapshot_reconcile(spark, sf_dir):
    return reconcile.reconcile(*_halves(spark, sf_dir), "user_id")


def log_fold_latest(spark, sf_dir):
    return reconcile.fold_log(read(spark, sf_dir, "events"), ["user_id"], F.struct("ts", "event_id"), ["event_id", "event_type", "ts"])


def keep_first_dedupe(spark, sf_dir):
    return reconcile.keep_first(read(spark, sf_dir, "events"), ["user_id", "event_type"], F.struct("ts", "event_id"), ["event_id"])


def symmetric_difference(spark, sf_dir):
    return reconcile.symmetric_difference(*_halves(spark, sf_dir))


def duplicate_grain(spark, sf_dir):
    return checks.repeated(read(spark, sf_dir, "events").withColumn("day", F.to_date("ts")), ["user_id", "event_type", "day"])


def label_conflicts(spark, sf_dir):
    return checks.label_conflicts(_places(spark, sf_dir).select(F.col("postcode").alias("nuts_code"), F.col("region").alias("nuts_label")))


def cadence_abandoned(spark, sf_dir):
    m = model(spark, sf_dir)
    return checks.abandoned(m.latest, F.lit("2024-02-20 00:00:00").cast("timestamp_ntz"))


def unique_places(spark, sf_dir):
    c = read(spark, sf_dir, "customer").select(F.floor("c_acctbal").cast("long").alias("postcode"), F.col("c_nationkey").alias("region"))
    return panel.unique_places(c, "postcode")


def round_robin_breadth(spark, sf_dir):
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return panel.round_robin(c, "c_nationkey", [F.asc("c_custkey")])


def date_diff_boundaries(spark, sf_dir):
    o = read(spark, sf_dir, "events")
    later = F.lit(REFERENCE_TIME).cast("timestamp_ntz")
    return o.select("event_id", C.hour_boundaries(F.col("ts"), later).alias("hours"), C.day_boundaries(F.col("ts"), later).alias("days"), C.second_boundaries(F.col("ts"), later).alias("seconds"))


def hmac_pseudonym(spark, sf_dir):
    c = read(spark, sf_dir, "customer")
    return c.select("c_custkey", C.pseudonym_of_id(b"key", F.col("c_name")).alias("of_id"), C.pseudonym_of_source(b"key", F.lit("tpch"), F.col("c_name")).alias("of_source"))


def pii_scan(spark, sf_dir):
    return checks.pii_fields(read(spark, sf_dir, "documents"), ["text"])


def suppression_leaks(spark, sf_dir):
    """Unmasked demand counts that publication would have to mask."""
    m = model(spark, sf_dir)
    return checks.suppression_leaks(M.dimension_demand(m.postings, m.latest), ["posting_count"]).select("source", "scope_id", "dimension", "value_uri", "posting_count")


def _broken(m):
    """The model with faults: a posting twice, one of a failed sweep, one without a manifest, two labels of one code, a skill twice, and a sweep that promises a row more."""
    one = m.postings.orderBy("scope_id", "sweep_id", "source_id").limit(1)
    failed = m.manifests.where("status = 'failed'").orderBy("sweep_id").limit(1)
    strayed = one.drop("source", "scope_id", "sweep_id").join(failed.select("source", "scope_id", "sweep_id")).select(*m.postings.columns)
    orphan = m.observations.orderBy("scope_id", "sweep_id", "source_id").limit(1).withColumn("sweep_id", F.lit("nowhere"))
    labels = m.labels.unionByName(m.labels.orderBy("nuts_code").limit(1).withColumn("nuts_label", F.lit("another")))
    skill = m.skills.orderBy("scope_id", "sweep_id", "source_id", "skill_ordinal").limit(1)
    promised = m.sweeps.where("row_count > 0").orderBy("sweep_id").limit(1).withColumn("row_count", F.col("row_count") + 1)
    sweeps = m.sweeps.join(promised.select("sweep_id"), "sweep_id", "left_anti").select(*m.sweeps.columns).unionByName(promised)
    return dataclasses.replace(m, postings=m.postings.unionByName(one).unionByName(strayed), observations=m.observations.unionByName(orphan), labels=labels, skills=m.skills.unionByName(skill), sweeps=sweeps, lifecycles=m.lifecycles.unionByName(m.lifecycles.orderBy(*m.lifecycles.columns[:4]).limit(1)))


def _counted(found: dict[str, DataFrame]) -> DataFrame:
    ones = [rows.agg(F.count(F.lit(1)).alias("offending")).select(F.lit(name).alias("assertion"), "offending") for name, rows in found.items()]
    return reduce(DataFrame.unionByName, ones)


def assertions(spark, sf_dir):
    """Offending rows of every assertion over the written model."""
    m = model(spark, sf_dir)
    return _counted(checks.suite(m, E.closures(m.postings, m.sweeps), m.marts(), F.lit("2024-02-20 00:00:00").cast("timestamp_ntz"), E.closures_direct(m.postings, m.sweeps)))


def assertions_on_broken_marts(spark, sf_dir):
    """The assertions over closures, latest sweeps and marts that are wrong by rules: how many rows each of them finds."""
    m = model(spark, sf_dir)
    u, inferred, marts = F.col("source_id").cast("long") % 10, F.col("event_basis") == "inferred_absence", m.marts()
    good = E.closures(m.postings, m.sweeps)
    closures = good.withColumns({
        "hmac_key_version": F.when((u == 3) & inferred, F.when(F.col("hmac_key_version") == "v1", "v2").otherwise("v1")).otherwise(F.col("hmac_key_version")),
        "event_at": F.when((u == 2) & inferred, F.col("event_at") + F.expr("interval 1 hour")).otherwise(F.col("event_at")),
        "event_basis": F.when(u == 1, "guessed").otherwise(F.col("event_basis")),
    })
    broken = marts | {
        "mapped": marts["mapped"].withColumn("postings_mapped", F.col("postings_mapped") + F.when(F.col("dimension") == "region", 10**6).otherwise(0)), "demand": marts["demand"].withColumn("value_uri", F.when(F.col("posting_count") % 2 == 1, F.col("value_uri"))),
        "flows": marts["flows"].withColumn("openings", F.coalesce("openings", F.when(F.col("grain") == "day", 3))), "survival": marts["survival"].withColumn("max_duration_days", F.when(F.col("lifecycle_status") == "active", -1).otherwise(F.col("max_duration_days"))),
        "labour": marts["labour"].where("active_postings > 0"), "quality": marts["quality"].withColumn("mapping_status", F.when(F.col("outcome_count") % 2 == 0, F.col("mapping_status")).otherwise("perhaps")),
    }
    latest = m.latest.where("scope_id NOT LIKE 'empty-A%'")
    found = checks.suite(dataclasses.replace(m, latest=latest), closures, broken, F.lit("2024-02-20 00:00:00").cast("timestamp_ntz"), good) | {"zero_sweep_published": checks.zero_sweeps_unpublished(m.latest, broken["labour"])}
    return _counted({name: found[name] for name in BROKEN})


#: What breaks, in SQL: each assertion's number of findings over the same wrong rows.
BROKEN = {
    "closure_basis_vocabulary": "SELECT DISTINCT event_basis FROM bad WHERE event_basis NOT IN ('observed', 'source_reported', 'inferred_absence')",
    "inferred_closures_complete": "SELECT 1 FROM bad b WHERE event_basis = 'inferred_absence' AND NOT EXISTS (SELECT 1 FROM sweeps s WHERE s.scope_id = b.scope_id AND s.sweep_id = b.sweep_id AND s.hmac_key_version = b.hmac_key_version AND s.observed_at = b.event_at)",
    "key_rotation_does_not_close": "SELECT 1 FROM bad b WHERE event_basis = 'inferred_absence' AND NOT EXISTS (SELECT 1 FROM sweeps s WHERE s.scope_id = b.scope_id AND s.hmac_key_version = b.hmac_key_version AND s.observed_at = b.event_at)",
    "latest_sweeps_include_empty": "SELECT DISTINCT scope_id FROM sweeps WHERE scope_id LIKE 'empty-A%'",
    "mapping_coverage": "SELECT 1 FROM ({mapped}) WHERE dimension = 'region'",
    "mapping_outputs": "SELECT 1 FROM dimension_demand WHERE posting_count % 2 = 0 UNION ALL SELECT 1 FROM ({quality}) WHERE outcome_count % 2 = 1",
    "no_cross_key_closures": "SELECT 1 FROM bad b JOIN manifests s ON s.scope_id = b.scope_id AND s.sweep_id = b.sweep_id AND s.hmac_key_version <> b.hmac_key_version",
    "posting_flows_suppression": "SELECT 1 FROM flows WHERE grain = 'day' AND openings IS NULL",
    "posting_survival_suppression": "SELECT 1 FROM ({survival}) WHERE lifecycle_status = 'active'",
    "survival_logic": "SELECT * FROM (SELECT * FROM bad EXCEPT SELECT * FROM closures) UNION ALL SELECT * FROM (SELECT * FROM closures EXCEPT SELECT * FROM bad)",
    "zero_sweep_published": "SELECT 1 FROM latest WHERE row_count = 0",
}
BAD = """SELECT source, scope_id, CASE WHEN u = 3 AND event_basis = 'inferred_absence' THEN CASE hmac_key_version WHEN 'v1' THEN 'v2' ELSE 'v1' END ELSE hmac_key_version END AS hmac_key_version, source_id, sweep_id,
CASE WHEN u = 2 AND event_basis = 'inferred_absence' THEN event_at + INTERVAL 1 HOUR ELSE event_at END AS event_at, event_type, CASE WHEN u = 1 THEN 'guessed' ELSE event_basis END AS event_basis FROM (SELECT *, CAST(source_id AS BIGINT) % 10 AS u FROM closures)"""


def _broken_sql() -> str:
    texts = {"mapped": posting_queries.QUERIES["mapping_coverage"][1], "quality": posting_queries.QUERIES["mapping_quality"][1], "survival": posting_queries.QUERIES["posting_survival"][1]}
    each = " UNION ALL ".join(f"SELECT '{name}' AS assertion, (SELECT count(*) FROM ({sql.format(**texts)})) AS offending" for name, sql in BROKEN.items())
    return with_ctes(each, FLOW_PARTS | {"stock": stock_cte("stock_of_sweep"), "bad": BAD})


def assertions_on_faults(spark, sf_dir):
    """The same kinds of checks over a model with one fault of each kind: all of them find it."""
    m = _broken(model(spark, sf_dir))
    return _counted({
        "postings_grain_unique": checks.repeated(m.postings, checks.POSTING_KEYS), "skill_grain_unique": checks.repeated(m.skills, [*checks.POSTING_KEYS, "skill_ordinal"]), "posting_lifecycle_grain_unique": checks.repeated(m.lifecycle(), checks.IDENTITY),
        "nuts_label_unambiguous": checks.label_conflicts(m.labels), "no_orphan_observations": checks.orphan_observations(m.observations, m.manifests), "incomplete_observations_excluded": checks.excluded_but_staged(m.postings, m.manifests), "manifest_row_counts": checks.row_count_mismatch(m.sweeps, m.observations),
    })


def negative_durations(spark, sf_dir):
    return checks.negative_durations(model(spark, sf_dir).lifecycle())


def page_truncation(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").groupBy("l_suppkey", F.month("l_shipdate").alias("page")).agg(F.count(F.lit(1)).alias("n_ids"))
    return checks.truncated(li.select(F.col("l_suppkey").alias("scope"), "page", "n_ids"), 50)


def _events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold.table_stream(spark, sf_dir, "events", read(spark, sf_dir, "events").schema)


def stream_fold(spark, sf_dir):
    path = new_path(spark, "stream")
    fold.run_to(fold.fold(_events_stream(spark, sf_dir), ["user_id"], F.struct("ts", "event_id"), ["event_id", "event_type", "ts"]), f"{path}/table", "complete", f"{path}/state")
    return spark.read.parquet(f"{path}/table")


def stream_dedupe(spark, sf_dir):
    path = new_path(spark, "stream")
    fold.run_to(fold.keep_first_ever(_events_stream(spark, sf_dir), ["user_id", "event_type"]).select("user_id", "event_type"), f"{path}/table", "append", f"{path}/state")
    return spark.read.parquet(f"{path}/table").select("user_id", "event_type")


REQUIREMENTS, SURVIVAL = (posting_queries.QUERIES[name][1] for name in ("requirement_demand", "posting_survival"))
ORACLES = {
    "top25_per_scope": with_ctes("SELECT * FROM (SELECT source, scope_id, dimension, value_uri, value_label, posting_count, row_number() OVER (PARTITION BY source, scope_id, dimension ORDER BY posting_count DESC, value_label NULLS LAST, value_uri NULLS LAST) AS place FROM dimension_demand) WHERE place <= 25"),
    "serving_orders": with_ctes("SELECT source, scope_id, grain, bucket_start, row_number() OVER (PARTITION BY source, scope_id ORDER BY CASE grain WHEN 'day' THEN 0 WHEN 'week' THEN 1 ELSE 2 END, bucket_start) AS place FROM flows", FLOWS),
    "leader_runner_up": with_ctes("SELECT source, scope_id, value_uri, value_label, posting_count, runner_up FROM (SELECT *, row_number() OVER w AS place, lead(posting_count) OVER w AS runner_up FROM dimension_demand WHERE dimension = 'occupation' WINDOW w AS (PARTITION BY source, scope_id ORDER BY posting_count DESC, value_label NULLS LAST, value_uri NULLS LAST)) WHERE place = 1 AND (runner_up IS NULL OR posting_count > runner_up)"),
    "gap_densified_axis": with_ctes("""SELECT a.source, a.scope_id, a.grain, a.bucket, f.openings, f.closures, f.active_postings FROM (SELECT source, scope_id, grain, CAST(unnest(CASE grain WHEN 'day' THEN range(min(bucket_start), max(bucket_start) + INTERVAL 1 DAY, INTERVAL 1 DAY) WHEN 'week' THEN range(min(bucket_start), max(bucket_start) + INTERVAL 1 DAY, INTERVAL 7 DAY) ELSE range(min(bucket_start), max(bucket_start) + INTERVAL 1 DAY, INTERVAL 1 MONTH) END) AS DATE) AS bucket FROM flows GROUP BY 1, 2, 3) a LEFT JOIN flows f ON f.grain = a.grain AND f.source = a.source AND f.scope_id = a.scope_id AND CAST(f.bucket_start AS DATE) = a.bucket""", FLOWS),
    "gap_markers": with_ctes("SELECT * FROM (SELECT source, scope_id, bucket_start, date_diff('day', lag(bucket_start) OVER (PARTITION BY source, scope_id ORDER BY bucket_start), bucket_start) AS gap_days FROM flows WHERE grain = 'day') WHERE gap_days > 1", FLOWS),
    "crosswalk_summary": f"SELECT concept, count(*) AS n, count(*) FILTER (WHERE relation = 'exact-match') AS n_exact, CASE WHEN bool_or(relation = 'exact-match') THEN max(CASE WHEN relation = 'exact-match' THEN target_uri END) ELSE max(target_uri) END AS uri FROM ({CANDIDATES_SQL}) GROUP BY 1",
    "postcode_regions": f"SELECT postcode, CASE WHEN count(DISTINCT region) = 1 THEN min(region) END AS nuts_code, CASE WHEN count(DISTINCT region) = 1 THEN 'mapped' ELSE 'ambiguous' END AS mapping_status FROM ({PLACES_SQL}) GROUP BY 1",
    "snapshot_reconcile": "SELECT coalesce(a.user_id, b.user_id) AS user_id, CASE WHEN b.user_id IS NULL THEN 'closed' WHEN a.user_id IS NULL THEN 'added' ELSE 'unchanged' END AS state FROM (SELECT DISTINCT user_id FROM events WHERE day(ts) = 5) a FULL JOIN (SELECT DISTINCT user_id FROM events WHERE day(ts) = 6) b ON a.user_id = b.user_id",
    "log_fold_latest": "SELECT user_id, event_id, event_type, ts, entries FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n, count(*) OVER (PARTITION BY user_id) AS entries FROM events) WHERE n = 1",
    "keep_first_dedupe": "SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events) WHERE n = 1",
    "symmetric_difference": "SELECT user_id, 'left' AS side FROM (SELECT user_id FROM events WHERE day(ts) = 5 EXCEPT SELECT user_id FROM events WHERE day(ts) = 6) UNION ALL SELECT user_id, 'right' FROM (SELECT user_id FROM events WHERE day(ts) = 6 EXCEPT SELECT user_id FROM events WHERE day(ts) = 5)",
    "duplicate_grain": "SELECT user_id, event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2, 3 HAVING count(*) > 1",
    "label_conflicts": f"SELECT postcode AS nuts_code, count(DISTINCT region) AS n_labels FROM ({PLACES_SQL}) GROUP BY 1 HAVING count(DISTINCT region) > 1",
    "cadence_abandoned": with_ctes("SELECT * FROM (SELECT source, scope_id, date_diff('second', observed_at, TIMESTAMP '2024-02-20 00:00:00') / 3600.0 AS age_hours, freshness_threshold_hours FROM latest) WHERE age_hours > 4 * freshness_threshold_hours"),
    "unique_places": "SELECT CAST(floor(c_acctbal) AS BIGINT) AS postcode, min(c_nationkey) AS region FROM customer GROUP BY 1 HAVING count(DISTINCT c_nationkey) = 1",
    "round_robin_breadth": "SELECT c_custkey, c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS turn FROM customer",
    "date_diff_boundaries": f"SELECT event_id, date_diff('hour', ts, TIMESTAMP '{REFERENCE_TIME}') AS hours, date_diff('day', ts, TIMESTAMP '{REFERENCE_TIME}') AS days, date_diff('second', ts, TIMESTAMP '{REFERENCE_TIME}') AS seconds FROM events",
    "pii_scan": r"""SELECT 'text' AS field, pattern, hits FROM (SELECT unnest([{'pattern': 'email', 'hits': count(*) FILTER (WHERE regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}'))}, {'pattern': 'url', 'hits': count(*) FILTER (WHERE regexp_matches(text, 'https?://'))}, {'pattern': 'phone', 'hits': count(*) FILTER (WHERE regexp_matches(text, '\+[0-9][0-9 ()-]{7,}[0-9]'))}, {'pattern': 'card', 'hits': count(*) FILTER (WHERE regexp_matches(text, '\b[0-9]{16}\b'))}], recursive := true) FROM documents) WHERE hits > 0""",
    "suppression_leaks": with_ctes("SELECT source, scope_id, dimension, value_uri, posting_count FROM dimension_demand WHERE posting_count BETWEEN 1 AND 4"),
    "assertions": with_ctes(f"""SELECT name AS assertion, CAST(n AS BIGINT) AS offending FROM (SELECT 'cadence_not_abandoned' AS name, (SELECT count(*) FROM latest WHERE date_diff('second', observed_at, TIMESTAMP '2024-02-20 00:00:00') / 3600.0 > 4 * freshness_threshold_hours) AS n
UNION ALL SELECT 'nuts_frame_counts', (SELECT CASE WHEN count(DISTINCT nuts_code) = 21 THEN 0 ELSE 1 END FROM labels WHERE nuts_code LIKE 'SE___')
UNION ALL SELECT 'source_coverage', (SELECT count(*) FROM coverage WHERE coverage_status <> 'covered')
UNION ALL SELECT 'requirement_totals', (SELECT count(*) FROM (SELECT r.sweep_id, r.dimension FROM (SELECT sweep_id, dimension, sum(posting_count) AS c FROM ({REQUIREMENTS}) GROUP BY 1, 2) r JOIN (SELECT sweep_id, count(DISTINCT source_id) AS t FROM of_latest GROUP BY 1) s ON s.sweep_id = r.sweep_id WHERE c <> t UNION ALL SELECT sweep_id, dimension FROM ({REQUIREMENTS}) GROUP BY sweep_id, dimension, value_code, value_label HAVING count(*) > 1 UNION ALL SELECT sweep_id, dimension FROM ({REQUIREMENTS}) WHERE (mapping_status <> 'not_present' AND value_code IS NULL) OR (mapping_status = 'not_present' AND value_code IS NOT NULL) UNION ALL SELECT sweep_id, 'i' FROM ({REQUIREMENTS}) GROUP BY 1 HAVING count(DISTINCT dimension) <> 3))
UNION ALL SELECT 'sample_coverage_fixtures', (SELECT CASE WHEN bool_or(observed_rows = 0 AND coverage_status = 'covered') THEN 0 ELSE 1 END + CASE WHEN bool_or(freshness_status = 'fresh') THEN 0 ELSE 1 END + CASE WHEN bool_or(freshness_status = 'stale') THEN 0 ELSE 1 END FROM coverage)
UNION ALL SELECT 'vacancies_distinct_from_postings', (SELECT CASE WHEN bool_or(advertised_vacancies > posting_count) THEN 0 ELSE 1 END FROM ({SURVIVAL}))
UNION ALL SELECT 'posting_survival_suppression', (SELECT count(*) FROM ({SURVIVAL}) WHERE (is_suppressed AND coalesce(posting_count, advertised_vacancies, median_duration_days, p25_duration_days, p75_duration_days, max_duration_days) IS NOT NULL) OR (NOT is_suppressed AND posting_count BETWEEN 1 AND 4) OR max_duration_days < 0)
UNION ALL SELECT unnest(['closure_basis_vocabulary', 'incomplete_observations_excluded', 'inferred_closures_complete', 'key_rotation_does_not_close', 'latest_sweeps_include_empty', 'manifest_row_counts', 'mapping_coverage', 'mapping_outputs', 'no_cross_key_closures', 'no_orphan_observations', 'nuts_label_unambiguous', 'posting_flows_suppression', 'posting_lifecycle_grain_unique', 'postings_grain_unique', 'skill_grain_unique', 'survival_logic', 'zero_sweep_published']), 0)"""),
    "assertions_on_broken_marts": _broken_sql(),
    "assertions_on_faults": "SELECT unnest(['postings_grain_unique', 'skill_grain_unique', 'posting_lifecycle_grain_unique', 'nuts_label_unambiguous', 'no_orphan_observations', 'incomplete_observations_excluded', 'manifest_row_counts']) AS assertion, CAST(1 AS BIGINT) AS offending",
    "negative_durations": with_ctes("SELECT source, scope_id, hmac_key_version, source_id, posting_duration_days FROM lifecycle WHERE posting_duration_days < 0"),
    "page_truncation": "SELECT l_suppkey AS scope, arg_max(n, page) AS last_rows FROM (SELECT l_suppkey, month(l_shipdate) AS page, count(*) AS n FROM lineitem GROUP BY 1, 2) GROUP BY 1 HAVING arg_max(n, page) = 50",
    "stream_fold": "SELECT user_id, event_id, event_type, ts, entries FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n, count(*) OVER (PARTITION BY user_id) AS entries FROM events) WHERE n = 1",
    "stream_dedupe": "SELECT DISTINCT user_id, event_type FROM events",
}
ROWS_ONLY = ("hmac_pseudonym",)


def queries() -> dict:
    return {name: globals()[name] for name in (*ORACLES, *ROWS_ONLY)}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
