"""Queries over the posting model."""

from __future__ import annotations


from pyspark.sql import functions as F

from ..operators import events as E
from ..operators import marts as M
from ..operators import staging as S
from .adapter import flows_sql, model, with_ctes

SWEEP_COLUMNS = ["source", "scope_id", "sweep_id", "hmac_key_version", "observed_at", "completed_at", "row_count", "status", "expected_country", "freshness_threshold_hours", "coverage_limitations"]
SWEEPS = ", ".join(SWEEP_COLUMNS)
POSTING_COLUMNS = ["source", "scope_id", "sweep_id", "hmac_key_version", "source_id", "observed_at", "number_of_vacancies", "removed_at", "country", "nuts_code", "nuts_label", "region_mapping_status", "esco_occupation_uri", "duration_label"]

SKILLS_SQL = "SELECT source, scope_id, sweep_id, source_id, hmac_key_version, observed_at, skill_ordinal, esco_skill_uri, esco_skill_label, mapping_status, mapping_confidence, mapping_method, jobtech_taxonomy_version, esco_version FROM skills"

QUERIES = {
    "admitted_sweeps": (lambda m: m.sweeps.select(*SWEEP_COLUMNS), f"SELECT {SWEEPS} FROM sweeps"),
    "postings_staged": (lambda m: m.postings.select(*POSTING_COLUMNS), f"SELECT {', '.join(POSTING_COLUMNS)} FROM postings"),
    "nuts_labels_min": (lambda m: m.labels, "SELECT nuts_code, nuts_label FROM labels"),
    "skill_unnest": (lambda m: m.skills, SKILLS_SQL),
    "skill_unnest_text": (lambda m: S.skill_mappings(m.postings.withColumn("skill_mappings", F.to_json("skill_mappings"))), SKILLS_SQL),
    "posting_events": (lambda m: E.posting_events(m.postings, m.sweeps), "SELECT * FROM posting_events"),
    "posting_lifecycle": (lambda m: m.lifecycle(), "SELECT * FROM lifecycle"),
    "closure_direct": (lambda m: E.closures_direct(m.postings, m.sweeps), "SELECT * FROM closures"),
    "closure_calendar": (lambda m: E.closures(m.postings, m.sweeps), "SELECT * FROM closures"),
    "latest_sweeps": (lambda m: m.latest, f"SELECT {', '.join(M.LATEST_COLUMNS)} FROM latest"),
    "source_coverage": (lambda m: m.coverage(), "SELECT * FROM coverage"),
    "labour_demand_latest": (
        lambda m: M.labour_demand(m.latest, m.coverage()),
        "SELECT l.source, l.scope_id, l.partition_id, l.sweep_id, l.run_id, l.expected_country AS country, l.observed_at, l.started_at, l.completed_at, l.status, l.hmac_key_version, l.source_version, l.licence_reference, l.access_method, l.approval_status, l.coverage_limitations, c.freshness_age_hours, c.freshness_status, c.coverage_status, c.observed_rows AS active_postings FROM latest l JOIN coverage c ON c.source = l.source AND c.scope_id = l.scope_id AND c.sweep_id = l.sweep_id WHERE c.coverage_status = 'covered'",
    ),
    "dimension_demand": (lambda m: M.dimension_demand(m.postings, m.latest), "SELECT * FROM dimension_demand"),
    "skill_demand": (
        lambda m: M.skill_demand(m.postings, m.skills, m.latest),
        "SELECT p.source, p.scope_id, p.sweep_id, p.observed_at, 'skill' AS dimension, k.esco_skill_uri AS value_uri, k.esco_skill_label AS value_label, k.esco_version AS taxonomy_version, count(DISTINCT p.source_id) AS posting_count FROM of_latest p JOIN skills k ON k.source = p.source AND k.scope_id = p.scope_id AND k.sweep_id = p.sweep_id AND k.source_id = p.source_id AND k.mapping_status = 'mapped' GROUP BY ALL",
    ),
    "requirement_demand": (
        lambda m: M.requirement_demand(m.postings, m.latest),
        " UNION ALL ".join(f"SELECT source, scope_id, sweep_id, observed_at, '{d}' AS dimension, {d}_code AS value_code, {d}_label AS value_label, {d}_mapping_status AS mapping_status, count(DISTINCT source_id) AS posting_count FROM of_latest WHERE {d}_mapping_status IS NOT NULL GROUP BY ALL" for d in M.REQUIREMENTS),
    ),
    "mapping_quality": (
        lambda m: M.mapping_quality(m.postings, m.skills, m.latest),
        """SELECT *, CAST(sum(outcome_count) OVER (PARTITION BY source, scope_id, sweep_id, dimension) AS BIGINT) AS total_outcomes FROM (
SELECT source, scope_id, sweep_id, 'region' AS dimension, region_mapping_status AS mapping_status, region_mapping_method AS mapping_method, CAST(NULL AS VARCHAR) AS mapping_confidence, nuts_version AS taxonomy_version, count(DISTINCT source_id) AS outcome_count FROM of_latest GROUP BY ALL
UNION ALL SELECT source, scope_id, sweep_id, 'occupation', occupation_mapping_status, occupation_mapping_method, occupation_mapping_confidence, esco_version, count(DISTINCT source_id) FROM of_latest GROUP BY ALL
UNION ALL SELECT source, scope_id, sweep_id, 'skill', mapping_status, mapping_method, mapping_confidence, esco_version, count(*) FROM latest_skills GROUP BY ALL)""",
    ),
    "mapping_coverage": (
        lambda m: M.mapping_coverage(m.postings, m.skills, m.latest),
        """SELECT source, scope_id, sweep_id, 'region' AS dimension, count(DISTINCT source_id) AS postings_total, count(DISTINCT CASE WHEN region_mapping_status <> 'not_present' THEN source_id END) AS postings_with_source_value, count(DISTINCT CASE WHEN region_mapping_status = 'mapped' THEN source_id END) AS postings_mapped, max(nuts_version) AS taxonomy_version FROM of_latest GROUP BY 1, 2, 3
UNION ALL SELECT source, scope_id, sweep_id, 'occupation', count(DISTINCT source_id), count(DISTINCT CASE WHEN occupation_mapping_status <> 'not_present' THEN source_id END), count(DISTINCT CASE WHEN occupation_mapping_status = 'mapped' THEN source_id END), max(esco_version) FROM of_latest GROUP BY 1, 2, 3
UNION ALL SELECT p.source, p.scope_id, p.sweep_id, 'skill', count(DISTINCT p.source_id), count(DISTINCT CASE WHEN f.v THEN p.source_id END), count(DISTINCT CASE WHEN f.m THEN p.source_id END), max(p.esco_version) FROM of_latest p LEFT JOIN (SELECT source, scope_id, sweep_id, source_id, bool_or(mapping_status <> 'not_present') AS v, bool_or(mapping_status = 'mapped') AS m FROM skills GROUP BY 1, 2, 3, 4) f USING (source, scope_id, sweep_id, source_id) GROUP BY 1, 2, 3""",
    ),
    "region_breadth": (
        lambda m: M.region_breadth(M.dimension_demand(m.postings, m.latest), m.latest, m.labels),
        "SELECT d.source, d.scope_id, d.country, d.n AS regions_with_postings, f.n AS regions_in_frame FROM (SELECT d.source, d.scope_id, l.expected_country AS country, count(DISTINCT d.value_uri) AS n FROM dimension_demand d JOIN latest l ON l.source = d.source AND l.scope_id = d.scope_id WHERE d.dimension = 'region' GROUP BY 1, 2, 3) d LEFT JOIN (SELECT left(nuts_code, 2) AS country, count(DISTINCT nuts_code) AS n FROM labels WHERE length(nuts_code) = 5 GROUP BY 1) f ON f.country = d.country",
    ),
    "collection_frequency": (
        lambda m: M.collection_frequency(m.sweeps),
        "SELECT source, scope_id, count(*) AS complete_sweeps, min(observed_at) AS first_observed_at, max(observed_at) AS last_observed_at, CAST(median(gap_hours) AS DOUBLE) AS median_interval_hours, max(freshness_threshold_hours) AS freshness_threshold_hours, max(coverage_limitations) AS coverage_limitations FROM (SELECT *, date_diff('hour', lag(observed_at) OVER (PARTITION BY source, scope_id ORDER BY observed_at), observed_at) AS gap_hours FROM sweeps) GROUP BY 1, 2",
    ),
    "posting_survival": (
        lambda m: M.posting_survival(m.lifecycle()),
        """SELECT source, scope_id, lifecycle_status, n > 0 AND n < 5 AS is_suppressed, any_right_censored, CASE WHEN n >= 5 THEN n END AS posting_count, CASE WHEN n >= 5 THEN v END AS advertised_vacancies, CASE WHEN n >= 5 THEN q50 END AS median_duration_days, CASE WHEN n >= 5 THEN q25 END AS p25_duration_days, CASE WHEN n >= 5 THEN q75 END AS p75_duration_days, CASE WHEN n >= 5 THEN longest END AS max_duration_days
FROM (SELECT source, scope_id, lifecycle_status, count(*) AS n, CAST(sum(coalesce(advertised_vacancies, 0)) AS BIGINT) AS v, bool_or(is_right_censored) AS any_right_censored, CAST(quantile_cont(posting_duration_days, 0.5) AS DOUBLE) AS q50, CAST(quantile_cont(posting_duration_days, 0.25) AS DOUBLE) AS q25, CAST(quantile_cont(posting_duration_days, 0.75) AS DOUBLE) AS q75, max(posting_duration_days) AS longest FROM lifecycle GROUP BY 1, 2, 3)""",
    ),
}


def queries() -> dict:
    found = {name: (lambda spark, sf_dir, make=make: make(model(spark, sf_dir))) for name, (make, _) in QUERIES.items()}
    for name, compat in (("posting_flows_compat", True), ("posting_flows_fixed", False)):
        found[name] = lambda spark, sf_dir, compat=compat: M.posting_flows((m := model(spark, sf_dir)).lifecycle(), m.sweeps, m.postings, compat)
    return found


def oracle_sql() -> dict[str, str]:
    return {name: with_ctes(sql) for name, (_, sql) in QUERIES.items()} | {"posting_flows_compat": flows_sql(True), "posting_flows_fixed": flows_sql(False)}
