"""Queries of findings, served orders and mapping evaluation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import evaluate, insights, serving
from ..operators import marts as M
from .adapter import FLOW_PARTS, model, read, stock_cte, with_ctes
from .posting_queries import QUERIES as MARTS

FLOWS = FLOW_PARTS | {"stock": stock_cte("stock_of_sweep")}
SCOPE = ["source", "scope_id"]


def mart(name: str) -> str:
    return f"({MARTS[name][1]})"


def findings(spark, sf_dir):
    """Every sentence that the rules generate over the marts."""
    m = model(spark, sf_dir)
    marts = m.marts()
    demand, skills, mapped, coverage, flows, needs = (marts[k] for k in ("demand", "skills", "mapped", "coverage", "flows", "requirements"))
    found = insights.every([
        insights.latest_count(marts["labour"]), insights.most_requested(demand, mapped, "occupation"), insights.most_requested(skills, mapped, "skill"), insights.region_concentration(demand, mapped),
        insights.requirement_shares(needs, "employment_type", ("0", "1")), insights.requirement_shares(needs, "working_hours_type", ("0", "1")), insights.median_duration(M.posting_survival(m.lifecycle())),
        insights.freshness_warning(coverage, m.latest), insights.sweep_churn(flows), insights.stock_trend(flows, M.collection_frequency(m.sweeps)), insights.run_state(coverage),
        insights.ranking_shortfall(demand, mapped, "occupation"), insights.empty_by_construction(mapped),
    ])
    return found.select("source", "scope_id", "section", "rule", "text")


def _leader(table: str, dimension: str) -> str:
    return f"""(SELECT l.*, c.postings_total, c.postings_mapped FROM (SELECT source, scope_id, value_label, posting_count, row_number() OVER w AS place, lead(posting_count) OVER w AS runner_up, count(*) OVER (PARTITION BY source, scope_id) AS n FROM {table} WHERE dimension = '{dimension}' WINDOW w AS (PARTITION BY source, scope_id ORDER BY posting_count DESC, value_label NULLS LAST, value_uri NULLS LAST)) l
JOIN {mart("mapping_coverage")} c ON c.source = l.source AND c.scope_id = l.scope_id AND c.dimension = '{dimension}' WHERE place = 1 AND (runner_up IS NULL OR runner_up < posting_count) AND posting_count BETWEEN 1 AND postings_mapped AND postings_mapped <= postings_total AND value_label <> '')"""


def _shares(dimension: str, text: str) -> str:
    return f"SELECT source, scope_id, 'requirements', '{dimension}_shares', format('{text}', total, a, b) FROM (SELECT source, scope_id, CAST(sum(posting_count) AS BIGINT) AS total, max(posting_count) FILTER (WHERE value_code = '0') AS a, max(posting_count) FILTER (WHERE value_code = '1') AS b FROM {mart('requirement_demand')} WHERE dimension = '{dimension}' GROUP BY 1, 2) WHERE a > 0 AND b > 0 AND a + b <= total"


PAIR = "(SELECT *, date_diff('day', older, bucket_start) AS apart FROM (SELECT source, scope_id, bucket_start, openings, closures, active_postings, row_number() OVER w AS place, lead(bucket_start) OVER w AS older, lead(active_postings) OVER w AS before FROM flows WHERE grain = 'day' WINDOW w AS (PARTITION BY source, scope_id ORDER BY bucket_start DESC)) WHERE place = 1 AND older IS NOT NULL)"
DAY = "'%Y-%m-%d'"
FINDINGS_SQL = with_ctes(f"""
SELECT source, scope_id, 'overview' AS section, 'latest_count' AS rule, format('The latest complete sweep observed {{:,}} active posting(s) on {{}}.', active_postings, strftime(observed_at, {DAY})) AS text FROM {mart("labour_demand_latest")} WHERE active_postings > 0
UNION ALL SELECT source, scope_id, 'demand', 'most_requested_occupation', format('The most frequently mapped occupation is {{}}, in {{:,}} of {{:,}} mapped posting(s).', value_label, posting_count, postings_mapped) FROM {_leader("dimension_demand", "occupation")}
UNION ALL SELECT source, scope_id, 'demand', 'most_requested_skill', format('The most frequently mapped skill is {{}}, asked for in {{:,}} of {{:,}} posting(s) with a mapped skill.', value_label, posting_count, postings_mapped) FROM {_leader(mart("skill_demand"), "skill")}
UNION ALL SELECT source, scope_id, 'regions', 'region_concentration', format('The leading region is {{}}, with {{:,}} of {{:,}} mapped posting(s) in this sweep.', value_label, posting_count, postings_mapped) FROM {_leader("dimension_demand", "region")} WHERE n >= 2
UNION ALL {_shares("employment_type", "Of {:,} postings in the latest sweep, {:,} are permanent employment and {:,} are fixed-term employment.")}
UNION ALL {_shares("working_hours_type", "Of {:,} postings in the latest sweep, {:,} are full-time and {:,} are part-time.")}
UNION ALL SELECT source, scope_id, 'survival', 'median_duration', format('The median observed duration is {{:.1f}} days across the {{:,}} closed posting(s); postings still open are right-censored and are excluded.', d, p) FROM (SELECT source, scope_id, count(*) AS n, bool_or(any_right_censored) AS c, max(median_duration_days) AS d, max(posting_count) AS p FROM {mart("posting_survival")} WHERE lifecycle_status IN ('source_reported', 'inferred_absence') GROUP BY 1, 2) WHERE n = 1 AND NOT c AND d IS NOT NULL AND p > 0
UNION ALL SELECT source, scope_id, 'overview', 'freshness_warning', 'Read the figures with care: ' || concat_ws('; ', f, c) || '.' FROM (SELECT v.source, v.scope_id, CASE freshness_status WHEN 'stale' THEN format('the latest sweep is {{:.0f}} hours old, past its freshness threshold', v.freshness_age_hours) WHEN 'unknown' THEN 'the latest sweep has unknown freshness' END AS f,
CASE coverage_status WHEN 'invalid' THEN format('it stored {{:,}} of {{:,}} expected row(s)', v.observed_rows, v.expected_rows) WHEN 'unknown_metadata' THEN 'its coverage is uncertified because sweep approval or metadata is incomplete' END AS c FROM coverage v JOIN latest l ON l.source = v.source AND l.scope_id = v.scope_id AND l.sweep_id = v.sweep_id) WHERE f IS NOT NULL OR c IS NOT NULL
UNION ALL SELECT source, scope_id, 'flows', 'sweep_churn', format('Between the two most recent daily buckets ({{}}), {{:,}} posting(s) opened and {{:,}} closed, leaving {{:,}} active.', CASE WHEN apart > 1 THEN apart || ' days apart' ELSE 'one day apart' END, openings, closures, active_postings) FROM {PAIR} WHERE openings IS NOT NULL AND closures IS NOT NULL AND active_postings IS NOT NULL
UNION ALL SELECT p.source, p.scope_id, 'flows', 'trend', CASE WHEN active_postings = before THEN format('Active postings were unchanged at {{:,}} between {{}} and {{}}.', before, strftime(older, {DAY}), strftime(bucket_start, {DAY})) ELSE format('Active postings {{}} from {{:,}} on {{}} to {{:,}} on {{}}.', CASE WHEN active_postings > before THEN 'rose' ELSE 'fell' END, before, strftime(older, {DAY}), active_postings, strftime(bucket_start, {DAY})) END
FROM {PAIR} p JOIN {mart("collection_frequency")} q ON q.source = p.source AND q.scope_id = p.scope_id WHERE apart = 1 AND before IS NOT NULL AND active_postings IS NOT NULL AND complete_sweeps >= 14 AND date_diff('day', first_observed_at, last_observed_at) >= 7
UNION ALL SELECT source, scope_id, 'overview', 'run_state', 'The last complete sweep ' || format('is {{:.1f}} days old', freshness_age_hours / 24) || ', ' || CASE freshness_status WHEN 'fresh' THEN 'which is inside the source freshness threshold' WHEN 'stale' THEN 'which is past the ' || freshness_threshold_hours || ' hour freshness threshold, so read it as out of date' ELSE 'and no freshness threshold is recorded for it' END || '. ' ||
CASE WHEN observed_rows < expected_rows THEN format('It stored {{:,}} of {{:,}} expected row(s), so rows are missing.', observed_rows, expected_rows) WHEN observed_rows > expected_rows THEN format('It stored {{:,}} row(s) against {{:,}} expected, so it holds more than its own manifest.', observed_rows, expected_rows) WHEN coverage_status = 'invalid' THEN format('It stored the expected {{:,}} row(s), but some of them fall outside the expected country.', observed_rows) ELSE format('It stored all {{:,}} expected row(s).', observed_rows) END || CASE WHEN coverage_status = 'unknown_metadata' THEN ' Coverage is uncertified because sweep approval or metadata is incomplete.' ELSE '' END FROM coverage
UNION ALL SELECT c.source, c.scope_id, 'demand', 'occupation_shortfall', format('Ranked from {{:,}} mapped posting(s) of {{:,}} in the latest sweep; {{:,}} carry a structured occupation.', postings_mapped, postings_total, postings_with_source_value) || CASE WHEN shown < postings_mapped THEN format(' Only the {{:,}} most frequent occupations are listed below, accounting for {{:,}} of those mapped postings; the rest sit in an unlisted tail.', listed, shown) ELSE '' END
FROM {mart("mapping_coverage")} c JOIN (SELECT source, scope_id, CAST(sum(posting_count) AS BIGINT) AS shown, count(*) AS listed FROM (SELECT *, row_number() OVER (PARTITION BY source, scope_id ORDER BY posting_count DESC, value_label NULLS LAST, value_uri NULLS LAST) AS place FROM dimension_demand WHERE dimension = 'occupation') WHERE place <= 25 GROUP BY 1, 2) t ON t.source = c.source AND t.scope_id = c.scope_id WHERE c.dimension = 'occupation' AND postings_total > 0
UNION ALL SELECT source, scope_id, 'coverage', 'empty_by_construction', 'The source tells nothing on ' || dimension || '.' FROM {mart("mapping_coverage")} WHERE postings_total > 0 AND postings_with_source_value = 0
""", FLOWS)


def newest_pair(spark, sf_dir):
    """The two newest day buckets of each scope."""
    m = model(spark, sf_dir)
    return insights.newest_pair(M.posting_flows(m.lifecycle(), m.sweeps, m.postings)).select("source", "scope_id", "bucket_start", "openings", "closures", "active_postings", "older", "before", "days_apart")


def stock_direction(spark, sf_dir):
    m = model(spark, sf_dir)
    return serving.direction(M.posting_flows(m.lifecycle(), m.sweeps, m.postings))


def _demand(m):
    return M.dimension_demand(m.postings, m.latest)


def demand_places(spark, sf_dir):
    return serving.places(_demand(model(spark, sf_dir)), "dimension", SCOPE).select("source", "scope_id", "dimension", "value_uri", "place")


def requirement_places(spark, sf_dir):
    m = model(spark, sf_dir)
    return serving.places(M.requirement_demand(m.postings, m.latest), "requirement", [*SCOPE, "dimension"]).select("source", "scope_id", "dimension", "value_code", "value_label", "place")


def labour_demand_places(spark, sf_dir):
    m = model(spark, sf_dir)
    return serving.in_order(M.labour_demand(m.latest, m.coverage()), "demand").select("source", "scope_id", "country", "active_postings")


def newest_coverage(spark, sf_dir):
    return serving.latest_coverage(model(spark, sf_dir).coverage()).select("source", "scope_id", "sweep_id", "observed_at", "coverage_status")


def outcomes_by_status(spark, sf_dir):
    m = model(spark, sf_dir)
    return serving.outcomes_by_status(M.mapping_quality(m.postings, m.skills, m.latest))


def region_bars(spark, sf_dir):
    return serving.bars(_demand(model(spark, sf_dir)))


def scope_groups(spark, sf_dir):
    m = model(spark, sf_dir)
    return serving.scope_groups(M.labour_demand(m.latest, m.coverage()))


def _reviews(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    expected = F.when(F.col("l_tax") > 0.02, F.when(F.col("l_linestatus") == "F", "A").otherwise("N"))
    return li.select(F.when(F.col("l_quantity") > 10, F.col("l_returnflag")).alias("produced"), expected.alias("expected"), F.when(F.col("l_discount") > 0.05, "narrower-or-broader").alias("verdict"))


REVIEWS = "(SELECT CASE WHEN l_quantity > 10 THEN l_returnflag END AS p, CASE WHEN l_tax > 0.02 THEN CASE WHEN l_linestatus = 'F' THEN 'A' ELSE 'N' END END AS e, l_discount > 0.05 AS loose FROM lineitem)"


def precision_recall(spark, sf_dir):
    return evaluate.precision_recall(_reviews(spark, sf_dir))


def refusals(spark, sf_dir):
    return evaluate.refusals(_reviews(spark, sf_dir))


def set_precision_recall(spark, sf_dir):
    """Sets of suppliers of each order's lines with odd and with low numbers."""
    lines = read(spark, sf_dir, "lineitem").groupBy("l_orderkey")
    sets = lines.agg(F.collect_set(F.when(F.col("l_linenumber") % 2 == 1, F.col("l_suppkey"))).alias("produced_set"), F.collect_set(F.when(F.col("l_linenumber") < 4, F.col("l_suppkey"))).alias("expected_set"))
    return evaluate.set_tallies(sets.withColumn("verdict", F.when(F.col("l_orderkey") % 3 == 0, "narrower-or-broader")))


def _metrics_sql(source: str) -> str:
    return f"""SELECT *, strict_tp / nullif(strict_tp + strict_fp, 0) AS strict_precision, strict_tp / nullif(strict_tp + strict_fn, 0) AS strict_recall, lenient_tp / nullif(lenient_tp + lenient_fp, 0) AS lenient_precision, lenient_tp / nullif(lenient_tp + lenient_fn, 0) AS lenient_recall
FROM (SELECT CAST(sum(CASE WHEN NOT loose THEN hit ELSE 0 END) AS BIGINT) AS strict_tp, CAST(sum(surplus + CASE WHEN loose THEN hit ELSE 0 END) AS BIGINT) AS strict_fp, CAST(sum(missed) AS BIGINT) AS strict_fn, CAST(sum(hit) AS BIGINT) AS lenient_tp, CAST(sum(surplus) AS BIGINT) AS lenient_fp, CAST(sum(missed) AS BIGINT) AS lenient_fn FROM ({source}))"""


def _crosswalk(spark, sf_dir):
    parts = read(spark, sf_dir, "part")
    return parts.select(F.col("p_type").alias("concept"), F.concat("p_brand", F.lit(":"), F.col("p_size") % 9).alias("target_uri"), F.when(F.col("p_size") % 11 == 0, "exact-match").otherwise("close-match").alias("relation")).distinct()


CROSSWALK = "(SELECT DISTINCT p_type AS concept, p_brand || ':' || (p_size % 9) AS target_uri, CASE WHEN p_size % 11 = 0 THEN 'exact-match' ELSE 'close-match' END AS relation FROM part)"


def collision_census(spark, sf_dir):
    candidates = _crosswalk(spark, sf_dir)
    return evaluate.collision_census(candidates, candidates.where("concept LIKE '%STEEL%' OR concept LIKE '%a%'").select("concept"))


def quiet_findings(spark, sf_dir):
    """The two findings that the model itself gives no cause for: scopes with one basis of closure, and sources that tell nothing on skills."""
    m = model(spark, sf_dir)
    silent = (F.col("dimension") == "skill") & F.col("scope_id").isin("click", "view")
    mapped = m.marts()["mapped"].withColumn("postings_with_source_value", F.when(silent, 0).otherwise(F.col("postings_with_source_value")))
    closed = M.posting_survival(m.lifecycle().where("lifecycle_status = 'inferred_absence'"))
    return insights.every([insights.median_duration(closed), insights.empty_by_construction(mapped)]).select("source", "scope_id", "section", "rule", "text")


QUIET_SQL = with_ctes(
    f"""SELECT source, scope_id, 'survival' AS section, 'median_duration' AS rule, format('The median observed duration is {{:.1f}} days across the {{:,}} closed posting(s); postings still open are right-censored and are excluded.', q, n) AS text
FROM (SELECT source, scope_id, count(*) AS n, CAST(quantile_cont(posting_duration_days, 0.5) AS DOUBLE) AS q FROM lifecycle WHERE lifecycle_status = 'inferred_absence' GROUP BY 1, 2) WHERE n >= 5
UNION ALL SELECT source, scope_id, 'coverage', 'empty_by_construction', 'The source tells nothing on skill.' FROM {mart("mapping_coverage")} WHERE dimension = 'skill' AND scope_id IN ('click', 'view') AND postings_total > 0"""
)


def served_orders(spark, sf_dir):
    """The place of each row of six served tables, counted by source."""
    m = model(spark, sf_dir)
    marts = m.marts()
    tables = {
        "coverage": (serving.latest_coverage(marts["coverage"]), "sweep_id"), "breadth": (M.region_breadth(marts["demand"], m.latest, m.labels), "country"), "frequency": (M.collection_frequency(m.sweeps), "scope_id"),
        "mapping": (serving.outcomes_by_status(marts["quality"]), "mapping_status"), "mapping_coverage": (marts["mapped"], "dimension"), "provenance": (m.latest, "sweep_id"),
    }
    placed = [serving.places(table, name, ["source"]).select(F.lit(name).alias("table_name"), *SCOPE, F.col(detail).alias("detail"), "place") for name, (table, detail) in tables.items()]
    return reduce(DataFrame.unionByName, placed)


#: Table, detail and order, as the SQL has them.
SERVED = (
    ("coverage", "sweep_id", "(SELECT * FROM coverage QUALIFY row_number() OVER (PARTITION BY source, scope_id ORDER BY observed_at DESC, sweep_id DESC) = 1)", "scope_id, country, observed_at DESC"), ("breadth", "country", mart("region_breadth"), "scope_id"), ("frequency", "scope_id", mart("collection_frequency"), "scope_id"),
    ("mapping", "mapping_status", f"(SELECT source, scope_id, dimension, mapping_status FROM {mart('mapping_quality')} GROUP BY ALL)", "scope_id, dimension, mapping_status"), ("mapping_coverage", "dimension", mart("mapping_coverage"), "scope_id, dimension"), ("provenance", "sweep_id", "latest", "scope_id"),
)
SERVED_SQL = with_ctes(" UNION ALL ".join(f"SELECT '{name}' AS table_name, source, scope_id, {detail} AS detail, row_number() OVER (PARTITION BY source ORDER BY {order}) AS place FROM {table} x" for name, detail, table, order in SERVED))

QUERIES = {
    "quiet_findings": (quiet_findings, QUIET_SQL),
    "served_orders": (served_orders, SERVED_SQL),
    "findings": (findings, FINDINGS_SQL),
    "newest_pair": (newest_pair, with_ctes(f"SELECT source, scope_id, bucket_start, openings, closures, active_postings, older, before, apart AS days_apart FROM {PAIR}", FLOWS)),
    "stock_direction": (stock_direction, with_ctes("SELECT source, scope_id, a AS first_stock, b AS last_stock, CASE WHEN b > a THEN 'rising' WHEN b < a THEN 'falling' ELSE 'flat' END AS direction FROM (SELECT source, scope_id, count(*) AS n, arg_min(active_postings, bucket_start) AS a, arg_max(active_postings, bucket_start) AS b FROM flows WHERE grain = 'day' AND active_postings IS NOT NULL GROUP BY 1, 2) WHERE n >= 2", FLOWS)),
    "demand_places": (demand_places, with_ctes("SELECT source, scope_id, dimension, value_uri, row_number() OVER (PARTITION BY source, scope_id ORDER BY posting_count DESC, dimension, value_label NULLS LAST, value_uri NULLS LAST) AS place FROM dimension_demand")),
    "requirement_places": (requirement_places, with_ctes(f"SELECT source, scope_id, dimension, value_code, value_label, row_number() OVER (PARTITION BY source, scope_id, dimension ORDER BY posting_count DESC, value_label NULLS LAST, value_code NULLS LAST) AS place FROM {mart('requirement_demand')}")),
    "labour_demand_places": (labour_demand_places, with_ctes(f"SELECT source, scope_id, country, active_postings FROM {mart('labour_demand_latest')} ORDER BY active_postings DESC, source, country")),
    "newest_coverage": (newest_coverage, with_ctes("SELECT source, scope_id, sweep_id, observed_at, coverage_status FROM coverage QUALIFY row_number() OVER (PARTITION BY source, scope_id ORDER BY observed_at DESC, sweep_id DESC) = 1")),
    "outcomes_by_status": (outcomes_by_status, with_ctes(f"SELECT source, scope_id, dimension, mapping_status, CAST(sum(outcome_count) AS BIGINT) AS outcome_count FROM {mart('mapping_quality')} GROUP BY 1, 2, 3, 4")),
    "region_bars": (region_bars, with_ctes("SELECT *, posting_count / max(posting_count) OVER (PARTITION BY source, scope_id) AS share FROM (SELECT source, scope_id, dimension, value_uri, value_label, posting_count, row_number() OVER (PARTITION BY source, scope_id ORDER BY posting_count DESC, value_label NULLS LAST, value_uri NULLS LAST) AS place FROM dimension_demand WHERE dimension = 'region') WHERE place <= 5")),
    "scope_groups": (scope_groups, with_ctes(f"SELECT source, string_agg(scope_id, ',' ORDER BY active_postings DESC, scope_id) AS scopes, CAST(sum(active_postings) AS BIGINT) AS active_postings FROM {mart('labour_demand_latest')} GROUP BY 1")),
    "precision_recall": (precision_recall, _metrics_sql(f"SELECT loose, CASE WHEN p = e THEN 1 ELSE 0 END AS hit, CASE WHEN p IS NOT NULL AND p IS DISTINCT FROM e THEN 1 ELSE 0 END AS surplus, CASE WHEN e IS NOT NULL AND p IS DISTINCT FROM e THEN 1 ELSE 0 END AS missed FROM {REVIEWS}")),
    "refusals": (refusals, f"SELECT count(*) FILTER (WHERE p IS NULL AND e IS NULL) AS correct_refusals, count(*) FILTER (WHERE p IS NULL AND e IS NOT NULL) AS incorrect_refusals FROM {REVIEWS}"),
    "set_precision_recall": (set_precision_recall, _metrics_sql("SELECT l_orderkey % 3 = 0 AS loose, len(list_intersect(a, b)) AS hit, len(a) - len(list_intersect(a, b)) AS surplus, len(b) - len(list_intersect(a, b)) AS missed FROM (SELECT l_orderkey, coalesce(list(DISTINCT l_suppkey) FILTER (WHERE l_linenumber % 2 = 1), []) AS a, coalesce(list(DISTINCT l_suppkey) FILTER (WHERE l_linenumber < 4), []) AS b FROM lineitem GROUP BY 1)")),
    "collision_census": (collision_census, f"SELECT count(*) AS tiebroken_concepts, count(*) FILTER (WHERE r > 1) AS with_rival_exact_match, count(*) FILTER (WHERE r > 1 AND (concept LIKE '%STEEL%' OR concept LIKE '%a%')) AS in_review_sample FROM (SELECT s.concept, (SELECT count(DISTINCT concept) FROM {CROSSWALK} x WHERE x.relation = 'exact-match' AND x.target_uri = s.uri) AS r FROM (SELECT concept, min(target_uri) FILTER (WHERE relation = 'exact-match') AS uri FROM {CROSSWALK} GROUP BY 1 HAVING count(*) > 1 AND count(*) FILTER (WHERE relation = 'exact-match') = 1) s)"),
}


def queries() -> dict:
    return {name: query for name, (query, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in QUERIES.items()}
