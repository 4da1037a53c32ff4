"""Checks of pages, checkpoints, panels and segments over collections derived from the given tables, each with rows that offend."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import checks, panel, reconcile
from ..sources import readers, writers
from ..sources.storage import new_path
from .adapter import model, read, with_ctes

PAGE_SIZE = 50


def _supplier_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as hits, suppliers as scopes, months as pages; some scopes tell a total that changes or is wrong."""
    by = read(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("scope"), F.month("l_shipdate").alias("page")).agg(F.count(F.lit(1)).alias("n_ids"), F.countDistinct("l_partkey").alias("n_distinct"))
    of = by.groupBy("scope").agg(F.max("page").alias("last_page"), F.sum("n_ids").alias("rows"))
    total = F.col("rows") + F.when(F.col("scope") % 5 == 0, 1).when(F.col("scope") % 7 == 0, F.col("page")).otherwise(0)
    return by.join(of, "scope").withColumn("total", total).drop("rows")


PAGES = """hits AS (SELECT l_suppkey AS scope, month(l_shipdate) AS page, count(*) AS n_ids, count(DISTINCT l_partkey) AS n_distinct FROM lineitem GROUP BY 1, 2),
pages AS (SELECT *, max(page) OVER w AS last_page, sum(n_ids) OVER w + CASE WHEN scope % 5 = 0 THEN 1 WHEN scope % 7 = 0 THEN page ELSE 0 END AS total FROM hits WINDOW w AS (PARTITION BY scope))"""


def page_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.page_problems(_supplier_pages(spark, sf_dir), PAGE_SIZE)


PROBLEMS_SQL = f"""WITH {PAGES},
by_scope AS (SELECT scope, count(DISTINCT total) AS totals, count(*) FILTER (WHERE page < last_page AND n_ids <> {PAGE_SIZE}) AS short, sum(n_ids - n_distinct) AS repeats, sum(n_ids) AS ids, max(total) AS total FROM pages GROUP BY 1)
SELECT scope, 'total changed' AS problem FROM by_scope WHERE totals > 1 UNION ALL SELECT scope, 'short page' FROM by_scope WHERE short > 0 UNION ALL SELECT scope, 'repeated id' FROM by_scope WHERE repeats > 0 UNION ALL SELECT scope, 'rows do not reconcile' FROM by_scope WHERE ids <> total"""


def unreachable_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands as scopes whose lines lie behind the last offset."""
    lines = read(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("scope")).agg((F.count(F.lit(1)) * 80).alias("total"))
    return checks.unreachable(lines.withColumn("page_size", F.lit(100)), 2000)


UNREACHABLE_SQL = "SELECT * FROM (SELECT l_partkey AS scope, count(*) * 80 AS total, 100 AS page_size, 2100 AS reachable FROM lineitem GROUP BY 1) WHERE total > reachable"


def filter_not_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as pages that asked for a priority, their orders as hits."""
    o = read(spark, sf_dir, "orders")
    pages = o.groupBy(F.col("o_custkey").alias("page")).agg(F.min("o_orderstatus").alias("asked"), F.collect_list("o_orderstatus").alias("hits"))
    return checks.filter_not_applied(pages.withColumn("asked", F.when(F.col("page") % 6 > 0, F.col("asked"))), 10, 0.5)


FILTER_SQL = "SELECT page, asked, n, matching FROM (SELECT *, (SELECT count(*) FROM orders o WHERE o.o_custkey = page AND o.o_orderstatus = asked) AS matching FROM (SELECT o_custkey AS page, CASE WHEN o_custkey % 6 > 0 THEN min(o_orderstatus) END AS asked, CAST(count(*) AS INTEGER) AS n FROM orders GROUP BY o_custkey)) WHERE asked IS NOT NULL AND n >= 10 AND matching <= n * 0.5"


def resume_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as pages of a checkpoint: some were altered since, some belong to another plan."""
    o = read(spark, sf_dir, "orders")
    sha = F.sha2(F.concat_ws("|", "o_orderkey", "o_custkey"), 256)
    kept = o.select(F.col("o_orderkey").alias("page"), sha.alias("sha256"), F.when(F.col("o_orderkey") % 17 == 0, "0").otherwise(sha).alias("stored_sha256"), F.col("o_orderstatus").alias("scope"), F.when(F.col("o_orderkey") % 11 > 0, 50).alias("page_size"))
    plan = spark.range(1).select(F.lit("O").alias("scope"), F.lit(50).alias("page_size"))
    return checks.resume_faults(kept, plan, ["scope", "page_size"])


RESUME_SQL = "SELECT o_orderkey AS page, CASE WHEN o_orderkey % 17 = 0 THEN 'altered' ELSE 'another plan' END AS problem FROM orders WHERE o_orderkey % 17 = 0 OR o_orderstatus IS DISTINCT FROM 'O' OR o_orderkey % 11 = 0"


def panel_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model's sweeps as those of a panel, by whose scopes the membership, the cap and the failed pages differ."""
    m = model(spark, sf_dir)
    scope = F.col("scope_id")
    sweeps = m.manifests.withColumns({"membership_hash": F.when(scope != "click", "pinned"), "page_cap": F.when(scope == "view", 3).otherwise(4), "coverage_limitations": F.when(scope != "error", "a sample, not a census"), "failed_pages": F.when(F.col("hmac_key_version") == "v2", 1).otherwise(0)})
    return checks.panel_faults(sweeps, m.observations, "pinned", 4, 12)


PANEL_SQL = with_ctes(
    """SELECT sweep_id, problem FROM (SELECT s.*, lines, regions FROM manifests s LEFT JOIN (SELECT sweep_id, count(*) AS lines, count(DISTINCT CASE WHEN region_mapping_status = 'mapped' THEN nuts_code END) AS regions FROM observed GROUP BY 1) f USING (sweep_id)) s,
LATERAL (SELECT unnest(list_filter([CASE WHEN NOT coalesce(status = 'complete' AND expected_pages = completed_pages AND expected_rows = row_count AND row_count = coalesce(lines, 0), FALSE) THEN 'not reconciled' END,
CASE WHEN coalesce(regions, 0) < 12 THEN 'too few regions' END, CASE WHEN scope_id = 'click' THEN 'another membership' END, CASE WHEN scope_id IN ('view', 'error') THEN 'cap not declared' END, CASE WHEN hmac_key_version = 'v2' THEN 'failed pages' END], lambda x: x IS NOT NULL)) AS problem)"""
)


def segmented_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.segmented_faults(model(spark, sf_dir).observations, 40, country="SE")


SEGMENTED_SQL = with_ctes(
    """SELECT problem, value FROM (SELECT unnest([{'problem': 'rows of another country', 'value': CAST(count(*) FILTER (WHERE country IS DISTINCT FROM 'SE') AS DOUBLE), 'bad': count(*) FILTER (WHERE country IS DISTINCT FROM 'SE') > 0},
{'problem': 'too few mapped', 'value': avg(CASE WHEN region_mapping_status = 'mapped' THEN 1.0 ELSE 0.0 END), 'bad': avg(CASE WHEN region_mapping_status = 'mapped' THEN 1.0 ELSE 0.0 END) < 0.85},
{'problem': 'too many unmapped', 'value': avg(CASE WHEN region_mapping_status = 'unmapped' THEN 1.0 ELSE 0.0 END), 'bad': avg(CASE WHEN region_mapping_status = 'unmapped' THEN 1.0 ELSE 0.0 END) > 0.05},
{'problem': 'too few regions', 'value': CAST(count(DISTINCT CASE WHEN region_mapping_status = 'mapped' THEN nuts_code END) AS DOUBLE), 'bad': count(DISTINCT CASE WHEN region_mapping_status = 'mapped' THEN nuts_code END) < 40}], recursive := true)
FROM (SELECT source_id, arg_min(country, sweep_id) AS country, arg_min(region_mapping_status, sweep_id) AS region_mapping_status, arg_min(nuts_code, sweep_id) AS nuts_code FROM observed GROUP BY 1)) WHERE bad"""
)


def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as collections that saw their lines and could use the large ones."""
    lines = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("scope")).agg(F.count(F.lit(1)).alias("seen"), F.count_if(F.col("l_quantity") > 25).alias("usable"))
    return checks.schema_drift(lines)


def panel_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.panel_pii(read(spark, sf_dir, "documents").select("text", "lang", F.col("source").alias("source_id"), "source"))


PII_SQL = r"""SELECT field, pattern, hits FROM (SELECT field, pattern, count(*) FILTER (WHERE regexp_matches(value, rule)) AS hits FROM (SELECT 'text' AS field, text AS value FROM documents UNION ALL SELECT 'lang', lang FROM documents UNION ALL SELECT 'source', source FROM documents),
(VALUES ('email', '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}'), ('url', 'https?://'), ('phone', '\+[0-9][0-9 ()-]{7,}[0-9]'), ('card', '\b[0-9]{16}\b'), ('postcode', '(^|[^0-9a-f])[0-9]{5}([^0-9a-f]|$)')) p(pattern, rule) GROUP BY 1, 2) WHERE hits > 0"""


def mapped_without_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings of which every ninth lost its region's code and every eleventh its occupation."""
    k, p = F.col("k"), model(spark, sf_dir).postings
    lost = p.withColumns({"nuts_code": F.when(k % 9 > 0, F.col("nuts_code")), "esco_occupation_uri": F.when(k % 11 > 0, F.col("esco_occupation_uri"))})
    return checks.mapped_without_code(lost).select("scope_id", "sweep_id", "source_id")


WITHOUT_SQL = with_ctes("SELECT scope_id, sweep_id, source_id FROM postings WHERE (region_mapping_status = 'mapped' AND k % 9 = 0) OR (occupation_mapping_status = 'mapped' AND k % 11 = 0)")


def spread_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty customers by the order of their names' hashes."""
    c = read(spark, sf_dir, "customer").select("c_custkey", F.sha2("c_name", 256).alias("source_id"))
    return panel.spread_sample(c, "source_id", 40)


def region_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each region's rows and pages, written as a side file and read back."""
    p = model(spark, sf_dir).postings.where("nuts_code IS NOT NULL").groupBy("nuts_code").agg(F.count(F.lit(1)).alias("rows"), F.ceil(F.count(F.lit(1)) / 25).alias("pages"))
    path = new_path(spark, "regions")
    writers.write_sorted(writers.region_stats(p), path, "nuts_code")
    return readers.inferred(spark, path).select("nuts_code", "stats")


REGIONS_SQL = with_ctes("""SELECT nuts_code, '{"rows":' || count(*) || ',"pages":' || CAST(ceil(count(*) / 25) AS BIGINT) || '}' AS stats FROM postings WHERE nuts_code IS NOT NULL GROUP BY 1""")


def pair_with_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two weeks of one scope's postings against each other: closed ones end on their expiry date where it lies in between, else at the end."""
    p = model(spark, sf_dir).postings.where("scope_id = 'view'")
    day = F.dayofmonth("observed_at")
    end = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    start = F.lit("2024-01-08 00:00:00").cast("timestamp_ntz")
    expiry = p.select(F.col("source_id"), F.timestamp_add("DAY", (F.col("source_id").cast("int") % 20), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("expires_at")).where("source_id % 3 > 0").distinct()
    return reconcile.reconcile(p.where((day >= 1) & (day < 8)), p.where((day >= 8) & (day < 15)), "source_id", expiry, start, end)


EXPIRY_SQL = with_ctes("""SELECT source_id, state, CASE WHEN state = 'closed' THEN CASE WHEN expires BETWEEN TIMESTAMP '2024-01-08' AND TIMESTAMP '2024-01-15' THEN expires ELSE TIMESTAMP '2024-01-15' END END AS removed_at
FROM (SELECT source_id, CASE WHEN was AND now THEN 'unchanged' WHEN was THEN 'closed' ELSE 'added' END AS state, CASE WHEN CAST(source_id AS BIGINT) % 3 > 0 THEN TIMESTAMP '2024-01-01' + INTERVAL 1 DAY * (CAST(source_id AS BIGINT) % 20) END AS expires
FROM (SELECT source_id, bool_or(day(observed_at) < 8) AS was, bool_or(day(observed_at) >= 8) AS now FROM postings WHERE scope_id = 'view' AND day(observed_at) < 15 GROUP BY 1))""")

QUERIES = {
    "page_problems": (page_problems, PROBLEMS_SQL),
    "unreachable_scopes": (unreachable_scopes, UNREACHABLE_SQL),
    "filter_not_applied": (filter_not_applied, FILTER_SQL),
    "resume_faults": (resume_faults, RESUME_SQL),
    "panel_faults": (panel_faults, PANEL_SQL),
    "segmented_faults": (segmented_faults, SEGMENTED_SQL),
    "schema_drift": (schema_drift, "SELECT l_orderkey AS scope, count(*) AS seen, 0 AS usable FROM lineitem GROUP BY 1 HAVING max(l_quantity) <= 25"),
    "panel_pii": (panel_pii, PII_SQL),
    "mapped_without_code": (mapped_without_code, WITHOUT_SQL),
    "spread_sample": (spread_sample, "SELECT c_custkey, sha256(c_name) AS source_id FROM customer ORDER BY 2 LIMIT 40"),
    "region_stats": (region_stats, REGIONS_SQL),
    "pair_with_expiry": (pair_with_expiry, EXPIRY_SQL),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for name, (query, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in QUERIES.items()}
