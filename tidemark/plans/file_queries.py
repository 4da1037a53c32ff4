"""Files of every kind written from the posting model and the given tables and read again, against SQL over the originals."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import events, staging
from ..sources import readers, writers
from ..sources.storage import new_path
from .adapter import FLOW_PARTS, label_files, model, read, stock_cte, with_ctes

KEY = b"0123456789abcdef0123456789abcdef"
PER_PAGE = 50


def partition_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations and manifests as files of source, scope and sweep; staged again from the files, with the orphans among the keys."""
    m, path = model(spark, sf_dir), new_path(spark, "collections")
    place = [F.col(c).alias(f"_{c}") for c in staging.SWEEP_KEYS]
    fields = [c for c in ("source_id", "removed_at", "country", "nuts_code", "nuts_label", "region_mapping_status", "skill_mappings", "number_of_vacancies") if c in m.observations.columns]
    lined = m.observations.select(*place, *staging.SWEEP_KEYS, F.date_format("observed_at", "yyyy-MM-dd HH:mm:ss").alias("observed_at"), *fields)
    lined.where("scope_id <> 'click' OR dayofmonth(observed_at) <> 3").write.partitionBy(*(f"_{c}" for c in staging.SWEEP_KEYS)).json(f"{path}/rows")
    times = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in readers.TIMES}
    m.manifests.withColumns(times).select(*place, "*").write.partitionBy(*(f"_{c}" for c in staging.SWEEP_KEYS)).json(f"{path}/manifests")
    manifests = readers.manifests(spark, readers.partition_glob(f"{path}/manifests", "*.json"))
    observed = readers.observations(spark, readers.partition_glob(f"{path}/rows", "*.json"))
    labels = staging.nuts_labels(label_files(spark, sf_dir))
    staged = staging.staged_postings(observed, staging.admitted(manifests), labels)
    keys = readers.observation_keys(spark, readers.partition_glob(f"{path}/rows", "*.json"))
    counted = keys.groupBy(*staging.SWEEP_KEYS).agg(F.count(F.lit(1)).alias("lines"))
    told = staged.groupBy(*staging.SWEEP_KEYS, "observed_at").agg(F.count(F.lit(1)).alias("postings"), F.count("nuts_label").alias("labelled"), F.min("removed_at").alias("first_removal"), F.sum(F.size(F.coalesce("skill_mappings", F.array()))).alias("skills"), F.sum("number_of_vacancies").alias("vacancies"))
    return told.join(counted, staging.SWEEP_KEYS)


PARTITIONS_SQL = with_ctes(
    """SELECT source, scope_id, sweep_id, observed_at, count(*) AS postings, count(nuts_label) AS labelled, date_trunc('milliseconds', min(removed_at)) AS first_removal, CAST(sum(CASE WHEN k % 7 > 1 THEN 2 ELSE 0 END) AS BIGINT) AS skills, CAST(sum(number_of_vacancies) AS BIGINT) AS vacancies, count(*) AS lines
FROM postings WHERE scope_id <> 'click' OR day(observed_at) <> 3 GROUP BY 1, 2, 3, 4"""
)


def label_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two label files of different columns, written with headers and merged by name."""
    path = new_path(spark, "labels")
    for k, table in enumerate(label_files(spark, sf_dir)):
        table.write.option("header", True).csv(f"{path}/{k}")
    return staging.nuts_labels([readers.csv_files(spark, [f"{path}/{k}" for k in range(2)])])


ALLOWED = ["source", "source_id", "scope_id", "nuts_code"]


def allowed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings brought to the allowed fields under pseudonyms, written as lines and read again."""
    path = new_path(spark, "allowed")
    writers.write_allowed(writers.sanitized(model(spark, sf_dir).postings, ALLOWED, KEY), ALLOWED, path)
    found = readers.observations(spark, path)
    hidden = F.count_if(F.col("source_id").rlike("^[0-9a-f]{64}$"))
    return found.groupBy("source", "scope_id", "nuts_code").agg(F.countDistinct("source_id").alias("ids"), hidden.alias("rows"), F.count("country").alias("others"))


def parquet_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings as Parquet with their skills as JSON text, opened again."""
    path = new_path(spark, "parquet")
    writers.write_parquet(model(spark, sf_dir).postings, path)
    held = spark.read.parquet(path).select("scope_id", "sweep_id", "source_id", F.from_json("skill_mappings", "array<struct<uri:string,status:string>>").alias("s"))
    return held.where("s IS NOT NULL").select("scope_id", "sweep_id", "source_id", F.size("s").cast("long").alias("n"), F.get("s", F.lit(0))["uri"].alias("first_uri"))


PARQUET_SQL = with_ctes("SELECT scope_id, sweep_id, source_id, CASE WHEN k % 7 = 1 THEN 0 ELSE 2 END AS n, CASE WHEN k % 7 > 1 THEN 'urn:skill:' || (k % 10) END AS first_uri FROM postings WHERE k % 7 > 0")


def closure_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closures as side files sorted by posting, with the place of each line."""
    m, path = model(spark, sf_dir), new_path(spark, "closed")
    closed = events.closures(m.postings, m.sweeps).select(F.concat_ws("/", "scope_id", "hmac_key_version", "source_id").alias("source_id"), F.date_format("event_at", "yyyy-MM-dd HH:mm:ss").alias("event_at"))
    writers.write_sorted(closed, path)
    lines = readers.numbered_lines(spark, path).select("place", F.from_json("value", "source_id string, event_at string").alias("r"))
    return lines.select("place", "r.*")


CLOSURES_SQL = with_ctes("SELECT row_number() OVER (ORDER BY id) - 1 AS place, id AS source_id, event_at FROM (SELECT scope_id || '/' || hmac_key_version || '/' || source_id AS id, strftime(event_at, '%Y-%m-%d %H:%M:%S') AS event_at FROM closures)")


def recorded_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the recorded hits of pages, each with the total."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    pages = o.groupBy((F.col("o_orderkey") % 40).alias("page")).agg(F.struct(F.count(F.lit(1)).alias("value")).alias("total"), F.collect_list(F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))).alias("hits"))
    path = new_path(spark, "recorded")
    pages.write.partitionBy("page").json(path)
    found = readers.recorded_hits(spark, f"{path}/*/*.json", "struct<id:bigint,status:string>")
    return found.select("total", "hit.*")


def dump_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as the items of one document a nation."""
    path = new_path(spark, "dump")
    item = F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    read(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.lit("x").alias("stav"), F.collect_list(item).alias("polozky")).write.partitionBy("s_nationkey").json(path)
    return readers.dump_items(spark, f"{path}/*/*.json", "polozky", "struct<id:bigint,name:string>")


def sitemap_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages' addresses in sitemaps of a hundred, some with a namespace, one entry empty."""
    p = read(spark, sf_dir, "pages").where("url IS NOT NULL")
    tag = F.when(F.col("page_id") % 2 == 0, "s:loc").otherwise("loc")
    entry = F.concat(F.lit("<url><"), tag, F.lit(">\n "), F.regexp_replace("url", "[&<]", "_"), F.lit(" </"), tag, F.lit("></url><url><loc></loc></url>"))
    maps = p.groupBy(F.floor(F.col("page_id") / 100).cast("long").alias("map")).agg(F.array_sort(F.collect_list(F.struct("page_id", entry.alias("entry")))).alias("e"))
    xml = maps.select("map", F.concat(F.lit("<urlset xmlns:s='x'>"), F.array_join(F.transform("e", lambda x: x["entry"]), ""), F.lit("</urlset>")).alias("xml"))
    return readers.sitemap_locations(xml).groupBy("map", "location").agg(F.count(F.lit(1)).alias("n"))


def search_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state that search pages carry as JSON, of customers, some without parts of it."""
    c, k = read(spark, sf_dir, "customer"), F.col("c_custkey")
    total = F.when(k % 3 > 0, F.concat(F.lit('"maxErgebnisse" : '), (k * 7).cast("string"), F.lit(","))).otherwise(F.lit(""))
    place = F.when(k % 4 > 0, F.concat(F.lit('"bereinigterOrt":"'), "c_mktsegment", F.lit('",'))).otherwise(F.lit('"bereinigterOrt":"",'))
    html = F.concat(F.lit('<p>"hits":1</p><script id="ng-state">{"a":{'), total, place, F.lit('"suchmodus": "UMKREIS"}}</script>'))
    return c.select("c_custkey", readers.search_envelope(html).alias("e")).select("c_custkey", "e.*")


def streamed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON lines of which every thirteenth is broken: the good ones' number by type, and the malformed."""
    e = read(spark, sf_dir, "events")
    line = F.to_json(F.struct("event_id", "event_type"))
    path = new_path(spark, "lines")
    e.select(F.when(F.col("event_id") % 13 == 0, F.concat(F.lit("{"), line)).when(F.col("event_id") % 17 == 0, F.lit("  ")).otherwise(line).alias("value")).write.text(path)
    good, bad = readers.lines(spark, path, "event_id bigint, event_type string")
    return good.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).unionByName(bad.select(F.lit("malformed").alias("event_type"), F.col("malformed").alias("n")))


def exported_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each scope's marts as one JSON text, its rows opened and counted again."""
    marts = model(spark, sf_dir).marts()
    held = writers.payload({"demand": marts["demand"], "flows": marts["flows"]}, ["source", "scope_id"])
    opened = held.select("scope_id", F.explode(F.from_json("payload", "map<string,array<string>>")).alias("mart", "rows"))
    rows = opened.select("scope_id", "mart", F.explode("rows").alias("row"))
    return rows.groupBy("scope_id", "mart").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.get_json_object("row", "$.posting_count").cast("long")).alias("postings"))


PAYLOAD_SQL = with_ctes(
    """SELECT scope_id, 'demand' AS mart, count(*) AS rows, CAST(sum(posting_count) AS BIGINT) AS postings FROM dimension_demand GROUP BY 1 UNION ALL SELECT scope_id, 'flows', count(*), NULL FROM flows GROUP BY 1""",
    FLOW_PARTS | {"stock": stock_cte("stock_of_sweep")},
)


def csv_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as quoted CSV, with quotes and commas inside, read again, and the lines that do not end in CRLF."""
    path = new_path(spark, "csv")
    rows = read(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit('a "quoted", '), "p_name", F.lit(" ")).alias("name"))
    path = writers.write_csv(rows, path, "survey-2024")
    found = spark.read.option("header", True).option("escape", "\\").option("ignoreTrailingWhiteSpace", False).csv(path.removesuffix("survey-2024") + "*2024")
    lines = spark.read.option("lineSep", "\n").text(path).agg(F.count_if(~F.col("value").endswith("\r")).alias("unended"))
    return found.select(F.col("p_partkey").cast("long").alias("p_partkey"), F.col("name")).crossJoin(lines)


QUERIES = {
    "partition_files": (partition_files, PARTITIONS_SQL),
    "label_tables": (label_tables, with_ctes("SELECT * FROM labels")),
    "allowed_lines": (allowed_lines, with_ctes("SELECT source, scope_id, nuts_code, count(DISTINCT source_id) AS ids, count(*) AS rows, 0 AS others FROM postings GROUP BY 1, 2, 3")),
    "parquet_copy": (parquet_copy, PARQUET_SQL),
    "closure_file": (closure_file, CLOSURES_SQL),
    "recorded_pages": (recorded_pages, "SELECT count(*) OVER (PARTITION BY o_orderkey % 40) AS total, o_orderkey AS id, o_orderstatus AS status FROM orders"),
    "dump_items": (dump_items, "SELECT s_suppkey AS id, s_name AS name FROM supplier"),
    "sitemap_pages": (sitemap_pages, "SELECT page_id // 100 AS map, trim(regexp_replace(url, '[&<]', '_', 'g')) AS location, count(*) AS n FROM pages WHERE url IS NOT NULL AND trim(url) <> '' GROUP BY 1, 2"),
    "search_states": (search_states, "SELECT c_custkey, CASE WHEN c_custkey % 3 > 0 THEN c_custkey * 7 END AS total, CASE WHEN c_custkey % 4 > 0 THEN c_mktsegment END AS place, 'UMKREIS' AS mode FROM customer"),
    "streamed_lines": (streamed_lines, "SELECT event_type, count(*) AS n FROM events WHERE event_id % 13 > 0 AND event_id % 17 > 0 GROUP BY 1 UNION ALL SELECT 'malformed', count(*) FROM events WHERE event_id % 13 = 0"),
    "exported_payload": (exported_payload, PAYLOAD_SQL),
    "csv_copy": (csv_copy, "SELECT p_partkey, 'a \"quoted\", ' || p_name || ' ' AS name, 0 AS unended FROM part"),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for name, (query, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in QUERIES.items()}
