"""Readers: manifests, observations, labels and dumps, each with its own schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import placed, written

TIMES = ("observed_at", "started_at", "completed_at")
#: Columns of a sweep's manifest; times are text until they are cast.
MANIFEST = (
    "source string, scope_id string, scope_hash string, scope_json string, partition_id string, sweep_id string, run_id string, observed_at string, started_at string, completed_at string, status string, expected_pages int, completed_pages int, "
    "expected_rows bigint, row_count bigint, hmac_key_version string, source_version string, licence_reference string, access_method string, approval_status string, expected_country string, freshness_threshold_hours int, coverage_limitations string, "
    "reference_hashes string, nuts_version string, jobtech_taxonomy_version string, esco_version string"
)
SKILL = "struct<uri:string,label:string,status:string,confidence:string,method:string,relation:string,source_language:string,jobtech_taxonomy_version:string,esco_version:string>"
LENIENT = ("first_published", "last_modified", "removed_at")
#: Columns of one posting of one sweep; requirement fields are absent in old partitions and read as null.
OBSERVATION = (
    "source string, source_id string, scope_id string, sweep_id string, observed_at string, first_published string, last_modified string, removed_at string, nuts_code string, nuts_label string, region_mapping_status string, region_mapping_method string, "
    "nuts_version string, country string, esco_occupation_uri string, esco_occupation_label string, occupation_mapping_status string, occupation_mapping_confidence string, occupation_mapping_method string, source_language string, "
    f"jobtech_taxonomy_version string, esco_version string, lang string, skill_mappings array<{SKILL}>, employment_type_code string, employment_type_label string, employment_type_mapping_status string, working_hours_type_code string, "
    "working_hours_type_label string, working_hours_type_mapping_status string, duration_code string, duration_label string, duration_mapping_status string, number_of_vacancies bigint"
)
CORRUPT = "_corrupt"


def partition_glob(root: str, name: str) -> str:
    """Files called ``name`` exactly three levels below ``root``: source, scope, sweep."""
    return f"{root.rstrip('/')}/*/*/*/{name}"


def manifests(spark: SparkSession, path: str, pretty: bool = False) -> DataFrame:
    """Manifests with strict types: a value that cannot be cast stops the read. ``pretty`` reads one object a file, else one a line."""
    raw = spark.read.schema(MANIFEST).option("multiLine", pretty).option("mode", "FAILFAST").json(path)
    return raw.select(*(F.col(c).cast("timestamp_ntz").alias(c) if c in TIMES else F.col(c) for c in raw.columns))


def observations(spark: SparkSession, path: str) -> DataFrame:
    """Observations, one a line: the sweep's time is cast strictly, the source's own times become null where they are unreadable."""
    raw = spark.read.schema(OBSERVATION).option("mode", "FAILFAST").json(path)
    typed = {"observed_at": F.col("observed_at").cast("timestamp_ntz")} | {c: F.col(c).try_cast("timestamp_ntz") for c in LENIENT}
    return raw.select(*(typed.get(c, F.col(c)).alias(c) for c in raw.columns))


def observation_keys(spark: SparkSession, path: str) -> DataFrame:
    """The five columns that tell which sweep an observation belongs to; nothing else is parsed."""
    return spark.read.schema("source string, scope_id string, sweep_id string, source_id string, observed_at string").json(path)


def inferred(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path)


def csv_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """CSV files with headers, merged by column name; columns that a file lacks are null. All columns are text."""
    frames = [spark.read.option("header", True).csv(path) for path in paths]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def lines(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, one row with the number of malformed lines) of a stream of JSON lines; malformed ones are counted, not dropped unseen."""
    held = spark.read.text(path).where(F.trim("value") != "").select("value", F.from_json("value", f"{schema}, {CORRUPT} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("row"))
    good = held.where(F.col(f"row.{CORRUPT}").isNull()).select("row.*").drop(CORRUPT)
    return good, held.agg(F.count_if(F.col(f"row.{CORRUPT}").isNotNull()).alias("malformed"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, place) of the lines below ``path``: numbered from 0 in the order of the files' names, however the files are split and dealt to tasks."""
    told = F.col("_metadata")
    split = [told["file_path"].alias("_file"), told["file_block_start"].alias("_start")]
    held = written(spark.read.text(path).select("value", *split, F.monotonically_increasing_id().alias("_at")), "lines")
    return placed(held, ["_file", "_start"])[0]


def dump_items(spark: SparkSession, path: str, field: str, item: str) -> DataFrame:
    """Items of the array ``field`` of one JSON document a file."""
    return spark.read.schema(f"{field} array<{item}>").option("multiLine", True).json(path).select(F.explode(field).alias("item")).select("item.*")


def recorded_hits(spark: SparkSession, path: str, hit: str) -> DataFrame:
    """Hits of recorded response pages, with the total that each page states."""
    pages = spark.read.schema(f"total struct<value:bigint>, hits array<{hit}>").option("multiLine", True).json(path)
    return pages.select(F.col("total.value").alias("total"), F.explode("hits").alias("hit"))


def sitemap_locations(pages: DataFrame, xml: str = "xml") -> DataFrame:
    """Every location of sitemaps (a column of XML text), with its place; namespaces and malformed text give no rows."""
    found = F.regexp_extract_all(F.col(xml), F.lit(r"<(?:\w+:)?loc>\s*([^<]*?)\s*</(?:\w+:)?loc>"), F.lit(1))
    return pages.select("*", F.posexplode(found).alias("place", "location")).where("location <> ''")


def search_envelope(html: Column) -> Column:
    """(total, place, mode) out of the state that a search page carries as JSON."""
    text = lambda name: F.nullif(F.regexp_extract(html, rf'"{name}"\s*:\s*"([^"]*)"', 1), F.lit(""))
    total = F.nullif(F.regexp_extract(html, r'"maxErgebnisse"\s*:\s*(\d+)', 1), F.lit("")).cast("long")
    return F.struct(total.alias("total"), text("bereinigterOrt").alias("place"), text("suchmodus").alias("mode"))
