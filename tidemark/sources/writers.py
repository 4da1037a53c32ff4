"""Writers: partitions with their manifests, side files, Parquet, CSV and exports."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import pseudonym_of_source


def _put(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under a temporary name and rename it, so that it is there whole or not at all."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    system, part = target.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop.Path(f"{path}.part")
    stream = system.create(part, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    system.delete(target, False)
    if not system.rename(part, target):
        raise OSError(f"could not put {path} in place")


def write_partition(rows: DataFrame, manifest: dict, path: str) -> dict:
    """A sweep's observations as JSON lines, then its manifest, which is what makes the sweep exist.

    The status is complete if all pages and the expected rows are there, else
    partial. Returns the manifest as written.
    """
    spark = rows.sparkSession
    rows.write.mode("overwrite").json(f"{path}/observations")
    n = spark.read.schema("source_id string").json(f"{path}/observations").count()
    whole = manifest["completed_pages"] == manifest["expected_pages"] and n == manifest["expected_rows"]
    told = manifest | {"row_count": n, "status": "complete" if whole else "partial"}
    _put(spark, f"{path}/manifest.json", json.dumps(told, indent=2, sort_keys=True) + "\n")
    return told


def write_allowed(rows: DataFrame, fields: list[str], path: str) -> None:
    """JSON lines of exactly ``fields``; any other column is refused."""
    extra = sorted(set(rows.columns) - set(fields))
    if extra:
        raise ValueError(f"columns outside the allowlist: {', '.join(extra)}")
    rows.select(*(f for f in fields if f in rows.columns)).write.mode("overwrite").json(path)


def sanitized(rows: DataFrame, fields: list[str], key: bytes) -> DataFrame:
    """The allowed fields only, the native id replaced by its pseudonym; rows without source or id stop it."""
    if len(key) < 32:
        raise ValueError("the key needs at least 32 bytes")
    named = F.coalesce((F.col("source") != "") & (F.col("source_id") != ""), F.lit(False))
    checked = F.when(named, pseudonym_of_source(key, F.col("source"), F.col("source_id"))).otherwise(F.raise_error(F.lit("source and source_id must not be empty")))
    return rows.withColumn("source_id", checked).select(*(f for f in fields if f in rows.columns))


def write_parquet(rows: DataFrame, path: str) -> None:
    """Parquet with the skill mappings as JSON text."""
    flat = rows.withColumn("skill_mappings", F.to_json("skill_mappings")) if "skill_mappings" in rows.columns else rows
    flat.write.mode("overwrite").parquet(path)


def write_sorted(rows: DataFrame, path: str, by: str = "source_id") -> None:
    """A side table (expiry dates, closures) sorted by id: a file a range of ids, their names in the order of the ranges."""
    rows.repartitionByRange(by).sortWithinPartitions(by).write.mode("overwrite").json(path)


def write_csv(rows: DataFrame, path: str, methodology: str | None = None) -> str:
    """Quoted CSV with a header and lines that end in CRLF; the folder, whose name tells the ``methodology``."""
    path = path if methodology is None else f"{path}-{methodology}"
    rows.write.mode("overwrite").option("header", True).option("quoteAll", True).option("lineSep", "\r\n").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def region_stats(rows: DataFrame) -> DataFrame:
    """One JSON object a region: rows, pages and what the source advertised."""
    return rows.select("nuts_code", F.to_json(F.struct(*(c for c in rows.columns if c != "nuts_code"))).alias("stats"))


def payload(marts: dict[str, DataFrame], scope: list[str]) -> DataFrame:
    """One row a scope: its rows of every mart as one JSON text, for export."""
    tagged = None
    for name, mart in marts.items():
        own = mart.select(*scope, F.lit(name).alias("mart"), F.to_json(F.struct(*(c for c in mart.columns if c not in scope))).alias("row"))
        tagged = own if tagged is None else tagged.unionByName(own)
    listed = tagged.groupBy(*scope, "mart").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    return listed.groupBy(*scope).agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("mart", "rows"))))).alias("payload"))
