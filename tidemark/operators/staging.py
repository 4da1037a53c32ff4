"""Admission of sweeps, typed postings, labels and unnested skills."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SWEEP_KEYS = ["source", "scope_id", "sweep_id"]
POSTING_KEYS = [*SWEEP_KEYS, "source_id"]
IDENTITY = ["source", "scope_id", "hmac_key_version", "source_id"]


def admitted(manifests: DataFrame) -> DataFrame:
    """Complete sweeps whose pages and rows reconcile; a null on either side keeps a sweep out."""
    return manifests.where((F.col("status") == "complete") & F.col("completed_at").isNotNull() & (F.col("completed_pages") == F.col("expected_pages")) & (F.col("row_count") == F.col("expected_rows")))


def nuts_labels(frames: list[DataFrame]) -> DataFrame:
    """One label for each region code, the least by name, over files merged by column name."""
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return every.where(F.col("nuts_code").isNotNull()).groupBy("nuts_code").agg(F.min("nuts_label").alias("nuts_label"))


def staged_postings(observations: DataFrame, sweeps: DataFrame, labels: DataFrame) -> DataFrame:
    """Observations of admitted sweeps with their key version; a collected label wins over the reference's."""
    keys = [*SWEEP_KEYS, "observed_at"]
    found = observations.join(sweeps.select(*keys, "hmac_key_version"), keys, "inner")
    named = labels.withColumnRenamed("nuts_label", "reference_label")
    return found.join(named, "nuts_code", "left").withColumn("nuts_label", F.coalesce("nuts_label", "reference_label")).drop("reference_label")


#: Fields of a skill's element, as text.
SKILL_FIELDS = ("uri", "label", "status", "confidence", "method", "jobtech_taxonomy_version", "esco_version")


def skill_mappings(postings: DataFrame) -> DataFrame:
    """One row per posting, sweep and skill; ordinals from 1; null and empty lists give none.

    The lists are arrays of structs or JSON text. A field that the elements
    lack is null, and so are all of an element that is no object; text that is
    no list gives no rows.
    """
    kind = postings.schema["skill_mappings"].dataType
    lists = F.col("skill_mappings")
    if isinstance(kind, T.StringType):
        lists = F.from_json(lists, "array<struct<" + ",".join(f"{f}:string" for f in SKILL_FIELDS) + ">>")
        names = set(SKILL_FIELDS)
    else:
        names = set(kind.elementType.names)
    opened = postings.select(*POSTING_KEYS, "hmac_key_version", "observed_at", F.posexplode(lists).alias("place", "skill"))
    field = lambda f: F.col(f"skill.{f}").cast("string") if f in names else F.lit(None).cast("string")
    return opened.select(
        *POSTING_KEYS,
        "hmac_key_version",
        "observed_at",
        (F.col("place") + 1).cast("long").alias("skill_ordinal"),
        field("uri").alias("esco_skill_uri"),
        field("label").alias("esco_skill_label"),
        field("status").alias("mapping_status"),
        field("confidence").alias("mapping_confidence"),
        field("method").alias("mapping_method"),
        field("jobtech_taxonomy_version").alias("jobtech_taxonomy_version"),
        field("esco_version").alias("esco_version"),
    )
