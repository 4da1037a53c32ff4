"""Building crosswalks from code lists: chained and three-way joins, deviations and manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import folded_name


def code_chain(towns: DataFrame, districts: DataFrame, regions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Towns (code, district) and districts (code, region) led to the regions' (code, nuts_code): what resolves, and how many of each kind don't."""
    to_region = regions.select(F.col("code").alias("region"), "nuts_code")
    led = districts.select(F.lit("district").alias("source_type"), "code", F.col("region"))
    through = towns.join(districts.select(F.col("code").alias("district"), "region"), "district", "left").select(F.lit("town").alias("source_type"), "code", "region")
    every = led.unionByName(through).join(to_region, "region", "left")
    found = every.where("nuts_code IS NOT NULL").select("source_type", "code", "nuts_code")
    return found, every.groupBy("source_type").agg(F.count_if(F.col("nuts_code").isNull()).alias("skipped"))


def by_folded_name(codes: DataFrame, regions: DataFrame) -> DataFrame:
    """Codes (code, name) joined to regions (nuts_code, name) by their folded names."""
    fold = lambda t, *keep: t.select(folded_name(F.col("name")).alias("folded"), *keep)
    return fold(codes, "code", "name").join(fold(regions, "nuts_code"), "folded").where("folded <> ''")


def three_way(municipalities: DataFrame, postcodes: DataFrame, districts: DataFrame) -> DataFrame:
    """Rows of all three kinds with their region: postcodes and municipalities through their municipality key (its first five digits are the district).

    ``municipalities`` (key, name), ``postcodes`` (postcode, key), ``districts`` (district, nuts_code, name).
    """
    region = districts.select("district", "nuts_code", F.col("name").alias("kreis_name"))
    named = municipalities.withColumn("district", F.substring("key", 1, 5)).join(region, "district").select("key", F.col("name").alias("municipality_name"), "nuts_code", "kreis_name")
    of_town = named.select(F.lit("municipality").alias("source_type"), F.col("key").alias("source_code"), "nuts_code", "municipality_name", "kreis_name")
    of_code = postcodes.join(named, "key").select(F.lit("plz").alias("source_type"), F.col("postcode").alias("source_code"), "nuts_code", "municipality_name", "kreis_name")
    of_district = region.select(F.lit("kreis").alias("source_type"), F.col("district").alias("source_code"), "nuts_code", F.lit("").alias("municipality_name"), "kreis_name")
    return of_town.unionByName(of_code).unionByName(of_district).distinct()


def deviations(a: DataFrame, b: DataFrame, key: str, value: str, most: int = 20) -> DataFrame:
    """The first ``most`` keys whose value differs between two tables, in order: a report."""
    both = a.select(key, F.col(value).alias("left_value")).join(b.select(key, F.col(value).alias("right_value")), key)
    return both.where("left_value <> right_value").orderBy(key).limit(most)


def crosswalk_manifest(crosswalk: DataFrame) -> DataFrame:
    """Rows, codes and regions of each kind of a crosswalk, and how many codes lie in several regions."""
    by_code = crosswalk.groupBy("source_type", "source_code").agg(F.countDistinct("nuts_code").alias("regions"), F.count(F.lit(1)).alias("rows"))
    counts = by_code.groupBy("source_type").agg(F.sum("rows").cast("long").alias("rows"), F.count(F.lit(1)).alias("codes"), F.count_if(F.col("regions") > 1).alias("ambiguous_codes"))
    return counts.join(crosswalk.groupBy("source_type").agg(F.countDistinct("nuts_code").alias("regions")), "source_type")


def labels_of_country(labels: DataFrame, country: str, length: int = 5) -> DataFrame:
    """A country's region labels at one depth of the code."""
    return labels.where(F.col("nuts_code").startswith(country) & (F.length("nuts_code") == length)).select("nuts_code", "nuts_label")


def correspondences(lists: DataFrame, level: int) -> DataFrame:
    """Codes and their regions out of correspondence lists (level, pairs: array of struct(source, target)) of one level."""
    return lists.where(F.col("level") == level).select(F.explode("pairs").alias("p")).select(F.col("p.source").alias("code"), F.col("p.target").alias("nuts_code")).distinct()
