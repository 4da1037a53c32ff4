"""Every source's payloads, made of orders as JSON, brought to records, with SQL that tells what they should be."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import lanes
from .adapter import read
from .reference_queries import ORDERS, _orders, _region, _regions_sql

#: Each source's payload as text: <id> is the order's number, <h> its place, <u> that as a UUID, <d> a day and <r> a radius.
PAYLOADS = {
    "adzuna_de": """{"id":"a<id>","title":"secret","created":"2024-03-0<d>T0<d>:30:00Z","category":{"tag":"it"}}""",
    "adzuna_nl": """{"id":"b<id>","created":"2024-03-0<d>","location":{"area":["x"]}}""",
    "vdab": """{"native_id":"<id>","online_since":"Online sinds <d> mrt. 2024","postcode":"w<h>"}""",
    "cbop": """{"native_id":"<id>","first_published":"2024-03-0<d>T10:00","nuts_code":"PL21","nuts_label":"x"}""",
    "mpsv": """{"portalId":<id>,"datumVlozeni":"2024-03-0<d>T12:00:00+01:00","datumZmeny":"bad","pocetMist":<d>,"mistoVykonuPrace":{"pracoviste":[{"adresa":null},{"adresa":{"kraj":{"id":"w<h>"}}}],"okresy":[{"id":""}],"obec":null}}""",
    "france_travail": """{"id":"<id>","dateCreation":"2024-03-0<d>T12:00:00.000Z","nombrePostes":-<d>,"romeCode":"M180<d>","lieuTravail":{"libelle":"x","codePostal":"20000"}}""",
    "nav": """{"native_id":"<id>","status":" inactive","sist_endret":"2024-03-0<d>T12:00:00+02:00","detail":{"ad_content":{"published":"2024-03-0<d>T01:00","updated":"","positioncount":"<d>.0","workLocations":[{"municipal":"w<h>","country":"NORGE"}],"categoryList":[{"categoryType":"ESCO","code":"http://data.europa.eu/esco/occupation/<u>","score":0.7}]}}}""",
    "tmt": """{"native_id":"<id>","application":{"openPositions":<d>},"metadata":{"created":"2024-03-0<d>T00:00:00Z","archived":null},"position":{"mainOccupation":null,"occupations":["http://data.europa.eu/esco/occupation/<u>"],"skills":["http://data.europa.eu/esco/skill/<u>",""]},"location":{"municipalities":[],"regions":[]},"languages":[" ","SV"]}""",
    "ba": """{"native_id":"<id>","first_published":"2024-03-0<d>","location_city":"w<h>","segment_nuts3":"XX00<d>","umkreis":<r>,"employer":"secret"}""",
}
URI = "http://data.europa.eu/esco/occupation/"
UUID = "00000000-0000-0000-0000-"
NUMBERED = f"'{UUID}' || lpad(CAST(h AS VARCHAR), 12, '0')"
DAY = "TIMESTAMP '2024-03-01' + INTERVAL 1 DAY * (d - 1)"


def lane_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ninth order is a posting of one of nine sources."""
    rows, names = _orders(spark, sf_dir).withColumn("d", F.col("id") % 7 + 1), list(PAYLOADS)
    places = _region(spark, sf_dir, "w", 2, 10**9)
    labels = read(spark, sf_dir, "nation").select(F.format_string("XX%03d", "n_nationkey").alias("nuts_code"), F.col("n_name").alias("nuts_label"))
    towns = places.withColumnRenamed("code", "name")
    none = spark.createDataFrame([], "source_type string, source_code string, nuts_code string, nuts_label string")
    references = {"postcodes": places, "codes": places, "departements": places, "counties": towns.limit(0), "municipalities": towns, "kunta": none, "towns": towns, "labels": labels}
    made = []
    for k, name in enumerate(names):
        text = F.lit(PAYLOADS[name])
        for mark, value in (("<id>", F.col("id")), ("<d>", F.col("d")), ("<h>", F.col("h")), ("<r>", F.col("d") % 2 * 25), ("<u>", F.concat(F.lit(UUID), F.lpad(F.col("h").cast("string"), 12, "0")))):
            text = F.replace(text, F.lit(mark), value.cast("string"))
        found = lanes.records(rows.where(F.col("id") % len(names) == k).select(text.alias("payload")), name, references)
        made.append(found.withColumn("lane", F.lit(name)).withColumn("skills", F.to_json("skill_mappings")).drop("skill_mappings"))
    return reduce(DataFrame.unionByName, made)


def _lane_sql() -> str:
    """One row a lane: what its records hold, written down from the payloads and the references."""
    none = dict.fromkeys([f for f in lanes.FIELDS if f != "skill_mappings"], "NULL") | {"occupation_mapping_status": "'not_present'", "jobtech_taxonomy_version": "''", "esco_version": f"'{lanes.ESCO_VERSION}'", "number_of_vacancies": "1", "skills": "'[]'", "source_id": "CAST(id AS VARCHAR)", "first_published": DAY}
    hit = lambda method, miss="'not_available'", status="'unmapped'": {"nuts_code": "t.nuts_code", "nuts_label": "t.nuts_label", "region_mapping_status": f"CASE WHEN t.nuts_code IS NULL THEN {status} ELSE 'mapped' END", "region_mapping_method": f"CASE WHEN t.nuts_code IS NULL THEN {miss} ELSE '{method}' END"}
    told = {
        "adzuna_de": {"source_id": "'a' || id", "first_published": f"{DAY} + INTERVAL 1 HOUR * d + INTERVAL 30 MINUTE", "region_mapping_status": "'not_present'", "region_mapping_method": "'adzuna_location_text_deferred'", "occupation_mapping_method": "'deferred_adzuna_category_to_esco'"},
        "adzuna_nl": {"source_id": "'b' || id", "region_mapping_status": "'not_present'", "region_mapping_method": "'adzuna_location_text_deferred'", "occupation_mapping_method": "'deferred_adzuna_category_to_esco'"},
        "vdab": hit("vdab_landing_postcode_nuts3") | {"occupation_mapping_method": "'not_available_vdab_html'"},
        "cbop": {"first_published": f"{DAY} + INTERVAL 10 HOUR", "nuts_code": "'PL21'", "nuts_label": "'x'", "region_mapping_status": "'mapped'", "region_mapping_method": "'cbop_region'", "occupation_mapping_method": "'not_implemented'"},
        "mpsv": hit("mpsv_kraje_codelist_nuts3") | {"first_published": f"{DAY} + INTERVAL 11 HOUR", "number_of_vacancies": "d", "occupation_mapping_method": "'deferred_cz_isco_to_esco'"},
        "france_travail": {"first_published": f"{DAY} + INTERVAL 12 HOUR", "region_mapping_status": "'ambiguous'", "region_mapping_method": "'ft_code_postal_corse_2a_2b'", "number_of_vacancies": "0", "occupation_mapping_status": "'unmapped'", "occupation_mapping_method": "'deferred_rome_to_esco'"},
        "nav": hit("nav_worklocation_municipal_nuts3", "'nav_region_name_unknown'") | {"first_published": f"{DAY} + INTERVAL 1 HOUR", "last_modified": f"{DAY} + INTERVAL 10 HOUR", "removed_at": f"{DAY} + INTERVAL 10 HOUR", "number_of_vacancies": "d", "esco_occupation_uri": f"'{URI}' || {NUMBERED}", "occupation_mapping_status": "'mapped'", "occupation_mapping_confidence": "'medium'", "occupation_mapping_method": "'nav_categorylist_esco'"},
        "tmt": {"region_mapping_status": "'not_present'", "region_mapping_method": "'not_available'", "number_of_vacancies": "d", "esco_occupation_uri": f"'{URI}' || {NUMBERED}", "occupation_mapping_status": "'mapped'", "occupation_mapping_method": "'finesco_esco_occupation_uri'", "source_language": "'sv'", "lang": "'sv'", "skills": f"""'[{{"uri":"http://data.europa.eu/esco/skill/' || {NUMBERED} || '","status":"mapped","method":"finesco_esco_skill_uri","jobtech_taxonomy_version":"","esco_version":"1.2.1"}}]'"""},
        "ba": {"nuts_code": "coalesce(t.nuts_code, 'XX00' || d)", "nuts_label": "coalesce(t.nuts_label, n.n_name)", "region_mapping_status": "CASE WHEN t.nuts_code IS NOT NULL OR d % 2 = 0 THEN 'mapped' ELSE 'low_confidence' END", "region_mapping_method": "CASE WHEN t.nuts_code IS NOT NULL THEN 'ba_city_municipality_nuts3' WHEN d % 2 = 0 THEN 'ba_segment_provenance_nuts3' ELSE 'ba_segment_radius_nuts3' END", "occupation_mapping_method": "'not_available_ba_html'"},
    }
    kinds = dict.fromkeys(("first_published", "last_modified", "removed_at"), "TIMESTAMP") | {"number_of_vacancies": "BIGINT"}
    parts = []
    for k, (name, values) in enumerate(told.items()):
        lane = lanes.LANES[name]
        row = none | {"country": f"'{lane.country}'", "source_language": f"'{lane.language}'", "lang": f"'{lane.language}'"} | values
        parts.append("SELECT " + ", ".join(f"CAST({v} AS {kinds.get(f, 'VARCHAR')}) AS {f}" for f, v in row.items()) + f", '{name}' AS lane FROM p LEFT JOIN t ON t.code = 'w' || h LEFT JOIN nation n ON n_nationkey = d WHERE id % {len(told)} = {k}")
    return f"WITH {ORDERS}, p AS (SELECT *, id % 7 + 1 AS d FROM o), t AS {_regions_sql('w', 2, 10**9)} " + " UNION ALL ".join(parts)


QUERIES = {"lane_payloads": (lane_payloads, _lane_sql())}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for name, (query, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in QUERIES.items()}
