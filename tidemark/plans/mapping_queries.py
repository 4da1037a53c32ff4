"""Queries of the crosswalk mappings: each deals its cases over a whole table, against small reference tables."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ..operators import mapping as M
from .adapter import read
from .cases import dealt, dealt_sql
from .rule_queries import OCCUPATION, SKILL

KEY = "c_custkey"
REGIONS = "code string, nuts_code string, nuts_label string"
NAMES = "name string, nuts_code string, nuts_label string"


def _cases(spark, sf_dir, shapes: dict[str, str], cases: list[tuple]):
    """Rows of ``customer`` with the cases' inputs, each of the given shape."""
    columns = [F.from_json(dealt(KEY, [json.dumps({"v": case[i]}) for case in cases]), f"v {kind}")["v"].alias(name) for i, (name, kind) in enumerate(shapes.items())]
    return read(spark, sf_dir, "customer").select(KEY, *columns)


def _told(found):
    parts = [F.coalesce(c, F.lit("-")) for c in ("nuts_code", "nuts_label", "mapping_status", "mapping_method")]
    return found.select(KEY, F.concat_ws("|", *parts).alias("found"))


def _sql(cases: list[tuple]) -> str:
    return f"SELECT {KEY}, {dealt_sql(KEY, [case[-1] for case in cases])} AS found FROM customer"


OTHER = OCCUPATION.replace("0b15375e", "00000000")
CANDIDATES = [("one", "u1", "l1", "exact-match", "high"), ("loose", "u2", "l2", "close-match", "low"), ("tie", "u3", "l3", "exact-match", "high"), ("tie", "u4", "l4", "close-match", "low"), ("both", "u5", "l5", "exact-match", "high"), ("both", "u6", "l6", "exact-match", "high"), ("vague", "u7", "l7", "broad-match", "low"), ("vague", "u8", "l8", "close-match", "low"), ("wrong", "u9", "l9", "exact-match", "high")]
REVIEWS = [("loose2", "u0", "l0", "exact-match", "mapped", "high"), ("wrong", None, None, None, "unmapped", None)]
CONCEPTS = [
    ("one", "u1|l1|mapped|high|crosswalk|exact-match"), ("loose", "-|-|low_confidence|low|crosswalk|close-match"), ("tie", "u3|l3|mapped|high|exact_match_tiebreak|exact-match"), ("both", "-|-|ambiguous|-|no_match|-"),
    ("vague", "-|-|ambiguous|-|no_match|-"), ("wrong", "-|-|unmapped|-|manual_review|-"), ("loose2", "u0|l0|mapped|high|manual_review|exact-match"), ("none", "-|-|unmapped|-|no_match|-"), ("", "-|-|not_present|-|source_absent|-"), (None, "-|-|not_present|-|source_absent|-"),
]


def concept_tables(spark):
    return spark.createDataFrame(CANDIDATES, "concept string, target_uri string, target_label string, relation string, confidence string"), spark.createDataFrame(REVIEWS, "concept string, target_uri string, target_label string, relation string, status string, confidence string")


def esco_mapping_rule(spark, sf_dir):
    found = M.map_concepts(_cases(spark, sf_dir, {"concept": "string"}, CONCEPTS), *concept_tables(spark))
    parts = [F.coalesce(c, F.lit("-")) for c in ("uri", "label", "mapping_status", "mapping_confidence", "mapping_method", "relation")]
    return found.select(KEY, F.concat_ws("|", *parts).alias("found"))


GEOGRAPHY = [("municipality", "0180", "SE110", "Stockholms län"), ("region", "01", "SE110", "Stockholms län"), ("region", "12", "SE224", "Skåne län")]
SWEDEN = [
    ("0180", "12", "SE110|Stockholms län|mapped|municipality_crosswalk"), ("0199", None, "SE110|Stockholms län|mapped|municipality_prefix_crosswalk"), ("9999", "12", "SE224|Skåne län|mapped|region_crosswalk"), (None, "12", "SE224|Skåne län|mapped|region_crosswalk"),
    ("9", None, "-|-|unmapped|no_match"), ("9999", "99", "-|-|unmapped|no_match"), (None, None, "-|-|not_present|source_absent"), ("", "", "-|-|not_present|source_absent"), ("1", "01", "SE110|Stockholms län|mapped|region_crosswalk"),
]


def region_cascade(spark, sf_dir):
    rows = _cases(spark, sf_dir, {"municipality": "string", "region_code": "string"}, SWEDEN)
    return _told(M.region_cascade(rows, spark.createDataFrame(GEOGRAPHY, "source_type string, source_code string, nuts_code string, nuts_label string")))


CZECH_TABLE = [("CZ-PHA", "CZ010", "Praha"), ("CZ-STC", "CZ020", "Středočeský"), ("OK1", "CZ020", "Středočeský"), ("OK2", "CZ064", "Jihomoravský"), ("OB1", "CZ010", "Praha")]
CZECH = [
    (["CZ-PHA"], "CZ-STC", [], None, "CZ010|Praha|mapped|mpsv_kraje_codelist_nuts3"), (["CZ-STC", "CZ-PHA"], None, [], None, "CZ020|Středočeský|ambiguous|mpsv_kraje_codelist_nuts3"), (["CZ-PHA", "CZ-PHA", "?"], None, [], None, "CZ010|Praha|mapped|mpsv_kraje_codelist_nuts3"),
    (["?"], "CZ-STC", ["OK2"], None, "CZ020|Středočeský|low_confidence|mpsv_kraje_codelist_contact_address"), ([], "?", ["OK2"], None, "CZ064|Jihomoravský|mapped|mpsv_okres_codelist_nuts3"), (None, None, ["OK2", "OK1"], "OB1", "CZ064|Jihomoravský|ambiguous|mpsv_okres_codelist_nuts3"),
    ([], None, [], "OB1", "CZ010|Praha|mapped|mpsv_obec_codelist_nuts3"), ([], None, None, "?", "-|-|unmapped|not_available"), (None, None, None, None, "-|-|unmapped|not_available"),
]


def czech_region(spark, sf_dir):
    rows = _cases(spark, sf_dir, {"work_regions": "array<string>", "contact_region": "string", "districts": "array<string>", "municipality": "string"}, CZECH)
    return _told(M.czech_region(rows, KEY, spark.createDataFrame(CZECH_TABLE, REGIONS)))


FRENCH_TABLE = [("64", "FRI15", "Pyrénées-Atlantiques"), ("75", "FR101", "Paris"), ("2A", "FRM01", "Corse-du-Sud"), ("971", "FRY10", "Guadeloupe")]
FRENCH = [
    ("64102", "75001", "75 - Paris", "FRI15|Pyrénées-Atlantiques|mapped|ft_commune_insee_departement_nuts3"), ("2a004", None, None, "FRM01|Corse-du-Sud|mapped|ft_commune_insee_departement_nuts3"), ("97113", None, None, "FRY10|Guadeloupe|mapped|ft_commune_insee_departement_nuts3"),
    (None, "20000", "2A - Ajaccio", "-|-|ambiguous|ft_code_postal_corse_2a_2b"), ("99999", "75001", None, "FR101|Paris|low_confidence|ft_code_postal_departement_nuts3"), (None, "abc", "64 - Anglet", "FRI15|Pyrénées-Atlantiques|low_confidence|ft_lieu_libelle_departement_nuts3"),
    (None, None, "Anglet", "-|-|unmapped|not_available"), ("", "", "", "-|-|unmapped|not_available"), (None, None, None, "-|-|unmapped|not_available"),
]


def french_region(spark, sf_dir):
    rows = _cases(spark, sf_dir, {"commune": "string", "postcode": "string", "label": "string"}, FRENCH)
    return _told(M.french_region(rows, KEY, spark.createDataFrame(FRENCH_TABLE, REGIONS)))


COUNTIES = [("Trøndelag", "NO060", "Trøndelag"), ("Troms - Romsa - Tromssa", "NO072", "Troms"), ("Oslo", "NO081", "Oslo")]
TOWNS = [("Oslo", "NO081", "Oslo"), ("Herøy (Nordland)", "NO071", "Nordland"), ("Herøy (Møre og Romsdal)", "NO0A3", "Møre og Romsdal"), ("Trondheim", "NO060", "Trøndelag")]
SPOT = "array<struct<county:string,municipal:string,country:string>>"


def spot(county=None, municipal=None, country="NORGE"):
    return {"county": county, "municipal": municipal, "country": country}


NORWEGIAN = [
    ([spot("TRØNDELAG", "OSLO")], "OSLO", "NO060|Trøndelag|mapped|nav_worklocation_county_nuts3"), ([spot("TROMS"), spot("OSLO")], None, "NO072|Troms|ambiguous|nav_worklocation_county_nuts3"), ([spot("?", "TRONDHEIM")], None, "NO060|Trøndelag|mapped|nav_worklocation_municipal_nuts3"),
    ([spot(None, "HERØY")], None, "-|-|ambiguous|nav_worklocation_municipal_nuts3"), ([spot(None, "HERØY"), spot(None, "OSLO")], None, "NO081|Oslo|ambiguous|nav_worklocation_municipal_nuts3"), ([], "TRONDHEIM", "NO060|Trøndelag|low_confidence|nav_feed_entry_municipal_nuts3"),
    ([], "HERØY", "-|-|ambiguous|nav_feed_entry_municipal_nuts3"), ([spot(None, None, "SVERIGE")], None, "-|-|unmapped|nav_worklocation_foreign_country"), ([spot("?", None, None)], None, "-|-|unmapped|nav_region_name_unknown"), ([], "?", "-|-|unmapped|nav_region_name_unknown"),
    ([], None, "-|-|not_present|not_available"), (None, None, "-|-|not_present|not_available"), ([spot(None, None, "SVERIGE"), spot(None, None, "Norway")], None, "-|-|not_present|not_available"),
]


def norwegian_region(spark, sf_dir):
    rows = _cases(spark, sf_dir, {"locations": SPOT, "feed_municipal": "string"}, NORWEGIAN)
    return _told(M.norwegian_region(rows, KEY, spark.createDataFrame(COUNTIES, NAMES), spark.createDataFrame(TOWNS, NAMES)))


def cat(code, score=None, kind="ESCO"):
    return {"categoryType": kind, "code": code, "score": score}


CATEGORIES = [
    ([cat(OCCUPATION, 0.7), cat(OTHER, 0.2)], f"{OCCUPATION}|mapped|medium|nav_categorylist_esco"), ([cat(OCCUPATION, 0.95), cat(OTHER, 0.95)], f"{OTHER}|ambiguous|high|nav_categorylist_esco"), ([cat(f" {OCCUPATION} ")], f"{OCCUPATION}|mapped|-|nav_categorylist_esco"),
    ([cat("http://data.europa.eu/esco/isco/c9112", 1.0)], "-|unmapped|-|nav_categorylist_esco_isco_group"), ([cat("x", 1.0)], "-|unmapped|-|nav_categorylist_esco_unrecognized"), ([cat(OCCUPATION, 1.0, "STYRK08")], "-|not_present|-|not_available"), ([], "-|not_present|-|not_available"), (None, "-|not_present|-|not_available"),
    ([cat(OCCUPATION, 0.0, " esco ")], f"{OCCUPATION}|mapped|low|nav_categorylist_esco"),
]


def norwegian_occupation(spark, sf_dir):
    rows = _cases(spark, sf_dir, {"categories": "array<struct<categoryType:string,code:string,score:double>>"}, CATEGORIES)
    told = M.norwegian_occupation(F.col("categories"))
    return rows.select(KEY, F.concat_ws("|", *(F.coalesce(told[c], F.lit("-")) for c in ("uri", "status", "confidence", "method"))).alias("found"))


FINNISH_TABLE = [("kunta", "091", "FI1B1", "Helsinki-Uusimaa"), ("kunta", "837", "FI197", "Pirkanmaa"), ("kunta", "5", "FI195", "Etelä-Pohjanmaa"), ("maakunta", "01", "FI1B1", "Helsinki-Uusimaa"), ("maakunta", "06", "FI197", "Pirkanmaa"), ("maakunta", "21", "FI200", "Åland"), ("maakunta", "21", "FI201", "Åland 2")]
FINNISH = [
    (["91"], ["06"], "FI1B1|Helsinki-Uusimaa|mapped|tmt_kunta_nuts3"), (["091", "837"], [], "-|-|ambiguous|tmt_kunta_multiple_nuts3"), (["005"], None, "FI195|Etelä-Pohjanmaa|mapped|tmt_kunta_nuts3"), ([], ["6"], "FI197|Pirkanmaa|mapped|tmt_maakunta_nuts3"), (["999"], ["1", "06"], "-|-|ambiguous|tmt_maakunta_multiple_nuts3"),
    ([], ["21"], "-|-|ambiguous|tmt_maakunta_ambiguous_code"), ([], ["21", "01"], "FI1B1|Helsinki-Uusimaa|mapped|tmt_maakunta_nuts3"), (["999"], [], "-|-|unmapped|tmt_unknown_region_code"), ([" "], [""], "-|-|not_present|not_available"), (None, None, "-|-|not_present|not_available"),
]


def finnish_region(spark, sf_dir):
    rows = _cases(spark, sf_dir, {"municipalities": "array<string>", "regions": "array<string>"}, FINNISH)
    return _told(M.finnish_region(rows, KEY, spark.createDataFrame(FINNISH_TABLE, "source_type string, source_code string, nuts_code string, nuts_label string")))


NATIONAL = "https://data.tyomarkkinatori.fi/esco/occupation/1"
FINNISH_OCCUPATIONS = [
    (OCCUPATION, [OTHER], f"{OCCUPATION}|mapped|finesco_esco_occupation_uri"), ("x", [NATIONAL, OTHER], f"{OTHER}|mapped|finesco_esco_occupation_uri"), ("http://data.europa.eu/esco/isco/C2511", [NATIONAL], "-|low_confidence|finesco_isco_group_uri_only"), (NATIONAL, [], "-|unmapped|finesco_national_extension_uri"),
    ("x", None, "-|unmapped|finesco_unrecognised_occupation_uri"), (None, [], "-|not_present|not_available"), (" ", [""], "-|not_present|not_available"),
]


def finnish_occupation(spark, sf_dir):
    rows = _cases(spark, sf_dir, {"main": "string", "others": "array<string>"}, FINNISH_OCCUPATIONS)
    told = M.finnish_occupation(F.col("main"), F.col("others"))
    return rows.select(KEY, F.concat_ws("|", *(F.coalesce(told[c], F.lit("-")) for c in ("uri", "status", "method"))).alias("found"))


FINNISH_SKILLS = [([SKILL, "http://data.europa.eu/esco/isced-f/0611"], f"mapped:finesco_esco_skill_uri:{SKILL},low_confidence:finesco_isced_f_uri:-"), ([NATIONAL, "", "x"], "unmapped:finesco_national_extension_uri:-,unmapped:finesco_unrecognised_skill_uri:-"), ([], ""), (None, ""), ([None, f" {SKILL}"], f"mapped:finesco_esco_skill_uri:{SKILL}")]


def finnish_skills(spark, sf_dir):
    rows = _cases(spark, sf_dir, {"skills": "array<string>"}, FINNISH_SKILLS)
    told = F.transform(M.finnish_skills(F.col("skills")), lambda s: F.concat_ws(":", s["status"], s["method"], F.coalesce(s["uri"], F.lit("-"))))
    return rows.select(KEY, F.array_join(told, ",").alias("found"))


FLEMISH = [("1500", "BE241|Halle-Vilvoorde|mapped|vdab_landing_postcode_nuts3"), (" 1500 ", "BE241|Halle-Vilvoorde|mapped|vdab_landing_postcode_nuts3"), ("1000", "-|-|unmapped|not_available"), ("", "-|-|unmapped|not_available"), (None, "-|-|unmapped|not_available")]


def flemish_region(spark, sf_dir):
    rows = _cases(spark, sf_dir, {"postcode": "string"}, FLEMISH)
    return _told(M.postcode_region(rows, KEY, spark.createDataFrame([("1500", "BE241", "Halle-Vilvoorde")], REGIONS)))


GERMAN_TOWNS = [("Berlin", "DE300", "Berlin"), ("Neunkirchen", "DEC03", "Neunkirchen"), ("Neunkirchen", "DEA5A", "Siegen-Wittgenstein"), ("Neunkirchen", "DE127", "Neckar-Odenwald-Kreis"), ("Hof", "DE244", "Hof"), ("Hof", "DE249", "Hof, Land")]
GERMAN = [
    ("Berlin", None, None, "DE300|Berlin|mapped|ba_city_municipality_nuts3"), ("berlin", None, None, "DE300|Berlin|mapped|ba_city_municipality_nuts3"), ("Neunkirchen, Saar", None, None, "DEC03|Neunkirchen|mapped|ba_city_qualifier_nuts3"), ("Neunkirchen", None, None, "-|-|ambiguous|ba_city_municipality_ambiguous"),
    ("Neunkirchen", "DEA", None, "DEA5A|Siegen-Wittgenstein|mapped|ba_segment_disambiguated"), ("Neunkirchen", "DEA", "DE127", "DE127|Neckar-Odenwald-Kreis|mapped|ba_segment_disambiguated"), ("Hof, Oberfranken", None, None, "-|-|ambiguous|ba_city_municipality_ambiguous"), ("Hof, Oberfranken", None, "DE249", "DE249|Hof, Land|mapped|ba_segment_disambiguated"),
    ("Neunkirchen, Bremen", None, None, "-|-|ambiguous|ba_city_municipality_ambiguous"), ("Deutschland", None, None, "-|-|ambiguous|ba_location_nationwide"), ("Bundesweit (alle)", None, None, "-|-|ambiguous|ba_location_nationwide"), ("Verschiedene Arbeitsorte", None, None, "-|-|ambiguous|ba_location_multiple"),
    ("Ausland", None, None, "-|-|ambiguous|ba_location_foreign"), ("Nirgendwo", None, None, "-|-|unmapped|not_available"), ("", None, None, "-|-|unmapped|not_available"), (None, None, None, "-|-|unmapped|not_available"),
]


def german_location(spark, sf_dir):
    rows = _cases(spark, sf_dir, {"city": "string", "segment_nuts1": "string", "segment_nuts3": "string"}, GERMAN)
    return _told(M.german_location(rows, KEY, spark.createDataFrame(GERMAN_TOWNS, NAMES)))


PROVENANCE = [
    (None, None, "unmapped", "not_available", "DE300", 0, "DE300|Berlin|mapped|ba_segment_provenance_nuts3"), (None, None, "unmapped", "not_available", "DE300", 25, "DE300|Berlin|low_confidence|ba_segment_radius_nuts3"), (None, None, "unmapped", "not_available", None, 0, "-|-|unmapped|not_available"),
    (None, None, "ambiguous", "ba_location_foreign", "DE300", 0, "-|-|ambiguous|ba_location_foreign"), ("DE244", "Hof", "mapped", "ba_city_municipality_nuts3", "DE300", 0, "DE244|Hof|mapped|ba_city_municipality_nuts3"), (None, None, "unmapped", "not_available", "DE999", 0, "DE999|-|mapped|ba_segment_provenance_nuts3"),
]


def segment_provenance(spark, sf_dir):
    shapes = {"nuts_code": "string", "nuts_label": "string", "mapping_status": "string", "mapping_method": "string", "segment_nuts3": "string", "radius": "int"}
    return _told(M.segment_provenance(_cases(spark, sf_dir, shapes, PROVENANCE), spark.createDataFrame([("DE300", "Berlin")], "nuts_code string, nuts_label string")))


HIT = """struct<id:string,country_code:string,workplace_address:struct<municipality_code:string,region_code:string,country_code:string>,occupation:struct<concept_id:string>,
must_have:struct<skills:array<struct<concept_id:string>>>,nice_to_have:struct<skills:array<struct<concept_id:string>>>,employment_type:struct<concept_id:string>,working_hours_type:struct<concept_id:string>,duration:struct<concept_id:string>,number_of_vacancies:bigint>"""
HITS = [
    (
        {"country_code": "SE", "workplace_address": {"municipality_code": "0180"}, "occupation": {"concept_id": "one"}, "must_have": {"skills": [{"concept_id": "tie"}, {"concept_id": "none"}]}, "nice_to_have": {"skills": [{"concept_id": "tie"}, {"concept_id": None}]}, "employment_type": {"concept_id": "e1"}, "number_of_vacancies": 3},
        "SE110|municipality_crosswalk|u1|crosswalk|unmapped:no_match,mapped:exact_match_tiebreak|u3|Permanent|Not stated|Not stated|3",
    ),
    ({"workplace_address": {"country_code": "199", "region_code": "12"}, "employment_type": {"concept_id": "zz"}, "duration": {"concept_id": ""}}, "SE224|region_crosswalk|-|source_absent|not_present:source_absent||Unrecognised code|Not stated|Not stated|-"),
    ({"country_code": "NO", "workplace_address": {"country_code": "199"}}, None),
    ({"country_code": "SE", "must_have": {"skills": []}}, "-|source_absent|-|source_absent|not_present:source_absent||Not stated|Not stated|Not stated|-"),
    ({}, None),
]


def _hits(spark, sf_dir):
    raw = _cases(spark, sf_dir, {"hit": HIT}, HITS)
    return raw.select(F.col(KEY).cast("string").alias("id"), *(f"hit.{c}" for c in ("country_code", "workplace_address", "occupation", "must_have", "nice_to_have", *M.DIMENSIONS, "number_of_vacancies")))


def _references(spark):
    candidates, reviews = concept_tables(spark)
    both = reviews.crossJoin(spark.createDataFrame([("occupation",), ("skill",)], "dimension string"))
    return {
        "geography": spark.createDataFrame(GEOGRAPHY, "source_type string, source_code string, nuts_code string, nuts_label string"),
        "occupations": candidates,
        "skills": candidates,
        "reviews": both,
        "requirements": spark.createDataFrame([("employment_type", "e1", "Permanent")], "dimension string, code string, label_en string"),
    }


def hit_enrichment(spark, sf_dir):
    found = M.enriched_hits(_hits(spark, sf_dir), _references(spark))
    skills = F.array_join(F.transform("skill_mappings", lambda s: F.concat_ws(":", s["status"], s["method"])), ",")
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in ("nuts_code", "region_mapping_method", "esco_occupation_uri", "occupation_mapping_method")]
    labels = [F.col(f"{d}_label") for d in M.DIMENSIONS]
    return found.select(F.col("id").cast("long").alias(KEY), F.concat_ws("|", *parts, skills, F.array_join("skill_uris", ","), *labels, F.coalesce(F.col("number_of_vacancies").cast("string"), F.lit("-"))).alias("found"))


def hit_refusals(spark, sf_dir):
    return M.refused_hits(_hits(spark, sf_dir)).select(F.col("id").cast("long").alias(KEY))


def lane_records(spark, sf_dir):
    """Flemish tiles as common records: constants of the lane, null where the source tells nothing."""
    rows = read(spark, sf_dir, "customer")
    lane = {"source_id": F.col(KEY).cast("string"), "nuts_code": F.lit("BE241")}
    return M.normalised(rows, lane, ["source_id", "nuts_code", "country", "lang", "esco_occupation_uri", "occupation_mapping_status", "occupation_mapping_method"], M.LANES["vdab"])


REQUIREMENTS = [("e1", "Permanent|mapped"), ("zz", "Unrecognised code|unmapped"), ("", "Not stated|not_present"), (None, "Not stated|not_present")]


def requirement_mapping_rule(spark, sf_dir):
    rows = _cases(spark, sf_dir, {"code": "string"}, REQUIREMENTS)
    found = M.requirement_label(rows, spark.createDataFrame([("e1", "Permanent")], "code string, label_en string"), "code")
    return found.select(KEY, F.concat_ws("|", "value_label", "mapping_status").alias("found"))


CASES = {
    "esco_mapping_rule": (esco_mapping_rule, CONCEPTS), "region_cascade": (region_cascade, SWEDEN), "requirement_mapping_rule": (requirement_mapping_rule, REQUIREMENTS), "czech_region": (czech_region, CZECH), "french_region": (french_region, FRENCH), "norwegian_region": (norwegian_region, NORWEGIAN),
    "norwegian_occupation": (norwegian_occupation, CATEGORIES), "finnish_region": (finnish_region, FINNISH), "finnish_occupation": (finnish_occupation, FINNISH_OCCUPATIONS), "finnish_skills": (finnish_skills, FINNISH_SKILLS), "flemish_region": (flemish_region, FLEMISH),
    "german_location": (german_location, GERMAN), "segment_provenance": (segment_provenance, PROVENANCE),
}
OTHERS = {
    "hit_enrichment": (hit_enrichment, f"SELECT * FROM ({_sql(HITS)}) WHERE found IS NOT NULL"),
    "hit_refusals": (hit_refusals, f"SELECT {KEY} FROM ({_sql(HITS)}) WHERE found IS NULL"),
    "lane_records": (lane_records, f"SELECT CAST({KEY} AS VARCHAR) AS source_id, 'BE241' AS nuts_code, 'BE' AS country, 'nl' AS lang, CAST(NULL AS VARCHAR) AS esco_occupation_uri, 'not_present' AS occupation_mapping_status, 'not_available_vdab_html' AS occupation_mapping_method FROM customer"),
}


def queries() -> dict:
    return {name: query for name, (query, _) in (CASES | OTHERS).items()}


def oracle_sql() -> dict[str, str]:
    return {name: _sql(cases) for name, (_, cases) in CASES.items()} | {name: sql for name, (_, sql) in OTHERS.items()}
