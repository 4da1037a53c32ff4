"""Queries of the scalar rules: each deals its cases over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from .adapter import read
from .cases import dealt, dealt_sql

OCCUPATION = "http://data.europa.eu/esco/occupation/0b15375e-dfdd-4047-9efb-096e0aaee7d2"
SKILL = "http://data.europa.eu/esco/skill/0b15375e-dfdd-4047-9efb-096e0aaee7d2"

#: Name of a one-argument rule: (function, cases as (input, expected), Spark type of the input, SQL type of the result).
RULES = {
    "uri_classification": (
        C.uri_class,
        [(OCCUPATION, "esco_occupation"), (OCCUPATION.replace("http:", "https:"), "esco_occupation"), (SKILL, "esco_skill"), ("http://data.europa.eu/esco/isco/c9112", "isco_group"), ("http://data.europa.eu/esco/isco/C2511", "isco_group"), ("http://data.europa.eu/esco/isco/25", "isco_group"), ("http://data.europa.eu/esco/isco/c91123", "unrecognised"), ("http://data.europa.eu/esco/occupation/", "unrecognised"), ("http://x/esco/occupation/1", "unrecognised"), ("http://data.europa.eu/ESCO/isced-f/0611", "isced_field"), ("http://data.europa.eu/esco/isced-f/0611", "isced_field"), ("https://data.tyomarkkinatori.fi/esco/x1", "national"), ("", "none"), ("  ", "none"), (None, "none"), ("STYRK08", "unrecognised")],
        "string",
        "VARCHAR",
    ),
    "name_folding": (
        C.folded_name,
        [("Troms - Romsa - Tromssa", "troms"), ("Troms/Romsa/Tromssa", "troms"), ("TRØNDELAG", "trondelag"), ("Møre og Romsdal", "more og romsdal"), ("Herøy (Nordland)", "heroy"), ("Aurskog-Høland", "aurskog holand"), ("Ǻkra", "akra"), ("Åland", "aland"), ("Đuro ŋaŧa", "duro nata"), ("Straße", "strasse"), ("Nordland - Nordlánnda", "nordland"), ("  ", ""), ("", ""), (None, ""), ("Ærø", "aero"), ("Nord-Odal", "nord odal"), ("Ñandú ﬁn", "nandu fin")],
        "string",
        "VARCHAR",
    ),
    "name_plain": (
        C.plain_name,
        [("Côtes-d'Armor", "cotes d armor"), ("Île-de-France", "ile de france"), ("Val-de-Marne (94)", "val de marne 94"), ("ÉTAMPES", "etampes"), ("  a  b ", "a b"), (None, None), ("", ""), ("Łódź", "łodz"), ("Αθήνα", "αθηνα")],
        "string",
        "VARCHAR",
    ),
    "score_buckets": (C.score_bucket, [(1.0, "high"), (0.9, "high"), (0.89, "medium"), (0.8, "medium"), (0.6, "medium"), (0.59, "low"), (0.5, "low"), (0.0, "low"), (None, None)], "double", "VARCHAR"),
    "relation_confidence": (C.confidence, [("exact-match", "high"), ("close-match", "low"), ("broad-match", "low"), ("narrow-match", "low"), (None, None)], "string", "VARCHAR"),
    "dutch_dates": (
        C.dutch_date,
        [("Online sinds 3 mrt. 2026", "2026-03-03"), ("Online sinds  15 aug. 2026", "2026-08-15"), ("3 maart 2026", "2026-03-03"), ("1 Sept. 2025", "2025-09-01"), ("31 februari 2026", None), ("30 feb. 2026", None), ("29 februari 2028", "2028-02-29"), ("12 March 2026", None), ("gisteren", None), ("", None), (None, None), ("5 mei 2026", "2026-05-05"), ("10 okt 2026", "2026-10-10"), ("32 dec. 2026", None)],
        "string",
        "DATE",
    ),
    "commune_departments": (C.department_of_commune, [("64102", "64"), ("2a004", "2A"), (" 2B033 ", "2B"), ("97113", "971"), ("98", None), ("9", None), ("AB123", None), ("", None), (None, None), ("75056", "75")], "string", "VARCHAR"),
    "postcode_departments": (C.department_of_postcode, [("64600", "64"), ("20000", None), ("20", None), ("97110", "971"), ("97", None), ("2A004", None), ("7", None), ("", None), (None, None), (" 75001 ", "75")], "string", "VARCHAR"),
    "label_departments": (C.department_of_label, [("64 - Anglet", "64"), (" 2A - Ajaccio", "2A"), ("971 - Les Abymes", "971"), ("2a - Ajaccio", None), ("Anglet", None), ("64 Anglet", None), ("", None), (None, None), ("75- Paris", "75")], "string", "VARCHAR"),
    "iso_times": (
        C.iso_time,
        [("2026-08-21T09:46:01+02:00", "2026-08-21 07:46:01"), ("2026-08-21T00:00:00Z", "2026-08-21 00:00:00"), ("2026-08-21T09:46:01", "2026-08-21 09:46:01"), (" 2026-08-21 ", "2026-08-21 00:00:00"), ("2026-08-21T23:30:00-05:00", "2026-08-22 04:30:00"), ("2026-02-30T00:00:00", None), ("soon", None), ("", None), (None, None)],
        "string",
        "TIMESTAMP",
    ),
    "landing_postcodes": (C.landing_postcode, [("https://www.vdab.be/vindeenjob/jobs/1000-brussel-stad", "1000"), ("https://www.vdab.be/vindeenjob/jobs/1500-halle-deeltijds/?p=2", "1500"), ("https://www.vdab.be/vindeenjob/jobs/verpleegkundige", None), ("https://www.vdab.be/vindeenjob/jobs/0500-x", None), ("/vindeenjob/jobs/1000-a/b", None), (None, None), ("", None)], "string", "VARCHAR"),
    "vacancy_ids": (C.vacancy_id, [("https://www.vdab.be/vindeenjob/vacatures/74399985/industrieel-ingenieur?x=1", "74399985"), ("/vindeenjob/vacatures/7/", "7"), ("/vindeenjob/vacatures/7", None), ("/vindeenjob/vacatures/a7/", None), (None, None)], "string", "VARCHAR"),
    "content_ranges": (C.content_range_total, [("offres 0-149/1234", 1234), (" offres 150-299/150 ", 150), ("offres 0-149/*", None), ("items 0-1/9", None), ("", None), (None, None)], "string", "BIGINT"),
    "digit_numbers": (C.digits_as_number, [("1.627 jobs", 1627), ("  12 ", 12), ("none", None), ("", None), (None, None)], "string", "BIGINT"),
    "position_counts": (C.position_count, [("2", 2), ("1", 1), ("", 1), ("many", 1), ("-3", 0), ("2.7", 2), (None, 1), (" 4 ", 4)], "string", "INTEGER"),
    "polish_dates": (lambda c: C.day_of(c, "dd.MM.yyyy"), [("03.02.2026", "2026-02-03"), ("31.02.2026", None), ("2026-02-03", None), ("", None), (None, None), ("29.02.2028", "2028-02-29")], "string", "DATE"),
    "czech_dates": (lambda c: C.day_of(c, "yyyy-MM-dd"), [("2026-02-03", "2026-02-03"), ("2026-02-31", None), ("03.02.2026", None), ("", None), (None, None)], "string", "DATE"),
    "http_dates": (lambda c: C.http_date(c.cast("timestamp_ntz")), [("2026-08-20 21:41:51", "Thu, 20 Aug 2026 21:41:51 GMT"), ("2026-01-01 00:00:00", "Thu, 01 Jan 2026 00:00:00 GMT"), (None, None)], "string", "VARCHAR"),
    "planned_windows": (lambda c: C.pages_planned(c, 150, 21), [(0, 1), (1, 1), (150, 1), (151, 2), (3000, 20), (999999, 21), (-5, 1), (None, 1)], "long", "BIGINT"),
    "grouped_numbers": (C.grouped, [(0, "0"), (999, "999"), (1000, "1,000"), (1234567, "1,234,567"), (-1234, "-1,234"), (None, None)], "long", "VARCHAR"),
    "statistics": (lambda c: F.coalesce(C.grouped(c, 1), F.lit("—")), [(3.0, "3.0"), (12.26, "12.3"), (0.5, "0.5"), (None, "—")], "double", "VARCHAR"),
    "scope_slugs": (C.slug, [("jobtech-se stock", "jobtech-se-stock"), ("--A__b--", "a-b"), ("", "scope"), ("ÅÄÖ", "scope"), ("x" * 70, "x" * 60)], "string", "VARCHAR"),
    "place_queries": (lambda c: C.place_query(c, 0), [("Starnberg", "wo=Starnberg&umkreis=0"), ("Bad Tölz", "wo=Bad%20T%C3%B6lz&umkreis=0"), ("a/b", "wo=a/b&umkreis=0"), ("", "umkreis=0"), ("80331", "wo=80331&umkreis=0")], "string", "VARCHAR"),
}


def _rule(function, cases, kind):
    return lambda spark, sf_dir: read(spark, sf_dir, "customer").select("c_custkey", function(dealt("c_custkey", [i for i, _ in cases], kind)).alias("found"))


def finnish_codes(spark, sf_dir):
    """Codes padded to their width, longer ones whole."""
    return read(spark, sf_dir, "customer").select("c_custkey", C.zero_padded(F.col("c_custkey").cast("string"), 3).alias("code"))


def locality_checks(spark, sf_dir):
    asked, resolved, mode = (dealt("c_custkey", [case[i] for case in LOCALITIES]) for i in range(3))
    return read(spark, sf_dir, "customer").select("c_custkey", C.locality_holds(asked, resolved, mode).alias("holds"))


LOCALITIES = [("Hof", "Hof, Saale", None, True), ("72213", "72213", "EXAKT", True), ("Osterholz", "Osterholz bei Bopfingen", None, False), ("Hof", "Hof", "UNGUELTIG", False), ("Hof", None, None, False), ("Hof", "", None, False), (" hof ", "HOF", None, True)]
SEATS = [("Schleswig-Flensburg", "Schleswig-Flensburg", ["flensburg", "schleswig", "schleswig-flensburg"]), ("Rosenheim", "Rosenheim, Landkreis", ["rosenheim"]), ("Ulm", "Ulm, Stadtkreis", ["ulm"]), ("Bad Tölz", "Tölz/Wolfratshausen", ["bad tölz", "tölz", "tölz/wolfratshausen", "wolfratshausen"]), ("", "", [])]


def seat_names(spark, sf_dir):
    district, label = (dealt("c_custkey", [case[i] for case in SEATS]) for i in range(2))
    return read(spark, sf_dir, "customer").select("c_custkey", F.array_join(C.seat_labels(district, label), "|").alias("labels"))


def skill_ids(spark, sf_dir):
    """Each order's parts as two arrays of structs: by even and odd line numbers."""
    lines = read(spark, sf_dir, "lineitem").groupBy("l_orderkey")
    item = F.struct(F.col("l_partkey").cast("string").alias("concept_id"))
    two = lines.agg(*(F.collect_list(F.when(F.col("l_linenumber") % 2 == side, item)).alias(name) for side, name in ((0, "must"), (1, "nice"))))
    return two.select("l_orderkey", F.array_join(C.merged_ids(F.col("must"), F.col("nice")), ",").alias("ids"), F.array_join(C.sorted_uris(F.col("nice"), "concept_id"), ",").alias("uris"))


def membership_hashes(spark, sf_dir):
    line = F.concat_ws("\t", "n_name", F.col("n_nationkey").cast("string"))
    return read(spark, sf_dir, "nation").groupBy("n_regionkey").agg(C.membership_hash(line, F.col("n_name")).alias("membership"))


def next_buckets(spark, sf_dir):
    grain = dealt("event_id", ["day", "week", "month"])
    return read(spark, sf_dir, "events").select("event_id", C.next_bucket(F.date_trunc("day", "ts").cast("timestamp_ntz"), grain).alias("next"))


def drawn_shares(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", C.share_percent(F.col("l_linenumber") - 1, F.lit(5000)).alias("share"))


def scope_hashes(spark, sf_dir):
    """Hash of a row as compact JSON, by the columns' order."""
    return read(spark, sf_dir, "nation").select("n_nationkey", C.canonical_hash("n_name", "n_regionkey").alias("scope_hash"))


OTHERS = {
    "finnish_codes": (finnish_codes, "SELECT c_custkey, CASE WHEN length(CAST(c_custkey AS VARCHAR)) < 3 THEN lpad(CAST(c_custkey AS VARCHAR), 3, '0') ELSE CAST(c_custkey AS VARCHAR) END AS code FROM customer"),
    "locality_checks": (locality_checks, f"SELECT c_custkey, {dealt_sql('c_custkey', [c[3] for c in LOCALITIES], 'BOOLEAN')} AS holds FROM customer"),
    "seat_names": (seat_names, f"SELECT c_custkey, {dealt_sql('c_custkey', ['|'.join(c[2]) for c in SEATS])} AS labels FROM customer"),
    "skill_ids": (skill_ids, "SELECT l_orderkey, array_to_string(list_sort(list_distinct(list(CAST(l_partkey AS VARCHAR)))), ',') AS ids, coalesce(array_to_string(list_sort(list(CAST(l_partkey AS VARCHAR)) FILTER (WHERE l_linenumber % 2 = 1)), ','), '') AS uris FROM lineitem GROUP BY 1"),
    "membership_hashes": (membership_hashes, "SELECT n_regionkey, sha256(string_agg(n_name || chr(9) || n_nationkey, chr(10) ORDER BY n_name)) AS membership FROM nation GROUP BY 1"),
    "next_buckets": (next_buckets, "SELECT event_id, CAST(CASE event_id % 3 WHEN 0 THEN date_trunc('day', ts) + INTERVAL 1 DAY WHEN 1 THEN date_trunc('day', ts) + INTERVAL 7 DAY ELSE date_trunc('month', ts) + INTERVAL 1 MONTH END AS TIMESTAMP) AS next FROM events"),
    "drawn_shares": (drawn_shares, "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 1 THEN 0.0 ELSE greatest(1.0, 100 * (l_linenumber - 1) / 5000) END AS share FROM lineitem"),
    "scope_hashes": (scope_hashes, """SELECT n_nationkey, sha256('{"n_name":"' || n_name || '","n_regionkey":' || n_regionkey || '}') AS scope_hash FROM nation"""),
}


def queries() -> dict:
    return {name: _rule(function, cases, kind) for name, (function, cases, kind, _) in RULES.items()} | {name: query for name, (query, _) in OTHERS.items()}


def oracle_sql() -> dict[str, str]:
    found = {name: f"SELECT c_custkey, {dealt_sql('c_custkey', [e for _, e in cases], kind)} AS found FROM customer" for name, (_, cases, _, kind) in RULES.items()}
    return found | {name: sql for name, (_, sql) in OTHERS.items()}
