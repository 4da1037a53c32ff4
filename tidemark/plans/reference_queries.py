"""Mappings of orders and lines against reference tables as large as the given tables, with a code that a third of the rows carry.

Concepts come from parts, places from customers and suppliers, regions from
nations, so references have as many codes as these have rows, some repeated
with one region or several.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import mapping
from .adapter import read

#: The number that every third row has in place of its own.
HOT = 7


def _hot(own: str, of: str) -> Column:
    return F.when(F.col(of) % 3 == 0, HOT).otherwise(F.col(own))


def _code(letter: str, number) -> Column:
    return F.concat(F.lit(letter), number.cast("string"))


def _nuts(nation: str) -> Column:
    return F.format_string("XX%03d", F.col(nation))


def _region(spark: SparkSession, sf_dir: str, letter: str, every: int, twice: int) -> DataFrame:
    """(code, nuts_code, nuts_label): customers with a number divisible by ``every`` as codes; those divisible by ``twice`` lie in a second region too."""
    c = read(spark, sf_dir, "customer").where(F.col("c_custkey") % every == 0)
    second = c.where((F.col("c_custkey") > 0) & (F.col("c_custkey") % twice == 0)).withColumn("c_nationkey", (F.col("c_nationkey") + 1) % 25)
    return c.unionByName(second).select(_code(letter, F.col("c_custkey")).alias("code"), _nuts("c_nationkey").alias("nuts_code"), F.concat(F.lit("Region "), "c_nationkey").alias("nuts_label"))


def _regions_sql(letter: str, every: int, twice: int) -> str:
    return f"(SELECT '{letter}' || c_custkey AS code, printf('XX%03d', n) AS nuts_code, 'Region ' || n AS nuts_label FROM (SELECT c_custkey, c_nationkey AS n FROM customer WHERE c_custkey % {every} = 0 UNION ALL SELECT c_custkey, (c_nationkey + 1) % 25 FROM customer WHERE c_custkey % {every} = 0 AND c_custkey > 0 AND c_custkey % {twice} = 0))"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("c"))
    return o.groupBy("id").agg(F.min("c").alias("c")).withColumn("h", _hot("c", "id"))


ORDERS = f"o AS (SELECT id, c, CASE WHEN id % 3 = 0 THEN {HOT} ELSE c END AS h FROM (SELECT o_orderkey AS id, min(o_custkey) AS c FROM orders GROUP BY 1))"
MAPPED = ["nuts_code", "nuts_label", "mapping_status", "mapping_method"]


def concepts_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as concepts with none to three candidates each; every tenth was reviewed, to be redirected or refused."""
    part = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("p"))
    n = (F.col("p") % 4).cast("int")
    many = part.select("p", F.explode(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array())).alias("i"))
    exact = (F.col("p") + F.col("i")) % 3 == 0
    candidates = many.select(_code("c", F.col("p")).alias("concept"), F.concat(F.lit("u"), "p", F.lit("-"), "i").alias("target_uri"), F.concat(F.lit("label "), "i").alias("target_label"), F.when(exact, "exact-match").otherwise("close-match").alias("relation"), F.when(F.col("i") == 1, "high").otherwise("low").alias("confidence"))
    refused = F.col("p") % 20 == 0
    reviews = part.where("p % 10 = 0").select(_code("c", F.col("p")).alias("concept"), F.when(~refused, _code("r", F.col("p"))).alias("target_uri"), F.when(~refused, F.lit("reviewed")).alias("target_label"), F.lit("broad-match").alias("relation"), F.when(refused, "unmapped").otherwise("mapped").alias("status"), F.lit("manual").alias("confidence"))
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", F.when(F.col("l_linenumber") == 7, "").when(F.col("l_orderkey") % 3 == 0, F.lit(f"c{HOT}")).otherwise(_code("c", F.col("l_partkey"))).alias("concept"))
    found = mapping.map_concepts(lines, candidates, reviews)
    return found.groupBy("concept", "uri", "label", "mapping_status", "mapping_confidence", "mapping_method", "relation").agg(F.count(F.lit(1)).alias("rows"))


CONCEPTS_SQL = f"""WITH l AS (SELECT CASE WHEN l_linenumber = 7 THEN '' WHEN l_orderkey % 3 = 0 THEN 'c{HOT}' ELSE 'c' || l_partkey END AS concept FROM lineitem),
k AS (SELECT 'c' || p AS concept, 'u' || p || '-' || i AS uri, 'label ' || i AS label, (p + i) % 3 = 0 AS exact, CASE WHEN i = 1 THEN 'high' ELSE 'low' END AS confidence FROM (SELECT p_partkey AS p, unnest(range(1, p_partkey % 4 + 1)) AS i FROM part)),
s AS (SELECT concept, count(*) AS n, count(*) FILTER (WHERE exact) AS x, max({{'exact': exact, 'uri': uri, 'label': label, 'confidence': confidence}}) AS pick FROM k GROUP BY 1),
r AS (SELECT 'c' || p_partkey AS concept, p_partkey % 20 = 0 AS refused, 'r' || p_partkey AS uri FROM part WHERE p_partkey % 10 = 0),
t AS (SELECT l.concept, CASE WHEN l.concept = '' THEN 'not_present' WHEN refused THEN 'unmapped' WHEN r.concept IS NOT NULL THEN 'mapped' WHEN n IS NULL THEN 'unmapped' WHEN n > 1 AND x = 1 THEN 'mapped' WHEN n > 1 THEN 'ambiguous' WHEN x = 1 THEN 'mapped' ELSE 'low_confidence' END AS mapping_status,
CASE WHEN l.concept = '' THEN 'source_absent' WHEN r.concept IS NOT NULL THEN 'manual_review' WHEN n IS NULL THEN 'no_match' WHEN n > 1 AND x = 1 THEN 'exact_match_tiebreak' WHEN n > 1 THEN 'no_match' ELSE 'crosswalk' END AS mapping_method, r.uri AS r_uri, pick
FROM l LEFT JOIN s ON s.concept = l.concept LEFT JOIN r ON r.concept = l.concept)
SELECT concept, CASE WHEN mapping_status = 'mapped' THEN CASE WHEN mapping_method = 'manual_review' THEN r_uri ELSE pick.uri END END AS uri, CASE WHEN mapping_status = 'mapped' THEN CASE WHEN mapping_method = 'manual_review' THEN 'reviewed' ELSE pick.label END END AS label, mapping_status,
CASE WHEN mapping_status IN ('mapped', 'low_confidence') THEN CASE WHEN mapping_method = 'manual_review' THEN 'manual' ELSE pick.confidence END END AS mapping_confidence, mapping_method,
CASE WHEN mapping_status IN ('mapped', 'low_confidence') THEN CASE WHEN mapping_method = 'manual_review' THEN 'broad-match' WHEN pick.exact THEN 'exact-match' ELSE 'close-match' END END AS relation, count(*) AS rows FROM t GROUP BY ALL"""


def cascade_of_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as municipalities, nations as regions, each a step of the Swedish cascade."""
    padded = lambda n, width: F.lpad(n.cast("string"), width, "0")
    c = read(spark, sf_dir, "customer").where("c_custkey % 3 <> 1")
    towns = c.select(F.lit("municipality").alias("source_type"), padded(F.col("c_custkey") * 10 + 5, 6).alias("source_code"), _nuts("c_nationkey").alias("nuts_code"), F.lit("town").alias("nuts_label"))
    areas = read(spark, sf_dir, "nation").where("n_nationkey % 4 > 0").select(F.lit("region").alias("source_type"), padded(F.col("n_nationkey"), 2).alias("source_code"), _nuts("n_nationkey").alias("nuts_code"), F.col("n_name").alias("nuts_label"))
    rows = _orders(spark, sf_dir).select("id", F.when(F.col("id") % 5 == 0, "").when(F.col("id") % 7 == 0, padded(F.col("c") % 30, 2)).otherwise(padded(F.col("h") * 10 + 5, 6)).alias("municipality"), F.when(F.col("id") % 4 > 0, padded(F.col("c") % 30, 2)).alias("region_code"))
    return mapping.region_cascade(rows, towns.unionByName(areas)).select("id", *MAPPED)


CASCADE_SQL = f"""WITH {ORDERS}, w AS (SELECT id, CASE WHEN id % 5 = 0 THEN NULL WHEN id % 7 = 0 THEN lpad(CAST(c % 30 AS VARCHAR), 2, '0') ELSE lpad(CAST(h * 10 + 5 AS VARCHAR), 6, '0') END AS m, CASE WHEN id % 4 > 0 THEN lpad(CAST(c % 30 AS VARCHAR), 2, '0') END AS r FROM o),
t AS (SELECT lpad(CAST(c_custkey * 10 + 5 AS VARCHAR), 6, '0') AS code, printf('XX%03d', c_nationkey) AS nuts FROM customer WHERE c_custkey % 3 <> 1), a AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code, printf('XX%03d', n_nationkey) AS nuts, n_name FROM nation WHERE n_nationkey % 4 > 0)
SELECT id, coalesce(t.nuts, p.nuts, a.nuts) AS nuts_code, CASE WHEN t.nuts IS NOT NULL THEN 'town' ELSE coalesce(p.n_name, a.n_name) END AS nuts_label, CASE WHEN coalesce(t.nuts, p.nuts, a.nuts) IS NOT NULL THEN 'mapped' WHEN m IS NULL AND r IS NULL THEN 'not_present' ELSE 'unmapped' END AS mapping_status,
CASE WHEN t.nuts IS NOT NULL THEN 'municipality_crosswalk' WHEN p.nuts IS NOT NULL THEN 'municipality_prefix_crosswalk' WHEN a.nuts IS NOT NULL THEN 'region_crosswalk' WHEN m IS NULL AND r IS NULL THEN 'source_absent' ELSE 'no_match' END AS mapping_method
FROM w LEFT JOIN t ON t.code = m LEFT JOIN a p ON p.code = left(m, 2) AND length(m) >= 2 LEFT JOIN a ON a.code = r"""


def czech_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with lists of workplaces and districts, a contact and a municipality, all from one table of customers."""
    rows = _orders(spark, sf_dir).select(
        "id",
        F.when(F.col("id") % 4 == 0, F.array(_code("w", F.col("h")), _code("w", F.col("c") + 1))).otherwise(F.array().cast("array<string>")).alias("work_regions"),
        F.when(F.col("id") % 5 == 0, _code("w", F.col("c"))).alias("contact_region"),
        F.when(F.col("id") % 3 > 0, F.array(_code("w", F.col("c") + 2), _code("w", F.col("h")))).alias("districts"),
        _code("w", F.col("h")).alias("municipality"),
    )
    return mapping.czech_region(rows, "id", _region(spark, sf_dir, "w", 2, 6)).select("id", *MAPPED)


def _hits(name: str, lists: str, table: str) -> str:
    """SQL of what ``hits_of`` finds: number of regions, and the region of the first place, the least of several there."""
    return f"{name} AS (SELECT id, count(DISTINCT nuts_code) AS n, arg_min({{'nuts_code': nuts_code, 'nuts_label': nuts_label}}, (place, nuts_code)) AS first FROM (SELECT id, unnest(range(len(codes))) AS place, unnest(codes) AS code FROM (SELECT id, {lists} AS codes FROM o)) JOIN {table} t USING (code) GROUP BY id)"


CZECH_SQL = f"""WITH {ORDERS}, t AS {_regions_sql("w", 2, 6)},
{_hits("w", "CASE WHEN id % 4 = 0 THEN ['w' || h, 'w' || (c + 1)] ELSE [] END", "t")}, {_hits("k", "CASE WHEN id % 5 = 0 THEN ['w' || c] ELSE [] END", "t")}, {_hits("d", "CASE WHEN id % 3 > 0 THEN ['w' || (c + 2), 'w' || h] ELSE [] END", "t")}, {_hits("m", "['w' || h]", "t")}
SELECT id, coalesce(w.first, k.first, d.first, m.first).nuts_code AS nuts_code, coalesce(w.first, k.first, d.first, m.first).nuts_label AS nuts_label,
CASE WHEN w.n > 1 THEN 'ambiguous' WHEN w.n = 1 THEN 'mapped' WHEN k.n > 0 THEN 'low_confidence' WHEN d.n > 1 THEN 'ambiguous' WHEN d.n = 1 OR m.n > 0 THEN 'mapped' ELSE 'unmapped' END AS mapping_status,
CASE WHEN w.n > 0 THEN 'mpsv_kraje_codelist_nuts3' WHEN k.n > 0 THEN 'mpsv_kraje_codelist_contact_address' WHEN d.n > 0 THEN 'mpsv_okres_codelist_nuts3' WHEN m.n > 0 THEN 'mpsv_obec_codelist_nuts3' ELSE 'not_available' END AS mapping_method
FROM o LEFT JOIN w USING (id) LEFT JOIN k USING (id) LEFT JOIN d USING (id) LEFT JOIN m USING (id)"""


def flemish_postcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postcodes of orders, with blanks around, against customers' ones."""
    rows = _orders(spark, sf_dir).select("id", F.when(F.col("id") % 11 > 0, F.concat(F.lit(" "), _code("p", F.col("h")), F.lit(" "))).alias("postcode"))
    return mapping.postcode_region(rows, "id", _region(spark, sf_dir, "p", 3, 10**9)).select("id", *MAPPED)


FLEMISH_SQL = f"""WITH {ORDERS} SELECT id, nuts_code, nuts_label, CASE WHEN nuts_code IS NULL THEN 'unmapped' ELSE 'mapped' END AS mapping_status, CASE WHEN nuts_code IS NULL THEN 'not_available' ELSE 'vdab_landing_postcode_nuts3' END AS mapping_method
FROM o LEFT JOIN {_regions_sql("p", 3, 10**9)} t ON t.code = CASE WHEN id % 11 > 0 THEN 'p' || h END"""


def finnish_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as municipalities and areas, the areas' codes shared by several regions now and then."""
    c = read(spark, sf_dir, "customer")
    region = (_nuts("c_nationkey").alias("nuts_code"), F.concat(F.lit("Region "), "c_nationkey").alias("nuts_label"))
    towns = c.where("c_custkey % 4 <> 2").select(F.lit("kunta").alias("source_type"), F.col("c_custkey").cast("string").alias("source_code"), *region)
    areas = c.where("c_custkey < 60").select(F.lit("maakunta").alias("source_type"), (F.col("c_custkey") % 40).cast("string").alias("source_code"), *region)
    lists = lambda *codes: F.array(*(F.lpad(x.cast("string"), 3, "0") for x in codes))
    rows = _orders(spark, sf_dir).select(
        "id",
        F.when(F.col("id") % 4 > 0, F.when(F.col("id") % 5 == 0, lists(F.col("h"), F.col("c"))).otherwise(lists(F.col("h")))).alias("municipalities"),
        F.when(F.col("id") % 6 > 0, F.array(F.lpad((F.col("c") % 45).cast("string"), 2, "0"), F.lit(" "))).otherwise(F.array().cast("array<string>")).alias("regions"),
    )
    return mapping.finnish_region(rows, "id", towns.unionByName(areas)).select("id", *MAPPED)


FINNISH_SQL = f"""WITH {ORDERS}, town AS (SELECT lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(3, length(CAST(c_custkey AS VARCHAR))) AS INTEGER), '0') AS code, printf('XX%03d', c_nationkey) AS nuts, c_nationkey AS k FROM customer WHERE c_custkey % 4 <> 2),
area AS (SELECT c_custkey % 40 AS code, count(DISTINCT c_nationkey) AS n, min(c_nationkey) AS k FROM customer WHERE c_custkey < 60 GROUP BY 1),
w AS (SELECT id, CASE WHEN id % 4 = 0 THEN [] WHEN id % 5 = 0 THEN [lpad(CAST(h AS VARCHAR), 3, '0'), lpad(CAST(c AS VARCHAR), 3, '0')] ELSE [lpad(CAST(h AS VARCHAR), 3, '0')] END AS towns, CASE WHEN id % 6 > 0 THEN c % 45 END AS area FROM o),
ht AS (SELECT id, count(DISTINCT nuts) AS n, min(k) AS k FROM (SELECT id, unnest(towns) AS code FROM w) JOIN town USING (code) GROUP BY id)
SELECT id, CASE WHEN ht.n = 1 THEN printf('XX%03d', ht.k) WHEN ht.n > 1 THEN NULL WHEN a.n = 1 THEN printf('XX%03d', a.k) END AS nuts_code, CASE WHEN ht.n = 1 THEN 'Region ' || ht.k WHEN ht.n > 1 THEN NULL WHEN a.n = 1 THEN 'Region ' || a.k END AS nuts_label,
CASE WHEN ht.n = 1 THEN 'mapped' WHEN ht.n > 1 THEN 'ambiguous' WHEN a.n = 1 THEN 'mapped' WHEN a.n > 1 THEN 'ambiguous' WHEN len(towns) > 0 OR area IS NOT NULL THEN 'unmapped' ELSE 'not_present' END AS mapping_status,
CASE WHEN ht.n = 1 THEN 'tmt_kunta_nuts3' WHEN ht.n > 1 THEN 'tmt_kunta_multiple_nuts3' WHEN a.n = 1 THEN 'tmt_maakunta_nuts3' WHEN a.n > 1 THEN 'tmt_maakunta_ambiguous_code' WHEN len(towns) > 0 OR area IS NOT NULL THEN 'tmt_unknown_region_code' ELSE 'not_available' END AS mapping_method
FROM w LEFT JOIN ht USING (id) LEFT JOIN area a ON a.code = w.area"""


def french_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Communes, postcodes and labels of orders against départements from suppliers."""
    s = read(spark, sf_dir, "supplier").where("s_suppkey < 96")
    table = s.select(F.lpad(F.col("s_suppkey").cast("string"), 2, "0").alias("code"), _nuts("s_nationkey").alias("nuts_code"), F.concat(F.lit("Region "), "s_nationkey").alias("nuts_label"))
    five = lambda c: F.lpad((c * 37 % 99000).cast("string"), 5, "0")
    rows = _orders(spark, sf_dir).select("id", F.when(F.col("id") % 4 == 0, five(F.col("h"))).alias("commune"), F.when(F.col("id") % 4 == 1, five(F.col("c"))).when(F.col("id") % 4 == 2, F.lit("20090")).alias("postcode"), F.when(F.col("id") % 4 == 3, F.concat(F.lpad((F.col("c") % 89).cast("string"), 2, "0"), F.lit(" - Ville"))).alias("label"))
    return mapping.french_region(rows, "id", table).select("id", *MAPPED)


FRENCH_SQL = f"""WITH {ORDERS}, t AS (SELECT lpad(CAST(s_suppkey AS VARCHAR), 2, '0') AS code, printf('XX%03d', s_nationkey) AS nuts_code, 'Region ' || s_nationkey AS nuts_label FROM supplier WHERE s_suppkey < 96),
w AS (SELECT id, id % 4 AS k, CASE id % 4 WHEN 0 THEN lpad(CAST(h * 37 % 99000 AS VARCHAR), 5, '0') WHEN 1 THEN lpad(CAST(c * 37 % 99000 AS VARCHAR), 5, '0') WHEN 3 THEN lpad(CAST(c % 89 AS VARCHAR), 2, '0') END AS code FROM o),
d AS (SELECT id, k, CASE WHEN k = 1 AND left(code, 2) = '20' THEN NULL WHEN k < 2 AND left(code, 2) IN ('97', '98') THEN left(code, 3) ELSE left(code, 2) END AS dep, k = 2 OR (k = 1 AND left(code, 2) = '20') AS corse FROM w)
SELECT id, nuts_code, nuts_label, CASE WHEN corse THEN 'ambiguous' WHEN nuts_code IS NULL THEN 'unmapped' WHEN k = 0 THEN 'mapped' ELSE 'low_confidence' END AS mapping_status,
CASE WHEN corse THEN 'ft_code_postal_corse_2a_2b' WHEN nuts_code IS NULL THEN 'not_available' WHEN k = 0 THEN 'ft_commune_insee_departement_nuts3' WHEN k = 1 THEN 'ft_code_postal_departement_nuts3' ELSE 'ft_lieu_libelle_departement_nuts3' END AS mapping_method FROM d LEFT JOIN t ON t.code = d.dep"""


def norwegian_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with two places each: nations as counties, customers as municipalities, some names in two regions."""
    n = read(spark, sf_dir, "nation").where("n_nationkey % 5 > 0")
    counties = n.select(F.concat(F.lit("Fylke "), "n_nationkey").alias("name"), _nuts("n_nationkey").alias("nuts_code"), F.concat(F.lit("Region "), "n_nationkey").alias("nuts_label"))
    towns = _region(spark, sf_dir, "By ", 2, 10).withColumnRenamed("code", "name")
    spot = lambda county, town, country: F.struct(county.alias("county"), town.alias("municipal"), country.alias("country"))
    none = F.lit(None).cast("string")
    one = spot(F.when(F.col("id") % 5 == 0, F.concat(F.lit(" FYLKE  "), F.col("c") % 30)), F.when(F.col("id") % 2 == 0, F.upper(_code("By ", F.col("h")))), F.when(F.col("id") % 13 == 0, F.lit("Sverige")).otherwise(F.lit("NORGE")))
    two = spot(none, F.when(F.col("id") % 7 == 0, F.concat(_code("By ", F.col("c") + 1), F.lit(" (x)"))), none)
    rows = _orders(spark, sf_dir).select("id", F.when(F.col("id") % 17 > 0, F.array(one, two)).alias("locations"), F.when(F.col("id") % 3 == 1, _code("by ", F.col("c"))).alias("feed_municipal"))
    return mapping.norwegian_region(rows, "id", counties, towns).select("id", *MAPPED)


NORWEGIAN_SQL = f"""WITH {ORDERS}, county AS (SELECT n_nationkey AS code FROM nation WHERE n_nationkey % 5 > 0),
town AS (SELECT CAST(substr(code, 4) AS BIGINT) AS code, count(DISTINCT nuts_code) AS n, min(nuts_code) AS nuts_code FROM {_regions_sql("By ", 2, 10)} GROUP BY 1),
w AS (SELECT id, id % 17 > 0 AS placed, CASE WHEN id % 17 > 0 AND id % 5 = 0 THEN c % 30 END AS county, list_filter([CASE WHEN id % 17 > 0 AND id % 2 = 0 THEN h END, CASE WHEN id % 17 > 0 AND id % 7 = 0 THEN c + 1 END], lambda x: x IS NOT NULL) AS towns, CASE WHEN id % 3 = 1 THEN c END AS feed, id % 17 > 0 AND id % 13 = 0 AS abroad FROM o),
ht AS (SELECT id, count(DISTINCT nuts_code) FILTER (WHERE n = 1) AS n, min(nuts_code) FILTER (WHERE n = 1) AS least, bool_or(n > 1) AS mixed FROM (SELECT id, unnest(towns) AS code FROM w) JOIN town USING (code) GROUP BY id),
j AS (SELECT w.*, k.code AS k, ht.n AS tn, ht.least AS tl, ht.mixed AS tm, f.n AS fn, CASE WHEN f.n = 1 THEN f.nuts_code END AS fl FROM w LEFT JOIN county k ON k.code = w.county LEFT JOIN ht ON ht.id = w.id LEFT JOIN town f ON f.code = w.feed),
r AS (SELECT id, CASE WHEN k IS NOT NULL THEN printf('XX%03d', k) WHEN tn > 0 OR tm THEN tl WHEN fn IS NOT NULL THEN fl END AS nuts_code,
CASE WHEN k IS NOT NULL THEN 'mapped' WHEN tn > 1 OR tm THEN 'ambiguous' WHEN tn = 1 THEN 'mapped' WHEN fn > 1 THEN 'ambiguous' WHEN fn = 1 THEN 'low_confidence' WHEN abroad OR county IS NOT NULL OR len(towns) > 0 OR feed IS NOT NULL THEN 'unmapped' ELSE 'not_present' END AS mapping_status,
CASE WHEN k IS NOT NULL THEN 'nav_worklocation_county_nuts3' WHEN tn > 0 OR tm THEN 'nav_worklocation_municipal_nuts3' WHEN fn IS NOT NULL THEN 'nav_feed_entry_municipal_nuts3' WHEN abroad THEN 'nav_worklocation_foreign_country' WHEN county IS NOT NULL OR len(towns) > 0 OR feed IS NOT NULL THEN 'nav_region_name_unknown' ELSE 'not_available' END AS mapping_method FROM j)
SELECT id, nuts_code, 'Region ' || CAST(substr(nuts_code, 3) AS INTEGER) AS nuts_label, mapping_status, mapping_method FROM r"""


def german_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cities of orders among customers' towns, some of which lie in two regions and are told apart by the segment or a qualifier."""
    c = read(spark, sf_dir, "customer").where("c_custkey % 2 = 0")
    nuts = lambda n: F.format_string("DE%d%02d", n % 9 + 1, n)
    second = c.where("c_custkey % 10 = 0").withColumn("c_nationkey", (F.col("c_nationkey") + 1) % 25)
    towns = c.unionByName(second).select(_code("Town ", F.col("c_custkey")).alias("name"), nuts(F.col("c_nationkey")).alias("nuts_code"), F.concat(F.lit("Region "), "c_nationkey").alias("nuts_label"))
    city = F.when(F.col("id") % 11 == 0, "").when(F.col("id") % 13 == 0, "Bundesweit und mehr").when(F.col("id") % 4 == 0, F.concat(_code("town ", F.col("h")), F.lit(", Baden"))).otherwise(_code("Town ", F.when(F.col("id") % 3 == 0, F.col("c")).otherwise(F.col("c") - F.col("c") % 10)))
    segment = nuts(F.col("c") % 25)
    rows = _orders(spark, sf_dir).select("id", city.alias("city"), F.when(F.col("id") % 5 > 1, F.substring(segment, 1, 3)).alias("segment_nuts1"), F.when(F.col("id") % 5 > 2, segment).alias("segment_nuts3"))
    return mapping.german_location(rows, "id", towns).select("id", *MAPPED)


GERMAN_SQL = f"""WITH {ORDERS}, t AS (SELECT DISTINCT 'town ' || c_custkey AS name, 'DE' || (k % 9 + 1) || printf('%02d', k) AS nuts, 'Region ' || k AS label FROM (SELECT c_custkey, c_nationkey AS k FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, (c_nationkey + 1) % 25 FROM customer WHERE c_custkey % 10 = 0)),
w AS (SELECT id, id % 11 = 0 AS absent, id % 13 = 0 AS marker, id % 4 = 0 AS qualified, 'town ' || CASE WHEN id % 4 = 0 THEN h WHEN id % 3 = 0 THEN c ELSE c - c % 10 END AS name, CASE WHEN id % 5 > 1 THEN 'DE' || (c % 25 % 9 + 1) END AS s1, CASE WHEN id % 5 > 2 THEN 'DE' || (c % 25 % 9 + 1) || printf('%02d', c % 25) END AS s3 FROM o),
x AS (SELECT w.*, t.nuts, t.label, qualified AND starts_with(nuts, 'DE1') AS fits, bool_or(qualified AND starts_with(nuts, 'DE1')) OVER (PARTITION BY id) AS any_fits FROM w JOIN t USING (name) WHERE NOT absent AND NOT marker),
f AS (SELECT id, any_value(any_fits) AS by_state, count(DISTINCT nuts) AS n, min({{'nuts': nuts, 'label': label}}) AS one, count(DISTINCT nuts) FILTER (WHERE nuts = s3) AS nh, min({{'nuts': nuts, 'label': label}}) FILTER (WHERE nuts = s3) AS here, count(DISTINCT nuts) FILTER (WHERE starts_with(nuts, s1)) AS nn, min({{'nuts': nuts, 'label': label}}) FILTER (WHERE starts_with(nuts, s1)) AS near FROM x WHERE fits OR NOT any_fits GROUP BY id),
r AS (SELECT w.id, CASE WHEN absent OR marker THEN NULL WHEN n = 1 THEN one WHEN n > 1 AND nh = 1 THEN here WHEN n > 1 AND nh = 0 AND nn = 1 THEN near END AS region, CASE WHEN absent THEN 'unmapped' WHEN marker THEN 'ambiguous' WHEN n = 1 OR (n > 1 AND (nh = 1 OR (nh = 0 AND nn = 1))) THEN 'mapped' WHEN n > 1 THEN 'ambiguous' ELSE 'unmapped' END AS mapping_status,
CASE WHEN absent THEN 'not_available' WHEN marker THEN 'ba_location_nationwide' WHEN n = 1 AND by_state THEN 'ba_city_qualifier_nuts3' WHEN n = 1 THEN 'ba_city_municipality_nuts3' WHEN n > 1 AND (nh = 1 OR (nh = 0 AND nn = 1)) THEN 'ba_segment_disambiguated' WHEN n > 1 THEN 'ba_city_municipality_ambiguous' ELSE 'not_available' END AS mapping_method FROM w LEFT JOIN f USING (id))
SELECT id, region.nuts AS nuts_code, region.label AS nuts_label, mapping_status, mapping_method FROM r"""


def segment_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What postcodes left unmapped takes the region of the segment that found it."""
    rows = _orders(spark, sf_dir).select("id", F.when(F.col("id") % 11 > 0, _code("p", F.col("h"))).alias("postcode"), F.when(F.col("c") % 4 > 0, F.format_string("XX%03d", F.col("c") % 30)).alias("segment_nuts3"), F.when(F.col("c") % 5 > 0, F.col("c") % 2 * 25).alias("radius"))
    labels = read(spark, sf_dir, "nation").select(_nuts("n_nationkey").alias("nuts_code"), F.col("n_name").alias("nuts_label"))
    first = mapping.postcode_region(rows, "id", _region(spark, sf_dir, "p", 3, 10**9))
    return mapping.segment_provenance(first, labels).select("id", *MAPPED)


SEGMENT_SQL = f"""WITH {ORDERS}, f AS ({FLEMISH_SQL.removeprefix(f"WITH {ORDERS} ")}), j AS (SELECT f.*, n_name, CASE WHEN c % 4 > 0 THEN printf('XX%03d', c % 30) END AS s, coalesce(c % 5 > 0 AND c % 2 = 0, FALSE) AS exact, f.mapping_status = 'unmapped' AND c % 4 > 0 AS taken FROM f JOIN o USING (id) LEFT JOIN nation ON n_nationkey = CASE WHEN c % 4 > 0 THEN c % 30 END)
SELECT id, CASE WHEN taken THEN s ELSE nuts_code END AS nuts_code, CASE WHEN taken THEN n_name ELSE nuts_label END AS nuts_label, CASE WHEN taken THEN CASE WHEN exact THEN 'mapped' ELSE 'low_confidence' END ELSE mapping_status END AS mapping_status, CASE WHEN taken THEN CASE WHEN exact THEN 'ba_segment_provenance_nuts3' ELSE 'ba_segment_radius_nuts3' END ELSE mapping_method END AS mapping_method FROM j"""

QUERIES = {
    "concepts_of_parts": (concepts_of_parts, CONCEPTS_SQL),
    "cascade_of_places": (cascade_of_places, CASCADE_SQL),
    "czech_places": (czech_places, CZECH_SQL),
    "flemish_postcodes": (flemish_postcodes, FLEMISH_SQL),
    "finnish_places": (finnish_places, FINNISH_SQL),
    "french_places": (french_places, FRENCH_SQL),
    "norwegian_places": (norwegian_places, NORWEGIAN_SQL),
    "german_places": (german_places, GERMAN_SQL),
    "segment_regions": (segment_regions, SEGMENT_SQL),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for name, (query, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in QUERIES.items()}
