"""Queries of panels, frontiers, page plans and crosswalk builders, over a reference derived from customers and nations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import zero_padded
from ..operators import crosswalk, frontier, panel
from ..sources.storage import file_state, written
from .adapter import model, read, with_ctes
from .cases import dealt, dealt_sql

NUTS = "printf('DE%03d', 100 + c_nationkey * 7)"


def _nuts(column: str):
    return F.format_string("DE%03d", 100 + F.col(column) * 7)


def _named(column: str):
    return F.concat(F.upper(F.substring(column, 1, 1)), F.lower(F.expr(f"substring({column}, 2)")))


def _towns(spark, sf_dir):
    c = read(spark, sf_dir, "customer")
    shared = F.concat(_named("c_mktsegment"), F.lit(" "), F.col("c_custkey") % 5)
    own = F.concat(F.lit("Town "), F.col("c_nationkey"), F.lit(" "), F.col("c_custkey") % 3)
    return c.select("c_custkey", _nuts("c_nationkey").alias("nuts_code"), F.when(F.col("c_custkey") % 2 == 0, own).otherwise(shared).alias("municipality_name"), F.lpad((F.abs(F.floor("c_acctbal")) % 9000).cast("string"), 5, "0").alias("code"))


def reference(spark, sf_dir):
    """A crosswalk as the German builder writes it."""
    towns, nations = _towns(spark, sf_dir), read(spark, sf_dir, "nation")
    none = F.lit("")
    plz = towns.select(F.lit("plz").alias("source_type"), F.col("code").alias("source_code"), "nuts_code", none.alias("nuts_label"), "municipality_name", none.alias("kreis_name"))
    names = towns.select(F.lit("municipality").alias("source_type"), F.col("c_custkey").cast("string").alias("source_code"), "nuts_code", none.alias("nuts_label"), "municipality_name", none.alias("kreis_name"))
    seats = nations.where("n_nationkey % 2 = 0").select(F.lit("municipality").alias("source_type"), F.concat(F.lit("s"), "n_nationkey").alias("source_code"), _nuts("n_nationkey").alias("nuts_code"), none.alias("nuts_label"), _named("n_name").alias("municipality_name"), none.alias("kreis_name"))
    districts = nations.select(F.lit("kreis").alias("source_type"), F.col("n_nationkey").cast("string").alias("source_code"), _nuts("n_nationkey").alias("nuts_code"), F.concat(_named("n_name"), F.lit(", Landkreis")).alias("nuts_label"), none.alias("municipality_name"), _named("n_name").alias("kreis_name"))
    return plz.unionByName(names).unionByName(seats).unionByName(districts)


TITLE = "upper({0}[1]) || lower({0}[2:])"
CTES = {
    "towns": f"SELECT c_custkey, {NUTS} AS nuts_code, CASE WHEN c_custkey % 2 = 0 THEN 'Town ' || c_nationkey || ' ' || (c_custkey % 3) ELSE upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) || ' ' || (c_custkey % 5) END AS municipality_name, lpad(CAST(abs(CAST(floor(c_acctbal) AS BIGINT)) % 9000 AS VARCHAR), 5, '0') AS code FROM customer",
    "nat": f"SELECT n_nationkey, printf('DE%03d', 100 + n_nationkey * 7) AS nuts_code, {TITLE.format('n_name')} AS name FROM nation",
    "muni": "SELECT DISTINCT nuts_code, municipality_name FROM (SELECT nuts_code, municipality_name FROM towns UNION ALL SELECT nuts_code, name FROM nat WHERE n_nationkey % 2 = 0)",
    "uniq": "SELECT lower(municipality_name) AS folded FROM muni GROUP BY 1 HAVING count(DISTINCT nuts_code) = 1",
    "sole": "SELECT DISTINCT nuts_code, municipality_name, code FROM towns WHERE code IN (SELECT code FROM towns GROUP BY 1 HAVING count(DISTINCT nuts_code) = 1)",
    "sized": "SELECT nuts_code, municipality_name, count(DISTINCT code) AS codes, min(code) AS least FROM sole GROUP BY 1, 2",
    "seats": "SELECT DISTINCT nuts_code, lower(v) AS folded FROM (SELECT nuts_code, name AS v FROM nat UNION ALL SELECT nuts_code, unnest(regexp_split_to_array(name, '[-/ ]')) AS v FROM nat) WHERE v <> '' AND (length(v) > 3 OR v IN (SELECT name FROM nat))",
    "here": "SELECT nuts_code, municipality_name FROM sized UNION SELECT nuts_code, municipality_name FROM muni",
    "tiers": """SELECT h.nuts_code, 'name' AS form, h.municipality_name AS value, 1 AS tier, 0 AS size, h.municipality_name AS name FROM here h JOIN seats s ON s.nuts_code = h.nuts_code AND s.folded = lower(h.municipality_name) WHERE s.folded IN (SELECT folded FROM uniq)
UNION ALL SELECT nuts_code, 'name', municipality_name, 2, -codes, municipality_name FROM sized WHERE lower(municipality_name) IN (SELECT folded FROM uniq)
UNION ALL SELECT nuts_code, 'name', municipality_name, 3, 0, municipality_name FROM muni WHERE lower(municipality_name) IN (SELECT folded FROM uniq)
UNION ALL SELECT s.nuts_code, 'plz', s.code, 4, -z.codes, s.municipality_name FROM sole s JOIN sized z ON z.nuts_code = s.nuts_code AND z.municipality_name = s.municipality_name
UNION ALL SELECT h.nuts_code, 'name', h.municipality_name, 5, 0, h.municipality_name FROM here h JOIN seats s ON s.nuts_code = h.nuts_code AND s.folded = lower(h.municipality_name)""",
    "cands": "SELECT nuts_code, row_number() OVER (PARTITION BY nuts_code ORDER BY tier, size, name, value) AS rank, form, value FROM (SELECT *, row_number() OVER (PARTITION BY nuts_code, form, value ORDER BY tier, size, name) AS nth FROM tiers) WHERE nth = 1 AND nuts_code IN (SELECT nuts_code FROM nat) QUALIFY rank <= 5",
    "frontier0": "SELECT '' AS key, 0 AS level, NULL AS nuts_code, NULL AS nuts1, 'pending' AS status UNION ALL SELECT 'wo=' || replace(r_name, ' ', '%20') || '&umkreis=0', 1, NULL, 'DE' || r_regionkey, CASE WHEN r_name IN (SELECT municipality_name FROM muni) THEN 'subdivided' ELSE 'pending' END FROM region UNION ALL SELECT 'wo=' || replace(municipality_name, ' ', '%20') || '&umkreis=0', 2, min(nuts_code), left(min(nuts_code), 3), 'pending' FROM muni GROUP BY municipality_name HAVING count(DISTINCT nuts_code) = 1 UNION ALL SELECT * FROM (SELECT 'wo=' || code || '&umkreis=0' AS key, 2, min(nuts_code), min(left(nuts_code, 3)), 'pending' FROM towns WHERE municipality_name IN (SELECT municipality_name FROM muni GROUP BY 1 HAVING count(DISTINCT nuts_code) > 1) AND code IN (SELECT code FROM sole) GROUP BY code)",
}


def sql(query: str) -> str:
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in CTES.items()) + "\n" + query


_candidates: dict[tuple, DataFrame] = {}


def panel_candidates(spark, sf_dir):
    """Written once for each state of the tables: panels, hashes and evidence all start from them."""
    key = (spark.sparkContext.applicationId, sf_dir, *(file_state(spark, f"{sf_dir}/{t}.parquet") for t in ("customer", "nation")))
    if key not in _candidates:
        _candidates[key] = written(panel.panel_candidates(reference(spark, sf_dir)), "candidates")
    return _candidates[key]


def rule_panel(spark, sf_dir):
    ref = reference(spark, sf_dir)
    return panel.rule_panel(panel_candidates(spark, sf_dir), ref.where("source_type = 'kreis'").select("nuts_code", "nuts_label", "kreis_name"))


def panel_hash(spark, sf_dir):
    return panel.panel_hash(rule_panel(spark, sf_dir))


def region_anchors(spark, sf_dir):
    return panel.anchors(reference(spark, sf_dir))


def _evidence(spark, sf_dir):
    """Side files of two sweeps: each candidate was seen, some resolved elsewhere."""
    found = panel_candidates(spark, sf_dir).withColumn("query", F.concat(F.lit("wo="), "value", F.lit("&umkreis=0")))
    place = F.when(F.col("rank") == 1, F.lit("elsewhere")).otherwise(F.concat("value", F.lit(", Kreis")))
    seen = F.struct("query", (F.length("value") % 4).cast("long").alias("advertised"), place.alias("resolved_place"), F.lit("EXAKT").alias("search_mode"))
    first = found.groupBy().agg(F.map_from_entries(F.collect_list(F.struct(F.concat("nuts_code", F.lit("/"), "rank"), seen))).alias("regions")).select(F.lit("2").alias("sweep_id"), "regions")
    old = found.groupBy().agg(F.map_from_entries(F.collect_list(F.struct(F.concat("nuts_code", F.lit("/"), "rank"), F.struct("query", F.lit(99).cast("long").alias("advertised"), F.lit("old").alias("resolved_place"), F.lit("UNGUELTIG").alias("search_mode"))))).alias("regions")).select(F.lit("1").alias("sweep_id"), "regions")
    return panel.evidence_index(first.unionByName(old))


def evidence_index(spark, sf_dir):
    return _evidence(spark, sf_dir)


def pinned_panel(spark, sf_dir):
    return panel.pinned_panel(panel_candidates(spark, sf_dir), _evidence(spark, sf_dir))


def frame_mismatches(spark, sf_dir):
    """A panel with one region twice, one unknown and one left out."""
    districts = reference(spark, sf_dir).where("source_type = 'kreis'").select("nuts_code")
    codes = districts.where("nuts_code <> 'DE100'").union(districts.where("nuts_code = 'DE107'")).union(districts.where("nuts_code = 'DE107'").select(F.lit("DE999")))
    return panel.frame_mismatches(codes, districts)


def query_forms(spark, sf_dir):
    n = read(spark, sf_dir, "nation")
    town = F.when(F.col("n_nationkey") % 3 > 0, _named("n_name"))
    forms = panel.query_forms(_named("n_name"), F.concat(_named("n_name"), F.lit(", Landkreis")), F.lit("01001"), F.lit("01002"), town)
    return n.select("n_nationkey", *(c.alias(k) for k, c in forms.items()))


def stratified_sample(spark, sf_dir):
    """Two members of each nation on average, the middle ones first."""
    s = read(spark, sf_dir, "customer").select("c_nationkey", "c_custkey")
    return panel.stratified(s, "c_nationkey", [F.asc("c_custkey")], 50)


def _states(spark, sf_dir):
    return read(spark, sf_dir, "region").select(F.col("r_name").alias("name"), F.concat(F.lit("DE"), "r_regionkey").alias("nuts1"))


def _unambiguous(spark, sf_dir):
    """The reference with postcodes that lie in one region only, as the frontier's provenance wants them."""
    ref = reference(spark, sf_dir)
    sole = ref.where("source_type = 'plz'").groupBy("source_code").agg(F.countDistinct("nuts_code").alias("n")).where("n = 1").select("source_code")
    return ref.where("source_type <> 'plz'").unionByName(ref.where("source_type = 'plz'").join(sole, "source_code", "left_semi"))


def initial_frontier(spark, sf_dir):
    return panel.initial_frontier(_unambiguous(spark, sf_dir), _states(spark, sf_dir)).select("key", "level", "nuts_code", "nuts1", "status")


def _worked(spark, sf_dir):
    """The first frontier with some segments truncated, failed and complete, and postcode segments of one region."""
    first = panel.initial_frontier(_unambiguous(spark, sf_dir), _states(spark, sf_dir))
    n = F.length("key")
    status = F.when(F.col("status") == "subdivided", "subdivided").when((F.col("level") == 0) | (n % 4 == 0), "truncated").when(n % 4 == 1, "failed").when(n % 4 == 2, "complete").otherwise("pending")
    third = read(spark, sf_dir, "nation").where("n_nationkey < 3").select(F.concat(F.lit("wo=0000"), "n_nationkey", F.lit("&umkreis=0")).alias("key"), F.lit(3).alias("level"), _nuts("n_nationkey").alias("nuts_code"), F.lit("DE1").alias("nuts1"), F.lit("p").alias("parent"), F.lit("truncated").alias("status"), F.lit(None).cast("int").alias("recency_days"))
    return first.withColumn("status", status).unionByName(third)


WORKED = "(SELECT key, level, nuts_code, nuts1, CASE WHEN status = 'subdivided' THEN status WHEN level = 0 OR length(key) % 4 = 0 THEN 'truncated' WHEN length(key) % 4 = 1 THEN 'failed' WHEN length(key) % 4 = 2 THEN 'complete' ELSE 'pending' END AS status FROM frontier0 UNION ALL SELECT 'wo=0000' || n_nationkey || '&umkreis=0', 3, nuts_code, 'DE1', 'truncated' FROM nat WHERE n_nationkey < 3)"


def frontier_order(spark, sf_dir):
    return panel.frontier_order(_worked(spark, sf_dir)).select("key", "level", "place")


def frontier_subdivision(spark, sf_dir):
    codes = _unambiguous(spark, sf_dir).where("source_type = 'plz'").select("source_code", "nuts_code")
    return panel.subdivide(_worked(spark, sf_dir), _states(spark, sf_dir), codes).select("key", "level", "nuts_code", "nuts1", "status")


def frontier_to_its_end(spark, sf_dir):
    """The first frontier asked until nothing waits; what a query holds is told by the customer that its key's hash points to, and some fail once or always."""
    customers = read(spark, sf_dir, "customer")
    n = customers.count()
    held = customers.select(F.col("c_custkey").alias("slot"), (F.abs(F.floor("c_acctbal")) * 2 + 1).cast("long").alias("items"))

    def ask(due, number):
        slots = due.select("key", "level", (F.conv(F.substring(F.md5("key"), 1, 6), 16, 10).cast("long") % n).alias("slot"))
        fails = (F.col("level") > 1) & ((F.col("slot") % 29 == 0) | ((F.col("slot") % 7 == 0) & (F.lit(number) == 1)))
        return slots.join(held, "slot", "left").select("key", F.coalesce("items", F.lit(1)).alias("items"), fails.alias("failed")).distinct()

    codes = _unambiguous(spark, sf_dir).where("source_type = 'plz'").select("source_code", "nuts_code")
    first = panel.initial_frontier(_unambiguous(spark, sf_dir), _states(spark, sf_dir))
    return frontier.run_to_end(first, ask, _states(spark, sf_dir), codes).select("key", "level", "nuts_code", "nuts1", "status", "rows_yielded", "truncated", "round")


#: The same by recursion: a segment is asked in the round after its parent's, or one later if it fails in the first.
TO_ITS_END = """WITH RECURSIVE {ctes},
size AS (SELECT count(*) AS n FROM customer),
asked(key, level, nuts_code, nuts1, status, since) AS (
  SELECT key, level, nuts_code, nuts1, status, 1 FROM frontier0
  UNION
  SELECT child.key, child.level, child.nuts_code, child.nuts1, 'pending', child.since FROM (
    SELECT 'wo=' || s.code || '&umkreis=0' AS key, 3 AS level, a.nuts_code, a.nuts1, a.done + 1 AS since FROM ({told}) a JOIN sole s ON s.nuts_code = a.nuts_code WHERE a.level = 2 AND a.cut
    UNION ALL
    SELECT a.key || '&veroeffentlichtseit=' || d, 4, a.nuts_code, a.nuts1, a.done + 1 FROM ({told}) a, (SELECT unnest([1, 7, 30]) AS d) WHERE a.level = 3 AND a.cut) child),
first AS (SELECT key, level, min(nuts_code) AS nuts_code, min(nuts1) AS nuts1, min(status) AS status, min(since) AS since FROM asked GROUP BY key, level)
SELECT key, level, nuts_code, nuts1, CASE WHEN status = 'subdivided' THEN status WHEN failing THEN 'failed' WHEN level = 1 OR cut THEN 'subdivided' ELSE 'complete' END AS status,
CASE WHEN status = 'subdivided' THEN NULL WHEN failing OR level = 1 THEN 0 ELSE least(items, 10000) END AS rows_yielded, status <> 'subdivided' AND cut AS truncated, CASE WHEN status <> 'subdivided' AND NOT failing THEN done END AS round FROM ({last})"""
TOLD = """SELECT b.*, level > 1 AND slot % 29 = 0 AS failing, items >= 10000 AND status = 'pending' AND NOT (level > 1 AND slot % 29 = 0) AS cut, CAST(since + CASE WHEN level > 1 AND slot % 7 = 0 AND since = 1 THEN 1 ELSE 0 END AS INTEGER) AS done
FROM (SELECT s.*, coalesce(CAST(abs(CAST(floor(c.c_acctbal) AS BIGINT)) * 2 + 1 AS BIGINT), 1) AS items FROM (SELECT f.*, CAST('0x' || substr(md5(key), 1, 6) AS BIGINT) % n AS slot FROM {source} f, size) s LEFT JOIN customer c ON c.c_custkey = s.slot) b"""


def to_its_end_sql() -> str:
    ctes = ",\n".join(f"{k} AS ({v})" for k, v in CTES.items())
    return TO_ITS_END.format(ctes=ctes, told=TOLD.format(source="asked"), last=TOLD.format(source="first"))


def stock_lower_bound(spark, sf_dir):
    return panel.stock_lower_bound(_worked(spark, sf_dir).withColumn("rows_yielded", F.length("key").cast("long")))


def segment_states(spark, sf_dir):
    """Suppliers as segments, months as pages, lines as items; pages of one priority fail."""
    li = read(spark, sf_dir, "lineitem")
    pages = li.groupBy(F.col("l_suppkey").alias("segment"), F.month("l_shipdate").alias("page")).agg(F.count(F.lit(1)).alias("items"), F.when(F.min("l_orderkey") % 50 == 0, 500).otherwise(200).alias("status"))
    return panel.segment_states(pages, 50, 12)


PLANS = [(100, 4, 4, "4|false|4"), (101, 4, 4, "4|true|4"), (30, 1, 4, "2|false|1"), (0, 1, 4, "1|false|1"), (None, 0, 4, "1|false|1"), (5000, 0, 4, "4|true|4"), (26, 2, 4, "2|false|2")]


def page_plan(spark, sf_dir):
    rows = read(spark, sf_dir, "customer").select("c_custkey", dealt("c_custkey", [p[0] for p in PLANS], "long").alias("advertised"), dealt("c_custkey", [p[1] for p in PLANS], "long").alias("pages_done"))
    found = panel.page_plan(rows, 4)
    return found.select("c_custkey", F.concat_ws("|", "planned_pages", F.col("capped").cast("string"), "expected_pages").alias("found"))


TOTALS = [(120, 1, None, 118, 3, "3|120"), (120, 1, 2, 99, 2, "2|99"), (120, 1, 9, 119, 3, "3|119"), (None, 1, None, 50, 2, "2|50"), (120, 3, None, 70, 5, "5|70"), (0, 1, None, 0, 1, "0|0")]


def planned_totals(spark, sf_dir):
    parts = [dealt("c_custkey", [t[i] for t in TOTALS], "long") for i in range(5)]
    found = panel.planned_totals(parts[0], parts[1], 50, parts[2], parts[3], parts[4])
    return read(spark, sf_dir, "customer").select("c_custkey", F.concat_ws("|", *found.values()).alias("found"))


def status_tally(spark, sf_dir):
    return panel.tally(model(spark, sf_dir).observations, "region_mapping_status")


def scope_states(spark, sf_dir):
    return panel.scope_states(model(spark, sf_dir).manifests)


def sweep_spacing(spark, sf_dir):
    return panel.spacing_allowed(panel.scope_states(model(spark, sf_dir).manifests), F.lit("2024-01-31 12:00:00").cast("timestamp_ntz"), 24)


def panel_coverage_text(spark, sf_dir):
    counts = read(spark, sf_dir, "nation").agg(F.count(F.lit(1)).alias("regions"), F.count_if(F.col("n_regionkey") > 0).alias("with_rows"), F.count_if(F.col("n_regionkey") == 1).alias("capped"), F.count_if(F.col("n_regionkey") == 2).alias("short"), F.lit(4).alias("cap"))
    return panel.coverage_text(counts).select("coverage_limitations")


def code_chain(spark, sf_dir):
    """Customers as towns, nations as districts, regions as regions; one region is unknown."""
    c, n, r = (read(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    found, _ = crosswalk.code_chain(c.select(F.col("c_custkey").cast("string").alias("code"), F.col("c_nationkey").cast("string").alias("district")), n.select(F.col("n_nationkey").cast("string").alias("code"), F.col("n_regionkey").cast("string").alias("region")), r.where("r_regionkey <> 2").select(F.col("r_regionkey").cast("string").alias("code"), F.col("r_name").alias("nuts_code")))
    return found


def code_chain_skipped(spark, sf_dir):
    c, n, r = (read(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    return crosswalk.code_chain(c.select(F.col("c_custkey").cast("string").alias("code"), F.col("c_nationkey").cast("string").alias("district")), n.select(F.col("n_nationkey").cast("string").alias("code"), F.col("n_regionkey").cast("string").alias("region")), r.where("r_regionkey <> 2").select(F.col("r_regionkey").cast("string").alias("code"), F.col("r_name").alias("nuts_code")))[1]


def folded_name_join(spark, sf_dir):
    """Nations shouted on one side and in small letters with a bracket on the other."""
    n = read(spark, sf_dir, "nation")
    return crosswalk.by_folded_name(n.select(F.col("n_nationkey").alias("code"), F.upper("n_name").alias("name")), n.where("n_nationkey < 20").select(F.concat(F.lit("N"), "n_nationkey").alias("nuts_code"), F.concat(F.lower("n_name"), F.lit(" (land)")).alias("name")))


def three_way_crosswalk(spark, sf_dir):
    c, n = read(spark, sf_dir, "customer"), read(spark, sf_dir, "nation")
    key = F.concat(F.lpad(F.col("c_nationkey").cast("string"), 5, "0"), F.lpad((F.col("c_custkey") % 7).cast("string"), 3, "0"))
    towns = c.select(key.alias("key"), F.concat(F.lit("t"), key).alias("name")).distinct()
    codes = c.select(zero_padded(F.col("c_custkey").cast("string"), 5).alias("postcode"), key.alias("key"))
    return crosswalk.three_way(towns, codes, n.where("n_nationkey <> 4").select(F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("district"), _nuts("n_nationkey").alias("nuts_code"), F.col("n_name").alias("name")))


def crosswalk_manifest(spark, sf_dir):
    return crosswalk.crosswalk_manifest(reference(spark, sf_dir))


def deviation_report(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    return crosswalk.deviations(o.select("o_orderkey", F.col("o_orderstatus").alias("v")), o.select("o_orderkey", F.when(F.col("o_custkey") % 7 == 0, "X").otherwise(F.col("o_orderstatus")).alias("v")), "o_orderkey", "v")


def country_labels(spark, sf_dir):
    labels = reference(spark, sf_dir).where("source_type = 'kreis'").select("nuts_code", "nuts_label")
    return crosswalk.labels_of_country(labels.union(labels.select(F.substring("nuts_code", 1, 4), "nuts_label")), "DE")


def correspondence_pairs(spark, sf_dir):
    c = read(spark, sf_dir, "customer")
    pairs = F.collect_list(F.struct(F.col("c_custkey").cast("string").alias("source"), _nuts("c_nationkey").alias("target")))
    lists = c.groupBy((F.col("c_nationkey") % 3).alias("level")).agg(pairs.alias("pairs"))
    return crosswalk.correspondences(lists, 1)


CHAIN = "SELECT 'district' AS source_type, CAST(n_nationkey AS VARCHAR) AS code, n_regionkey AS region FROM nation UNION ALL SELECT 'town', CAST(c_custkey AS VARCHAR), n_regionkey FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey"
EV = "(SELECT 'wo=' || value || '&umkreis=0' AS query, length(value) % 4 AS advertised, CASE WHEN rank = 1 THEN 'elsewhere' ELSE value || ', Kreis' END AS resolved_place, nuts_code, rank FROM cands)"
QUERIES = {
    "panel_candidates": (panel_candidates, sql("SELECT * FROM cands")),
    "rule_panel": (rule_panel, sql("SELECT c.nuts_code, n.name || ', Landkreis' AS nuts_label, n.name AS kreis_name, form, value, 'wo=' || value || '&umkreis=0' AS query FROM cands c JOIN nat n ON n.nuts_code = c.nuts_code WHERE rank = 1")),
    "panel_hash": (panel_hash, sql("SELECT sha256(string_agg(nuts_code || chr(9) || form || chr(9) || value, chr(10) ORDER BY nuts_code)) AS membership_hash, count(*) AS frame_size FROM cands WHERE rank = 1")),
    "region_anchors": (region_anchors, sql("SELECT nuts_code, CASE WHEN town IS NOT NULL THEN 'name' ELSE 'plz' END AS form, coalesce(town, anchor) AS value, anchor FROM (SELECT t.nuts_code, arg_min(t.municipality_name, (-t.codes, t.municipality_name)) FILTER (WHERE lower(t.municipality_name) IN (SELECT folded FROM uniq)) AS town, (SELECT arg_min(z.least, (-z.codes, z.municipality_name)) FROM sized z WHERE z.nuts_code = t.nuts_code) AS anchor FROM (SELECT nuts_code, municipality_name, count(DISTINCT code) AS codes FROM towns GROUP BY 1, 2) t GROUP BY 1) WHERE coalesce(town, anchor) IS NOT NULL")),
    "evidence_index": (evidence_index, sql(f"SELECT query, max(advertised) AS advertised, max(resolved_place) AS resolved_place, 'EXAKT' AS search_mode, 'sweep:2' AS source FROM {EV} GROUP BY 1")),
    "pinned_panel": (pinned_panel, sql(f"SELECT nuts_code, form, value, rank - 1 AS candidate_rank, good AS resolved FROM (SELECT c.*, coalesce(e.advertised > 0 AND e.resolved_place <> 'elsewhere', FALSE) AS good, row_number() OVER (PARTITION BY c.nuts_code ORDER BY coalesce(e.advertised > 0 AND e.resolved_place <> 'elsewhere', FALSE) DESC, c.rank) AS nth FROM cands c LEFT JOIN (SELECT query, max(advertised) AS advertised, max(resolved_place) AS resolved_place FROM {EV} GROUP BY 1) e ON e.query = 'wo=' || c.value || '&umkreis=0') WHERE nth = 1")),
    "frame_mismatches": (frame_mismatches, "SELECT * FROM (VALUES ('DE100', 'missing'), ('DE107', 'repeated'), ('DE999', 'not in the frame')) t(nuts_code, problem)"),
    "query_forms": (query_forms, sql("SELECT n_nationkey, 'wo=' || name AS plain, 'wo=' || name || '&umkreis=0' AS plain0, 'wo=' || name || ', Landkreis&umkreis=0' AS label, 'wo=Landkreis ' || name || '&umkreis=0' AS lk, 'wo=01001&umkreis=0' AS plz0, 'wo=01002&umkreis=0' AS anchor, 'wo=01002&umkreis=25' AS anchor25, CASE WHEN n_nationkey % 3 > 0 THEN 'wo=' || name || '&umkreis=0' END AS town FROM nat")),
    "stratified_sample": (stratified_sample, "SELECT c_nationkey, c_custkey FROM (SELECT *, row_number() OVER (ORDER BY turn, n DESC, c_nationkey) AS nth FROM (SELECT *, (nth0 - n // 2 + n) % n AS turn FROM (SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS nth0, count(*) OVER (PARTITION BY c_nationkey) AS n FROM customer))) WHERE turn = 0 OR nth <= 50"),
    "initial_frontier": (initial_frontier, sql("SELECT * FROM frontier0")),
    "frontier_order": (frontier_order, sql(f"SELECT key, level, row_number() OVER (ORDER BY CASE level WHEN 2 THEN 0 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE level END, coalesce(nuts_code, ''), key) AS place FROM {WORKED} WHERE status IN ('pending', 'failed')")),
    "frontier_subdivision": (frontier_subdivision, sql(f"SELECT key, level, nuts_code, nuts1, CASE WHEN status = 'truncated' THEN 'subdivided' ELSE status END AS status FROM {WORKED} UNION ALL SELECT DISTINCT 'wo=' || s.code || '&umkreis=0', 3, w.nuts_code, w.nuts1, 'pending' FROM {WORKED} w JOIN sole s ON s.nuts_code = w.nuts_code WHERE w.level = 2 AND w.status = 'truncated' AND 'wo=' || s.code || '&umkreis=0' NOT IN (SELECT key FROM {WORKED} WHERE level = 3) UNION ALL SELECT key || '&veroeffentlichtseit=' || d, 4, nuts_code, nuts1, 'pending' FROM {WORKED} CROSS JOIN (SELECT unnest([1, 7, 30]) AS d) WHERE level = 3 AND status = 'truncated'")),
    "frontier_to_its_end": (frontier_to_its_end, to_its_end_sql()),
    "stock_lower_bound": (stock_lower_bound, sql(f"SELECT CAST(coalesce(sum(length(key)) FILTER (WHERE status = 'complete'), 0) AS BIGINT) AS measured_stock FROM {WORKED}")),
    "segment_states": (segment_states, "SELECT l_suppkey AS segment, CASE WHEN bool_or(bad) THEN 'failed' WHEN max(page) >= 12 AND arg_max(items, page) >= 50 THEN 'truncated' ELSE 'complete' END AS status, CAST(sum(items) AS BIGINT) AS rows_yielded, arg_max(items, page) >= 50 AS last_page_full FROM (SELECT l_suppkey, month(l_shipdate) AS page, count(*) AS items, min(l_orderkey) % 50 = 0 AS bad FROM lineitem GROUP BY 1, 2) GROUP BY 1"),
    "page_plan": (page_plan, f"SELECT c_custkey, {dealt_sql('c_custkey', [p[-1] for p in PLANS])} AS found FROM customer"),
    "planned_totals": (planned_totals, f"SELECT c_custkey, {dealt_sql('c_custkey', [t[-1] for t in TOTALS])} AS found FROM customer"),
    "status_tally": (status_tally, with_ctes("SELECT region_mapping_status, count(*) AS n, count(*) / (SELECT count(*) FROM observed) AS share FROM observed GROUP BY 1")),
    "scope_states": (scope_states, with_ctes("SELECT source, scope_id, count(*) AS sweeps, max(started_at) AS newest_started, arg_max(freshness_threshold_hours, started_at) AS threshold FROM manifests GROUP BY 1, 2")),
    "sweep_spacing": (sweep_spacing, with_ctes("SELECT source, date_diff('second', max(started_at), TIMESTAMP '2024-01-31 12:00:00') / 3600.0 AS age_hours, date_diff('second', max(started_at), TIMESTAMP '2024-01-31 12:00:00') / 3600.0 >= 24 AS allowed FROM manifests GROUP BY 1")),
    "panel_coverage_text": (panel_coverage_text, "SELECT printf('Stratified region-bounded sample, not a census: %d of %d regions gave rows; %d were cut at %d pages, %d ended early.', count(*) FILTER (WHERE n_regionkey > 0), count(*), count(*) FILTER (WHERE n_regionkey = 1), 4, count(*) FILTER (WHERE n_regionkey = 2)) AS coverage_limitations FROM nation"),
    "code_chain": (code_chain, f"SELECT source_type, code, r_name AS nuts_code FROM ({CHAIN}) JOIN region ON r_regionkey = region WHERE r_regionkey <> 2"),
    "code_chain_skipped": (code_chain_skipped, f"SELECT source_type, count(*) FILTER (WHERE region IS NULL OR region = 2) AS skipped FROM ({CHAIN}) GROUP BY 1"),
    "folded_name_join": (folded_name_join, "SELECT replace(lower(n_name), '_', ' ') AS folded, n_nationkey AS code, upper(n_name) AS name, 'N' || n_nationkey AS nuts_code FROM nation WHERE n_nationkey < 20"),
    "three_way_crosswalk": (three_way_crosswalk, "WITH k AS (SELECT *, printf('%05d', c_nationkey) || printf('%03d', c_custkey % 7) AS key FROM customer WHERE c_nationkey <> 4) SELECT DISTINCT 'municipality' AS source_type, key AS source_code, printf('DE%03d', 100 + c_nationkey * 7) AS nuts_code, 't' || key AS municipality_name, n_name AS kreis_name FROM k JOIN nation ON n_nationkey = c_nationkey UNION ALL SELECT DISTINCT 'plz', printf('%05d', c_custkey), printf('DE%03d', 100 + c_nationkey * 7), 't' || key, n_name FROM k JOIN nation ON n_nationkey = c_nationkey UNION ALL SELECT 'kreis', printf('%05d', n_nationkey), printf('DE%03d', 100 + n_nationkey * 7), '', n_name FROM nation WHERE n_nationkey <> 4"),
    "crosswalk_manifest": (crosswalk_manifest, sql("SELECT source_type, CAST(count(*) AS BIGINT) AS rows, count(DISTINCT code) AS codes, count(DISTINCT nuts_code) AS regions, CASE source_type WHEN 'plz' THEN (SELECT count(*) FROM (SELECT code FROM towns GROUP BY 1 HAVING count(DISTINCT nuts_code) > 1)) ELSE 0 END AS ambiguous_codes FROM (SELECT 'plz' AS source_type, code, nuts_code FROM towns UNION ALL SELECT 'municipality', CAST(c_custkey AS VARCHAR), nuts_code FROM towns UNION ALL SELECT 'municipality', 's' || n_nationkey, nuts_code FROM nat WHERE n_nationkey % 2 = 0 UNION ALL SELECT 'kreis', CAST(n_nationkey AS VARCHAR), nuts_code FROM nat) GROUP BY 1")),
    "deviation_report": (deviation_report, "SELECT o_orderkey, o_orderstatus AS left_value, 'X' AS right_value FROM orders WHERE o_custkey % 7 = 0 ORDER BY 1 LIMIT 20"),
    "country_labels": (country_labels, sql("SELECT nuts_code, name || ', Landkreis' AS nuts_label FROM nat")),
    "correspondence_pairs": (correspondence_pairs, f"SELECT CAST(c_custkey AS VARCHAR) AS code, {NUTS} AS nuts_code FROM customer WHERE c_nationkey % 3 = 1"),
}


def queries() -> dict:
    return {name: query for name, (query, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for name, (_, text) in QUERIES.items()}
