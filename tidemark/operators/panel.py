"""Deterministic choices: panel candidates, interleaving, spread and stratified samples, frontiers and page plans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import locality_holds, membership_hash, place_query, seat_labels
from ..functions.windows import top_n
from ..sources.storage import numbered
from .mapping import first_of

PER_PAGE = 25


def unique_places(places: DataFrame, column: str, region: str = "region") -> DataFrame:
    """Values that identify exactly one region."""
    return places.groupBy(column).agg(F.countDistinct(region).alias("n"), F.min(region).alias("region")).where("n = 1").drop("n")


def _slices(reference: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Districts, towns with their unambiguous postcodes, municipality names, and names that lie in one region.

    ``reference`` is (source_type: plz, municipality or kreis, source_code, nuts_code, nuts_label, municipality_name, kreis_name).
    """
    districts = reference.where("source_type = 'kreis'").select("nuts_code", "nuts_label", "kreis_name")
    postcodes = reference.where("source_type = 'plz' AND source_code <> ''").select("nuts_code", "municipality_name", "source_code").distinct()
    sole = postcodes.groupBy("source_code").agg(F.countDistinct("nuts_code").alias("n")).where("n = 1").select("source_code")
    names = reference.where("source_type = 'municipality' AND municipality_name <> ''").select("nuts_code", "municipality_name").distinct()
    unique = names.groupBy(F.lower("municipality_name").alias("folded")).agg(F.countDistinct("nuts_code").alias("n")).where("n = 1").select("folded")
    return districts, postcodes.join(sole, "source_code"), names, unique


def panel_candidates(reference: DataFrame, n: int = 5) -> DataFrame:
    """(nuts_code, rank, form, value): the places by which a region may be asked for.

    First its seat town, if its name lies in one region only; then its towns
    with such names, those with most postcodes first; then its unambiguous
    postcodes by the same order; last the seat's name even if it is shared.
    """
    districts, postcodes, names, unique = _slices(reference)
    towns = postcodes.groupBy("nuts_code", "municipality_name").agg(F.countDistinct("source_code").alias("codes"))
    here = towns.select("nuts_code", "municipality_name").union(names).distinct().withColumn("folded", F.lower("municipality_name"))
    seats = districts.select("nuts_code", F.explode(seat_labels(F.col("kreis_name"), F.col("nuts_label"))).alias("folded"))
    seat_towns = here.join(seats, ["nuts_code", "folded"])

    def tier(number: int, rows: DataFrame, form: str, value: str, order: Column) -> DataFrame:
        return rows.select("nuts_code", F.lit(form).alias("form"), F.col(value).alias("value"), F.struct(F.lit(number).alias("tier"), order.cast("long").alias("size"), F.col("municipality_name").alias("name"), F.col(value).alias("value")).alias("order"))

    folded = F.lower("municipality_name")
    tiers = [
        tier(1, seat_towns.join(unique, "folded"), "name", "municipality_name", F.lit(0)),
        tier(2, towns.withColumn("folded", folded).join(unique, "folded"), "name", "municipality_name", -F.col("codes")),
        tier(3, names.withColumn("folded", folded).join(unique, "folded"), "name", "municipality_name", F.lit(0)),
        tier(4, postcodes.join(towns, ["nuts_code", "municipality_name"]), "plz", "source_code", -F.col("codes")),
        tier(5, seat_towns, "name", "municipality_name", F.lit(0)),
    ]
    once = reduce(DataFrame.unionByName, tiers).groupBy("nuts_code", "form", "value").agg(F.min("order").alias("order")).join(districts.select("nuts_code"), "nuts_code", "left_semi")
    return top_n(once, ["nuts_code"], [F.asc("order")], n, "rank").select("nuts_code", F.col("rank").cast("long").alias("rank"), "form", "value")


def rule_panel(candidates: DataFrame, districts: DataFrame) -> DataFrame:
    """The panel by rule: the first candidate of every region, with its query."""
    first = candidates.where("rank = 1").join(districts, "nuts_code")
    return first.select("nuts_code", "nuts_label", "kreis_name", "form", "value", F.concat(F.lit("wo="), "value", F.lit("&umkreis=0")).alias("query"))


def panel_hash(panel: DataFrame) -> DataFrame:
    """One row: the membership hash over the panel's lines in the order of regions, and its size."""
    line = F.concat_ws("\t", "nuts_code", "form", "value")
    return panel.agg(membership_hash(line, F.col("nuts_code")).alias("membership_hash"), F.count(F.lit(1)).alias("frame_size"))


def evidence_index(sweeps: DataFrame) -> DataFrame:
    """Per query what the newest sweep (by sweep_id) saw: advertised, resolved_place, search_mode, source.

    ``sweeps`` has sweep_id and a map of regions to struct(query, advertised, resolved_place, search_mode).
    """
    seen = sweeps.select("sweep_id", F.explode(F.map_values("regions")).alias("r")).where("r.query <> ''")
    last = seen.groupBy(F.col("r.query").alias("query")).agg(F.max_by(F.struct(F.col("r.advertised").alias("advertised"), F.col("r.resolved_place").alias("resolved_place"), F.col("r.search_mode").alias("search_mode"), F.concat(F.lit("sweep:"), "sweep_id").alias("source")), "sweep_id").alias("e"))
    return last.select("query", "e.*")


def pinned_panel(candidates: DataFrame, evidence: DataFrame) -> DataFrame:
    """(nuts_code, form, value, candidate_rank, resolved): of each region the first candidate that the source resolved to itself with hits, else its first one."""
    asked = candidates.withColumn("query", F.concat(F.lit("wo="), "value", F.lit("&umkreis=0"))).join(evidence, "query", "left")
    good = F.coalesce(F.col("advertised") > 0, F.lit(False)) & locality_holds(F.col("value"), F.col("resolved_place"), F.col("search_mode"))
    pick = F.struct("form", "value", (F.col("rank") - 1).alias("candidate_rank"))
    chosen = asked.groupBy("nuts_code").agg(F.min_by(pick, F.when(good, F.col("rank"))).alias("best"), F.min_by(pick, "rank").alias("first"), F.bool_or(good).alias("resolved"))
    return chosen.select("nuts_code", F.when(F.col("resolved"), F.col("best")).otherwise(F.col("first")).alias("p"), "resolved").select("nuts_code", "p.*", "resolved")


def frame_mismatches(panel: DataFrame, districts: DataFrame) -> DataFrame:
    """(nuts_code, problem): regions that a pinned panel names twice, lacks, or that the frame lacks."""
    counted = panel.groupBy("nuts_code").agg(F.count(F.lit(1)).alias("n"))
    both = counted.join(districts.select("nuts_code", F.lit(1).alias("known")), "nuts_code", "full")
    problem = F.when(F.col("known").isNull(), "not in the frame").when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "repeated")
    return both.select("nuts_code", problem.alias("problem")).where("problem IS NOT NULL")


def anchors(reference: DataFrame) -> DataFrame:
    """(nuts_code, form, value, anchor): each region's town with most postcodes and a name of its own, else its anchor: the least postcode of its largest town."""
    _, sole, _, unique = _slices(reference)
    every = reference.where("source_type = 'plz'").groupBy("nuts_code", "municipality_name").agg(F.countDistinct("source_code").alias("codes")).withColumn("folded", F.lower("municipality_name")).join(unique.withColumn("unique", F.lit(True)), "folded", "left")
    size = F.struct((-F.col("codes")).alias("size"), F.col("municipality_name").alias("name"))
    town = every.groupBy("nuts_code").agg(F.min(F.when(F.col("unique"), size))["name"].alias("town"))
    largest = sole.groupBy("nuts_code", "municipality_name").agg(F.countDistinct("source_code").alias("codes"), F.min("source_code").alias("least"))
    anchor = largest.groupBy("nuts_code").agg(F.min(F.struct((-F.col("codes")).alias("size"), F.col("municipality_name").alias("name"), "least"))["least"].alias("anchor"))
    told = town.join(anchor, "nuts_code", "left")
    named = F.col("town").isNotNull()
    return told.select("nuts_code", F.when(named, "name").otherwise("plz").alias("form"), F.coalesce("town", "anchor").alias("value"), "anchor").where("value IS NOT NULL")


def query_forms(district: Column, label: Column, least: Column, anchor: Column, town: Column) -> dict[str, Column]:
    """Every form in which a region may be asked for; null where a part is missing."""
    asked = lambda place, radius=None: F.concat(F.lit("wo="), place, F.lit("" if radius is None else f"&umkreis={radius}"))
    return {
        "plain": asked(district),
        "plain0": asked(district, 0),
        "label": asked(label, 0),
        "lk": asked(F.concat(F.lit("Landkreis "), district), 0),
        "plz0": asked(least, 0),
        "anchor": asked(anchor, 0),
        "anchor25": asked(anchor, 25),
        "town": asked(town, 0),
    }


def round_robin(rows: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """Visiting order that takes the first of every group, then the second, …: turn and group."""
    return rows.withColumn("turn", F.row_number().over(Window.partitionBy(group).orderBy(*order)).cast("long"))


def stratified(rows: DataFrame, stratum: str, order: list[Column], size: int | None = None) -> DataFrame:
    """The middle member of every stratum; up to ``size`` members are filled from the largest strata, one of each in turn, those after the middle first."""
    w = Window.partitionBy(stratum)
    placed = rows.withColumns({"_at": F.row_number().over(w.orderBy(*order)) - 1, "_n": F.count(F.lit(1)).over(w)})
    # How many places after the middle a member comes, around the end.
    turned = placed.withColumn("_turn", F.pmod(F.col("_at") - F.floor(F.col("_n") / 2), F.col("_n")))
    if size is None:
        return turned.where("_turn = 0").drop("_at", "_n", "_turn")
    middle = turned.where("_turn = 0")
    more = max(0, size - middle.count())  # a sample is a bounded number of rows, so Spark keeps that many a task and no task sorts all
    return middle.unionByName(turned.where("_turn > 0").orderBy("_turn", F.desc("_n"), stratum).limit(more)).drop("_at", "_n", "_turn")


def spread_sample(rows: DataFrame, pseudonym: str, n: int) -> DataFrame:
    """A fixed sample: the ``n`` smallest pseudonyms, which hashing has spread evenly."""
    return rows.orderBy(pseudonym).limit(n)


# The order in which a frontier's levels are worked on, and days of the last subdivision.
LEVEL_ORDER = {2: 0, 0: 1, 1: 2, 3: 3, 4: 4}
RECENCY_DAYS = (1, 7, 30)


def frontier_order(segments: DataFrame) -> DataFrame:
    """Segments to do, failed ones again, with their place: by level, region and key."""
    rank = F.create_map(*(F.lit(x) for pair in LEVEL_ORDER.items() for x in pair))
    waiting = segments.where(F.col("status").isin("pending", "failed"))
    ordered = waiting.withColumns({"_rank": F.element_at(rank, F.col("level")), "_region": F.coalesce("nuts_code", F.lit(""))})
    placed, _ = numbered(ordered, ["_rank", "_region", "key"])
    return placed.withColumn("place", F.col("place") + 1).drop("_rank", "_region")


def insert_absent(frontier: DataFrame, more: DataFrame, keys: list[str]) -> DataFrame:
    return frontier.unionByName(more.dropDuplicates(keys).join(frontier, keys, "left_anti"))


SEGMENT = ("key", "level", "nuts_code", "nuts1", "parent", "status", "recency_days")


def _segments(rows: DataFrame, key: Column, level: int, nuts: Column, nuts1: Column, status: Column, parent: Column | None = None, days: Column | None = None) -> DataFrame:
    none = F.lit(None)
    values = (key, F.lit(level), nuts.cast("string"), nuts1.cast("string"), (none if parent is None else parent).cast("string"), status, (none if days is None else days).cast("int"))
    return rows.select(*(v.alias(c) for c, v in zip(SEGMENT, values, strict=True)))


def initial_frontier(reference: DataFrame, states: DataFrame, radius: int = 0) -> DataFrame:
    """Segments of the levels 0 to 2: the whole country, the states (name, nuts1), and municipalities.

    A name that lies in one region is asked for as it is, one of several by its
    postcodes. A state that is also a municipality is marked subdivided: its
    municipality covers it.
    """
    spark = reference.sparkSession
    pending, none = F.lit("pending"), F.lit(None)
    names = reference.where("source_type = 'municipality' AND municipality_name <> ''").select("municipality_name", "nuts_code").distinct()
    counted = names.groupBy("municipality_name").agg(F.countDistinct("nuts_code").alias("n"), F.min("nuts_code").alias("one"))
    whole = _segments(spark.range(1), F.lit(""), 0, none, none, pending)
    cities = states.join(counted.select(F.col("municipality_name").alias("name"), F.lit(True).alias("city")), "name", "left")
    level_1 = _segments(cities, place_query(F.col("name"), radius), 1, none, F.col("nuts1"), F.when(F.col("city"), "subdivided").otherwise("pending"))
    sole = _segments(counted.where("n = 1"), place_query(F.col("municipality_name"), radius), 2, F.col("one"), F.substring("one", 1, 3), pending)
    postcodes = reference.where("source_type = 'plz'").select("municipality_name", "source_code", "nuts_code").distinct().join(counted.where("n > 1").select("municipality_name"), "municipality_name")
    shared = _segments(postcodes, place_query(F.col("source_code"), radius), 2, F.col("nuts_code"), F.substring("nuts_code", 1, 3), pending)
    return whole.unionByName(level_1).unionByName(sole).unionByName(shared).dropDuplicates(["level", "key"])


def children(cut: DataFrame, states: DataFrame, postcodes: DataFrame, radius: int = 0) -> DataFrame:
    """What truncated segments fall into, each child once, with the least of its parents.

    The country falls into ``states`` (name, nuts1), a municipality into the
    ``postcodes`` (source_code, nuts_code) of its region, a postcode into
    windows of recency; a state's municipalities are in the frontier already.
    """
    pending = F.lit("pending")
    parent = F.col("parent_key")
    of_level = lambda level: cut.where(F.col("level") == level).select(F.col("key").alias("parent_key"), "nuts_code", "nuts1")
    # The country is one segment, so this join pairs one row with the states.
    of_country = _segments(of_level(0).drop("nuts1", "nuts_code").limit(1).crossJoin(states), place_query(F.col("name"), radius), 1, F.lit(None), F.col("nuts1"), pending, parent)
    of_town = of_level(2).join(postcodes.select("source_code", F.col("nuts_code").alias("_nuts")).distinct(), F.col("nuts_code") == F.col("_nuts"))
    of_town = _segments(of_town, place_query(F.col("source_code"), radius), 3, F.col("nuts_code"), F.col("nuts1"), pending, parent)
    windows = of_level(3).withColumn("days", F.explode(F.array(*map(F.lit, RECENCY_DAYS))))
    of_code = _segments(windows, F.concat(parent, F.lit("&veroeffentlichtseit="), F.col("days").cast("string")), 4, F.col("nuts_code"), F.col("nuts1"), pending, parent, F.col("days"))
    every = of_country.unionByName(of_town).unionByName(of_code)
    return every.groupBy("level", "key").agg(F.min_by(F.struct(*(c for c in SEGMENT if c not in ("level", "key"))), "parent").alias("s")).select("level", "key", "s.*").select(*SEGMENT)


def subdivide(frontier: DataFrame, states: DataFrame, postcodes: DataFrame, radius: int = 0) -> DataFrame:
    """Children of truncated segments join the frontier, and these are marked subdivided; failed ones stay as they are."""
    cut = frontier.where("status = 'truncated'")
    moved = frontier.withColumn("status", F.when(F.col("status") == "truncated", "subdivided").otherwise(F.col("status")))
    return insert_absent(moved, children(cut, states, postcodes, radius), ["level", "key"])


def stock_lower_bound(frontier: DataFrame) -> DataFrame:
    """Rows of the segments that were read to their end: the least that the stock can be."""
    return frontier.agg(F.coalesce(F.sum(F.when(F.col("status") == "complete", F.col("rows_yielded"))), F.lit(0)).cast("long").alias("measured_stock"))


def segment_states(pages: DataFrame, per_page: int = PER_PAGE, most: int = 400) -> DataFrame:
    """What became of each segment whose pages (segment, page, status, items) were fetched: failed, truncated on a full last page, or complete; and its rows."""
    by = pages.groupBy("segment").agg(F.max("page").alias("pages"), F.max_by("items", "page").alias("last_items"), F.count_if(F.col("status") != 200).alias("failed_pages"), F.sum("items").cast("long").alias("rows_yielded"))
    state = first_of([(F.col("failed_pages") > 0, "failed"), ((F.col("pages") >= most) & (F.col("last_items") >= per_page), "truncated")], "complete")
    return by.select("segment", state.alias("status"), "rows_yielded", (F.col("last_items") >= per_page).alias("last_page_full"))


def page_plan(regions: DataFrame, cap: int, per_page: int = PER_PAGE) -> DataFrame:
    """Pages planned for each region (advertised, pages_done) within the cap, whether the cap cuts it, and what a short read takes off the plan."""
    available = F.ceil(F.col("advertised") / per_page)
    planned = F.when(F.col("advertised").isNull(), 1).otherwise(F.greatest(F.lit(1), F.least(F.lit(cap), available))).cast("long")
    told = regions.withColumns({"planned_pages": planned, "capped": F.coalesce(available > cap, F.lit(False))})
    short = (F.col("pages_done") > 0) & (F.col("pages_done") < F.col("planned_pages"))
    return told.withColumn("expected_pages", F.when(short, F.col("pages_done")).otherwise(F.col("planned_pages")))


def planned_totals(advertised: Column, segments: Column, per_page: int, most: Column, rows_seen: Column, pages_done: Column) -> dict[str, Column]:
    """expected_pages and expected_rows of a sweep: by the advertised count where one query covers it, within a page budget if there is one, else what was read."""
    single = advertised.isNotNull() & (segments == 1)
    needed = F.ceil(advertised / per_page)
    pages = F.when(~single, pages_done).when(most.isNotNull(), F.least(needed, most)).otherwise(needed).cast("long")
    rows = F.when(~single | most.isNotNull(), rows_seen).otherwise(F.least(advertised, needed * per_page)).cast("long")
    return {"expected_pages": pages, "expected_rows": rows}


def tally(rows: DataFrame, column: str) -> DataFrame:
    """How often each value occurs, and its share of all rows."""
    counted = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def scope_states(manifests: DataFrame) -> DataFrame:
    """Per scope: stored sweeps, the newest start and the threshold that it carries."""
    last = F.max_by("freshness_threshold_hours", F.when(F.col("started_at").isNotNull() & F.col("freshness_threshold_hours").isNotNull(), F.struct("started_at", "sweep_id")))
    return manifests.groupBy("source", "scope_id").agg(F.count(F.lit(1)).alias("sweeps"), F.max("started_at").alias("newest_started"), last.alias("threshold"))


def spacing_allowed(states: DataFrame, now: Column, minimum_hours: float) -> DataFrame:
    """(source, age_hours, allowed): whether a source's newest start is old enough for another sweep."""
    newest = states.groupBy("source").agg(F.max("newest_started").alias("newest"))
    age = F.timestamp_diff("SECOND", F.col("newest"), now) / F.lit(3600.0)
    return newest.select("source", age.alias("age_hours"), F.coalesce(age >= minimum_hours, F.lit(True)).alias("allowed"))


def coverage_text(stats: DataFrame) -> DataFrame:
    """What a panel sweep's manifest says of its coverage, from one row of counters (regions, with_rows, capped, short, cap)."""
    text = F.format_string("Stratified region-bounded sample, not a census: %d of %d regions gave rows; %d were cut at %d pages, %d ended early.", "with_rows", "regions", "capped", "cap", "short")
    return stats.withColumn("coverage_limitations", text)
