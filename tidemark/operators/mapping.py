"""Crosswalk mappings as joins and one chain of conditions: the first hit wins, ambiguity is refused."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import department_of_commune, department_of_label, department_of_postcode, folded_name, is_corsican_postcode, score_bucket, uri_class, zero_padded

NOT_STATED, UNRECOGNISED = "Not stated", "Unrecognised code"
DIMENSIONS = ("employment_type", "working_hours_type", "duration")
#: A region that was not found and not refused either.
UNMAPPED = ("unmapped", "not_available")


def crosswalk_summary(candidates: DataFrame) -> DataFrame:
    """Per concept: candidates, exact ones, and the one to take (the sole exact one, else the sole one)."""
    exact = F.col("relation") == "exact-match"
    carried = [c for c in ("target_uri", "target_label", "relation", "confidence") if c in candidates.columns]
    pick = F.struct(exact.cast("int").alias("exact"), *(F.col(c).alias(c.removeprefix("target_")) for c in carried))
    return candidates.groupBy("concept").agg(F.count(F.lit(1)).alias("n"), F.count_if(exact).alias("n_exact"), F.max(pick).alias("pick"))


def map_concepts(rows: DataFrame, candidates: DataFrame, reviews: DataFrame) -> DataFrame:
    """``rows`` (…, concept) with uri, label, mapping_status, mapping_confidence, mapping_method, relation.

    ``candidates`` are (concept, target_uri, target_label, relation,
    confidence), ``reviews`` the same with status, one a concept. Absent, then a
    manual review, which redirects or refuses, then the crosswalk: none is
    unmapped; of several the sole exact one wins, else they are ambiguous; a
    single one that is not exact is of low confidence. Only mapped rows carry a
    URI and label; low confidence keeps its confidence and relation.
    """
    chosen = crosswalk_summary(candidates).withColumnRenamed("concept", "c_concept")
    said = reviews.select(F.col("concept").alias("r_concept"), *(F.col(c).alias(f"r_{c}") for c in ("target_uri", "target_label", "relation", "status", "confidence")))
    joined = rows.join(said, F.col("concept") == F.col("r_concept"), "left").join(chosen, F.col("concept") == F.col("c_concept"), "left")
    absent, reviewed = F.coalesce(F.col("concept") == "", F.lit(True)), F.col("r_status").isNotNull()
    n, n_exact = F.coalesce("n", F.lit(0)), F.coalesce("n_exact", F.lit(0))
    choices = [
        (absent, "not_present", "source_absent"),
        (reviewed, F.col("r_status"), "manual_review"),
        (n == 0, "unmapped", "no_match"),
        ((n > 1) & (n_exact == 1), "mapped", "exact_match_tiebreak"),
        (n > 1, "ambiguous", "no_match"),
        (n_exact == 1, "mapped", "crosswalk"),
    ]
    status, method = first_of([(c, s) for c, s, _ in choices], "low_confidence"), first_of([(c, m) for c, _, m in choices], "crosswalk")
    taken = joined.withColumns({"mapping_status": status, "mapping_method": method})
    mapped, kept = F.col("mapping_status") == "mapped", F.col("mapping_status").isin("mapped", "low_confidence")

    def told(review: str, pick: str, where: Column) -> Column:
        return F.when(where, F.when(F.col("mapping_method") == "manual_review", F.col(review)).otherwise(F.col(pick)))

    return taken.select(
        *rows.columns,
        told("r_target_uri", "pick.uri", mapped).alias("uri"),
        told("r_target_label", "pick.label", mapped).alias("label"),
        "mapping_status",
        told("r_confidence", "pick.confidence", kept).alias("mapping_confidence"),
        "mapping_method",
        told("r_relation", "pick.relation", kept).alias("relation"),
    )


def first_of(choices: list[tuple[Column, object]], otherwise) -> Column:
    """The value of the first condition that holds."""
    value = lambda v: v if isinstance(v, Column) else F.lit(v)
    (first, then), *rest = choices
    return reduce(lambda chain, c: chain.when(c[0], value(c[1])), rest, F.when(first, value(then))).otherwise(value(otherwise))


def region_cascade(rows: DataFrame, geography: DataFrame) -> DataFrame:
    """Swedish region of (municipality, region_code): the municipality, its first two digits as a region, the region code.

    ``geography`` is (source_type, source_code, nuts_code, nuts_label).
    """
    steps = {
        "municipality_crosswalk": ("municipality", F.col("municipality")),
        "municipality_prefix_crosswalk": ("region", F.when(F.length("municipality") >= 2, F.substring("municipality", 1, 2))),
        "region_crosswalk": ("region", F.col("region_code")),
    }
    joined = rows
    for method, (kind, code) in steps.items():
        table = geography.where(F.col("source_type") == kind).select(F.col("source_code").alias(f"{method}_code"), F.struct("nuts_code", "nuts_label").alias(method))
        joined = joined.withColumn(f"{method}_key", F.nullif(code, F.lit(""))).join(table, F.col(f"{method}_key") == F.col(f"{method}_code"), "left")
    absent = F.coalesce(F.nullif("municipality", F.lit("")), F.nullif("region_code", F.lit(""))).isNull()
    hit = F.coalesce(*steps)
    method = first_of([(F.col(m).isNotNull(), m) for m in steps] + [(absent, "source_absent")], "no_match")
    status = first_of([(hit.isNotNull(), "mapped"), (absent, "not_present")], "unmapped")
    return joined.select(*rows.columns, hit["nuts_code"].alias("nuts_code"), hit["nuts_label"].alias("nuts_label"), status.alias("mapping_status"), method.alias("mapping_method"))


def requirement_label(rows: DataFrame, labels: DataFrame, code: str) -> DataFrame:
    """Label of a requirement code: empty is not stated, unknown keeps its code."""
    known = labels.select(F.col("code").alias("l_code"), F.col("label_en"))
    joined = rows.join(known, F.col(code) == F.col("l_code"), "left")
    empty = F.col(code).isNull() | (F.col(code) == "")
    return joined.select(
        *rows.columns,
        F.when(empty, NOT_STATED).when(F.col("l_code").isNull(), UNRECOGNISED).otherwise(F.col("label_en")).alias("value_label"),
        F.when(empty, "not_present").when(F.col("l_code").isNull(), "unmapped").otherwise("mapped").alias("mapping_status"),
    )


def enriched_hits(hits: DataFrame, references: dict[str, DataFrame]) -> DataFrame:
    """Raw hits mapped and brought to one record each: region, occupation, skills and requirements.

    ``hits`` has id, country_code, workplace_address, occupation, must_have,
    nice_to_have, the requirement blocks and number_of_vacancies;
    ``references`` the tables geography, occupations, skills, reviews
    (dimension, …) and requirements (dimension, code, label_en). Hits without
    an id or from another country than Sweden are refused: they are left out
    here and found by ``refused_hits``.
    """
    address = F.col("workplace_address")
    kept = accepted_hits(hits)
    base = kept.select("id", address["municipality_code"].alias("municipality"), address["region_code"].alias("region_code"), F.col("occupation")["concept_id"].alias("concept"), *(F.col(d)["concept_id"].alias(f"{d}_code") for d in DIMENSIONS), "must_have", "nice_to_have", "number_of_vacancies")
    region = region_cascade(base, references["geography"]).withColumnsRenamed({"mapping_status": "region_mapping_status", "mapping_method": "region_mapping_method"})
    reviews = references["reviews"]
    occupation = map_concepts(region, references["occupations"], reviews.where("dimension = 'occupation'")).withColumnsRenamed({"uri": "esco_occupation_uri", "label": "esco_occupation_label", "mapping_status": "occupation_mapping_status", "mapping_confidence": "occupation_mapping_confidence", "mapping_method": "occupation_mapping_method"}).drop("relation", "concept")
    told = occupation
    for d in DIMENSIONS:
        labels = references["requirements"].where(F.col("dimension") == d)
        told = requirement_label(told, labels, f"{d}_code").withColumnsRenamed({"value_label": f"{d}_label", "mapping_status": f"{d}_mapping_status"})
        told = told.withColumn(f"{d}_code", F.nullif(f"{d}_code", F.lit("")))
    ids = F.array_sort(F.array_distinct(F.array_compact(F.concat(*(F.transform(F.coalesce(F.col(f)["skills"], F.array()), lambda s: s["concept_id"]) for f in ("must_have", "nice_to_have"))))))
    opened = kept.select("id", F.explode_outer(ids).alias("concept"))
    mapped = map_concepts(opened, references["skills"], reviews.where("dimension = 'skill'"))
    element = F.struct(F.col("concept"), "uri", "label", F.col("mapping_status").alias("status"), F.col("mapping_confidence").alias("confidence"), F.col("mapping_method").alias("method"), "relation")
    skills = mapped.groupBy("id").agg(F.array_sort(F.collect_list(element)).alias("skills"))
    out = told.join(skills, "id").withColumn("skill_mappings", F.transform("skills", lambda s: s.dropFields("concept"))).drop("skills", "must_have", "nice_to_have", "municipality", "region_code")
    return out.withColumns({"country": F.lit("SE"), "skill_uris": F.array_sort(F.array_compact(F.transform("skill_mappings", lambda s: s["uri"])))})


def _acceptable() -> Column:
    country = F.coalesce(F.nullif("country_code", F.lit("")), F.col("workplace_address")["country_code"])
    return F.coalesce(F.col("id") != "", F.lit(False)) & F.coalesce(country.isin("SE", "199"), F.lit(False))


def accepted_hits(hits: DataFrame) -> DataFrame:
    return hits.where(_acceptable())


def refused_hits(hits: DataFrame) -> DataFrame:
    """Hits that stop a collection: without an id, or from another country."""
    return hits.where(~_acceptable())


def hits_of(rows: DataFrame, key: str, codes: Column, table: DataFrame, name: str) -> DataFrame:
    """``rows`` with what an array of codes finds in ``table`` (code, nuts_code, nuts_label): ``name``_n regions, ``name``_first by place, the least of several there, ``name``_least by code.

    ``key`` has to tell the rows apart: rows that share one share what they find.
    """
    opened = rows.select(F.col(key).alias("_key"), F.posexplode(codes).alias("_place", "_code"))
    region = F.struct("nuts_code", "nuts_label")
    found = opened.join(table.select(F.col("code").alias("_code"), "nuts_code", "nuts_label"), "_code").where("nuts_code <> ''").groupBy("_key").agg(F.countDistinct("nuts_code").alias(f"{name}_n"), F.min_by(region, F.struct("_place", region)).alias(f"{name}_first"), F.min(region).alias(f"{name}_least"))
    return rows.join(found, F.col(key) == F.col("_key"), "left").drop("_key").withColumn(f"{name}_n", F.coalesce(f"{name}_n", F.lit(0)))


def _resolved(joined: DataFrame, keep: list[str], choices: list[tuple[Column, Column | None, object, str]], otherwise: tuple[str, str] = UNMAPPED) -> DataFrame:
    """``keep`` with nuts_code, nuts_label, mapping_status, mapping_method of the first choice (condition, region, status, method) that holds."""
    none = F.lit(None).cast("struct<nuts_code:string,nuts_label:string>")
    region = first_of([(c, none if r is None else r) for c, r, _, _ in choices], none)
    status, method = first_of([(c, s) for c, _, s, _ in choices], otherwise[0]), first_of([(c, m) for c, _, _, m in choices], otherwise[1])
    told = joined.select(*keep, region.alias("_region"), status.alias("mapping_status"), method.alias("mapping_method"))
    return told.select(*keep, F.col("_region.nuts_code").alias("nuts_code"), F.col("_region.nuts_label").alias("nuts_label"), "mapping_status", "mapping_method")


def several(n: Column) -> Column:
    return F.when(n > 1, "ambiguous").otherwise("mapped")


def czech_region(rows: DataFrame, key: str, table: DataFrame) -> DataFrame:
    """Region of (work_regions[], contact_region, districts[], municipality): workplaces, the contact's address, districts, the municipality."""
    joined = hits_of(rows, key, F.col("work_regions"), table, "work")
    joined = hits_of(joined, key, F.array("contact_region"), table, "contact")
    joined = hits_of(joined, key, F.col("districts"), table, "district")
    joined = hits_of(joined, key, F.array("municipality"), table, "town")
    n = {t: F.col(f"{t}_n") for t in ("work", "contact", "district", "town")}
    return _resolved(joined, rows.columns, [
        (n["work"] > 0, F.col("work_first"), several(n["work"]), "mpsv_kraje_codelist_nuts3"),
        (n["contact"] > 0, F.col("contact_first"), "low_confidence", "mpsv_kraje_codelist_contact_address"),
        (n["district"] > 0, F.col("district_first"), several(n["district"]), "mpsv_okres_codelist_nuts3"),
        (n["town"] > 0, F.col("town_first"), "mapped", "mpsv_obec_codelist_nuts3"),
    ])


def french_region(rows: DataFrame, key: str, table: DataFrame) -> DataFrame:
    """Region of (commune, postcode, label): the commune's département, the postcode's (Corsica's is refused), the label's."""
    codes = {"commune": department_of_commune(F.col("commune")), "postcode": department_of_postcode(F.col("postcode")), "label": department_of_label(F.col("label"))}
    joined = rows
    for name, code in codes.items():
        joined = hits_of(joined, key, F.array(code), table, f"_{name}")
    return _resolved(joined, rows.columns, [
        (F.col("_commune_n") > 0, F.col("_commune_first"), "mapped", "ft_commune_insee_departement_nuts3"),
        (is_corsican_postcode(F.col("postcode")) & (F.length(F.trim("postcode")) >= 2), None, "ambiguous", "ft_code_postal_corse_2a_2b"),
        (F.col("_postcode_n") > 0, F.col("_postcode_first"), "low_confidence", "ft_code_postal_departement_nuts3"),
        (F.col("_label_n") > 0, F.col("_label_first"), "low_confidence", "ft_lieu_libelle_departement_nuts3"),
    ])


# Names that mean Norway, folded.
NORWAY = ("norge", "norway", "no", "nor")


def norwegian_region(rows: DataFrame, key: str, counties: DataFrame, municipalities: DataFrame) -> DataFrame:
    """Region of (locations[] of county, municipal, country; feed_municipal): county, municipality, the feed's municipality, abroad, unknown, absent.

    The tables are (name, nuts_code, nuts_label). A municipality's name that
    lies in several regions finds none, and makes what it is part of ambiguous.
    """
    named = lambda t: t.select(folded_name(F.col("name")).alias("code"), "nuts_code", "nuts_label")
    towns = named(municipalities)
    counted = towns.groupBy("code").agg(F.countDistinct("nuts_code").alias("n"), F.first("nuts_code").alias("nuts_code"), F.first("nuts_label").alias("nuts_label"))
    unique, shared = counted.where("n = 1"), counted.where("n > 1").select("code")
    # All names are folded once, row by row of the exploded locations.
    spots = rows.select(F.col(key).alias("_key"), F.posexplode_outer("locations").alias("_place", "_spot"))
    folded = spots.select("_key", "_place", *(folded_name(F.col("_spot")[f]).alias(f) for f in ("county", "municipal", "country")), *(F.trim(F.coalesce(F.col("_spot")[f], F.lit(""))).alias(f"raw_{f}") for f in ("county", "municipal")))
    lists = folded.groupBy("_key").agg(F.collect_list("county").alias("_counties"), F.collect_list("municipal").alias("_towns"), F.bool_or(F.col("country").isin(*NORWAY)).alias("_home"), F.bool_or(F.col("country") != "").alias("_country"), F.bool_or((F.col("raw_county") != "") | (F.col("raw_municipal") != "")).alias("_told"))
    joined = rows.join(lists, F.col(key) == F.col("_key"), "left").drop("_key").withColumn("_feed", F.array(folded_name(F.col("feed_municipal"))))
    joined = hits_of(joined, key, F.col("_counties"), named(counties), "_county")
    for field, name in (("_towns", "_town"), ("_feed", "_fed")):
        joined = hits_of(joined, key, F.col(field), unique, name)
        several_regions = joined.select(F.col(key).alias("_key"), F.explode(field).alias("code")).join(shared, "code").select("_key").distinct().withColumn(f"{name}_shared", F.lit(True))
        joined = joined.join(several_regions, F.col(key) == F.col("_key"), "left").drop("_key").withColumn(f"{name}_shared", F.coalesce(f"{name}_shared", F.lit(False)))

    def town(name: str, status: str, method: str):
        n, mixed = F.col(f"{name}_n"), F.col(f"{name}_shared")
        return (n > 0) | mixed, F.col(f"{name}_least"), F.when((n > 1) | mixed, "ambiguous").otherwise(status), method

    signal = F.coalesce("_told", F.lit(False)) | (F.trim(F.coalesce("feed_municipal", F.lit(""))) != "")
    return _resolved(joined, rows.columns, [
        (F.col("_county_n") > 0, F.col("_county_least"), several(F.col("_county_n")), "nav_worklocation_county_nuts3"),
        town("_town", "mapped", "nav_worklocation_municipal_nuts3"),
        town("_fed", "low_confidence", "nav_feed_entry_municipal_nuts3"),
        (F.coalesce(F.col("_country") & ~F.col("_home"), F.lit(False)), None, "unmapped", "nav_worklocation_foreign_country"),
        (signal, None, "unmapped", "nav_region_name_unknown"),
    ], ("not_present", "not_available"))


def norwegian_occupation(categories: Column) -> dict[str, Column]:
    """uri, status, confidence and method of an array of struct(categoryType, code, score): the best scored occupation, a tie is ambiguous with the lowest URI."""
    told = F.filter(F.coalesce(categories, F.array()), lambda c: F.upper(F.trim(c["categoryType"])) == "ESCO")
    scored = F.transform(told, lambda c: F.struct(F.trim(F.coalesce(c["code"], F.lit(""))).alias("code"), F.coalesce(c["score"], F.lit(0.0)).alias("score"), c["score"].alias("raw")))
    valid = F.filter(scored, lambda c: uri_class(c["code"]) == "esco_occupation")
    top = F.array_max(F.transform(valid, lambda c: c["score"]))
    winners = F.array_sort(F.array_distinct(F.transform(F.filter(valid, lambda c: c["score"] >= top), lambda c: c["code"])))
    best = F.get(winners, F.lit(0))
    raw = F.get(F.filter(valid, lambda c: c["code"] == best), F.lit(0))["raw"]
    group = F.exists(scored, lambda c: uri_class(c["code"]) == "isco_group")
    found = F.size(valid) > 0
    return {
        "uri": best,
        "status": first_of([(F.size(winners) > 1, "ambiguous"), (found, "mapped"), (F.size(told) > 0, "unmapped")], "not_present"),
        "confidence": F.when(found, score_bucket(raw)),
        "method": first_of([(found, "nav_categorylist_esco"), (group, "nav_categorylist_esco_isco_group"), (F.size(told) > 0, "nav_categorylist_esco_unrecognized")], "not_available"),
    }


def finnish_region(rows: DataFrame, key: str, table: DataFrame) -> DataFrame:
    """Region of (municipalities[], regions[]): municipalities, then regions; several are ambiguous, region codes of several regions too.

    ``table`` is (source_type: kunta or maakunta, source_code, nuts_code, nuts_label).
    """
    known = table.select("source_type", zero_padded(F.upper(F.trim("source_code")), 3).alias("wide"), zero_padded(F.upper(F.trim("source_code")), 2).alias("narrow"), "nuts_code", "nuts_label")
    towns = known.where("source_type = 'kunta'").select(F.col("wide").alias("code"), "nuts_code", "nuts_label")
    areas = known.where("source_type = 'maakunta'").groupBy(F.col("narrow").alias("code")).agg(F.countDistinct("nuts_code").alias("n"), F.first("nuts_code").alias("nuts_code"), F.first("nuts_label").alias("nuts_label"))
    stated = lambda column, width: F.transform(F.filter(F.coalesce(F.col(column), F.array().cast("array<string>")), lambda c: F.trim(c) != ""), lambda c: zero_padded(F.upper(F.trim(c)), width))
    joined = rows.withColumns({"_towns": stated("municipalities", 3), "_areas": stated("regions", 2)})
    joined = hits_of(hits_of(joined, key, F.col("_towns"), towns, "_town"), key, F.col("_areas"), areas.where("n = 1"), "_area")
    mixed = joined.select(F.col(key).alias("_key"), F.explode("_areas").alias("code")).join(areas.where("n > 1"), "code").select("_key").distinct().withColumn("_mixed", F.lit(True))
    joined = joined.join(mixed, F.col(key) == F.col("_key"), "left").drop("_key")
    told = (F.size("_towns") > 0) | (F.size("_areas") > 0)
    return _resolved(joined, rows.columns, [
        (F.col("_town_n") == 1, F.col("_town_first"), "mapped", "tmt_kunta_nuts3"),
        (F.col("_town_n") > 1, None, "ambiguous", "tmt_kunta_multiple_nuts3"),
        (F.col("_area_n") == 1, F.col("_area_first"), "mapped", "tmt_maakunta_nuts3"),
        (F.col("_area_n") > 1, None, "ambiguous", "tmt_maakunta_multiple_nuts3"),
        (F.coalesce("_mixed", F.lit(False)), None, "ambiguous", "tmt_maakunta_ambiguous_code"),
        (told, None, "unmapped", "tmt_unknown_region_code"),
    ], ("not_present", "not_available"))


def finnish_occupation(main: Column, others: Column) -> dict[str, Column]:
    """uri, status and method: the first occupation URI, the main one before the others; a group or a national concept is told, not taken."""
    stated = F.filter(F.transform(F.concat(F.array(main), F.coalesce(others, F.array().cast("array<string>"))), lambda v: F.trim(v)), lambda v: v != "")
    kinds = F.transform(stated, uri_class)
    uri = F.get(F.filter(stated, lambda v: uri_class(v) == "esco_occupation"), F.lit(0))
    # A group's URI counts by its namespace here, whatever follows it.
    group = F.exists(stated, lambda v: v.rlike(r"(?i)^https?://data\.europa\.eu/esco/isco/"))
    national = F.array_contains(kinds, "national")
    choices = [(uri.isNotNull(), "mapped", "finesco_esco_occupation_uri"), (F.size(stated) == 0, "not_present", "not_available"), (group, "low_confidence", "finesco_isco_group_uri_only"), (national, "unmapped", "finesco_national_extension_uri")]
    return {"uri": uri, "status": first_of([(c, s) for c, s, _ in choices], "unmapped"), "method": first_of([(c, m) for c, _, m in choices], "finesco_unrecognised_occupation_uri")}


def finnish_skills(skills: Column) -> Column:
    """Array of struct(status, method, uri), one for each stated skill in order."""
    stated = F.filter(F.transform(F.coalesce(skills, F.array().cast("array<string>")), lambda v: F.trim(v)), lambda v: v != "")

    def element(value: Column) -> Column:
        kind = uri_class(value)
        status = F.when(kind == "esco_skill", "mapped").when(kind == "isced_field", "low_confidence").otherwise("unmapped")
        method = F.when(kind == "esco_skill", "finesco_esco_skill_uri").when(kind == "isced_field", "finesco_isced_f_uri").when(kind == "national", "finesco_national_extension_uri").otherwise("finesco_unrecognised_skill_uri")
        return F.struct(status.alias("status"), method.alias("method"), F.when(kind == "esco_skill", value).alias("uri"))

    return F.transform(stated, element)


def postcode_region(rows: DataFrame, key: str, table: DataFrame, method: str = "vdab_landing_postcode_nuts3") -> DataFrame:
    """Region of a postcode that the table has, else not available."""
    joined = hits_of(rows, key, F.array(F.trim("postcode")), table, "_postcode")
    return _resolved(joined, rows.columns, [(F.col("_postcode_n") > 0, F.col("_postcode_first"), "mapped", method)])


# Places that the German source names without a location, and qualifiers of place names by state.
MARKERS = (("verschiedene arbeitsorte", "ba_location_multiple"), ("deutschland", "ba_location_nationwide"), ("bundesweit", "ba_location_nationwide"), ("ausland", "ba_location_foreign"))
STATE_ALIASES = {
    "baden": "DE1", "württemberg": "DE1", "neckar": "DE1", "hegau": "DE1", "oberbayern": "DE2", "niederbayern": "DE2", "oberpfalz": "DE2", "oberfranken": "DE2", "mittelfranken": "DE2", "unterfranken": "DE2",
    "schwaben": "DE2", "bayern": "DE2", "rheinland": "DEA", "westfalen": "DEA", "nordrhein-westfalen": "DEA", "pfalz": "DEB", "eifel": "DEB", "rheinland-pfalz": "DEB", "hessen": "DE7", "saar": "DEC",
    "saarland": "DEC", "sachsen": "DED", "anhalt": "DEE", "sachsen-anhalt": "DEE", "holstein": "DEF", "schleswig": "DEF", "schleswig-holstein": "DEF", "thüringen": "DEG", "mecklenburg": "DE8",
    "mecklenburg-vorpommern": "DE8", "pommern": "DE8", "brandenburg": "DE4", "niedersachsen": "DE9", "berlin": "DE3", "hamburg": "DE6", "bremen": "DE5",
}


def german_location(rows: DataFrame, key: str, towns: DataFrame) -> DataFrame:
    """Region of (city, segment_nuts1, segment_nuts3) by the first two tiers.

    A marker without a place is ambiguous. A city behind a comma qualifier is
    narrowed to the qualifier's state; one that lies in one region is mapped;
    others are narrowed by the segment that found them. ``towns`` is (name,
    nuts_code, nuts_label).
    """
    lower = F.lower(F.trim("city"))
    aliases = F.create_map(*(F.lit(x) for pair in STATE_ALIASES.items() for x in pair))
    parts = F.split(F.trim("city"), ",", 2)
    named = rows.withColumns({"_base": F.lower(F.trim(parts[0])), "_state": F.try_element_at(aliases, F.lower(F.trim(F.get(parts, F.lit(1)))))})
    options = named.select(F.col(key).alias("_key"), F.col("_base").alias("code"), "_state", "segment_nuts1", "segment_nuts3").join(towns.select(F.lower(F.trim("name")).alias("code"), "nuts_code", "nuts_label").distinct(), "code")
    region, in_state = F.struct("nuts_code", "nuts_label"), F.coalesce(F.col("nuts_code").startswith(F.col("_state")), F.lit(False))
    narrowed = options.withColumn("_any", F.max(in_state).over(_by_key())).where(~F.col("_any") | in_state)
    here, near = (F.coalesce(c, F.lit(False)) for c in (F.col("nuts_code") == F.col("segment_nuts3"), F.col("nuts_code").startswith(F.col("segment_nuts1"))))
    found = narrowed.groupBy("_key").agg(
        F.max("_any").alias("_by_state"), F.countDistinct(region).alias("_n"), F.min(region).alias("_one"),
        F.countDistinct(F.when(here, region)).alias("_n_here"), F.min(F.when(here, region)).alias("_here"), F.countDistinct(F.when(near, region)).alias("_n_near"), F.min(F.when(near, region)).alias("_near"),
    )
    joined = named.join(found, F.col(key) == F.col("_key"), "left")
    absent = F.coalesce(F.col("city") == "", F.lit(True))
    markers = [(F.coalesce((lower == m) | lower.startswith(f"{m} "), F.lit(False)), None, "ambiguous", method) for m, method in MARKERS]
    n, inside = F.coalesce("_n", F.lit(0)), F.coalesce("_n_here", F.lit(0))
    return _resolved(joined, rows.columns, [
        (absent, None, *UNMAPPED),
        *markers,
        ((n == 1) & F.col("_by_state"), F.col("_one"), "mapped", "ba_city_qualifier_nuts3"),
        (n == 1, F.col("_one"), "mapped", "ba_city_municipality_nuts3"),
        ((n > 1) & (inside == 1), F.col("_here"), "mapped", "ba_segment_disambiguated"),
        ((n > 1) & (inside == 0) & (F.col("_n_near") == 1), F.col("_near"), "mapped", "ba_segment_disambiguated"),
        (n > 1, None, "ambiguous", "ba_city_municipality_ambiguous"),
    ])


def _by_key():
    return Window.partitionBy("_key")


def segment_provenance(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Third tier: what is unmapped takes the region of the segment (segment_nuts3, radius) that found it; a radius lowers the confidence."""
    known = labels.select(F.col("nuts_code").alias("_code"), F.col("nuts_label").alias("_label"))
    joined = rows.join(known, F.col("segment_nuts3") == F.col("_code"), "left")
    taken = (F.col("mapping_status") == "unmapped") & F.coalesce(F.col("segment_nuts3") != "", F.lit(False))
    exact = F.coalesce(F.col("radius") == 0, F.lit(False))
    new = {
        "nuts_code": F.col("segment_nuts3"),
        "nuts_label": F.col("_label"),
        "mapping_status": F.when(exact, "mapped").otherwise("low_confidence"),
        "mapping_method": F.when(exact, "ba_segment_provenance_nuts3").otherwise("ba_segment_radius_nuts3"),
    }
    return joined.select(*(F.when(taken, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in rows.columns))


def postcode_regions(crosswalk: DataFrame) -> DataFrame:
    """Status of each postcode: one region is mapped, several are ambiguous."""
    found = crosswalk.groupBy("postcode").agg(F.countDistinct("nuts_code").alias("n"), F.min("nuts_code").alias("first"))
    return found.select("postcode", F.when(F.col("n") == 1, F.col("first")).alias("nuts_code"), F.when(F.col("n") == 1, "mapped").otherwise("ambiguous").alias("mapping_status"))


# What each source's records have in common.
LANES = {
    "vdab": {"country": "BE", "source_language": "nl", "lang": "nl", "occupation_mapping_status": "not_present", "occupation_mapping_method": "not_available_vdab_html"},
    "cbop": {"country": "PL", "source_language": "pl", "lang": "pl", "occupation_mapping_status": "not_present", "occupation_mapping_method": "not_implemented"},
}


def normalised(rows: DataFrame, lane: dict[str, Column], fields: list[str], constants: dict[str, str] | None = None) -> DataFrame:
    """One source lane brought to the common fields: constants fill in, missing ones are null, others are dropped."""
    fixed = {k: F.lit(v) for k, v in (constants or {}).items()}
    return rows.select(*((lane | {k: v for k, v in fixed.items() if k not in lane}).get(f, F.lit(None).cast("string")).alias(f) for f in fields))
