"""What each source tells of a posting, brought to one record: a payload's fields, its region and occupation, and what the source's records have in common."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import dutch_date, iso_time, position_count
from . import mapping

#: Fields of a record, in their order; the source, scope and sweep are added by who collects.
FIELDS = (
    "source_id", "first_published", "last_modified", "removed_at", "nuts_code", "nuts_label", "region_mapping_status", "region_mapping_method", "country", "esco_occupation_uri", "esco_occupation_label", "occupation_mapping_status",
    "occupation_mapping_confidence", "occupation_mapping_method", "source_language", "jobtech_taxonomy_version", "esco_version", "skill_mappings", "lang", "number_of_vacancies",
)
REGION = ("nuts_code", "nuts_label", "region_mapping_status", "region_mapping_method")
SKILLS = "array<struct<uri:string,status:string,method:string,jobtech_taxonomy_version:string,esco_version:string>>"
ESCO_VERSION = "1.2.1"

# The payloads' fields that are read, nothing else of a payload is.
ADZUNA = "id string, created string, category struct<tag:string>"
VDAB = "native_id string, online_since string, postcode string"
CBOP = "native_id string, first_published string, nuts_code string, nuts_label string"
ADDRESS = "struct<kraj:struct<id:string>>"
MPSV = (
    "portalId string, datumVlozeni string, datumZmeny string, expirace string, pocetMist int, "
    f"mistoVykonuPrace struct<pracoviste:array<struct<adresa:{ADDRESS}>>,okresy:array<struct<id:string>>,obec:struct<id:string>>, prvniKontaktSeZamestnavatelem struct<kdeSeHlasit:struct<adresa:{ADDRESS}>>"
)
FRANCE = "id string, dateCreation string, dateActualisation string, nombrePostes int, romeCode string, lieuTravail struct<commune:string,codePostal:string,libelle:string>"
NAV = (
    "native_id string, status string, sist_endret string, date_modified string, feed_municipal string, "
    "detail struct<ad_content:struct<published:string,updated:string,positioncount:string,workLocations:array<struct<county:string,municipal:string,country:string>>,categoryList:array<struct<categoryType:string,code:string,score:double>>>>"
)
TMT = (
    "native_id string, application struct<published:string,openPositions:int>, metadata struct<created:string,lastModified:string,archived:string>, "
    "position struct<mainOccupation:string,occupations:array<string>,skills:array<string>>, location struct<municipalities:array<string>,regions:array<string>>, languages array<string>"
)
BA = "native_id string, first_published string, location_city string, segment_nuts3 string, segment_nuts1 string, umkreis int"


@dataclass
class Lane:
    """One source: the schema of its payload, its country and language, and how its records are made of (payload, references)."""

    payload: str
    country: str
    language: str
    make: object


def _record(rows: DataFrame, lane: Lane, told: dict[str, Column]) -> DataFrame:
    """``rows`` as records: what the lane tells, and what all records have unless it tells another."""
    common = {
        "country": F.lit(lane.country), "source_language": F.lit(lane.language), "lang": F.lit(lane.language), "occupation_mapping_status": F.lit("not_present"), "jobtech_taxonomy_version": F.lit(""), "esco_version": F.lit(ESCO_VERSION),
        "skill_mappings": F.array().cast(SKILLS), "number_of_vacancies": F.lit(1),
    }
    kinds = {"first_published": "timestamp_ntz", "last_modified": "timestamp_ntz", "removed_at": "timestamp_ntz", "skill_mappings": SKILLS, "number_of_vacancies": "bigint"}
    return rows.select(*((common | told).get(f, F.lit(None)).cast(kinds.get(f, "string")).alias(f) for f in FIELDS))


def _region(rows: DataFrame) -> DataFrame:
    return rows.withColumnsRenamed({"mapping_status": "region_mapping_status", "mapping_method": "region_mapping_method"})


def _regions() -> dict[str, Column]:
    return {c: F.col(c) for c in REGION}


def _adzuna(p: DataFrame, lane: Lane, refs: dict) -> DataFrame:
    told = {"source_id": F.col("id"), "first_published": iso_time(F.col("created")), "region_mapping_status": F.lit("not_present"), "region_mapping_method": F.lit("adzuna_location_text_deferred"), "occupation_mapping_method": F.lit("deferred_adzuna_category_to_esco")}
    return _record(p, lane, told)


def _vdab(p: DataFrame, lane: Lane, refs: dict) -> DataFrame:
    found = _region(mapping.postcode_region(p, "native_id", refs["postcodes"]))
    return _record(found, lane, _regions() | {"source_id": F.col("native_id"), "first_published": dutch_date(F.col("online_since")), "occupation_mapping_method": F.lit("not_available_vdab_html")})


def _cbop(p: DataFrame, lane: Lane, refs: dict) -> DataFrame:
    known = F.coalesce(F.col("nuts_code") != "", F.lit(False))
    region = {"region_mapping_status": F.when(known, "mapped").otherwise("not_present"), "region_mapping_method": F.when(known, "cbop_region").otherwise("not_available")}
    return _record(p, lane, {"source_id": F.col("native_id"), "first_published": iso_time(F.col("first_published")), "nuts_code": F.col("nuts_code"), "nuts_label": F.col("nuts_label"), "occupation_mapping_method": F.lit("not_implemented")} | region)


def _mpsv(p: DataFrame, lane: Lane, refs: dict) -> DataFrame:
    ids = lambda values: F.filter(F.coalesce(values, F.array().cast("array<string>")), lambda v: F.coalesce(v != "", F.lit(False)))
    place = F.col("mistoVykonuPrace")
    spread = p.withColumns({
        "work_regions": ids(F.transform(place["pracoviste"], lambda w: w["adresa"]["kraj"]["id"])), "districts": ids(F.transform(place["okresy"], lambda o: o["id"])), "municipality": F.nullif(place["obec"]["id"], F.lit("")),
        "contact_region": F.col("prvniKontaktSeZamestnavatelem.kdeSeHlasit.adresa.kraj.id"),
    })
    found = _region(mapping.czech_region(spread, "portalId", refs["codes"]))
    return _record(found, lane, _regions() | {"source_id": F.col("portalId"), "first_published": iso_time(F.col("datumVlozeni")), "last_modified": iso_time(F.col("datumZmeny")), "number_of_vacancies": F.col("pocetMist"), "occupation_mapping_method": F.lit("deferred_cz_isco_to_esco")})


def _france(p: DataFrame, lane: Lane, refs: dict) -> DataFrame:
    spread = p.select("*", F.col("lieuTravail.commune").alias("commune"), F.col("lieuTravail.codePostal").alias("postcode"), F.col("lieuTravail.libelle").alias("label"))
    found = _region(mapping.french_region(spread, "id", refs["departements"]))
    coded = F.coalesce(F.col("romeCode") != "", F.lit(False))
    told = {"source_id": F.col("id"), "first_published": iso_time(F.col("dateCreation")), "last_modified": iso_time(F.col("dateActualisation")), "number_of_vacancies": F.greatest(F.lit(0), F.coalesce("nombrePostes", F.lit(1)))}
    return _record(found, lane, _regions() | told | {"occupation_mapping_status": F.when(coded, "unmapped").otherwise("not_present"), "occupation_mapping_method": F.lit("deferred_rome_to_esco")})


def _nav(p: DataFrame, lane: Lane, refs: dict) -> DataFrame:
    ad = F.col("detail.ad_content")
    stated = lambda c: F.nullif(c, F.lit(""))
    moved = F.coalesce(stated(F.col("sist_endret")), F.col("date_modified"))
    spread = p.withColumn("locations", F.coalesce(ad["workLocations"], F.array().cast("array<struct<county:string,municipal:string,country:string>>")))
    found = _region(mapping.norwegian_region(spread, "native_id", refs["counties"], refs["municipalities"]))
    job = mapping.norwegian_occupation(ad["categoryList"])
    gone = F.upper(F.trim(F.coalesce("status", F.lit("")))) == "INACTIVE"
    told = {
        "source_id": F.col("native_id"), "first_published": iso_time(ad["published"]), "last_modified": iso_time(F.coalesce(stated(ad["updated"]), moved)), "removed_at": F.when(gone, iso_time(moved)), "number_of_vacancies": position_count(ad["positioncount"]),
        "esco_occupation_uri": job["uri"], "occupation_mapping_status": job["status"], "occupation_mapping_confidence": job["confidence"], "occupation_mapping_method": job["method"],
    }
    return _record(found, lane, _regions() | told)


def _tmt(p: DataFrame, lane: Lane, refs: dict) -> DataFrame:
    spread = p.select("*", F.col("location.municipalities").alias("municipalities"), F.col("location.regions").alias("regions"))
    found = _region(mapping.finnish_region(spread, "native_id", refs["kunta"]))
    job = mapping.finnish_occupation(F.col("position.mainOccupation"), F.col("position.occupations"))
    tongue = F.lower(F.trim(F.get(F.filter(F.coalesce("languages", F.array().cast("array<string>")), lambda v: F.coalesce(F.trim(v) != "", F.lit(False))), F.lit(0))))
    tongue = F.coalesce(tongue, F.lit(lane.language))
    skills = F.transform(mapping.finnish_skills(F.col("position.skills")), lambda s: F.struct(s["uri"].alias("uri"), s["status"].alias("status"), s["method"].alias("method"), F.lit("").alias("jobtech_taxonomy_version"), F.lit(ESCO_VERSION).alias("esco_version")))
    published = F.coalesce(F.nullif("application.published", F.lit("")), F.col("metadata.created"))
    told = {
        "source_id": F.col("native_id"), "first_published": iso_time(published), "last_modified": iso_time(F.col("metadata.lastModified")), "removed_at": iso_time(F.col("metadata.archived")), "number_of_vacancies": F.greatest(F.lit(0), F.coalesce("application.openPositions", F.lit(1))),
        "esco_occupation_uri": job["uri"], "occupation_mapping_status": job["status"], "occupation_mapping_method": job["method"], "skill_mappings": skills, "source_language": tongue, "lang": tongue,
    }
    return _record(found, lane, _regions() | told)


def _ba(p: DataFrame, lane: Lane, refs: dict) -> DataFrame:
    spread = p.withColumnsRenamed({"location_city": "city", "umkreis": "radius"}).withColumn("radius", F.coalesce("radius", F.lit(0)))
    found = _region(mapping.segment_provenance(mapping.german_location(spread, "native_id", refs["towns"]), refs["labels"]))
    return _record(found, lane, _regions() | {"source_id": F.col("native_id"), "first_published": iso_time(F.col("first_published")), "occupation_mapping_method": F.lit("not_available_ba_html")})


LANES = {
    "adzuna_de": Lane(ADZUNA, "DE", "de", _adzuna),
    "adzuna_nl": Lane(ADZUNA, "NL", "nl", _adzuna),
    "vdab": Lane(VDAB, "BE", "nl", _vdab),
    "cbop": Lane(CBOP, "PL", "pl", _cbop),
    "mpsv": Lane(MPSV, "CZ", "cs", _mpsv),
    "france_travail": Lane(FRANCE, "FR", "fr", _france),
    "nav": Lane(NAV, "NO", "no", _nav),
    "tmt": Lane(TMT, "FI", "fi", _tmt),
    "ba": Lane(BA, "DE", "de", _ba),
}


def records(payloads: DataFrame, name: str, references: dict[str, DataFrame], payload: str = "payload") -> DataFrame:
    """Records (``FIELDS``) of a source's ``payloads`` (JSON text); native ids are still to be replaced by pseudonyms.

    Fields of a payload that are not read never leave it. Payloads that are no
    JSON are left out, as are those without an id. Ids have to tell the
    payloads apart.
    """
    lane = LANES[name]
    read = payloads.select(F.from_json(payload, lane.payload).alias("p")).select("p.*")
    key = read.columns[0]
    return lane.make(read.where(F.coalesce(F.col(key) != "", F.lit(False))), lane, references)
