"""Payloads of the sources, broken and bare ones among them, as records."""

import json

from tidemark.operators import lanes


def made(spark, name, payloads, references=None):
    table = spark.createDataFrame([(p if p is None or isinstance(p, str) else json.dumps(p),) for p in payloads], "payload string")
    return {r.source_id: r for r in lanes.records(table, name, references or {}).collect()}


def test_payloads_without_an_id_or_a_form_are_left_out(spark):
    found = made(spark, "adzuna_nl", [None, "", "{broken", "[1]", {"id": ""}, {"id": None}, {"id": "7", "created": "nonsense", "company": "secret"}])
    assert list(found) == ["7"]
    record = found["7"].asDict()
    assert list(record) == list(lanes.FIELDS) and "secret" not in map(str, record.values())
    assert (record["country"], record["lang"], record["first_published"], record["number_of_vacancies"], record["skill_mappings"]) == ("NL", "nl", None, 1, [])


def test_bare_payloads_get_what_all_records_have(spark):
    places = spark.createDataFrame([("x", "XX1", "X")], "code string, nuts_code string, nuts_label string")
    towns = places.withColumnRenamed("code", "name")
    kunta = spark.createDataFrame([], "source_type string, source_code string, nuts_code string, nuts_label string")
    labels = places.select("nuts_code", "nuts_label")
    references = {"postcodes": places, "codes": places, "departements": places, "counties": towns, "municipalities": towns, "kunta": kunta, "towns": towns, "labels": labels}
    keys = {"mpsv": "portalId", "france_travail": "id", "adzuna_de": "id", "adzuna_nl": "id"}
    absent = {"adzuna_de": "not_present", "adzuna_nl": "not_present", "cbop": "not_present", "nav": "not_present", "tmt": "not_present"}
    for name, lane in lanes.LANES.items():
        record = made(spark, name, [{keys.get(name, "native_id"): "1"}], references)["1"]
        assert record.nuts_code is None and record.region_mapping_status == absent.get(name, "unmapped"), name
        assert (record.country, record.lang, record.occupation_mapping_status, record.skill_mappings) == (lane.country, lane.language, "not_present", []), name
        assert record.number_of_vacancies == (None if name == "mpsv" else 1), name


def test_what_only_some_sources_tell(spark):
    finnish = {"native_id": "1", "application": {"published": "", "openPositions": -3}, "metadata": {"created": "2024-01-02", "archived": "2024-02-01T00:00:00+02:00"}, "languages": [" ", " EN "]}
    kunta = spark.createDataFrame([], "source_type string, source_code string, nuts_code string, nuts_label string")
    record = made(spark, "tmt", [finnish], {"kunta": kunta})["1"]
    assert (str(record.first_published), str(record.removed_at), record.number_of_vacancies, record.lang) == ("2024-01-02 00:00:00", "2024-01-31 22:00:00", 0, "en")
    towns = spark.createDataFrame([], "name string, nuts_code string, nuts_label string")
    ads = [{"native_id": str(k), "status": status, "sist_endret": "", "date_modified": "2024-01-05"} for k, status in enumerate(["ACTIVE", "inactive "])]
    found = made(spark, "nav", ads, {"counties": towns, "municipalities": towns})
    assert found["0"].removed_at is None and str(found["1"].removed_at) == str(found["1"].last_modified) == "2024-01-05 00:00:00"
