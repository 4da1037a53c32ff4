"""Readers and writers, by round trips through small files of the sources' shapes."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators import checks, events, staging
from tidemark.sources import readers, writers

MANIFEST = {"source": "jobtech", "scope_id": "se", "sweep_id": "s1", "observed_at": "2026-08-03 09:00:00", "started_at": "2026-08-03 09:00:00", "completed_at": "2026-08-03 10:00:00", "expected_pages": 1, "completed_pages": 1, "expected_rows": 2, "hmac_key_version": "v1", "freshness_threshold_hours": 48}


def observation(source_id, **more):
    return {"source": "jobtech", "source_id": source_id, "scope_id": "se", "sweep_id": "s1", "observed_at": "2026-08-03 09:00:00", "country": "SE"} | more


def test_a_partition_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([json.dumps(r) for r in (observation("a", first_published="2026-08-01T08:00:00", removed_at="soon", skill_mappings=[{"uri": "u", "status": "mapped"}]), observation("b", number_of_vacancies=3, nuts_code="SE110"))], "string")
    observed = rows.select(F.from_json("value", readers.OBSERVATION).alias("r")).select("r.*")
    for sweep, expected in (("s1", 2), ("s2", 3)):
        told = writers.write_partition(observed, MANIFEST | {"sweep_id": sweep, "expected_rows": expected}, f"{tmp_path}/jobtech/se/{sweep}")
        assert told["status"] == ("complete" if expected == 2 else "partial") and told["row_count"] == 2
    found = readers.manifests(spark, readers.partition_glob(str(tmp_path), "manifest.json"), pretty=True)
    assert found.count() == 2 and dict(found.dtypes)["observed_at"] == "timestamp_ntz" and staging.admitted(found).count() == 1
    back = readers.observations(spark, f"{tmp_path}/jobtech/se/s1/observations")
    labels = staging.nuts_labels([spark.createDataFrame([("SE110", "Stockholm")], "nuts_code string, nuts_label string")])
    posted = {r.source_id: r for r in staging.staged_postings(back, staging.admitted(found), labels).collect()}
    assert set(posted) == {"a", "b"} and posted["b"].nuts_label == "Stockholm" and posted["a"].removed_at is None and posted["a"].first_published is not None
    assert checks.orphan_observations(readers.observation_keys(spark, f"{tmp_path}/jobtech/se/s1/observations"), found).count() == 0
    assert events.closures(staging.staged_postings(back, staging.admitted(found), labels), staging.admitted(found)).count() == 0


def test_csv_files_merge_by_name(spark, tmp_path):
    for name, text in (("a", "nuts_code,nuts_label\nSE110,Stockholm\n"), ("b", "nuts_label,source_version,nuts_code\nA first,2024,SE110\nSkåne,2024,SE224\n")):
        (tmp_path / f"{name}.csv").write_text(text)
    found = readers.csv_files(spark, [f"{tmp_path}/{n}.csv" for n in "ab"])
    assert {tuple(r) for r in staging.nuts_labels([found]).collect()} == {("SE110", "A first"), ("SE224", "Skåne")}


def test_malformed_lines_are_counted(spark, tmp_path):
    (tmp_path / "s.ndjson").write_text('{"id": "1"}\n{broken\n\n{"id": "2"}\n')
    good, bad = readers.lines(spark, f"{tmp_path}/s.ndjson", "id string")
    assert {r.id for r in good.collect()} == {"1", "2"} and bad.first().malformed == 1


def test_dumps_pages_and_maps(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps({"polozky": [{"portalId": 1}, {"portalId": 2}]}, indent=1))
    assert readers.dump_items(spark, f"{tmp_path}/d.json", "polozky", "struct<portalId:bigint>").count() == 2
    (tmp_path / "p.json").write_text(json.dumps({"total": {"value": 7}, "hits": [{"id": "x"}]}))
    assert [tuple(r) for r in readers.recorded_hits(spark, f"{tmp_path}/p.json", "struct<id:string>").select("total", "hit.id").collect()] == [(7, "x")]
    xml = '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc> https://a/1 </loc></url><url><loc>https://a/2</loc></url><loc></loc></urlset>'
    pages = spark.createDataFrame([(xml,), ("<broken",), (None,)], "xml string")
    assert [r.location for r in readers.sitemap_locations(pages).orderBy("place").collect()] == ["https://a/1", "https://a/2"]
    html = '<script>{"suchergebnis":{"maxErgebnisse": 42},"woOutput":{"bereinigterOrt":"Hof, Saale","suchmodus":"EXAKT"}}</script>'
    envelope = spark.createDataFrame([(html,), ("<p/>",)], "html string").select(readers.search_envelope(F.col("html")).alias("e")).select("e.*").collect()
    assert [tuple(r) for r in envelope] == [(42, "Hof, Saale", "EXAKT"), (None, None, None)]


def test_allowlist_pseudonyms_and_exports(spark, tmp_path):
    rows = spark.createDataFrame([("jobtech", "b", "x"), ("jobtech", "a", "y")], "source string, source_id string, employer string")
    with pytest.raises(ValueError, match="employer"):
        writers.write_allowed(rows, ["source", "source_id"], f"{tmp_path}/no")
    key = b"k" * 32
    safe = writers.sanitized(rows, ["source", "source_id"], key)
    assert safe.columns == ["source", "source_id"]
    assert {r.source_id for r in safe.collect()} == {r.p for r in rows.select(C.pseudonym_of_source(key, F.col("source"), F.col("source_id")).alias("p")).collect()}
    with pytest.raises(Exception, match="must not be empty"):
        writers.sanitized(rows.withColumn("source_id", F.lit("")), ["source_id"], key).collect()
    writers.write_allowed(safe, ["source", "source_id"], f"{tmp_path}/yes")
    assert spark.read.json(f"{tmp_path}/yes").count() == 2
    writers.write_sorted(rows, f"{tmp_path}/sorted")
    assert [r.source_id for r in spark.read.json(f"{tmp_path}/sorted").collect()] == ["a", "b"]
    writers.write_parquet(rows, f"{tmp_path}/table")
    writers.write_csv(rows, f"{tmp_path}/csv")
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").count() == spark.read.parquet(f"{tmp_path}/table").count() == 2
    told = writers.payload({"demand": rows.select("source", "source_id"), "names": rows.select("source", "employer")}, ["source"]).first()
    assert json.loads(told.payload)["demand"] == ['{"source_id":"a"}', '{"source_id":"b"}']


@pytest.mark.parametrize("split", ["4k", "1m"])
def test_places_of_lines_in_files_that_are_split(spark, tmp_path, split):
    rows = spark.range(3000).select(F.format_string("%05d", 2999 - F.col("id")).alias("source_id"))
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        writers.write_sorted(rows, f"{tmp_path}/sorted")
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        found = sorted((r.place, json.loads(r.value)["source_id"]) for r in readers.numbered_lines(spark, f"{tmp_path}/sorted").collect())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert found == [(k, f"{k:05d}") for k in range(3000)]
    assert len(list((tmp_path / "sorted").glob("part-*"))) == 4
