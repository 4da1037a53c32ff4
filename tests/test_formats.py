"""Old table formats, nested documents, filters and bitmaps on small awkward inputs."""

import struct

from pyspark.sql import functions as F

from tidemark.operators import breadth, documents, filters
from tidemark.sources import dbf, storage, xlsx


def dbf_bytes(records, fields, claimed=None):
    head = struct.pack("<B3sIHH20x", 3, b"\0\0\0", len(records) if claimed is None else claimed, 32 + 32 * len(fields) + 1, 1 + sum(w for _, w in fields))
    return head + b"".join(struct.pack("<11sc4xB15x", n.encode(), b"C", w) for n, w in fields) + b"\r" + b"".join(records)


def test_dbf_records_in_ranges(spark, tmp_path):
    fields = [("NAME", 6), ("CODE", 3)]
    records = [b" Ulm   089", b"*gone  000", " Köln1   ".encode(), b" \xff bad 2  ", b" short"]
    (tmp_path / "a.dbf").write_bytes(dbf_bytes(records, fields, 9))
    (tmp_path / "b.DBF").write_bytes(dbf_bytes([b" second x "], fields))
    (tmp_path / "c.txt").write_bytes(b"no table")
    wanted = [("Ulm", "089"), ("Köln1", ""), ("� bad", "2"), ("second", "x")]
    for records_a_range in (1, 2, 1000):
        found = dbf.read_dbf(spark, f"file://{tmp_path}", records=records_a_range)
        assert found.columns == ["NAME", "CODE"] and sorted(map(tuple, found.collect())) == sorted(wanted)
    assert ("gone", "000") in {tuple(r) for r in dbf.read_dbf(spark, f"file://{tmp_path}", deleted=True).collect()}


def test_dbf_refuses_what_does_not_fit_and_takes_empty_tables(spark, tmp_path):
    rows = spark.createDataFrame([("too long for it",)], "a string")
    try:
        dbf.write_dbf(rows, f"file://{tmp_path}/bad", {"a": 3})
        raise AssertionError("it was written")
    except Exception as error:
        assert "more than 3 bytes" in str(error)
    dbf.write_dbf(rows.limit(0), f"file://{tmp_path}/none", {"a": 3})
    assert dbf.read_dbf(spark, f"file://{tmp_path}/none").count() == 0


def test_xlsx_rows_with_gaps_and_without_strings(spark):
    book = xlsx.make_book("A & B", [["x", None, "y"], [None, None], ["x"] + [None] * 26 + ["z <>"]])
    books = spark.createDataFrame([("one", bytearray(book)), ("none", None), ("other", bytearray(xlsx.make_book("C", [["q"]])))], "path string, content binary")
    found = xlsx.pieces(books, "A & B")
    rows = {r.row: r.values for r in xlsx.sheet_rows(found).collect()}
    assert rows == {0: ["x", "y"], 1: [], 2: ["x", "z <>"]}
    filled = {r.row: r.values for r in xlsx.sheet_rows(found, gaps=True).collect()}
    assert filled[0] == ["x", "", "y"] and filled[1] == [] and filled[2] == ["x", *[""] * 26, "z <>"]
    refs = spark.createDataFrame([("A1",), ("Z9",), ("AA10",), ("AB7",), (None,)], "r string")
    assert [r[0] for r in refs.select(xlsx.column_number(F.col("r"))).collect()] == [0, 25, 26, 27, None]


def test_documents_are_walked_to_any_depth(spark):
    deep = "[" * 40 + '{"total": 5}' + "]" * 40
    rows = spark.createDataFrame([(1, '{"a": {"hits": 3, "b.c": [1, [2, {"x": null}], true, "cut"]}, "e": {}, "f": []}'), (2, deep), (3, "7"), (4, None), (5, "{broken")], "id int, doc string")
    found = {(r.id, r.path): (r.value, r.kind) for r in documents.walk(rows, "id", "doc").collect()}
    assert found[1, "a.hits"] == ("3", "BIGINT") and found[1, "a.b.c[1][1].x"] == ("null", "VOID") and found[1, "a.b.c[2]"] == ("true", "BOOLEAN")
    assert (1, "a.b.c[3]") not in found and found[1, "e"][0] == "{}" and found[1, "f"][0] == "[]"
    assert found[2, "[0]" * 40 + ".total"] == ("5", "BIGINT")
    assert {k[0] for k in found} == {1, 2}
    counts = {(r.id, r.path) for r in documents.count_leaves(documents.walk(rows, "id", "doc")).collect()}
    assert counts == {(1, "a.hits"), (2, "[0]" * 40 + ".total")}
    whole = {r.path for r in documents.walk(rows, "id", "doc", first=None).where("id = 1").collect()}
    assert "a.b.c[3]" in whole


def test_filters_never_drop_rows_that_lack_the_attribute(spark):
    rows = spark.createDataFrame([("SE", "x", "2024-01"), ("SE", None, "2024-02"), ("DE", "x", None), (None, "y", "2024-03"), ("", "", "2023-01")], "country string, skill string, bucket string")
    some = lambda wanted, *bounds: sorted((r.country or "", r.skill or "", r.bucket or "") for r in filters.matching(rows, wanted, *bounds).collect())
    assert some({"country": "SE"}) == [("", "", "2023-01"), ("", "y", "2024-03"), ("SE", "", "2024-02"), ("SE", "x", "2024-01")]
    assert some({"country": "SE' OR '1'='1"}) == [("", "", "2023-01"), ("", "y", "2024-03")]
    assert some({"country": None, "skill": "x"}, "2024-01", "2024-02") == [("DE", "x", ""), ("SE", "", "2024-02"), ("SE", "x", "2024-01")]
    assert len(some({})) == 5
    counts = {(r.country, r.skill): r.n for r in filters.filter_counts(rows, ["country", "skill"]).collect()}
    assert counts == {(None, None): 5, ("SE", None): 4, ("DE", None): 3, (None, "x"): 4, (None, "y"): 3, ("SE", "x"): 3, ("DE", "x"): 2}
    dims = spark.createDataFrame([("region", 1), ("skill", 2)], "dimension string, n int")
    assert [r.n for r in filters.by_dimension(dims, True).collect()] == [1] and [r.n for r in filters.by_dimension(dims, False).collect()] == [2]


def test_bitmaps_of_many_codes(spark):
    codes = spark.range(70_000).select(F.concat(F.lit("c"), "id").alias("code"), (F.col("id") % 3).alias("sweep"))
    rows = codes.unionByName(codes.where("sweep = 0").withColumn("sweep", F.lit(1).cast("long"))).unionByName(spark.createDataFrame([(None, 9), ("", 9)], "code string, sweep long"))
    bits = breadth.sweep_bitmaps(rows, ["sweep"], "code")
    assert {r.sweep: r.breadth for r in breadth.union_breadth(bits, ["sweep"]).collect()} == {0: 23334, 1: 46667, 2: 23333}
    assert breadth.union_breadth(bits.where("sweep < 2"), []).first().breadth == 46667
    assert breadth.common_breadth(bits.where("sweep < 2").withColumn("g", F.lit(1)), ["g"], 2).first().breadth == 23334


def test_places_of_rows_across_ranges(spark):
    placed, total = storage.numbered(spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(7), ["v"])
    assert total == 1000 and all(r.v == r.place for r in placed.collect())
    none, total = storage.numbered(spark.range(0).select(F.col("id").alias("v")), ["v"])
    assert total == 0 and none.count() == 0


def test_a_member_named_like_an_empty_array_is_walked(spark):
    rows = spark.createDataFrame([(1, '{"[]":{"a":1},"b":[],"c":null}')], "id int, doc string")
    found = {(r.path, r.value, r.kind) for r in documents.walk(rows, "id", "doc").collect()}
    assert found == {("[]", '{"a":1}', "OBJECT"), ("[].a", "1", "BIGINT"), ("b", "[]", "ARRAY"), ("c", "null", "VOID")}
