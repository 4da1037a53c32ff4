import hashlib
import hmac

from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.functions import columns as C


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_pseudonym_is_hmac_sha256(spark):
    names = ["a", "", "é☃", "x" * 300]
    table = spark.createDataFrame([(n,) for n in names], "s string")
    found = [r.h for r in table.select(C.hmac_sha256(b"key", F.col("s")).alias("h")).collect()]
    assert found == [hmac.new(b"key", n.encode(), hashlib.sha256).hexdigest() for n in names]


def one(spark, column, **values):
    table = spark.range(1)
    for name, value in values.items():
        table = table.withColumn(name, F.lit(value))
    return table.select(column.alias("x")).first().x


def test_boundaries_are_counted_not_spans(spark):
    at = lambda t: F.lit(t).cast("timestamp_ntz")
    assert one(spark, C.hour_boundaries(at("2024-01-01 10:59:59"), at("2024-01-01 11:00:00"))) == 1
    assert one(spark, C.day_boundaries(at("2024-01-01 23:59:59"), at("2024-01-02 00:00:00"))) == 1
    assert one(spark, C.second_boundaries(at("2024-01-01 00:00:00.9"), at("2024-01-01 00:00:01.1"))) == 1


def test_codes_and_counts(spark):
    assert [one(spark, C.zero_padded(F.lit(c), 3)) for c in ("7", "007", "12345")] == ["007", "007", "12345"]
    assert [one(spark, C.position_count(F.lit(c).cast("string"))) for c in ("3", "2.7", "-4", "x", None)] == [3, 2, 0, 1, 1]
    assert [one(spark, C.is_suppressed(F.lit(n))) for n in (0, 1, 4, 5)] == [False, True, True, False]


def test_iso_times_are_matched_once(spark):
    """The pattern stands twice in the plan, however many parts are taken; a zone without digits is not cast."""
    times = ["2024-03-05T10:20:30.1234567-0130", "20240305 23:59+01", "2024-03-05T01:02Z", "2024-03-05", "2024-02-30", "2024-03-05T01:02Z\n", "bad|2024-03-05", "", None]
    rows = spark.createDataFrame([(t,) for t in times], "t string").select(C.iso_time(F.col("t")).alias("found"))
    assert rows._jdf.queryExecution().analyzed().toString().count("(?:[T ]") <= 2
    stated = [r.found and str(r.found) for r in rows.collect()]
    assert stated == ["2024-03-05 11:50:30.123456", "2024-03-05 22:59:00", "2024-03-05 01:02:00", "2024-03-05 00:00:00", None, "2024-03-05 01:02:00", None, None, None]
