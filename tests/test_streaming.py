from datetime import datetime, timedelta

import __spark_entry__ as entry


def test_dedupe_over_many_files_and_months(spark, tmp_path):
    """More files than one batch takes, over more days than any watermark."""
    start = datetime(2024, 1, 1)
    rows = [(i, i % 3, "view", start + timedelta(days=20 * (i * 7 % 40))) for i in range(40)]
    rows[39] = (39, 9, "view", start)  # a new key in the last batch, long before the others
    (tmp_path / "events.parquet").mkdir()
    for n in range(20):
        part = tmp_path / "events.parquet" / f"n={n}"
        part.mkdir()
        spark.createDataFrame(rows[2 * n : 2 * n + 2], "event_id long, user_id long, event_type string, ts timestamp").coalesce(1).toPandas().to_parquet(part / "events.parquet", coerce_timestamps="us")
    found = entry.queries()["stream_dedupe"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found)) == [(0, "view"), (1, "view"), (2, "view"), (9, "view")]
