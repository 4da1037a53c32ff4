"""Streams, polls, feeds and resumed sweeps over the posting model and the event table, with their SQL over the whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import commit, feed
from ..sources.storage import new_path
from ..streaming import buckets, closures, marks
from .adapter import FLOW_PARTS, model, read, stock_cte, with_ctes

#: Days of the month that part the arrivals of streams and polls.
CUTS = (11, 21)
DELAY_DAYS = 2
#: Partitions of the streams' state; the tables here have few scopes.
STATES = 8


def _arrivals(rows: DataFrame, part, path: str) -> None:
    """``rows`` under ``path``, in folders part=0, 1, 2 by the column ``part``."""
    rows.withColumn("part", part).write.partitionBy("part").parquet(path)


def closures_as_sweeps_arrive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sweeps arrive in three batches that are not in the order of time, their sightings before or after them."""
    m, path = model(spark, sf_dir), new_path(spark, "closures")
    dealt = F.conv(F.substring("sweep_id", 1, 2), 16, 10).cast("int")
    _arrivals(m.postings.select(*closures.IDENTITY, "observed_at", "sweep_id", "removed_at"), dealt % 3, f"{path}/postings")
    _arrivals(m.sweeps.select(*closures.CALENDAR, "observed_at", "sweep_id"), (dealt + 1) % 3, f"{path}/sweeps")
    for part in range(3):
        for name in ("postings", "sweeps"):
            spark.read.parquet(f"{path}/{name}").where(F.col("part") == part).drop("part").write.mode("append").parquet(f"{path}/arrived/{name}")
        stream = [spark.readStream.schema(spark.read.parquet(f"{path}/{n}").drop("part").schema).parquet(f"{path}/arrived/{n}") for n in ("postings", "sweeps")]
        closures.run(closures.closure_changes(*stream, buckets=4), f"{path}/store", STATES)
    return closures.closures(spark, f"{path}/store")


def flows_as_time_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flow events arrive in three batches and then some again that are too late; the buckets whose end the watermark has passed."""
    m, path = model(spark, sf_dir), new_path(spark, "flows")
    events = buckets.flow_events(m.lifecycle(), m.sweeps, m.postings)
    day = F.dayofmonth("at")
    arrivals = [events.where(day < CUTS[0]), events.where((day >= CUTS[0]) & (day < CUTS[1])), events.where(day >= CUTS[1]), events.where(day < 5)]
    for arrival in arrivals:
        arrival.write.mode("append").parquet(f"{path}/arrived")
        buckets.run(buckets.flows(spark.readStream.schema(events.schema).parquet(f"{path}/arrived"), f"{DELAY_DAYS} days"), f"{path}/store", STATES)
    return buckets.finished_flows(spark, f"{path}/store")


FLOWS_SQL = with_ctes(
    f"""SELECT f.* FROM flows f, (SELECT date_trunc('milliseconds', max(moment)) - INTERVAL {DELAY_DAYS} DAY AS mark
FROM (SELECT first_seen_at AS moment FROM lifecycle UNION ALL SELECT closure_at FROM lifecycle UNION ALL SELECT observed_at FROM sweeps))
WHERE bucket_start + CASE grain WHEN 'day' THEN INTERVAL 1 DAY WHEN 'week' THEN INTERVAL 7 DAY ELSE INTERVAL 1 MONTH END <= mark""",
    FLOW_PARTS | {"stock": stock_cte("stock_of_sweep")},
)


def marked_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three polls of the events, the second cut short by its budget and repeated: what each status's polls saw and marked."""
    time = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    events = read(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("status"), time.alias("modified"), F.dayofmonth("ts").alias("day"))
    polls = marks.MarkedFeed(spark, new_path(spark, "marks"))
    polls.poll(events.where(F.col("day") < CUTS[0]), 0)
    for _ in range(2):
        polls.poll(events.where(F.col("day") < CUTS[1]), 1, budget=50)
    polls.poll(events, 2)
    return polls.marks()


MARKS_SQL = f"""WITH ev AS (SELECT event_type AS status, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS modified, day(ts) AS day FROM events),
m0 AS (SELECT status, max(modified) AS mark, count(*) AS rows_seen, 0 AS rows_left, 0 AS batch FROM ev WHERE day < {CUTS[0]} GROUP BY 1),
m1 AS (SELECT status, CASE WHEN count(*) <= 50 THEN max(modified) END AS mark, least(count(*), 50) AS rows_seen, greatest(count(*) - 50, 0) AS rows_left, 1 AS batch FROM ev LEFT JOIN m0 USING (status) WHERE day < {CUTS[1]} AND (mark IS NULL OR modified >= mark) GROUP BY status),
since AS (SELECT status, coalesce(m1.mark, m0.mark) AS mark FROM m1 FULL JOIN m0 USING (status)),
m2 AS (SELECT status, max(modified) AS mark, count(*) AS rows_seen, 0 AS rows_left, 2 AS batch FROM ev LEFT JOIN since USING (status) WHERE mark IS NULL OR modified >= mark GROUP BY status)
SELECT status, mark, rows_seen, CAST(rows_left AS BIGINT) AS rows_left, CAST(batch AS BIGINT) AS batch FROM (SELECT * FROM m0 UNION ALL SELECT * FROM m1 UNION ALL SELECT * FROM m2)"""

PER_PAGE = 200


def feed_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed of the events is read when half of it is recorded, and again when its tail has grown and pages have followed."""
    spark.dataSource.register(feed.RecordedFeed)
    events = read(spark, sf_dir, "events").select("ts", "event_id", F.to_json(F.struct("event_id", "event_type")).alias("item"), F.dayofmonth("ts").alias("day"))
    path = new_path(spark, "feed")
    for some in (events.where("day < 15"), events, events):
        feed.record_pages(some, [F.col("ts"), F.col("event_id")], PER_PAGE, f"{path}/pages")
        stream = spark.readStream.format("recorded_feed").option("path", f"{path}/pages").option("cursor_path", f"{path}/cursor/at.json").load()
        stream.writeStream.format("parquet").option("path", f"{path}/taken").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    taken = spark.read.parquet(f"{path}/taken")
    return taken.select("page", "place", F.get_json_object("item", "$.event_id").cast("long").alias("event_id"))


FEED_SQL = f"SELECT '/feed/' || (n // {PER_PAGE}) AS page, CAST(n % {PER_PAGE} AS INTEGER) AS place, event_id FROM (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS n FROM events)"


def sweep_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written as a sweep of pages with a manifest: each page's rows and hashes as the manifest tells them."""
    rows = read(spark, sf_dir, "customer").select(F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("source_id"), F.col("c_mktsegment").alias("segment"), "c_nationkey")
    path = new_path(spark, "sweep")
    commit.write_sweep(rows, {"source": "customers", "scope_id": "all", "sweep_id": "s1"}, path, PER_PAGE)
    told = spark.read.json(f"{path}/manifest.json").where("status = 'complete'").select(F.explode("pages").alias("p"))
    return told.select(F.col("p.index").alias("page"), F.col("p.row_count").alias("row_count"), F.col("p.safe_hash").alias("safe_hash"), F.col("p.ids_hash").alias("ids_hash"))


SWEEP_SQL = f"""WITH rows AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS id, c_mktsegment AS segment, c_nationkey FROM customer),
placed AS (SELECT id, '{{"c_nationkey":' || c_nationkey || ',"segment":"' || segment || '","source_id":"' || id || '"}}' AS line, (row_number() OVER (ORDER BY id) - 1) // {PER_PAGE} AS page FROM rows)
SELECT CAST(page AS BIGINT) AS page, count(*) AS row_count, sha256(string_agg(line || chr(10), '' ORDER BY id)) AS safe_hash, sha256(string_agg(id, chr(10) ORDER BY id)) AS ids_hash FROM placed GROUP BY page"""

QUERIES = {
    "closures_as_sweeps_arrive": (closures_as_sweeps_arrive, with_ctes("SELECT * FROM closures")),
    "flows_as_time_passes": (flows_as_time_passes, FLOWS_SQL),
    "marked_polls": (marked_polls, MARKS_SQL),
    "feed_resumed": (feed_resumed, FEED_SQL),
    "sweep_pages": (sweep_pages, SWEEP_SQL),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for name, (query, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in QUERIES.items()}
