"""Flows per day, week and month from a stream, each bucket told once when its end has passed the watermark.

Two stateful steps follow each other. The first adds up what belongs to one
sweep or one moment, and lets it go when the watermark has passed it. The
second keeps a bucket's openings and closures and the stock of its last sweep,
and tells them when a timer at the bucket's end fires; months have no fixed
width, so their ends are timers and not windows. Rows that come after the
watermark has passed their time are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.marts import GRAINS, SCOPE, masked_flows
from .closures import NEVER
from .state import state_on_disk

KEYS = [*SCOPE, "grain", "bucket_start", "bucket_end"]
FLOWS = "source string, scope_id string, grain string, bucket_start timestamp, bucket_end timestamp, o bigint, c bigint, s bigint, v bigint"
#: What a flow event may be.
OPENED, CLOSED, STOCK = "opened", "closed", "stock"


def flow_events(lifecycle: DataFrame, sweeps: DataFrame, postings: DataFrame) -> DataFrame:
    """(source, scope_id, kind, at, sweep_id, completed_at, n, vacancies): first sightings, closures, and the stock of sweeps, empty ones too."""
    none, time = F.lit(None).cast("string"), lambda c: F.col(c).cast("timestamp")
    nothing = F.lit(0).cast("long")
    opened = lifecycle.select(*SCOPE, F.lit(OPENED).alias("kind"), time("first_seen_at").alias("at"), none.alias("sweep_id"), F.lit(None).cast("timestamp").alias("completed_at"), F.lit(1).cast("long").alias("n"), nothing.alias("vacancies"))
    closed = lifecycle.where("closure_at IS NOT NULL").select(*SCOPE, F.lit(CLOSED).alias("kind"), time("closure_at").alias("at"), none.alias("sweep_id"), F.lit(None).cast("timestamp").alias("completed_at"), F.lit(1).cast("long").alias("n"), nothing.alias("vacancies"))
    swept = sweeps.select(*SCOPE, F.lit(STOCK).alias("kind"), time("observed_at").alias("at"), "sweep_id", time("completed_at").alias("completed_at"), nothing.alias("n"), nothing.alias("vacancies"))
    held = postings.select(*SCOPE, F.lit(STOCK).alias("kind"), time("observed_at").alias("at"), "sweep_id", F.lit(None).cast("timestamp").alias("completed_at"), F.lit(1).cast("long").alias("n"), F.coalesce(F.col("number_of_vacancies").cast("long"), nothing).alias("vacancies"))
    return opened.unionByName(closed).unionByName(swept).unionByName(held)


class Bucket(StatefulProcessor):
    """Openings, closures and the last sweep's stock of a bucket, told when its end has passed."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.flow = handle.getValueState("flow", "o bigint, c bigint, at bigint, completed bigint, sweep string, s bigint, v bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if self.flow.exists():
            o, c, *last = self.flow.get()
        else:
            o, c, last = 0, 0, [NEVER, NEVER, "", 0, 0]
            self.handle.registerTimer(int(pd.Timestamp(key[4]).timestamp() * 1000))
        for part in rows:
            for kind, at, completed, sweep, n, v in zip(part["kind"], part["at_micros"].tolist(), part["completed_micros"].tolist(), part["sweep_id"], part["n"].tolist(), part["vacancies"].tolist(), strict=True):
                if kind == OPENED:
                    o += n
                elif kind == CLOSED:
                    c += n
                elif (at, completed, sweep) >= tuple(last[:3]):
                    last = [at, completed, sweep, n, v]
        self.flow.update((o, c, *last))
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        o, c, at, _, _, s, v = self.flow.get()
        swept = at != NEVER
        self.flow.clear()
        yield pd.DataFrame({"source": [key[0]], "scope_id": [key[1]], "grain": [key[2]], "bucket_start": [key[3]], "bucket_end": [key[4]], "o": [o], "c": [c], "s": pd.array([s if swept else None], "Int64"), "v": pd.array([v if swept else None], "Int64")})

    def close(self) -> None:
        pass


def flows(events: DataFrame, delay: str) -> DataFrame:
    """Stream of finished buckets (source, scope_id, grain, bucket_start, bucket_end, o, c, s, v); stock is null without a sweep.

    ``delay`` is how long after the newest row a row may still come.
    """
    sums = events.withWatermark("at", delay).groupBy(*SCOPE, "kind", "sweep_id", "at").agg(F.sum("n").alias("n"), F.sum("vacancies").alias("vacancies"), F.max("completed_at").alias("completed_at"))
    grained = sums.withColumn("grain", F.explode(F.array(*map(F.lit, GRAINS))))
    start = F.when(F.col("grain") == "day", F.date_trunc("day", "at")).when(F.col("grain") == "week", F.date_trunc("week", "at")).otherwise(F.date_trunc("month", "at"))
    one = F.when(F.col("grain") == "day", F.expr("interval 1 day")).when(F.col("grain") == "week", F.expr("interval 7 day"))
    placed = grained.withColumn("bucket_start", start).withColumn("bucket_end", F.when(F.col("grain") == "month", F.add_months(F.to_date("bucket_start"), 1).cast("timestamp")).otherwise(F.col("bucket_start") + one))
    told = placed.select(*KEYS, "at", "kind", F.coalesce("sweep_id", F.lit("")).alias("sweep_id"), "n", "vacancies", F.unix_micros("at").alias("at_micros"), F.coalesce(F.unix_micros("completed_at"), F.lit(NEVER)).alias("completed_micros"))
    return told.groupBy(*KEYS).transformWithStateInPandas(Bucket(), FLOWS, "Append", "EventTime")


def run(finished: DataFrame, store: str, partitions: int | None = None) -> None:
    """Add the buckets that what is there finishes to ``store``."""
    with state_on_disk(finished.sparkSession, partitions):
        query = finished.writeStream.format("parquet").option("path", f"{store}/flows").option("checkpointLocation", f"{store}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()


def finished_flows(spark: SparkSession, store: str) -> DataFrame:
    """The finished buckets as the batch mart tells them, small counts masked."""
    told = spark.read.schema(FLOWS).parquet(f"{store}/flows")
    return masked_flows(told.withColumn("bucket_start", F.col("bucket_start").cast("timestamp_ntz")), [*SCOPE, "grain", "bucket_start"])
