"""High-water marks of feeds that are asked for what changed: one for each status, kept between runs.

A mark is the greatest change time, as text, that a finished run saw. It is
written by the batch that saw it, so a batch that is repeated writes the same
mark again; a run that a budget cut short leaves the mark alone, since rows
before its greatest may be missing. A mark of one status says nothing about
another.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MARKS = "mark string, rows_seen bigint, rows_left bigint, status string, batch bigint"


class MarkedFeed:
    """Polls of a feed with rows (status, modified, ...), whose marks and taken rows lie in the shared folder ``store``."""

    def __init__(self, spark: SparkSession, store: str, status: str = "status", modified: str = "modified"):
        self.spark, self.store, self.status, self.modified = spark, store.rstrip("/"), status, modified

    def marks(self) -> DataFrame:
        """(status, mark, rows_seen, rows_left, batch) of every poll so far; a poll cut short has no mark."""
        try:
            return self.spark.read.schema(MARKS).parquet(f"{self.store}/marks")
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], MARKS)

    def current(self, before: int | None = None) -> DataFrame:
        """(status, since): the mark of each status from the polls ``before`` a batch."""
        told = self.marks().where("mark IS NOT NULL")
        told = told if before is None else told.where(F.col("batch") < before)
        return told.groupBy("status").agg(F.max_by("mark", "batch").alias("since"))

    def poll(self, feed: DataFrame, batch: int, budget: int | None = None, statuses: list[str] | None = None) -> DataFrame:
        """Take what changed at or after the marks, oldest first, at most ``budget`` rows of a status; the rows taken.

        Rows without a change time are taken by a poll without a mark only and
        move none. ``batch`` numbers the poll: the same number again sees the
        marks as they were before it and replaces what it wrote.
        """
        wanted = feed if statuses is None else feed.where(F.col(self.status).isin(statuses))
        modified = F.nullif(F.trim(F.col(self.modified).cast("string")), F.lit(""))
        since = self.current(batch).withColumnRenamed("status", self.status)
        due = wanted.join(since, self.status, "left").where(F.col("since").isNull() | (modified >= F.col("since"))).drop("since").withColumn("_modified", modified)
        if budget is not None:
            due = _oldest(due, self.status, budget)
        path = f"{self.store}/rows/batch={batch}"
        due.withColumn("_left", F.col("_left") if budget is not None else F.lit(0).cast("long")).write.mode("overwrite").parquet(path)
        taken = self.spark.read.parquet(path)
        left = F.max("_left")
        told = taken.groupBy(F.col(self.status).alias("status")).agg(F.when(left == 0, F.max("_modified")).alias("mark"), F.count(F.lit(1)).alias("rows_seen"), left.alias("rows_left"))
        told.write.mode("overwrite").parquet(f"{self.store}/marks/batch={batch}")
        return taken.drop("_modified", "_left")

    def rows(self) -> DataFrame:
        """All rows taken by all polls; a row at a mark is taken again by the next."""
        return self.spark.read.parquet(f"{self.store}/rows").drop("_modified", "_left", "batch")

    def sink(self, budget: int | None = None) -> Callable[[DataFrame, int], None]:
        """For ``foreachBatch``: every batch of a stream is a poll."""

        def put(batch: DataFrame, number: int) -> None:
            self.poll(batch, number, budget)

        return put


def _oldest(due: DataFrame, status: str, budget: int) -> DataFrame:
    """The ``budget`` rows of each status that changed first, and how many it leaves; ties by the whole row's hash."""
    n = due.groupBy(status).agg(F.count(F.lit(1)).alias("_n"))
    order = Window.partitionBy(status).orderBy(F.col("_modified").asc_nulls_first(), F.xxhash64(*due.columns))
    first = due.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= budget).drop("_place")
    return first.join(n, status).withColumn("_left", F.greatest(F.col("_n") - budget, F.lit(0))).drop("_n")
