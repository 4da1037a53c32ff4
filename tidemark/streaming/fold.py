"""Streams: last-wins folds and keep-first deduplication.

All run on ``availableNow`` triggers as well as continuously; the results equal
the batch operators' over the same input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table_stream(spark: SparkSession, folder: str, name: str, schema, files_at_once: int = 16) -> DataFrame:
    """Stream of a Parquet table, one file or a folder of files."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).option("recursiveFileLookup", "true").option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def fold(stream: DataFrame, key: list[str], order: Column, values: list[str]) -> DataFrame:
    """Last entry and number of entries per key, kept as streaming state."""
    last = stream.groupBy(*key).agg(F.max_by(F.struct(*values), order).alias("last"), F.count(F.lit(1)).alias("entries"))
    return last.select(*key, "last.*", "entries")


def keep_first(stream: DataFrame, key: list[str], time: str, delay: str) -> DataFrame:
    """One entry per key; keys are forgotten once the watermark has passed them."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(key)


def keep_first_ever(stream: DataFrame, key: list[str]) -> DataFrame:
    """One entry per key over all time; no key is forgotten, so the state grows with the keys."""
    return stream.dropDuplicates(key)


def run_to(stream: DataFrame, path: str, mode: str, checkpoint: str) -> None:
    """Run what is there into a Parquet table at ``path``.

    Complete mode rewrites the table; append and update mode write batch n, or
    write it again, as ``batch=n``, so after updates the last batch that has a
    key holds its values.
    """

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(path if mode == "complete" else f"{path}/batch={number}")

    stream.writeStream.outputMode(mode).foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
