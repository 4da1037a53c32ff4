"""Tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local master may go without: there a temporary folder serves. On a
    cluster a machine's own folder would lose data silently, so it is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        named = f"file://{tempfile.mkdtemp(prefix='tidemark-')}"
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage is cut, and readers share one computation."""
    path = new_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_state(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Number of the files at or below a path, their length together, and the newest time of change."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(target, True)
    count = length = newest = 0
    while files.hasNext():
        status = files.next()
        count, length, newest = count + 1, length + status.getLen(), max(newest, status.getModificationTime())
    return count, length, newest


def numbered(rows: DataFrame, by: list[str], path: str | None = None) -> tuple[DataFrame, int]:
    """``rows`` with their ``place`` from 0 in the order of ``by``, and how many they are.

    A window over all rows would sort them in one task. Here they are sorted
    by ranges and written to ``path``, and each range's places begin where the
    range before ends: one offset a range is all that the driver sees.
    """
    spark = rows.sparkSession
    path = path or new_path(spark, "numbered")
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    ranged.write.mode("overwrite").parquet(path)
    held = spark.read.schema(ranged.schema).parquet(path)
    return placed(held, ["_part"])


def placed(held: DataFrame, run: list[str]) -> tuple[DataFrame, int]:
    """``held`` with the ``place`` of each row from 0, and how many they are: runs follow each other in the order of ``run``, and ``_at`` counts up within each without gaps."""
    total, shifts = 0, []
    for part in sorted(held.groupBy(*run).agg(F.min("_at").alias("first"), F.count(F.lit(1)).alias("n")).collect()):
        shifts.append((*part[:-2], total - part.first))
        total += part.n
    shift = held.sparkSession.createDataFrame(shifts, held.select(*run, F.lit(0).cast("long").alias("_shift")).schema)
    return held.join(F.broadcast(shift), run).withColumn("place", F.col("_at") + F.col("_shift")).drop(*run, "_at", "_shift"), total
