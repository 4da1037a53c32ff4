"""Exact deduplication of a stream of documents with keyed state on disk that never expires.

Two streams run over a folder to which documents are added. The first writes a
log of what arrives: digest, identifier, letters and the place of the content
(file and row). The second keeps, for every digest, the document that stays
and how many there were; its state lies in RocksDB, checkpointed to the
store, and no watermark ever drops a key. Both go on where they were when more
files have come or a run was lost.

A digest that was met before is only a hit. The contents of hits are looked up
by their places, and whole texts are grouped, byte by byte; texts that share a
digest but not their bytes are parted again. All of it is DataFrame and SQL
work.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, bounded_broadcast, materialize

WHITE = r"[\x20\x09-\x0D]+"
#: Files that one batch of a stream takes at most.
FILES_AT_ONCE = 100_000
PLACE = ["file", "row"]
#: What state on disk needs; memory of all stores of an executor is bounded together.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else each of many small stores takes megabytes of disk in advance
}


def normalised(text: Column) -> Column:
    """The text without its ASCII white space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), WHITE, "")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """A stream takes its settings when it starts; afterwards the session has its own again."""
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class Dedup:
    """Deduplication of the Parquet documents under ``source``, a folder, a file or a pattern.

    ``store`` is a folder that the driver and all executors share; it holds the
    log, the state and the groups. The number of the state's partitions is the
    session's shuffle setting when the store is first used.
    """

    def __init__(self, spark: SparkSession, source: str, store: str, doc_id: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] = sha256, files_at_once: int = FILES_AT_ONCE, broadcast_rows: int = BROADCAST_ROWS):
        self.spark, self.source, self.store, self.digest = spark, source, store.rstrip("/"), digest
        self.doc_id, self.text, self.files_at_once, self.broadcast_rows = doc_id, text, files_at_once, broadcast_rows

    def _documents(self, read) -> DataFrame:
        """(doc_id, text, file, row) of a batch or streaming reader."""
        given = read.parquet(self.source)
        return given.select(F.col(f"`{self.doc_id}`").cast("long").alias("doc_id"), F.col(f"`{self.text}`").cast("string").alias("text"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))

    def _run(self, query, name: str) -> None:
        query.option("checkpointLocation", f"{self.store}/checkpoints/{name}").trigger(availableNow=True).start().awaitTermination()

    def run(self) -> Dedup:
        """Take in all that is there and was not taken in yet."""
        schema = self.spark.read.parquet(self.source).schema
        arriving = self._documents(self.spark.readStream.schema(schema).option("maxFilesPerTrigger", self.files_at_once))
        logged = arriving.select("doc_id", self.digest(normalised(F.col("text"))).alias("digest"), F.length(F.coalesce("text", F.lit(""))).alias("letters"), *PLACE)
        self._run(logged.writeStream.format("parquet").option("path", f"{self.store}/log"), "log")

        log = self.spark.readStream.schema(logged.schema).option("maxFilesPerTrigger", self.files_at_once).parquet(f"{self.store}/log")
        with _settings(self.spark, STATE):
            self._run(_grouped(log, "digest").writeStream.outputMode("update").foreachBatch(self._put), "groups")
        return self

    def _put(self, changed: DataFrame, number: int) -> None:
        """A batch's changed groups; a batch that is repeated replaces its own."""
        changed.write.mode("overwrite").parquet(f"{self.store}/groups/batch={number}")

    def groups(self) -> DataFrame:
        """(digest, keeper, n) by digest, as the last batch that changed it left it."""
        changed = self.spark.read.parquet(f"{self.store}/groups")
        return changed.groupBy("digest").agg(F.min("keeper").alias("keeper"), F.max("n").alias("n"))

    def decisions(self) -> DataFrame:
        """One row (doc_id, digest, file, row, keep_id, group_size, kept) per document taken in.

        Of equal texts that of most letters (code points) stays, then the
        smallest id, null ids last, then the first place, so one row of
        repeated ones. Null and empty texts and those of white space only are
        equal. Other columns are ignored; no documents give no rows.
        """
        log = self.spark.read.parquet(f"{self.store}/log")
        several = materialize(self.groups().where("n > 1"), "several")
        few = bounded_broadcast(several, several.count(), self.broadcast_rows)
        hits = materialize(log.join(few, "digest").select("digest", *PLACE), "hits")
        parted = self._parted(hits)
        collided = materialize(parted.groupBy("digest").count().where("count > 1").select("digest"), "collided")

        same = log.join(few, "digest", "left")
        if not collided.isEmpty():
            same = log.join(few.join(collided, "digest", "left_anti"), "digest", "left")
            same = same.join(collided, "digest", "left_anti").unionByName(self._told_apart(log, hits.join(collided, "digest")))
        own = F.struct("file", "row")
        keeper = F.col("keeper")
        return same.select(
            "doc_id",
            "digest",
            *PLACE,
            F.when(keeper.isNull(), F.col("doc_id")).otherwise(keeper["doc_id"]).alias("keep_id"),
            F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
            (keeper.isNull() | (F.struct(keeper["file"].alias("file"), keeper["row"].alias("row")) == own)).alias("kept"),
        )

    def _contents(self, hits: DataFrame) -> DataFrame:
        """(digest, file, row, body) of ``hits``, looked up by their places."""
        return self._documents(self.spark.read).join(bounded_broadcast(hits, hits.count(), self.broadcast_rows), PLACE).select("digest", *PLACE, normalised(F.col("text")).alias("body"))

    def _parted(self, hits: DataFrame) -> DataFrame:
        """(digest, body): the different whole texts behind each digest; copies are one row before they are shuffled."""
        return self._contents(hits).select("digest", "body").distinct()

    def _told_apart(self, log: DataFrame, hits: DataFrame) -> DataFrame:
        """Rows of the log whose digest stands for several texts, with the group of their own text."""
        members = materialize(log.join(self._contents(materialize(hits, "collisions")), ["digest", *PLACE]), "members")
        groups = _grouped(members, "digest", "body")
        return members.join(groups, ["digest", "body"]).drop("body")


def _grouped(log: DataFrame, *keys: str) -> DataFrame:
    """(keys..., keeper, n): the document that stays, ordered by what decides, and the number of documents."""
    keeper = F.struct((-F.col("letters")).alias("order"), F.col("doc_id").isNull().alias("nameless"), "doc_id", *PLACE)
    return log.groupBy(*keys).agg(F.min(keeper).alias("keeper"), F.count(F.lit(1)).alias("n"))
