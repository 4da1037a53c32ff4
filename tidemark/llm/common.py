"""What the operators share: table reading, shared storage and id columns."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A table may be broadcast up to this many rows; beyond it the same join shuffles.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may
    go without (tests): then a temporary folder is made. On a cluster a
    machine's own folder would lose data silently, so it is refused.
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


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage: a lost executor costs its running tasks, not the
    stages before the written table.
    """
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that ``materialize`` wrote and nothing reads any more."""
    spark = df.sparkSession
    root = shared_dir(spark)
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if path.replace("file:///", "file:/").startswith(root.replace("file:///", "file:/")):
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def bounded_broadcast(df: DataFrame, rows: int, bound: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcasting if its counted ``rows`` are within ``bound``."""
    return F.broadcast(df) if rows <= bound else df


def fold_remainder(id_column: str, modulus: int):
    """crc32 of the id written as text, modulo ``modulus`` (null ids: as the empty text)."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % modulus


class Recent:
    """A bounded memory of words and their codes in two generations.

    What is asked for again moves to the young generation, so frequent words
    stay and rare ones are forgotten: at most twice ``bound`` are held.
    """

    def __init__(self, bound: int):
        self.bound = bound
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def table(self, words: set[str], make) -> dict[str, bytes]:
        """Codes of all ``words``; ``make`` gives those of a list of words that are not held."""
        young, old = self.young, self.old
        found = {w: young.get(w) or old.get(w) for w in words}
        found.update(make([w for w, code in found.items() if code is None]))
        young.update(found)
        if len(young) > self.bound:
            self.old, self.young = young, {}
        return found
