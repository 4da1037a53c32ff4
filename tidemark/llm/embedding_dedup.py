"""Near-duplicate embeddings: random-hyperplane sign hashing in several tables, exact cosines, components.

Equal vectors under one label are one node with a count, so copies are never
paired. Every node gets a bucket in each table; nodes that share a bucket and
whose 64-bit sketches are near are verified by the exact cosine in double
precision. The bits of a bucket follow the number of nodes, and the number of
tables follows from the bits so that a pair at the threshold is missed with a
probability of at most ``MISS``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .components import connected_components

THRESHOLD = 0.98
MISS = 1e-6
SEED = 20240229
#: Sketches of a pair at the threshold differ in 4 of 64 bits on average; over this many (eight deviations) they are not compared.
SKETCH_BITS = 20


def table_plan(nodes: int, threshold: float = THRESHOLD, miss: float = MISS) -> tuple[int, int]:
    """(bits of a bucket, tables) for so many nodes."""
    bits = min(30, max(10, math.ceil(math.log2(max(2, nodes))) - 3))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log(1 - agree))


def _hash_rows(bits: int, tables: int):
    def rows(batches):
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            sizes = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            for size in np.unique(sizes):
                if size not in planes:
                    planes[size] = np.random.default_rng([SEED, int(size)]).standard_normal((int(size), 64 + bits * tables))
                at = np.flatnonzero(sizes == size)
                vectors = flat[offsets[at][:, None] + np.arange(size)]
                signs = (vectors @ planes[size] > 0).astype(np.uint8)
                sketch = np.packbits(signs[:, :64], axis=1, bitorder="little").copy().view("<i8").ravel()
                place = pa.array(at)
                for table in range(tables):
                    bucket = signs[:, 64 + table * bits : 64 + (table + 1) * bits].astype(np.int64) @ (1 << np.arange(bits, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(place), batch.column(2).take(place), pa.array(bucket << 16 | table), pa.array(sketch)], ["node", "block", "bucket", "sketch"])

    return rows


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def scaled(vector: Column) -> Column:
    """``vector`` as doubles times the power of two that brings its largest component near 1: exact, and its norm is neither 0 nor infinite."""
    largest = F.array_max(F.transform(vector, lambda x: F.abs(x.cast("double"))))
    # Two steps, since one factor could itself be out of range.
    half = F.floor(-F.floor(F.log2(largest)) / 2)
    rest = -F.floor(F.log2(largest)) - half
    return F.transform(vector, lambda x: x.cast("double") * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), rest))


def _without_collisions(rows: DataFrame) -> DataFrame:
    """``rows`` (label, raw, fit) with a hash of label and vector in a column ``node`` under which no two of those that fit share one.

    Vectors under one hash are told apart by a second one of 64 bits, so no
    vector is shuffled to rule out what happens once in many trillions.
    """
    for seed in range(8):
        hashed = rows.withColumn("node", F.xxhash64(F.lit(seed), "label", "raw"))
        other = F.xxhash64("raw", F.lit(seed + 1), "label")
        shared = hashed.where("fit").groupBy("node").agg(F.min(other).alias("least"), F.max(other).alias("most")).where("least <> most")
        if shared.isEmpty():
            return hashed
    raise ValueError("vectors share their hashes under every seed")


def near_pairs(nodes: DataFrame, count: int, threshold: float = THRESHOLD, miss: float = MISS) -> DataFrame:
    """Pairs (a, b, n_a, n_b), a < b, of the written table ``nodes`` (node, block, vector, norm, n) with a cosine of at least ``threshold``."""
    bits, tables = table_plan(count, threshold, miss)
    hashed = nodes.select("node", "vector", "block").mapInArrow(_hash_rows(bits, tables), "node long, block long, bucket long, sketch long")
    x = hashed.select("block", "bucket", F.col("node").alias("a"), F.col("sketch").alias("sketch_a"))
    y = hashed.select(F.col("block").alias("block_b"), F.col("bucket").alias("bucket_b"), F.col("node").alias("b"), F.col("sketch").alias("sketch_b"))
    alike = F.bit_count(F.col("sketch_a").bitwiseXOR(F.col("sketch_b"))) <= SKETCH_BITS
    candidates = materialize(x.join(y, (F.col("block") == F.col("block_b")) & (F.col("bucket") == F.col("bucket_b")) & (F.col("a") < F.col("b")) & alike).select("a", "b").distinct(), "candidates")
    first = nodes.select(F.col("node").alias("a"), F.col("vector").alias("v_a"), F.col("norm").alias("norm_a"), F.col("n").alias("n_a"))
    second = nodes.select(F.col("node").alias("b"), F.col("vector").alias("v_b"), F.col("norm").alias("norm_b"), F.col("n").alias("n_b"))
    both = candidates.join(first, "a").join(second, "b")
    return both.where(dot(F.col("v_a"), F.col("v_b")) / (F.col("norm_a") * F.col("norm_b")) >= threshold).select("a", "b", "n_a", "n_b")


def dedup(rows: DataFrame, threshold: float = THRESHOLD, miss: float = MISS, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label") -> DataFrame:
    """One row per row of ``rows``: vec_id, n_links, component_id, kept.

    Only vectors of equal labels and lengths are compared. Null labels and
    vectors that are null, empty, all zero or hold a null or non-finite
    component link with nothing: they are components of their own. Repeated
    rows are vectors of their own that link with their copies. A component of
    null ids has a null component_id and its rows are kept. Other columns are
    ignored.
    """
    named = rows.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("vector"), F.col(label_column).alias("label"))
    fit = usable(F.col("vector")) & F.col("label").isNotNull()
    hashed = _without_collisions(named.select("vec_id", "label", F.col("vector").alias("raw"), fit.alias("fit")))
    marked = materialize(hashed.select("vec_id", F.when(F.col("fit"), F.col("node")).alias("node")), "vectors")
    single = hashed.where("fit").select("node", F.xxhash64("label", F.size("raw")).alias("block"), F.when(F.col("fit"), scaled(F.col("raw"))).alias("vector"), "vec_id")
    nodes = single.groupBy("node").agg(F.first("block").alias("block"), F.first("vector").alias("vector"), F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"))
    nodes = materialize(nodes.withColumn("norm", F.sqrt(dot(F.col("vector"), F.col("vector")))), "nodes")
    pairs = materialize(near_pairs(nodes, nodes.count(), threshold, miss), "pairs")

    links = pairs.select(F.col("a").alias("node"), F.col("n_b").alias("n")).unionByName(pairs.select(F.col("b").alias("node"), F.col("n_a").alias("n"))).groupBy("node").agg(F.sum("n").alias("others"))
    roots = materialize(connected_components(pairs.select("a", "b")), "roots")
    least = roots.join(nodes.select("node", "least"), "node").groupBy("root").agg(F.min("least").alias("component_id"))
    moved = roots.join(least, "root").select("node", "component_id")
    found = nodes.select("node", "n", "least").join(links, "node", "left").join(moved, "node", "left")
    labels = materialize(found.select("node", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component_id", "least").alias("component_id")), "labels")
    out = marked.join(labels, "node", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
