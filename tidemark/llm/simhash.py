"""SimHash near-duplicate groups with Golay-code fuzzy hashing.

A fingerprint of 64 bits is cut into segments of 23, 23 and 18 bits. Each
segment is a word of the binary Golay code of length 23: it is decoded to the
nearest codeword, and, when that is three errors away, also to the codewords
four errors away (one key or six). Two words that differ in at most two bits
always share such a codeword. Four errors over three segments leave two
segments with at most two errors together, so every pair within four bits
shares the combined key of some two segments; the join verifies the distance.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .components import connected_components

MAX_BITS = 4
SHINGLE_WORDS = 4
HASH_SEED = 42
SEGMENTS = ((0, 23), (23, 23), (46, 18))
SEGMENT_PAIRS = ((0, 1), (0, 2), (1, 2))
#: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 generates the code.
GENERATOR = 0b101011100011


def syndromes(words: np.ndarray) -> np.ndarray:
    """Remainder of each 23-bit word on division by the generator."""
    rest = words.astype(np.int64)
    for bit in range(22, 10, -1):
        rest = np.where((rest >> bit) & 1, rest ^ (GENERATOR << (bit - 11)), rest)
    return rest


@lru_cache(maxsize=1)
def decoding() -> np.ndarray:
    """For each syndrome the errors that lead to keys: (2048, 6), -1 where unused."""
    errors = np.full((2048, 6), -1, dtype=np.int64)
    used = np.zeros(2048, dtype=np.int64)
    weight = np.full(2048, 9)
    for n in range(5):
        words = np.array([sum(1 << b for b in bits) for bits in combinations(range(23), n)], dtype=np.int64)
        for s, word in zip(syndromes(words), words, strict=True):
            if n <= 3 or weight[s] == 3:
                errors[s, used[s]] = word
                used[s] += 1
                weight[s] = min(weight[s], n)
    return errors


def golay_keys(segment: np.ndarray) -> np.ndarray:
    """Codeword indices (12 bits) near each 23-bit word: (n, 6), -1 where unused, the nearest first."""
    errors = decoding()[syndromes(segment)]
    return np.where(errors < 0, -1, (segment[:, None] ^ errors) >> 11)


def fingerprint(text: str | None) -> int:
    """SimHash of the word shingles of ``text``; null and wordless texts have fingerprint zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE_WORDS:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE_WORDS)), strict=False))
    hashed = np.array([xxhash.xxh64_intdigest(s, HASH_SEED) for s in shingles], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashed), 4096):
        part = hashed[start : start + 4096].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashed), bitorder="little").view("<u8")[0])


def _fingerprint_batches(batches):
    for batch in batches:
        found = np.array([fingerprint(t.as_py()) for t in batch.column(1)], dtype="<u8").view("<i8")
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["doc_id", "fp"])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row (doc_id, fp) per row of ``docs``; fp is the fingerprint as a signed long."""
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")).mapInArrow(_fingerprint_batches, "doc_id long, fp long")


def _key_batches(batches):
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        keys = [golay_keys(((fps >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64)) for at, n in SEGMENTS]
        for number, (a, b) in enumerate(SEGMENT_PAIRS):
            for i in range(6):
                for j in range(6):
                    there = (keys[a][:, i] >= 0) & (keys[b][:, j] >= 0)
                    if there.any():
                        key = (number << 24) | (keys[a][there, i] << 12) | keys[b][there, j]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(key), pa.array(fps[there].view(np.int64)), pa.array(np.full(len(key), (i > 0) + 2 * (j > 0), dtype=np.int32))], ["key", "fp", "beyond"]
                        )


def near_pairs(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a < b) of the distinct fingerprints ``fps`` (one column, fp) that differ in 1 to ``max_bits`` bits.

    ``max_bits`` may be at most 4, the distance that the segments guarantee. A
    pair that shares several keys is taken from the first segment pair that
    guarantees it and, for equal segments, from their nearest codeword. Up to
    108 keyed rows come from each fingerprint, which Spark doesn't foresee when
    it sizes them, so their join is held to shuffles.
    """
    if max_bits > MAX_BITS:
        raise ValueError(f"the segments guarantee up to {MAX_BITS} bits")
    keyed = fps.select("fp").mapInArrow(_key_batches, "key long, fp long, beyond int")
    x = keyed.select("key", F.col("fp").alias("a"), F.col("beyond").alias("beyond_a"))
    y = keyed.select(F.col("key").alias("key_b"), F.col("fp").alias("b"))
    apart = F.col("a").bitwiseXOR(F.col("b"))
    errors = [F.bit_count(apart.bitwiseAND(F.lit(_signed(((1 << n) - 1) << at)))) for at, n in SEGMENTS]
    near = [errors[a] + errors[b] <= 2 for a, b in SEGMENT_PAIRS]
    first = F.when(near[0], 0).when(near[1], 1).when(near[2], 2).otherwise(-1)
    beyond = [F.col("beyond_a").bitwiseAND(F.lit(bit)) > 0 for bit in (1, 2)]
    repeated = F.lit(False)
    for number, pair in enumerate(SEGMENT_PAIRS):
        for at, segment in enumerate(pair):
            repeated = repeated | ((F.shiftright("key", 24) == number) & (errors[segment] == 0) & beyond[at])
    condition = (F.col("key") == F.col("key_b")) & (F.col("a") < F.col("b")) & (F.bit_count(apart) <= max_bits) & (F.shiftright("key", 24) == first) & ~repeated
    return x.join(y.hint("merge"), condition).select("a", "b")


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def component_labels(marked: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, root, component_id) of each distinct fingerprint of the written table ``marked`` (doc_id, fp)."""
    classes = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = materialize(connected_components(near_pairs(classes, max_bits)), "roots")
    linked = roots.join(classes, roots["node"] == classes["fp"])
    smallest = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    moved = roots.join(smallest, "root").select(F.col("node").alias("fp"), "root", "component_id")
    labels = classes.join(moved, "fp", "left")
    return materialize(labels.select("fp", F.coalesce("root", "fp").alias("root"), F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id")), "labels")


def simhash_components(docs: DataFrame, max_bits: int = MAX_BITS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row (doc_id, fp, component_id) per row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over fingerprints that
    differ in at most ``max_bits`` bits. Rows with a null id take part in the
    linking; a component of null ids only has a null component_id. Repeated
    rows stay repeated. Other columns of ``docs`` are ignored. An empty table
    gives an empty result. Equal fingerprints are one node, so copies are never
    paired with one another.
    """
    marked = materialize(fingerprints(docs, id_column, text_column), "fingerprints")
    return marked.join(component_labels(marked, max_bits), "fp", "left").select("doc_id", "fp", "component_id")


def _fingerprint_series(texts: pd.Series) -> pd.Series:
    return pd.Series(np.array([fingerprint(t) for t in texts], dtype="<u8").view("<i8"))


def keep_one(docs: DataFrame, max_bits: int = MAX_BITS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate component: that of its smallest id.

    All columns stay as they were. Of several rows with that id (repeated
    rows, or a component of null ids only) the one with the smallest text hash
    stays.
    """
    packed = materialize(docs.select(F.struct("*").alias("row"), F.col(id_column).cast("long").alias("doc_id"), F.pandas_udf(_fingerprint_series, "long")(F.col(text_column).cast("string")).alias("fp")), "marked")
    marked = packed.select("doc_id", "fp")
    labels = component_labels(marked, max_bits)
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    kept = packed.join(labels, "fp").where(first)
    crowded = materialize(marked.join(labels, "fp").where(first).groupBy("root").count().where("count > 1").select("root"), "crowded")
    if crowded.isEmpty():
        return kept.select("row.*")
    alone = kept.join(crowded, "root", "left_anti").select("row")
    chosen = kept.join(crowded, "root", "left_semi").groupBy("root").agg(F.min_by("row", F.xxhash64(f"row.{text_column}")).alias("row")).select("row")
    return alone.unionByName(chosen).select("row.*")
