"""Benchmark decontamination: size-partitioned MinHash containment search.

Items are partitioned by the number of their distinct word shingles. The
MinHash sketch of an item holds its smallest shingle hashes, as many as the
upper size bound of its partition calls for: a document that contains at least
``threshold`` of q shingles misses at most q - ceil(threshold * q) of them, so
one more than that many sketch values cannot all be missing. Sketches of fixed
size, as used between sets of like sizes, would see next to nothing of a short
item in a long document; these find every one. Candidates are verified by
exact shingle containment. An item of fewer words than a shingle is one
shingle of its own length, so documents are also cut into shingles of those
lengths that occur among the items. All of it is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, bounded_broadcast, materialize

SHINGLE_WORDS = 5
THRESHOLD = 0.8
WHITE = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Lower-case words between ASCII white space; null and empty texts have none."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), WHITE), "")


def _with(value: Column, use) -> Column:
    """``use(value)`` with ``value`` bound to a lambda variable, so that it is computed once a row however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _starts(parts: Column, shingle: int) -> Column:
    return F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(parts) - shingle))


def shingle_hashes(text: Column, shingle: int = SHINGLE_WORDS) -> Column:
    """Hash of each word shingle of a text; fewer words: one of the whole sequence; none: null."""

    def of(hashes: Column) -> Column:
        each = F.transform(_starts(hashes, shingle), lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(shingle))))
        return F.when(F.size(hashes) >= shingle, each).when(F.size(hashes) > 0, F.array(F.xxhash64(hashes)))

    return _with(F.transform(words(text), lambda w: F.xxhash64(w)), of)


def shingle_texts(text: Column, shingle: int = SHINGLE_WORDS) -> Column:
    """The distinct word shingles of a text; none: null."""

    def of(parts: Column) -> Column:
        each = F.transform(_starts(parts, shingle), lambda i: F.array_join(F.slice(parts, i + 1, shingle), " "))
        return F.when(F.size(parts) > 0, F.array_distinct(each))

    return _with(words(text), of)


def _each(parts: Column, k: int, use) -> Column:
    """``use(place, k)`` for all places where ``k`` of ``parts`` begin; none if there are fewer."""
    return F.when(F.size(parts) >= k, F.transform(F.sequence(F.lit(0), F.size(parts) - k), lambda i: use(i, k))).otherwise(F.array())


def document_hashes(text: Column, shingle: int = SHINGLE_WORDS, shorter: tuple[int, ...] = ()) -> Column:
    """Hashes of the shingles of a document: of ``shingle`` words, and of the lengths ``shorter`` as ``shingle_hashes`` has them for items of just these."""

    def of(hashes: Column) -> Column:
        long_ones = _each(hashes, shingle, lambda i, n: F.xxhash64(*(F.get(hashes, i + k) for k in range(n))))
        return F.concat(long_ones, *(_each(hashes, k, lambda i, n: F.xxhash64(F.slice(hashes, i + 1, n))) for k in shorter))

    return _with(F.transform(words(text), lambda w: F.xxhash64(w)), of)


def document_texts(text: Column, shingle: int = SHINGLE_WORDS, shorter: tuple[int, ...] = ()) -> Column:
    """The distinct shingles of a document, of ``shingle`` words and of the lengths ``shorter``."""

    def of(parts: Column) -> Column:
        return F.array_distinct(F.concat(*(_each(parts, k, lambda i, n: F.array_join(F.slice(parts, i + 1, n), " ")) for k in (shingle, *shorter))))

    return _with(words(text), of)


def item_sketches(items: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """Rows (item_key, n_item, need, h): the sketch values of each item.

    A size partition holds the items of 2^c to 2^(c+1) - 1 distinct shingles;
    its sketch size follows from its upper bound.
    """
    sets = items.select("item_key", F.array_sort(F.array_distinct(shingle_hashes(F.col("text"), shingle))).alias("hashes")).withColumn("n_item", F.size("hashes"))
    upper = F.pow(F.lit(2.0), F.floor(F.log2("n_item")) + 1) - 1
    sized = sets.where("n_item > 0").withColumn("sketch_size", (upper - F.ceil(upper * threshold) + 1).cast("int"))
    return sized.select("item_key", "n_item", F.ceil(F.col("n_item") * threshold).cast("int").alias("need"), F.explode(F.slice("hashes", F.lit(1), F.least("sketch_size", "n_item"))).alias("h"))


def contained_items(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE_WORDS, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Pairs (doc_id, text_hash, item_id, n_item, n_found, containment) with containment of at least ``threshold``.

    Containment is the share of an item's distinct shingles that the document
    has. An item of fewer words than a shingle is one shingle, found wherever
    these words follow each other. Null and empty texts and items
    contain nothing and are in nothing. Repeated rows give one pair; rows that
    share an id but not a text are told apart by ``text_hash``. Null ids stay
    null. Other columns are ignored.
    """
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    wanted = items.select(F.col(item_id).alias("item_id"), F.col(text).cast("string").alias("text")).distinct().withColumn("item_key", F.xxhash64("item_id", "text"))
    wanted = materialize(wanted, "items")
    sketches = materialize(item_sketches(wanted, threshold, shingle), "sketches")
    probes = bounded_broadcast(sketches, sketches.count(), broadcast_rows)

    lengths = wanted.select(F.size(words(F.col("text"))).alias("n")).where((F.col("n") > 0) & (F.col("n") < shingle)).distinct()
    shorter = tuple(sorted(r.n for r in lengths.collect()))  # fewer than the words of a shingle

    shingled = named.select("doc_id", "text_hash", F.explode(document_hashes(F.col("text"), shingle, shorter)).alias("h"))
    candidates = materialize(shingled.join(probes, "h").select("doc_id", "text_hash", "item_key", "n_item", "need").distinct(), "candidates")

    exact_items = wanted.select("item_key", "item_id", F.explode(shingle_texts(F.col("text"), shingle)).alias("shingle"))
    exact_items = materialize(exact_items, "item-shingles")
    of_items = bounded_broadcast(exact_items, exact_items.count(), broadcast_rows)
    texts = named.join(candidates.select(F.col("doc_id").alias("c_id"), F.col("text_hash").alias("c_hash")).distinct(), F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("text_hash") == F.col("c_hash")), "left_semi").distinct()
    theirs = texts.select("doc_id", "text_hash", F.explode(document_texts(F.col("text"), shingle, shorter)).alias("shingle"))
    found = theirs.join(of_items, "shingle").groupBy("doc_id", "text_hash", "item_key", "item_id").agg(F.count(F.lit(1)).alias("n_found"))
    c = candidates.select(F.col("doc_id").alias("c_id"), F.col("text_hash").alias("c_hash"), F.col("item_key").alias("c_item"), "n_item", "need")
    verified = found.join(c, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("text_hash") == F.col("c_hash")) & (F.col("item_key") == F.col("c_item"))).where("n_found >= need")
    return verified.select("doc_id", "text_hash", "item_id", F.col("n_item").cast("long").alias("n_item"), "n_found", (F.col("n_found") / F.col("n_item")).alias("containment")).distinct()


def decontaminate(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE_WORDS, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that contain no item; all columns as they were."""
    leaks = materialize(contained_items(docs, items, threshold, shingle, doc_id, item_id, text).select(F.col("doc_id").alias("leak_id"), F.col("text_hash").alias("leak_hash")).distinct(), "leaks")
    own = docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("own_id"), F.xxhash64(F.col(text).cast("string")).alias("own_hash"))
    return own.join(leaks, F.col("own_id").eqNullSafe(F.col("leak_id")) & (F.col("own_hash") == F.col("leak_hash")), "left_anti").select("row.*")
