"""Per-document word frequencies, and a skew-proof join of them with a table of words.

A few words make up a third of any corpus, so a plain shuffle by word sends
them to one task. Here the frequent words are looked up in a broadcast table,
bounded in rows and bytes, while a text is cut into words, and never leave the
task; only the rare rest is joined by shuffle. Both come from one pass over the
texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .pieces import chunks

#: Most words that the broadcast head of a word table may have.
HEAD_WORDS = 200_000
#: And the most bytes of each; longer words are always joined by shuffle.
HEAD_BYTES = 64
#: Leads the key of a text's own row among its rare words; no word starts so.
OWN = " "
#: Rows that leave a Python worker together.
ROWS_AT_ONCE = 200_000
#: Texts that are cut together.
TEXTS_AT_ONCE = 256
#: And those that Arrow cuts together, by their total bytes.
TEXT_BYTES = 8_000_000


#: A document is known by its id and the hash of its text, which any re-read of the input gives again.
KEY = ["own_id", "text_hash"]
NO_ID = -(1 << 63)


def keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(own_id, text_hash, text); null ids become ``NO_ID``, null texts empty."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("own_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def frequencies(rows: DataFrame, split: Callable[[str], list], kind: str = "string") -> DataFrame:
    """Rows (own_id, text_hash, word, n): how often each word that ``split`` gives occurs in each text.

    Texts without words give no row.
    """
    value = pa.string() if kind == "string" else pa.binary()

    def bags(batches):
        for batch in batches:
            owners: list[int] = []
            words: list = []
            counts: list[int] = []
            for at, body in enumerate(batch.column(2)):
                found = Counter(split(body.as_py()))
                owners += [at] * len(found)
                words += found.keys()
                counts += found.values()
                if len(owners) >= ROWS_AT_ONCE:
                    yield packed(batch, owners, words, counts)
                    owners, words, counts = [], [], []
            yield packed(batch, owners, words, counts)

    def packed(batch, owners, words, counts):
        at = pa.array(owners, pa.int32())
        return pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(words, value), pa.array(counts, pa.int64())], [*KEY, "word", "n"])

    return rows.select(*KEY, "text").mapInArrow(bags, f"own_id long, text_hash long, word {kind}, n long")


def with_sums(rows: DataFrame, sums: DataFrame, names: list[str], keep: dict[str, Column]) -> DataFrame:
    """One row (doc_id, names..., keep...) per row of ``rows`` (as ``keyed`` gives them).

    ``sums`` has one row per key; rows repeated m times were added up m times,
    so their sums are divided by m. Keys without sums get zeros.
    """
    once = rows.select(*KEY, *(v.alias(k) for k, v in keep.items())).groupBy(*KEY, *keep).agg(F.count(F.lit(1)).alias("copies"))
    found = once.join(sums, KEY, "left")
    each = [(F.coalesce(F.col(n), F.lit(0)) / F.col("copies")).alias(n) for n in names]
    opened = found.select(F.when(F.col("own_id") != NO_ID, F.col("own_id")).alias("doc_id"), *each, *keep, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return opened.drop("copy")


def head_of(words: DataFrame, weight: str = "total", bound: int = HEAD_WORDS, steps: int = 1) -> DataFrame:
    """The most frequent words of the written table ``words``, at most ``bound`` of them.

    The threshold comes from a histogram of the weights over powers of two,
    each in ``steps`` classes: the words of all classes that fit together
    within the bound.
    """
    power = F.floor(F.log2(weight) * steps)
    classes = words.groupBy(power.alias("power")).count().collect()
    total, least = 0, None
    for row in sorted(classes, reverse=True):
        total += row["count"]
        if total > bound:
            break
        least = row["power"]
    return words.where(power >= least) if least is not None else words.limit(0)


def sums_by_row(rows: DataFrame, split: Callable[[str], list], words: DataFrame, columns: list[str], kind: str = "string", bound: int = HEAD_WORDS, lists: Callable[[pa.Array], pa.ListArray] | None = None) -> DataFrame:
    """Per key the sums over its words of n times each of ``columns`` (double), looked up in the written table ``words``.

    ``words`` is (word, total, columns...). Words must all be in the table, and
    none may start with a blank. Texts without words have sums of zero.
    ``lists`` may give the words of a whole column as ``split`` does, empty
    ones besides.
    """
    value = pa.string() if kind == "string" else pa.binary()
    length = F.octet_length("word")
    table = head_of(words.where(length <= HEAD_BYTES), bound=bound).select("word", *(F.col(c).cast("double") for c in columns)).toArrow()
    head = rows.sparkSession.sparkContext.broadcast((table.column(0).to_pylist(), np.column_stack([table.column(c).to_numpy() for c in columns]).reshape(-1, len(columns))))
    shape = pa.schema([("own_id", pa.int64()), ("text_hash", pa.int64()), ("word", value), ("n", pa.int64()), *((c, pa.float64()) for c in columns)])

    def parts(batches):
        place = values = None
        for batch in batches:
            if place is None:
                known, values = head.value
                place = {w: i for i, w in enumerate(known)}
            if lists:
                for start, end in chunks(pc.binary_length(batch.column(2)).to_pylist(), TEXT_BYTES):
                    yield from of_column(batch.slice(start, end - start), place, values)
                continue
            for first in range(0, batch.num_rows, TEXTS_AT_ONCE):
                some = batch.slice(first, TEXTS_AT_ONCE)
                owners, rare, counts, sums = [], [], [], np.zeros((some.num_rows, len(columns)))
                for at, body in enumerate(some.column(2)):
                    found = Counter(split(body.as_py()))
                    places = list(map(place.get, found))
                    each = np.fromiter(found.values(), np.int64, len(found))
                    held = np.array([-1 if p is None else p for p in places], np.int64)
                    sums[at] = each[held >= 0] @ values[held[held >= 0]]
                    missing = np.flatnonzero(held < 0)
                    if len(missing):
                        spelt = list(found)
                        owners += [at] * len(missing)
                        rare += [spelt[i] for i in missing]
                        counts += each[missing].tolist()
                yield packed(some, range(some.num_rows), own_words(some), [1] * some.num_rows, sums.T)
                for start in range(0, len(owners), ROWS_AT_ONCE):
                    end = start + ROWS_AT_ONCE
                    yield packed(some, owners[start:end], rare[start:end], counts[start:end], [None] * len(columns))

    def own_words(some):
        return [f"{OWN}{k}" if kind == "string" else f"{OWN}{k}".encode() for k in some.column(1).to_pylist()]

    def of_column(some, place, values):
        split = lists(some.column(2))
        found = split.flatten().dictionary_encode()
        spelt = found.dictionary.cast(value)
        names = spelt.to_pylist()
        held = np.fromiter((place.get(w, -1) for w in names), np.int64, len(names))
        at, owner = found.indices.to_numpy(), np.repeat(np.arange(some.num_rows), pc.list_value_length(split).to_numpy())
        is_word = pc.not_equal(pc.binary_length(spelt), 0).to_numpy(zero_copy_only=False)[at]
        where = held[at]
        known = is_word & (where >= 0)
        sums = [np.bincount(owner[known], weights=values[where[known], c], minlength=some.num_rows) for c in range(len(columns))]
        yield packed(some, range(some.num_rows), own_words(some), [1] * some.num_rows, sums)
        rare = is_word & (where < 0)
        pairs, counts = np.unique(owner[rare] * max(1, len(names)) + at[rare], return_counts=True)
        for start in range(0, len(pairs), ROWS_AT_ONCE):
            some_pairs = pairs[start : start + ROWS_AT_ONCE]
            yield packed(some, some_pairs // len(names), spelt.take(pa.array(some_pairs % len(names))), counts[start : start + ROWS_AT_ONCE], [None] * len(columns))

    def packed(batch, owners, spelt, counts, sums):
        at = pa.array(owners, pa.int32())
        own = [pa.nulls(len(at), pa.float64()) if c is None else pa.array(c) for c in sums]
        return pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(spelt, value), pa.array(counts, pa.int64()), *own], schema=shape)

    told = rows.select(*KEY, "text").mapInArrow(parts, ", ".join([f"own_id long, text_hash long, word {kind}, n long", *(f"{c} double" for c in columns)]))
    looked_up = told.join(words.select("word", *(F.col(c).cast("double").alias(f"word_{c}") for c in columns)), "word", "left")
    return looked_up.groupBy(*KEY).agg(*(F.sum(F.coalesce(c, F.col("n") * F.col(f"word_{c}"))).alias(c) for c in columns))


def totals(bags: DataFrame, extra: dict[str, Column] | None = None) -> DataFrame:
    """(word, total, ...) over all rows; counts are combined on the map side before they shuffle."""
    extra = extra or {}
    return bags.groupBy("word").agg(F.sum("n").alias("total"), *(F.sum(v).alias(k) for k, v in extra.items()))


def written_totals(bags: DataFrame, tag: str, extra: dict[str, Column] | None = None) -> DataFrame:
    return materialize(totals(bags, extra), tag)
