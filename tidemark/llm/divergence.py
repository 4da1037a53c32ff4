"""Source divergence audit: how far the word use of a language's sources differs, by joint count histograms.

A term's share in a group depends only on its count there, so all terms that
have count x in one source and y in another add the same to the distance of the
two. The terms that two sources have in common are tallied by their pairs of
counts, inside blocks of terms and then over all blocks, and the difference of
shares is evaluated once a combination, times its terms. Terms that one or both
lack are never listed: the histogram of each source's own counts gives them,
less what the common terms have taken out of it. All shares are whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, bounded_broadcast, materialize

#: Documents of its language that a kept term occurs in, at least.
LEAST_DOCUMENTS = 30
#: Added to every count.
PRIOR = 5
#: Parts that the whole of a distribution has.
UNIT = 1_000_000_000
#: Terms listed for a group.
TOP = 50
#: Bytes of text that are counted together.
SLICE_BYTES = 8 << 20
#: Cells (counts of a term in a source) of a block of terms, about.
BLOCK_CELLS = 1 << 16
#: Pairs of cells that are tallied together.
PAIRS_AT_ONCE = 1 << 21
#: Bytes of terms stand for themselves, A-Z for their small letters, all others for a blank.
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
GROUP = ["lang", "source"]
JOINT = pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("x", pa.int64()), ("y", pa.int64()), ("terms", pa.int64())])


def _counted(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) over slices of the texts of a batch."""
    sizes = pc.binary_length(batch.column(2)).to_pylist()
    first, held = 0, 0
    for k, size in enumerate([*sizes, None]):
        if k > first and (size is None or held + size > SLICE_BYTES):
            yield _tally(batch.slice(first, k - first))
            first, held = k, 0
        held += size or 0


def _tally(some: pa.RecordBatch) -> pa.RecordBatch:
    names = list(zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True))
    number = {g: i for i, g in enumerate(dict.fromkeys(names))}
    parts = [body.as_py().translate(TERM_BYTES).split() for body in some.column(2)]
    terms = pa.array([w for p in parts for w in p], pa.binary()).dictionary_encode()
    known = len(terms.dictionary)
    of = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    each, n = np.unique(of * known + terms.indices.to_numpy(), return_counts=True)  # a document's terms
    group = np.array([number[g] for g in names], np.int64)
    own = group[each // max(known, 1)] * known + each % max(known, 1)
    cells, where, docs = np.unique(own, return_inverse=True, return_counts=True)
    total = np.bincount(where, n, minlength=len(cells)).astype(np.int64)
    at = pa.array(cells // max(known, 1))
    lang, source = (pa.array([g[i] for g in number], pa.string()).take(at) for i in (0, 1))
    return pa.RecordBatch.from_arrays([lang, source, terms.dictionary.take(pa.array(cells % max(known, 1))), pa.array(total), pa.array(docs)], ["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in each group of ``docs`` (lang, source, text without nulls)."""

    def each(batches):
        for batch in batches:
            yield from _counted(batch)

    told = docs.select("lang", "source", F.col("text").cast("binary")).mapInArrow(each, "lang string, source string, term binary, n long, docs long")
    return told.groupBy(*GROUP, "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(UNIT * (count + PRIOR) / (total + PRIOR * kept)) exactly, with decimals that hold any count."""
    wide = lambda c: c.cast("decimal(20,0)")
    above, below = F.lit(UNIT).cast("decimal(10,0)") * (wide(count) + F.lit(PRIOR)), wide(total) + F.lit(PRIOR) * wide(kept)
    return F.lit(1) + F.call_function("div", above, below)


def joint_counts(cells: DataFrame, how_many: int, block_cells: int = BLOCK_CELLS) -> DataFrame:
    """(lang, a, b, x, y, terms): terms with count x > 0 in source a and y > 0 in source b, for a before b.

    ``cells`` are (lang, source, term, n), ``how_many`` of them. Blocks hold whole terms.
    """
    blocks = max(1, -(-how_many // block_cells))
    blocked = cells.select("lang", F.pmod(F.xxhash64("term"), F.lit(blocks)).alias("block"), "source", "term", "n")

    def each(held: pa.Table) -> pa.Table:
        return pa.Table.from_batches(_joint(held), JOINT)

    told = blocked.groupBy("lang", "block").applyInArrow(each, "lang string, a string, b string, x long, y long, terms long")
    return told.groupBy("lang", "a", "b", "x", "y").agg(F.sum("terms").alias("terms"))


def _joint(held: pa.Table) -> Iterator[pa.RecordBatch]:
    lang = held.column("lang")[0].as_py()
    names, source = np.unique(np.array(held.column("source").to_pylist(), object), return_inverse=True)
    counts, count = np.unique(held.column("n").to_numpy(), return_inverse=True)
    term = held.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
    order = np.lexsort((source, term))
    term, source, count = term[order], source[order].astype(np.int64), count[order].astype(np.int64)
    packed: list[np.ndarray] = []
    pairs, gap = 0, 0
    several, wide = len(names), len(counts)

    def tallied() -> pa.RecordBatch:
        both = np.concatenate(packed, axis=1)
        code = both[0] * (wide * wide) + both[1] if several * several * wide * wide < 1 << 62 else None
        if code is not None:
            code, terms = np.unique(code, return_counts=True)
            ab, xy = code // (wide * wide), code % (wide * wide)
        else:
            (ab, xy), terms = np.unique(both, axis=1, return_counts=True)
        strings = pa.array(names.tolist(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(ab), pa.string()), strings.take(pa.array(ab // several)), strings.take(pa.array(ab % several)), pa.array(counts[xy // wide]), pa.array(counts[xy % wide]), pa.array(terms)], schema=JOINT
        )

    while True:
        gap += 1  # each cell with the one that is ``gap`` behind it among those of its term
        at = np.flatnonzero(term[gap:] == term[:-gap])
        if not len(at):
            break
        packed.append(np.stack([source[at] * several + source[at + gap], count[at] * wide + count[at + gap]]))
        pairs += len(at)
        if pairs >= PAIRS_AT_ONCE:
            yield tallied()
            packed, pairs = [], 0
    if packed:
        yield tallied()


def audit(
    docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, top: int = TOP, text: str = "text", lang: str = "lang", source: str = "source", broadcast_rows: int = BROADCAST_ROWS, block_cells: int = BLOCK_CELLS
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) for every group (lang, source) of ``docs``.

    Part ``pair`` holds the distance to each other source of the language,
    part ``term`` the ``top`` terms that the group uses more than its language.
    Ranks count from 1 by falling value, then by the item's bytes. Nulls in
    the three columns count as ''. Texts without terms, empty ones too, make
    their group occur; a language without kept terms has distances of zero and
    no terms. Every row is a document, repeated ones too. Other columns are
    ignored. No documents: no rows.
    """
    given = docs.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))))
    counts = materialize(term_counts(given), "term-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).where(F.col("docs") >= least_documents).drop("docs")
    cells = materialize(counts.join(kept, ["lang", "term"]), "cells")
    kept_of = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
    sums = given.select(*GROUP).distinct().join(cells.groupBy(*GROUP).agg(F.sum("n").alias("total")), GROUP, "left").join(kept_of, "lang", "left").fillna(0, ["total", "kept", "lang_total"])
    sums = materialize(sums, "group-sums")
    groups = bounded_broadcast(sums, sums.count(), broadcast_rows)
    result = _pairs(cells, sums, groups, broadcast_rows, block_cells).unionByName(_terms(cells, groups, top))
    return result.select(*GROUP, "part", "item", "value", "rank")


def _ranked(found: DataFrame) -> DataFrame:
    return found.withColumn("rank", F.row_number().over(Window.partitionBy(*GROUP).orderBy(F.desc("value"), "item")))


def _terms(cells: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    of = cells.join(groups, GROUP).select(*GROUP, F.col("term").cast("string").alias("item"), share(F.col("n"), F.col("total"), F.col("kept")).alias("p"), share(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q"))
    more = of.where("p > q").select(*GROUP, F.lit("term").alias("part"), "item", (F.col("p") - F.col("q")).alias("value"))
    return _ranked(more).where(F.col("rank") <= top)


def _pairs(cells: DataFrame, sums: DataFrame, groups: DataFrame, broadcast_rows: int, block_cells: int) -> DataFrame:
    zero = share(F.lit(0), F.col("total"), F.col("kept"))
    side = lambda df, name: df.select("lang", F.col("source").alias(name), F.col("total").alias(f"{name}_total"), F.when(F.col("kept") > 0, zero).otherwise(0).alias(f"{name}_zero"), F.col("kept").alias(f"{name}_kept"))
    a, b = side(sums, "a"), side(sums, "b")
    near = lambda df, name: bounded_broadcast(side(df, name), sums.count(), broadcast_rows)
    p, q = share(F.col("x"), F.col("a_total"), F.col("a_kept")), share(F.col("y"), F.col("b_total"), F.col("b_kept"))
    neither = F.abs(F.col("a_zero") - F.col("b_zero"))

    joint = joint_counts(cells.select(*GROUP, "term", "n"), cells.count(), block_cells)
    # what a common term adds, less what the histograms below count for it
    common = joint.join(near(sums, "a"), ["lang", "a"]).join(near(sums, "b"), ["lang", "b"]).withColumns({"p": p, "q": q})
    beyond = F.abs(F.col("p") - F.col("q")) - F.abs(F.col("p") - F.col("b_zero")) - F.abs(F.col("a_zero") - F.col("q")) + neither
    half = common.groupBy("lang", "a", "b").agg(F.sum(F.col("terms") * beyond).alias("value"))
    both = half.unionByName(half.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))

    # one source's terms against the other's zero: by the histogram of its counts
    histogram = cells.groupBy("lang", F.col("source").alias("a"), F.col("n").alias("x")).agg(F.count(F.lit(1)).alias("terms"))
    shares = histogram.join(near(sums, "a"), ["lang", "a"]).select("lang", "a", "terms", p.alias("p"), "a_zero")
    alone = shares.join(near(sums, "b"), "lang").where("a != b").groupBy("lang", "a", "b").agg(F.sum(F.col("terms") * (F.abs(F.col("p") - F.col("b_zero")) - neither)).alias("value"))
    alone = alone.unionByName(alone.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))

    # every kept term against two zeros; here all pairs of the result occur
    empty = a.join(b, "lang").where("a != b").select("lang", "a", "b", (F.col("a_kept") * neither).alias("value"))
    value = empty.unionByName(alone).unionByName(both).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    return _ranked(value.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), "value"))
