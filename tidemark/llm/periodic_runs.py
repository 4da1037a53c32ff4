"""Periodic runs of words: branching tandem repeats of a suffix tree, rotated and merged into maximal runs.

Words are coded as numbers and many texts are worked on together with numpy.
A run of at least ``least`` words with two periods or more holds every one of
its words in a shingle of ``least // 2`` words that occurs twice, so only
stretches of such words get a suffix tree; the rest of a text has no run.

The tree of a stretch is that of the intervals of its sorted suffixes: leaf
lists are intervals, and the depth of a node is the number of words that its
leaves share. Stoye and Gusfield's traversal looks, at every node of depth d,
at the leaves of all children but the largest: leaf i starts a branching
tandem repeat of period d if leaf i + d is below another child, and leaf i - d
starts one if that is. Every leaf is looked at O(log n) times. A branching
repeat is the last of its run; rotating it to the left as long as words d apart
agree gives the run, and repeats that a run with the same end covers are powers
of its period.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What lies between words.
WHITE = r"[\x20\x09-\x0D]+"
#: Least words of a run.
LEAST = 12
#: Bytes of text that are worked on together; a longer text is worked on alone.
SLICE_BYTES = 4 << 20
#: Leaves that are looked at together.
LEAVES_AT_ONCE = 1 << 21
#: Steps of pointer jumping before a stack takes over.
JUMPS = 48
#: Words that all repeats are rotated by together, before each is done on its own.
ROTATED_TOGETHER = 16
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")]), False)


def stretches(codes: np.ndarray, owner: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all words inside shingles that their text holds twice, and the number of the stretch of each."""
    n = len(codes)
    if n < 2 * shingle:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = n - shingle + 1
    h = (owner[:first].astype(np.uint64) + np.uint64(1)) * MULTIPLIER
    with np.errstate(over="ignore"):
        for k in range(shingle):
            h = (h ^ (h >> np.uint64(29))) * MULTIPLIER + codes[k : first + k].astype(np.uint64)
        h ^= h >> np.uint64(32)
    inside = np.flatnonzero(owner[:first] == owner[shingle - 1 :])
    order = inside[np.argsort(h[inside])]
    same = h[order[1:]] == h[order[:-1]]
    repeated = np.zeros(len(order), bool)
    repeated[1:] |= same
    repeated[:-1] |= same
    rise = np.zeros(n + 1, np.int64)
    starts = order[repeated]
    np.add.at(rise, starts, 1)
    np.add.at(rise, starts + shingle, -1)
    places = np.flatnonzero(np.cumsum(rise[:-1]) > 0)
    if not len(places):
        return places, places
    breaks = (np.diff(places) > 1) | (np.diff(owner[places]) != 0)
    number = np.concatenate([[0], np.cumsum(breaks)])
    long_enough = np.bincount(number)[number] >= 2 * shingle
    places, number = places[long_enough], number[long_enough]
    return places, np.unique(number, return_inverse=True)[1] if len(number) else number


def sorted_suffixes(x: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes of all stretches in order, and the ranks by their first 1, 2, 4, ... words.

    A rank is the place of the first suffix of those that share it. Suffixes
    of different stretches never share one. Each doubling sorts only what is
    not yet told apart.
    """
    m = len(x)
    key = number * (int(x.max()) + 1) + x
    order = np.argsort(key, kind="stable")
    heads = np.concatenate([[True], key[order[1:]] != key[order[:-1]]])
    rank = np.empty(m + 1, np.int32)
    rank[order] = np.maximum.accumulate(np.where(heads, np.arange(m), 0))
    rank[m] = -1
    end = np.flatnonzero(np.concatenate([number[1:] != number[:-1], [True]])) + 1
    end = end[number]
    levels, width = [rank], 1
    active = order[_shared(rank[order])]
    while len(active):
        ahead = active + width
        second = np.where(ahead < end[active], rank[np.minimum(ahead, m)], -1).astype(np.int64)
        first = rank[active].astype(np.int64)
        by = np.argsort(first * (m + 1) + second + 1, kind="stable")
        active, first, second = active[by], first[by], second[by]
        fresh = np.concatenate([[True], first[1:] != first[:-1]])
        heads = fresh | np.concatenate([[True], second[1:] != second[:-1]])
        at = np.arange(len(active))
        rank = rank.copy()
        rank[active] = first + np.maximum.accumulate(np.where(heads, at, 0)) - np.maximum.accumulate(np.where(fresh, at, 0))
        levels.append(rank)
        active = active[_shared(rank[active])]
        width *= 2
    suffixes = np.empty(m, np.int64)
    suffixes[rank[:m]] = np.arange(m)
    return suffixes, levels


def _shared(ranks: np.ndarray) -> np.ndarray:
    """Which of the sorted ``ranks`` occur more than once."""
    same = ranks[1:] == ranks[:-1]
    shared = np.zeros(len(ranks), bool)
    shared[1:] |= same
    shared[:-1] |= same
    return shared


def shared_words(suffixes: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Words that each sorted suffix shares with the one before it (first: -1)."""
    i, j = suffixes[:-1].copy(), suffixes[1:].copy()
    found = np.zeros(len(i), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        equal = levels[k][i] == levels[k][j]
        step = equal.astype(np.int64) << k
        found += step
        i += step
        j += step
    return np.concatenate([[-1], found])


def nearest_below(depth: np.ndarray, strict: bool) -> np.ndarray:
    """For each place the nearest one before it whose depth is less (or, unless ``strict``, equal); place 0 has the least."""
    m = len(depth)
    before = np.arange(-1, m - 1)
    before[0] = 0
    open_ = np.arange(1, m)
    for _ in range(JUMPS):
        to = before[open_]
        open_ = open_[depth[to] >= depth[open_] if strict else depth[to] > depth[open_]]
        if not len(open_):
            return before
        before[open_] = before[before[open_]]
    stack: list[int] = []
    told = depth.tolist()
    for k, d in enumerate(told):
        while stack and (told[stack[-1]] >= d if strict else told[stack[-1]] > d):
            stack.pop()
        before[k] = stack[-1] if stack else 0
        stack.append(k)
    return before


def _nearest_after(depth: np.ndarray, strict: bool) -> np.ndarray:
    m = len(depth)
    after = np.full(m, m)
    after[1:] -= nearest_below(np.concatenate([[-1], depth[:0:-1]]), strict)[:0:-1]
    return after


def branching_repeats(suffixes: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of all branching tandem repeats, from the leaves of all children but the largest of each node."""
    m = len(suffixes)
    padded = np.concatenate([depth, [-1]])
    low, low_equal = nearest_below(depth, True), nearest_below(depth, False)
    high, high_equal = _nearest_after(depth, True), _nearest_after(depth, False)
    cut = np.flatnonzero(depth > 0)
    leads = cut[padded[low_equal[cut]] < depth[cut]]  # the first cut of each node, that also bounds its first child
    child_from = np.concatenate([low_equal[leads], cut])
    child_to = np.concatenate([leads, high_equal[cut]])
    of = np.concatenate([leads, cut])
    node = np.unique(low[of] * (m + 1) + high[of], return_inverse=True)[1]
    size = child_to - child_from
    order = np.lexsort((size, node))
    smaller = order[:-1][node[order[1:]] == node[order[:-1]]] if len(order) else order
    place = np.empty(m, np.int64)
    place[suffixes] = np.arange(m)
    found: list[np.ndarray] = []
    ends = np.cumsum(size[smaller])
    at = 0
    while at < len(smaller):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + LEAVES_AT_ONCE, "right")))
        some = smaller[at:upto]
        at = upto
        many = size[some]
        child = np.repeat(some, many)
        leaf = suffixes[np.arange(len(child)) - np.repeat(np.cumsum(many) - many, many) + child_from[child]]
        d, lo, hi = depth[of[child]], low[of[child]], high[of[child]]
        for other, start in ((leaf + d, leaf), (leaf - d, leaf - d)):
            there = (other >= 0) & (other < m)
            r = np.where(there, place[np.where(there, other, 0)], -1)
            good = there & (r >= lo) & (r < hi) & ((r < child_from[child]) | (r >= child_to[child]))
            found.append(start[good] * (m + 1) + d[good])
    pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return pairs // (m + 1), pairs % (m + 1)


def rotated(x: np.ndarray, bound: np.ndarray, start: np.ndarray, period: np.ndarray) -> np.ndarray:
    """How far to the left each repeat can be rotated: where the words a period apart begin to agree, not before ``bound``."""
    start = start.copy()
    moving = np.arange(len(start))
    for _ in range(ROTATED_TOGETHER):
        before = start[moving] - 1
        ok = before >= bound[moving]
        ok &= x[np.maximum(before, 0)] == x[np.maximum(before, 0) + period[moving]]
        moving = moving[ok]
        if not len(moving):
            return start
        start[moving] -= 1
    for k in moving.tolist():
        to, q, least, width = int(start[k]), int(period[k]), int(bound[k]), 64
        while to > least:
            since = max(least, to - width)
            unequal = np.flatnonzero(x[since:to] != x[since + q : to + q])
            if len(unequal):
                to = since + int(unequal[-1]) + 1
                break
            to, width = since, 2 * width
        start[k] = to
    return start


def merged(x: np.ndarray, first: np.ndarray, start: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of the maximal runs that the branching repeats end.

    Of the repeats with one end the shortest is rotated first; those that it
    then covers are powers of its period, and the next one starts a longer run.
    """
    end = start + 2 * period
    order = np.lexsort((period, end))
    start, period, end = start[order], period[order], end[order]
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(start):
        lead = np.concatenate([[True], end[1:] != end[:-1]])
        s = rotated(x, first[start[lead]], start[lead], period[lead])
        out.append((s, end[lead], period[lead]))
        left = start < s[np.cumsum(lead) - 1]
        left &= ~lead
        start, period, end = start[left], period[left], end[left]
    if not out:
        return start, end, period
    return tuple(np.concatenate(parts) for parts in zip(*out, strict=True))


def runs_of(codes: np.ndarray, owner: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start, then period; ``owner`` is the ascending number of each word's text.

    Starts are places in ``codes``. A run never crosses texts.
    """
    places, number = stretches(codes, owner, max(1, least // 2))
    if not len(places):
        return (np.zeros(0, np.int64),) * 3
    x = codes[places].astype(np.int64)
    suffixes, levels = sorted_suffixes(x, number)
    depth = shared_words(suffixes, levels)
    del levels
    heads = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
    start, end, period = merged(x, heads[number], *branching_repeats(suffixes, depth))
    long_enough = end - start >= least
    start, end, period = start[long_enough], end[long_enough], period[long_enough]
    order = np.lexsort((period, start))
    start, end, period = start[order], end[order], period[order]
    return places[start], end - start, period


def _slices(bodies: pa.Array) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts of at most ``SLICE_BYTES`` together, or of one text."""
    sizes = pc.binary_length(bodies).to_pylist()
    first, held = 0, 0
    for k, size in enumerate(sizes):
        if k > first and held + size > SLICE_BYTES:
            yield first, k
            first, held = k, 0
        held += size
    if first < len(sizes):
        yield first, len(sizes)


def _found(batch: pa.RecordBatch, least: int) -> Iterator[pa.RecordBatch]:
    for first, last in _slices(batch.column(1)):
        some = batch.slice(first, last - first)
        parts = [body.as_py().split() for body in some.column(1)]  # of bytes: at the six ASCII blanks
        lens = np.array([len(p) for p in parts], np.int64)
        begin = np.cumsum(lens) - lens
        words = pa.array([w for p in parts for w in p], pa.binary()).dictionary_encode()
        owner = np.repeat(np.arange(len(parts)), lens)
        start, length, period = runs_of(words.indices.to_numpy(), owner, least)
        of = owner[start]
        counts = np.bincount(of, minlength=len(parts))
        rise = np.zeros(len(owner) + 1, np.int64)
        np.add.at(rise, start + period, 1)
        np.add.at(rise, start + length, -1)
        kept = np.cumsum(rise[:-1]) == 0
        collapsed = [p if not c else [p[i] for i in np.flatnonzero(kept[b : b + n]).tolist()] for p, c, b, n in zip(parts, counts.tolist(), begin.tolist(), lens.tolist(), strict=True)]
        told = pa.StructArray.from_arrays([pa.array(start - begin[of]), pa.array(length), pa.array(period)], fields=[pa.field(n, pa.int64(), False) for n in ("start", "length", "period")])
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), told)
        yield pa.RecordBatch.from_arrays([some.column(0), pa.array(lens), lists, pa.array([b" ".join(c) for c in collapsed], pa.binary())], ["doc_id", "n_words", "runs", "collapsed"])


def find_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """One row (doc_id, n_words, runs, collapsed) per row of ``docs``, in any order.

    ``runs`` are all maximal stretches of consecutive words with a smallest
    period q, at least ``least`` and 2 * q words long, as (start, length,
    period) by start, then period; ``collapsed`` is the text, one blank between
    words, without the words that some run holds after its first period.
    Words lie between ASCII white space. Null and empty texts have no words,
    no run and an empty collapsed text. Repeated rows give a row each, null
    ids stay null, and other columns are ignored. A text is worked on whole,
    in memory that grows with its words times the logarithm of its longest
    repeat.
    """
    quoted = [F.col(f"`{c}`") for c in (doc_id, text)]
    given = docs.select(quoted[0].alias("doc_id"), F.coalesce(quoted[1].cast("string"), F.lit("")).cast("binary").alias("body"))
    shape = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("collapsed", T.BinaryType())])

    def each(batches):
        for batch in batches:
            if batch.num_rows:
                yield from _found(batch, least)

    return given.mapInArrow(each, shape).withColumn("collapsed", F.col("collapsed").cast("string"))
