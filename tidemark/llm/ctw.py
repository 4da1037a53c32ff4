"""Language-model scores by context-tree weighting over the bytes of texts.

A text is its words with a blank after each and an end, coded byte by byte,
and a byte as eight binary decisions. The context of a decision is the bits of
the byte so far and the bytes before it in the text, the nearest first. Every
context of every depth holds counts of zeros and ones and their
Krichevsky-Trofimov estimate; a context's weighted probability mixes, half and
half, its own estimate and the product of its children's. The prediction for a
decision mixes the estimates of all depths along its context path by the
weights that this leaves them.

Grams (a byte and its context) are counted text by text. The tree is cut where
no branch below has more than ``BRANCH_GRAMS`` distinct grams: a branch is in
one partition, where numpy adds up the levels and, in a second pass, carries
the weights down; the levels above are grouped sums and joins. The scores are
looked up position by position: the frequent grams in a broadcast table of
bounded size, the rest joined by shuffle.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold_remainder, materialize
from .pieces import chunks
from .wordbag import HEAD_WORDS, KEY, NO_ID, TEXT_BYTES, head_of, keyed, sums_by_row, with_sums

DEPTH = 6
#: Nearest bytes by which the tree is partitioned, at least; more where a branch is larger than the bound.
CUT = 2
BRANCH_GRAMS = 50_000
#: Distinct grams in a partition, on average, and those worked on together.
GRAMS_AT_ONCE = 50_000
FOLDS = 10
BLANK = 0x20
#: The end of a text, coded as a byte that no word has.
END = b"\n"
SMOOTHING = 0.1
#: Most grams that the broadcast head of the gram table may have.
HEAD_GRAMS = 2_000_000
#: Bytes of text that are turned into grams together.
BYTES_AT_ONCE = 1 << 20
#: Distinct grams that a task adds up before it hands them on.
COUNTS_HELD = 1 << 21


def tokens(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def text_grams(texts: list[str], depth: int = DEPTH):
    """Arrays (number of the text, gram) for the coded bytes of each text, its words' blanks and its end included; about ``BYTES_AT_ONCE`` together."""
    before, blank = bytes(depth - 1) + bytes([BLANK]), bytes([BLANK])
    group, first, size = [], 0, 0
    for at, text in enumerate(texts):
        words = tokens(text)
        group.append(before + blank.join(words) + (blank if words else b"") + END)
        size += len(group[-1])
        if size >= BYTES_AT_ONCE or at == len(texts) - 1:
            lengths = np.fromiter(map(len, group), dtype=np.int64, count=len(group))
            flat, owner = bytes(7 - depth) + b"".join(group), np.repeat(np.arange(first, at + 1, dtype=np.int32), lengths)
            # The eight bytes that end with each byte after the first context.
            eights = np.ndarray(len(owner) - depth, dtype=">u8", buffer=flat, strides=(1,))
            is_coded = np.ones(len(owner), dtype=bool)
            is_coded[((np.cumsum(lengths) - lengths)[:, None] + np.arange(depth)).ravel()] = False
            for start in range(depth, len(owner), BYTES_AT_ONCE):
                end = min(start + BYTES_AT_ONCE, len(owner))
                coded = is_coded[start:end]
                # The context's nearest byte is lowest, and the coded byte below it.
                gram = eights[start - depth : end - depth].astype(np.int64)
                gram &= (1 << 8 * depth + 8) - 1
                yield owner[start:end][coded], gram[coded]
            group, first, size = [], at + 1, 0


def _text_gram_counts(depth: int):
    """(gram, n, total) of the texts of a partition, n being the count in training texts."""

    def added(parts):
        grams, n, total = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(grams, kind="stable")
        grams = grams[order]
        starts = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]])
        return grams[starts], np.add.reduceat(n[order], starts), np.add.reduceat(total[order], starts)

    def packed(parts):
        return pa.RecordBatch.from_arrays([pa.array(x) for x in added(parts)], ["gram", "n", "total"])

    def rows(batches):
        held: list = []
        for batch in batches:
            trains = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for owner, grams in text_grams(batch.column(0).to_pylist(), depth):
                once, total = np.unique(grams << 1 | trains[owner], return_counts=True)
                held.append((once >> 1, total * (once & 1), total))
                # Like sizes are added up together, so a gram is sorted a logarithmic number of times.
                while len(held) > 1 and len(held[-2][0]) < 2 * len(held[-1][0]):
                    held[-2:] = [added(held[-2:])]
                if sum(len(h[0]) for h in held) > COUNTS_HELD:
                    yield packed(held)
                    held = []
        if held:
            yield packed(held)

    return rows


def _added_up(batches):
    """One row for each gram of rows (gram, n, total) that are sorted by gram."""
    held = [np.zeros(0, np.int64)] * 3  # the last gram, of which more may follow
    for batch in batches:
        grams, n, total = (np.concatenate([h, c.to_numpy()]) for h, c in zip(held, batch.columns, strict=True))
        if len(grams):
            starts = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]])
            sums = [grams[starts], np.add.reduceat(n, starts), np.add.reduceat(total, starts)]
            held = [x[-1:] for x in sums]
            yield pa.RecordBatch.from_arrays([pa.array(x[:-1]) for x in sums], ["gram", "n", "total"])
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], ["gram", "n", "total"])


def token_lists(texts: pa.Array) -> pa.ListArray:
    """``tokens`` of each text, among which there may be empty ones."""
    return pc.ascii_split_whitespace(pc.ascii_lower(texts))


def _word_counts(batches):
    """(word, total, train) of the texts of a partition, added up in groups of about ``TEXT_BYTES``."""
    for batch in batches:
        for start, end in chunks(pc.binary_length(batch.column(0)).to_pylist(), TEXT_BYTES):
            some = batch.slice(start, end - start)
            split = token_lists(some.column(0))
            found = split.flatten().dictionary_encode()
            at, lengths = found.indices.to_numpy(), pc.list_value_length(split).to_numpy()
            total = np.bincount(at, minlength=len(found.dictionary))
            train = np.bincount(at, weights=np.repeat(some.column(1).to_numpy(zero_copy_only=False), lengths), minlength=len(total)).astype(np.int64)
            rows = pa.RecordBatch.from_arrays([found.dictionary.cast(pa.binary()), pa.array(total), pa.array(train)], ["word", "total", "train"])
            yield rows.filter(pc.not_equal(pc.binary_length(rows.column(0)), 0))


class GramTable:
    """Scores of grams by a table with one slot a hash; those that lost their slot are found by bisection.

    ``grams`` come in rising order of frequency: of those with one hash the last has the slot.
    """

    def __init__(self, grams: np.ndarray, scores: np.ndarray):
        self.shift = np.uint64(64 - max(1, len(grams).bit_length()))
        self.keys = np.full(1 << 64 - int(self.shift), -1, dtype=np.int64)
        self.values = np.zeros(len(self.keys))
        slots = self.slots(grams)
        self.keys[slots] = grams
        kept = self.keys[slots] == grams
        self.values[slots[kept]] = scores[kept]
        lost = np.flatnonzero(~kept)
        lost = lost[np.argsort(grams[lost])]
        self.more, self.more_values = np.append(grams[lost], np.int64(2**63 - 1)), np.append(scores[lost], 0.0)

    def slots(self, grams: np.ndarray) -> np.ndarray:
        return ((grams.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def look_up(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores, 0 where there is none, and the places of those without."""
        slots = self.slots(grams)
        scores = self.values[slots]
        missed = np.flatnonzero(self.keys[slots] != grams)
        at = np.searchsorted(self.more, grams[missed])
        scores[missed] = self.more_values[at]
        absent = self.more[at] != grams[missed]
        scores[missed[absent]] = 0.0
        return scores, missed[absent]


def _text_sums(depth: int, head):
    """Of rows (own_id, text_hash, text): one row with the head's sum and the number of coded bytes a text, and one row for each gram that the head lacks."""

    def rows(batches):
        table = None
        for batch in batches:
            table = table or GramTable(*head.value)
            n = batch.num_rows
            sums, coded = np.zeros(n), np.zeros(n, dtype=np.int64)
            for owner, grams in text_grams(batch.column(2).to_pylist(), depth):
                scores, absent = table.look_up(grams)
                sums += np.bincount(owner, weights=scores, minlength=n)
                coded += np.bincount(owner, minlength=n)
                if len(absent):
                    at = pa.array(owner[absent])
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(grams[absent]), pa.nulls(len(absent), pa.float64()), pa.nulls(len(absent), pa.int64())], [*KEY, "gram", "score", "coded"])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.nulls(n, pa.int64()), pa.array(sums), pa.array(coded)], [*KEY, "gram", "score", "coded"])

    return rows


def sums_across_words(rows: DataFrame, trains: Column, depth: int, head_grams: int) -> DataFrame:
    """(own_id, text_hash, score, coded) by contexts that run through the whole text; one row or more for each row of ``rows``."""
    counted = rows.select("text", trains.alias("trains")).mapInArrow(_text_gram_counts(depth), "gram long, n long, total long")
    # Tasks have added up their grams, so sorting is cheaper than to hash them all again.
    together = counted.repartition("gram").sortWithinPartitions("gram")
    grams = materialize(together.mapInArrow(_added_up, "gram long, n long, total long"), "grams")
    scores = materialize(gram_scores(grams, depth), "gram-scores")
    head = head_of(grams, bound=head_grams, steps=8).select("gram", "total").join(scores, "gram").toArrow()
    order = np.argsort(head.column("total").to_numpy(), kind="stable")
    head = rows.sparkSession.sparkContext.broadcast((head.column("gram").to_numpy()[order], head.column("log10p").to_numpy()[order]))
    found = materialize(rows.select(*KEY, "text").mapInArrow(_text_sums(depth, head), "own_id long, text_hash long, gram long, score double, coded long"), "text-sums")
    rest = found.where("gram is not null").select(*KEY, "gram").join(scores, "gram").groupBy(*KEY).agg(F.sum("log10p").alias("score"))
    return found.where("gram is null").select(*KEY, "score", "coded").unionByName(rest.withColumn("coded", F.lit(0).cast("long")))


def log_gamma(x, log=F.log):
    """ln of the gamma function for x >= 0.5, by Stirling's series at x + 8; of columns or, with numpy's ``log``, of arrays."""
    z = x + 8
    series = (z - 0.5) * log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z * z * z)
    return series - log(reduce(lambda a, b: a * b, [x + k for k in range(8)]))


def log_kt(zeros, ones, log=F.log):
    """ln of the Krichevsky-Trofimov probability of a run of ``zeros`` and ``ones``."""
    return log_gamma(zeros + 0.5, log) + log_gamma(ones + 0.5, log) - log_gamma(zeros + ones + 1, log) - math.log(math.pi)


def _log_mix(a: Column, b: Column) -> Column:
    return F.greatest(a, b) + F.log1p(F.exp(-F.abs(a - b))) + math.log(0.5)


class Branches:
    """The levels from the deepest to ``cut`` over some grams, all of them of whole branches.

    Level by level: sorted keys (context << 8 | node, node being the bits so
    far after a one), each key's place in the level above, ln of its own and of
    its weighted probability, and the chance of a one.
    """

    def __init__(self, grams: np.ndarray, n: np.ndarray, depth: int, cut: int):
        left = np.arange(8)
        byte = (grams & 255)[:, None]
        self.bits = byte >> left & 1
        keys = (grams[:, None] >> 8 << 8) | (1 << 7 - left) | byte >> left + 1
        weight = np.repeat(n.astype(np.float64), 8)
        once, self.place = np.unique(keys.ravel(), return_inverse=True)
        ones = np.bincount(self.place, weights=weight * self.bits.ravel(), minlength=len(once))
        zeros = np.bincount(self.place, weights=weight, minlength=len(once)) - ones
        own = log_kt(zeros, ones, np.log)
        self.levels = [[once, None, own, own, zeros, ones]]
        for d in range(depth - 1, cut - 1, -1):
            below, _, _, mixed, zeros, ones = self.levels[-1]
            once, above = np.unique((below >> 8 & (1 << 8 * d) - 1) << 8 | below & 255, return_inverse=True)
            self.levels[-1][1] = above
            zeros, ones, children = (np.bincount(above, weights=w, minlength=len(once)) for w in (zeros, ones, mixed))
            own = log_kt(zeros, ones, np.log)
            self.levels.append([once, None, own, np.logaddexp(own, children) + math.log(0.5), zeros, ones])

    def log10p(self, keys: np.ndarray, sofar: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """log10 of each gram's chance, given for the keys at ``cut`` the prediction so far and the weight left."""
        order = np.argsort(keys)
        at = order[np.searchsorted(keys, self.levels[-1][0], sorter=order)]
        sofar, rest = sofar[at], rest[at]
        for number in range(len(self.levels) - 1, -1, -1):
            _, _, own, mixed, zeros, ones = self.levels[number]
            if number < len(self.levels) - 1:
                above = self.levels[number][1]
                sofar, rest = sofar[above], rest[above]
            share = rest * np.exp(own - mixed + math.log(0.5)) if number else rest
            sofar, rest = sofar + share * (ones + 0.5) / (zeros + ones + 1), rest - share
        one = sofar[self.place].reshape(self.bits.shape)
        return np.log10(np.where(self.bits == 1, one, 1 - one)).sum(axis=1)


def _branch(values: np.ndarray, cut: int) -> np.ndarray:
    return values >> 8 & (1 << 8 * cut) - 1


def _whole_branches(branch: np.ndarray):
    """Slices of the sorted ``branch`` that cut between branches, of about ``GRAMS_AT_ONCE`` rows."""
    start = 0
    while start < len(branch):
        end = int(np.searchsorted(branch, branch[min(start + GRAMS_AT_ONCE, len(branch)) - 1], side="right"))
        yield start, end
        start = end


def _columns(batches, n: int) -> list[np.ndarray]:
    """The whole partition's columns; partitions are made so small that this is bounded."""
    whole = pa.Table.from_batches(list(batches))
    return [whole.column(i).to_numpy() for i in range(n)]


def _cut_rows(depth: int, cut: int):
    def rows(batches):
        batches = list(batches)
        if not batches:
            return
        grams, n = _columns(batches, 2)
        order = np.argsort(_branch(grams, cut), kind="stable")
        grams, n = grams[order], n[order]
        for start, end in _whole_branches(_branch(grams, cut)):
            keys, _, own, mixed, zeros, ones = Branches(grams[start:end], n[start:end], depth, cut).levels[-1]
            yield pa.RecordBatch.from_arrays([*map(pa.array, (keys >> 8, (keys & 255).astype(np.int32), zeros, ones, own, mixed))], ["context", "node", "zeros", "ones", "log_own", "log_mixed"])

    return rows


def _score_rows(depth: int, cut: int):
    """Of a partition's grams (sofar = -1) and keys at the cut (n = 0), the grams' scores."""

    def rows(batches):
        batches = list(batches)
        if not batches:
            return
        values, n, sofar, rest = _columns(batches, 4)
        is_key = sofar >= 0
        keys, key_sofar, key_rest = values[is_key], sofar[is_key], rest[is_key]
        grams, n = values[~is_key], n[~is_key]
        order = np.argsort(_branch(grams, cut), kind="stable")
        grams, n = grams[order], n[order]
        for start, end in _whole_branches(_branch(grams, cut)):
            yield pa.RecordBatch.from_arrays([pa.array(grams[start:end]), pa.array(Branches(grams[start:end], n[start:end], depth, cut).log10p(keys, key_sofar, key_rest))], ["gram", "log10p"])

    return rows


def _branch_column(cut: int) -> Column:
    return F.shiftright("gram", 8).bitwiseAND((1 << 8 * cut) - 1)


def _cut_of(grams: DataFrame, depth: int) -> tuple[int, int]:
    """How many grams there are, and the fewest nearest bytes, at least ``CUT``, after which no branch has more than ``BRANCH_GRAMS``."""
    for cut in range(CUT, depth):
        sizes = grams.groupBy(_branch_column(cut).alias("branch")).count().agg(F.sum("count").alias("every"), F.max("count").alias("largest")).first()
        if (sizes["largest"] or 0) <= BRANCH_GRAMS:
            break
    return sizes["every"] or 0, cut


def _with_parent(here: DataFrame, level: int, above: DataFrame) -> DataFrame:
    """``here`` with what is left by the level above. Bytes and nodes bound the levels 0 and 1 to 255 and 65,280 rows; deeper ones shuffle."""
    parents = F.broadcast(above) if level <= 2 else above
    return here.withColumn("parent", F.col("context").bitwiseAND((1 << 8 * (level - 1)) - 1)).join(parents, ["parent", "node"])


def gram_scores(grams: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(gram, log10p) of every gram of the written table ``grams`` (gram, n); grams with n = 0 were never trained on."""
    if not CUT < depth <= 6:  # a gram and its kind share 64 bits
        raise ValueError(f"depth must be over {CUT} and at most 6")
    every, cut = _cut_of(grams, depth)
    parts = max(1, -(-every // GRAMS_AT_ONCE))
    branch = _branch_column(cut)
    levels = [materialize(grams.repartition(parts, branch).mapInArrow(_cut_rows(depth, cut), "context long, node int, zeros double, ones double, log_own double, log_mixed double"), "level")]
    own = log_kt(F.col("zeros"), F.col("ones"))
    for d in range(cut - 1, -1, -1):
        parents = levels[-1].groupBy(F.col("context").bitwiseAND((1 << 8 * d) - 1).alias("context"), "node").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("log_mixed").alias("log_children"))
        levels.append(materialize(parents.withColumn("log_own", own).withColumn("log_mixed", _log_mix(F.col("log_own"), F.col("log_children"))).drop("log_children"), "level"))

    one = (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1)
    above = None
    for d in range(cut):
        here = levels[cut - d]
        if above is None:
            here = here.withColumn("rest", F.lit(1.0)).withColumn("sofar", F.lit(0.0))
        else:
            here = _with_parent(here, d, above).drop("parent")
        share = F.col("rest") * F.exp(F.col("log_own") - F.col("log_mixed") + math.log(0.5))
        above = here.select(F.col("context").alias("parent"), "node", (F.col("sofar") + share * one).alias("sofar"), (F.col("rest") - share).alias("rest"))
    keys = _with_parent(levels[0], cut, above).select((F.shiftleft("context", 8) + F.col("node")).alias("gram"), F.lit(0).cast("long").alias("n"), "sofar", "rest")
    both = grams.select("gram", "n", F.lit(-1.0).alias("sofar"), F.lit(0.0).alias("rest")).unionByName(keys)
    return both.repartition(parts, branch).mapInArrow(_score_rows(depth, cut), "gram long, log10p double")


def score_texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", depth: int = DEPTH, folds: int = FOLDS, head_words: int = HEAD_WORDS, head_grams: int = HEAD_GRAMS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Training rows are those whose crc32(id as text) modulo ``folds`` is not 0;
    rows with a null id are held out. ``base_score`` is the smoothed unigram
    log10 probability and ``score`` that of the context tree; both cover the
    text's words and its end. ``bits_per_byte`` spreads ``score`` over the
    coded bytes. Null texts count as empty, which have the end only. Repeated
    rows count and stay; other columns are ignored.
    """
    rows = keyed(docs, id_column, text_column)
    trains = F.when(F.col("own_id") != NO_ID, fold_remainder("own_id", folds) != 0).otherwise(F.lit(False))
    counted = rows.select("text", trains.alias("trains")).mapInArrow(_word_counts, "word binary, total long, train long")
    words = materialize(counted.groupBy("word").agg(F.sum("total").alias("total"), F.sum("train").alias("train")), "words")
    ends = rows.agg(F.count(F.lit(1)).alias("total"), F.coalesce(F.sum(trains.cast("long")), F.lit(0)).alias("train")).select(F.lit(END).alias("word"), "total", "train")
    sums = words.unionByName(ends).agg(F.sum("train").alias("tokens"), F.sum((F.col("train") > 0).cast("long")).alias("distinct")).first()
    n, below = sums["tokens"] or 0, (sums["tokens"] or 0) + SMOOTHING * ((sums["distinct"] or 0) + 1)
    base = F.log10((F.col("train") + SMOOTHING) / F.lit(below))
    known = (F.col("train") > 0).cast("long")
    values = ["n_tokens", "n_known", "base_score"]
    end = ends.select(base.alias("base"), known.alias("known")).first()
    each_word = words.select("word", "total", F.lit(1).alias("n_tokens"), known.alias("n_known"), base.alias("base_score"))
    of_words = sums_by_row(rows, tokens, each_word, values, "binary", head_words, token_lists)
    of_words = of_words.withColumns({"score": F.lit(0.0), "coded": F.lit(0).cast("long")})
    nothing = F.lit(0.0)
    of_texts = sums_across_words(rows, trains, depth, head_grams).withColumns({c: nothing for c in values})
    each = of_words.unionByName(of_texts).groupBy(*KEY).agg(*(F.sum(c).alias(c) for c in (*values, "score", "coded")))
    added = with_sums(rows, each, [*values, "score", "coded"], {"held_out": ~trains})
    return added.select(
        "doc_id",
        "held_out",
        (F.col("n_tokens") + 1).cast("long").alias("n_tokens"),
        (F.col("n_known") + end["known"]).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base_score") + end["base"]).alias("base_score"),
        "score",
        (-F.col("score") / math.log10(2) / F.col("coded")).alias("bits_per_byte"),
    )
