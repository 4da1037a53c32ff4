import math
import zlib
from collections import Counter, defaultdict

import pyarrow as pa

from tidemark.llm import ctw

from .helpers import ROWS, documents

DEPTH = 4


def kt(zeros, ones):
    return math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.lgamma(zeros + ones + 1) - math.log(math.pi)


def plain_base(rows):
    """Everything but the context tree's score."""
    split = lambda t: [*(t or "").encode().lower().split(), b"\n"]
    trains = [d is not None and zlib.crc32(str(d).encode()) % 10 != 0 for d, _ in rows]
    train = Counter(w for (_, text), use in zip(rows, trains, strict=True) if use for w in split(text))
    n, v = sum(train.values()), len(train)
    for (d, text), use in zip(rows, trains, strict=True):
        tokens = split(text)
        yield d, not use, len(tokens), sum(train[t] > 0 for t in tokens), n, sum(math.log10((train[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)


def test_branches_cut_at_any_size(spark, monkeypatch):
    rows = [(i, f"word{i} again{i % 7}") for i in range(40)]
    whole = sorted(map(tuple, ctw.score_texts(documents(spark, rows)).collect()))
    monkeypatch.setattr(ctw, "GRAMS_AT_ONCE", 5)
    for most in (50, 5, 1):  # the cut is made after 2 bytes and more
        monkeypatch.setattr(ctw, "BRANCH_GRAMS", most)
        cut = sorted(map(tuple, ctw.score_texts(documents(spark, rows)).collect()))
        assert all(a[:5] == b[:5] and abs(a[6] - b[6]) < 1e-9 for a, b in zip(whole, cut, strict=True))


def plain_across(rows):
    """Scores by brute force, contexts running through the whole text."""

    def stream(text):
        raw = b"".join(w + b" " for w in (text or "").encode().lower().split()) + b"\n"
        padded = bytes(DEPTH - 1) + b" " + raw
        for i, byte in enumerate(raw):
            for left in range(7, -1, -1):
                yield padded[i : i + DEPTH][::-1], 1 << 7 - left | byte >> left + 1, byte >> left & 1

    counts, children, memo = defaultdict(lambda: [0, 0]), defaultdict(set), {}
    for d, text in rows:
        use = d is not None and zlib.crc32(str(d).encode()) % 10 != 0
        for context, node, bit in stream(text):
            for k in range(DEPTH + 1):
                counts[context[:k], node][bit] += use
                if k:
                    children[context[: k - 1], node].add(context[:k])

    def weighted(context, node):
        if (context, node) not in memo:
            own, below = kt(*counts[context, node]), sum(weighted(c, node) for c in children[context, node])
            memo[context, node] = own if len(context) == DEPTH else math.log(0.5) + max(own, below) + math.log1p(math.exp(-abs(own - below)))
        return memo[context, node]

    def one(context, node, k=0):
        zeros, ones = counts[context[:k], node]
        own = (ones + 0.5) / (zeros + ones + 1)
        stop = 1 if k == DEPTH else 0.5 * math.exp(kt(zeros, ones) - weighted(context[:k], node))
        return stop * own + (1 - stop) * one(context, node, k + 1) if k < DEPTH else own

    for d, text in rows:
        every = [math.log10(p if bit else 1 - p) for c, node, bit in stream(text) for p in [one(c, node)]]
        yield d, sum(every), -sum(every) / math.log10(2) / (len(every) / 8)


def test_scores_match_a_plain_context_tree(spark, monkeypatch):
    rows = [r for r in ROWS if r[0] != 6] + [(i, f"Some words {i} and some more wordy words{i % 3} ünd") for i in range(30, 60)]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    want = sorted(((d, s, bits, *base[1:]) for (d, s, bits), base in zip(plain_across(rows), plain_base(rows), strict=True)), key=key)
    for head, together in ((ctw.HEAD_GRAMS, 1 << 20), (20, 1 << 20), (0, 7)):
        monkeypatch.setattr(ctw, "BYTES_AT_ONCE", together)
        found = ctw.score_texts(documents(spark, rows), depth=DEPTH, head_words=3, head_grams=head).collect()
        for got, (d, score, bits, *rest) in zip(sorted(found, key=lambda r: key((r.doc_id, r.score))), want, strict=True):
            assert got.doc_id == d and abs(got.score - score) < 1e-6 and abs(got.bits_per_byte - bits) < 1e-6
            assert list(got[1:5]) == rest[:4] and abs(got.base_score - rest[4]) < 1e-6


def test_held_out_texts_score_above_the_base(spark):
    """The tree beats the smoothed unigrams on texts that it did not learn from."""
    import __spark_entry__ as entry

    held = entry.queries()["op8_ctw_scores"](spark, "/root/testdata/sf0.01").where("held_out").selectExpr("sum(score) AS score", "sum(base_score) AS base").first()
    assert held.score > held.base


def test_word_order_changes_the_score_of_the_query(spark, tmp_path):
    import __spark_entry__ as entry

    fluent = " ".join(["the cat sat on the mat and saw the dog run"] * 5)
    shuffled = " ".join(sorted(fluent.split()))
    documents(spark, [*((i, fluent) for i in range(1, 60)), (100, fluent), (101, shuffled)]).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in entry.queries()["op8_ctw_scores"](spark, str(tmp_path)).collect()}
    assert abs(found[100].base_score - found[101].base_score) < 1e-6
    assert found[100].score > found[101].score + 1


def test_counts_are_the_same_however_many_are_held(spark, monkeypatch):
    texts = [f"word{i % 5} and more{i % 3} of it" for i in range(50)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([i % 4 > 0 for i in range(50)])], ["text", "trains"])
    sums = []
    for held, together in ((1 << 22, 1 << 20), (30, 64)):
        monkeypatch.setattr(ctw, "COUNTS_HELD", held)
        monkeypatch.setattr(ctw, "BYTES_AT_ONCE", together)
        n, total = Counter(), Counter()
        for out in ctw._text_gram_counts(6)([batch]):
            for gram, a, b in zip(*(c.to_pylist() for c in out.columns), strict=True):
                n[gram] += a
                total[gram] += b
        sums.append((n, total))
    assert sums[0] == sums[1] and sum(sums[0][1].values()) == sum(len(t) + 2 for t in texts)


def test_words_are_counted_before_they_leave_a_task():
    texts, trains = ["A b\x0b a\x1cA É É", "", " \r\n ", "b a c É"], [True, True, False, False]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(trains)], ["text", "trains"])
    found = [tuple(r.values()) for b in ctw._word_counts([batch]) for r in b.to_pylist()]
    want = Counter(w for t in texts for w in ctw.tokens(t))
    train = Counter(w for t, use in zip(texts, trains, strict=True) if use for w in ctw.tokens(t))
    assert sorted(found) == sorted((w, n, train[w]) for w, n in want.items())  # one row a word, not one a text


def test_sorted_grams_are_added_up_across_batches():
    grams = [3, 3, 5, 5, 5, 8, 9, 9]
    for size in (1, 2, 3, 8):
        batches = [pa.RecordBatch.from_arrays([pa.array(grams[i : i + size]), pa.array([1] * len(grams[i : i + size])), pa.array([2] * len(grams[i : i + size]))], ["gram", "n", "total"]) for i in range(0, 8, size)]
        assert [tuple(r.values()) for b in ctw._added_up(batches) for r in b.to_pylist()] == [(3, 2, 4), (5, 3, 6), (8, 1, 2), (9, 2, 4)]
    assert not sum(b.num_rows for b in ctw._added_up([]))


def test_empty_table(spark):
    assert ctw.score_texts(documents(spark, [])).count() == 0
