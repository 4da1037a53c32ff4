import random
import re
from collections import Counter, defaultdict
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.llm import divergence

from .helpers import LONG, documents

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def plain(docs, least, top=50):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, documents_with = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in docs:
        terms = TERM.findall((text or "").translate(lower))
        counts[lang or "", source or ""].update(terms)
        documents_with[lang or ""].update(set(terms))
    rows = set()
    for lang in documents_with:
        kept = sorted(t for t, n in documents_with[lang].items() if n >= least)
        groups = {s: c for (x, s), c in counts.items() if x == lang}
        all_ = sum(groups.values(), Counter())

        def shares(c, kept=kept):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in groups.items()}, shares(all_)
        for s, c in groups.items():
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in groups if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if c[t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                rows |= {(lang, s, part, i, v, r) for r, (i, v) in enumerate(found[:most], 1)}
    return rows


def corpus():
    rng = random.Random(4)
    vocabulary = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80)] + ["Été", "ÉTÉ", "été", "naïve", "ＡＢ"]
    docs = [(rng.choice(["en", "fr", None]), rng.choice(["s1", "s2", "s3", "S1", None]) if rng.random() < 0.6 else "hot", " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 9, 60])))) for _ in range(160)]
    docs += [("de", "a", None), ("de", "b", ""), ("de", "c", "123 456"), ("en", "alone", None), ("xx", "one", "lonely words")] + [("en", "hot", LONG)] * 3
    return docs


def frame(spark, docs):
    table = documents(spark, [(k, d[2]) for k, d in enumerate(docs)])
    more = spark.createDataFrame([(k, d[0], d[1]) for k, d in enumerate(docs)], "doc_id long, lang string, source string")
    return table.join(more, "doc_id").withColumns({"total": F.lit(1), "kept": F.lit(2), "term": F.lit("t"), "n": F.lit(5)})


def test_by_brute_force(spark):
    docs = corpus()
    for least, bound, block in ((3, 10**6, 1 << 16), (6, 0, 40), (500, 10**6, 1 << 16)):
        found = divergence.audit(frame(spark, docs), least, top=7, broadcast_rows=bound, block_cells=block)
        assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
        assert sorted(map(tuple, found.collect())) == sorted(plain(docs, least, 7))


def test_no_documents(spark):
    assert divergence.audit(frame(spark, [("en", "a", "b")]).limit(0)).count() == 0


def test_tallies_are_the_same_in_small_pieces(spark, monkeypatch):
    import pyarrow as pa

    cells = pa.table({"lang": ["x"] * 8, "source": list("abcabcab"), "term": [b"t", b"t", b"t", b"u", b"u", b"u", b"v", b"v"], "n": [1, 2, 3, 1, 2, 4, 1, 2]})
    whole = Counter()
    for r in pa.Table.from_batches(divergence._joint(cells)).to_pylist():
        whole[tuple(list(r.values())[:-1])] += r["terms"]
    monkeypatch.setattr(divergence, "PAIRS_AT_ONCE", 1)
    pieces = Counter()
    for r in pa.Table.from_batches(divergence._joint(cells)).to_pylist():
        pieces[tuple(list(r.values())[:-1])] += r["terms"]
    assert pieces == whole and whole["x", "a", "b", 1, 2] == 3 and whole["x", "b", "c", 2, 4] == 1


def test_shares_of_counts_beyond_any_long_product(spark):
    given = spark.createDataFrame([(10**15, 3 * 10**15, 7)], "n long, total long, kept long")
    found = given.select(divergence.share(F.col("n"), F.col("total"), F.col("kept")).alias("p")).first().p
    assert found == 1 + int(Decimal(10**9 * (10**15 + 5)) // Decimal(3 * 10**15 + 35))
