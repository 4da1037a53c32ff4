import hashlib
import random
import re
import zlib

import numpy as np

from tidemark.llm import periodic_runs, registry

from .helpers import documents


def plain_runs(words, least=12):
    """All runs, by trying every period at every word."""
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, 2 * q):
                part = words[i : i + length]
                if not any(part[r:] == part[: length - r] for r in range(1, q)):
                    found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_collapsed(words, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def split(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def random_texts(seed, count):
    rng = random.Random(seed)
    for _ in range(count):
        words = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.choice([0, 1, 11, 12, 13, 40, 90]))]
        if len(words) > 6 and rng.random() < 0.6:
            a = rng.randrange(len(words))
            p = rng.randint(1, max(1, (len(words) - a) // 2))
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        yield words


def test_runs_by_brute_force_for_several_lengths():
    for least in (2, 5, 12):
        texts = list(random_texts(least, 400))
        owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        offset = np.cumsum([0, *map(len, texts)]).tolist()
        found = list(zip(*(x.tolist() for x in periodic_runs.runs_of(np.array(sum(texts, []), np.int32), owner, least)), strict=True))
        assert found == [(s + offset[k], n, q) for k, t in enumerate(texts) for s, n, q in plain_runs(t, least)]


def test_the_stack_and_the_jumps_agree(monkeypatch):
    rng = np.random.default_rng(1)
    depth = np.concatenate([[-1], rng.integers(0, 6, 500)])
    jumped = [periodic_runs.nearest_below(depth, s) for s in (True, False)]
    monkeypatch.setattr(periodic_runs, "JUMPS", 0)
    assert all((a == periodic_runs.nearest_below(depth, s)).all() for a, s in zip(jumped, (True, False), strict=True))


def test_small_slices_and_few_leaves_give_the_same(monkeypatch):
    words = [f"w{i % 5}" for i in range(300)] + ["x"] + ["y"] * 40 + [f"z{i % 3}{i // 90}" for i in range(200)]
    codes = np.unique(words, return_inverse=True)[1].astype(np.int32)
    whole = [x.tolist() for x in periodic_runs.runs_of(codes, np.zeros(len(codes), np.int64))]
    monkeypatch.setattr(periodic_runs, "LEAVES_AT_ONCE", 3)
    monkeypatch.setattr(periodic_runs, "ROTATED_TOGETHER", 1)
    assert whole == [x.tolist() for x in periodic_runs.runs_of(codes, np.zeros(len(codes), np.int64))]
    assert list(zip(*whole, strict=True)) == plain_runs(words)


def test_awkward_documents(spark):
    rows = [(k, " ".join(f"w{c}" for c in words)) for k, words in enumerate(random_texts(9, 60))]
    rows += [(100, None), (101, ""), (102, " \n\t"), (None, "a " * 30), (103, "b c " * 20), (103, "b c " * 20), (104, "ab " * 100_000), (105, "q" * 500_000), (106, "x\x1cy " * 12), (107, "A a " * 6)]
    docs = documents(spark, rows)
    found = sorted((tuple(map(repr, (r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed))) for r in periodic_runs.find_runs(docs).collect()))
    wanted = []
    for d, text in rows:
        words = split(text)
        runs = [(0, len(words), 1)] if d == 104 else plain_runs(words)
        wanted.append(tuple(map(repr, (d, len(words), runs, plain_collapsed(words, runs)))))
    assert found == sorted(wanted)
    assert periodic_runs.find_runs(documents(spark, [])).count() == 0
    odd = spark.createDataFrame([("a", "u v " * 9)], "`my.id` string, `the text` string")
    assert [tuple(x) for x in periodic_runs.find_runs(odd, "my.id", "the text").first().runs] == [(0, 18, 2)]


def test_query_by_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    wanted = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        words = split(r.text)
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = fast_runs(words)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        wanted[r.doc_id] = (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha(lines), sha(plain_collapsed(words, runs)))
    found = {r.doc_id: tuple(r)[1:] for r in registry.op13_periodic_runs(spark, sf).collect()}
    assert found == wanted
    assert sum(v[0] > 0 for v in found.values()) > 5


def fast_runs(words, least=12):
    """As ``plain_runs``, with numpy comparing a whole text with itself moved by each period."""
    codes = np.unique(words, return_inverse=True)[1] if words else np.zeros(0, int)
    n, found = len(codes), []
    for q in range(1, n // 2 + 1):
        same = np.concatenate([[False], codes[q:] == codes[:-q], [False]])
        turns = np.flatnonzero(same[1:] != same[:-1])
        for i, j in zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True):
            length = j - i + q
            if length >= max(least, 2 * q):
                part = codes[i : i + length]
                if not any((part[r:] == part[: length - r]).all() for r in range(1, q)):
                    found.append((i, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))
