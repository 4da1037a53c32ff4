import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import simhash

from .helpers import ROWS, documents

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashed = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashed) > len(hashed))


def plain_components(rows, bits=4):
    marks = [(d, plain_fingerprint(t)) for d, t in rows]
    group = list(range(len(marks)))
    find = lambda i: i if group[i] == i else find(group[i])
    for i in range(len(marks)):
        for j in range(i):
            if (marks[i][1] ^ marks[j][1]).bit_count() <= bits:
                group[find(i)] = find(j)
    out = []
    for i, (d, fp) in enumerate(marks):
        ids = [marks[j][0] for j in range(len(marks)) if find(j) == find(i) and marks[j][0] is not None]
        out.append((d, fp, min(ids, default=None)))
    return out


def test_two_errors_share_a_codeword():
    random.seed(2)
    words = np.array([random.getrandbits(23) for _ in range(300)])
    for n in (0, 1, 2):
        other = words.copy()
        for i in range(len(other)):
            for bit in random.sample(range(23), n):
                other[i] ^= 1 << bit
        a, b = simhash.golay_keys(words), simhash.golay_keys(other)
        assert all(set(x[x >= 0]) & set(y[y >= 0]) for x, y in zip(a, b, strict=True))


def test_near_pairs_are_all_found(spark):
    random.seed(5)
    fps = {random.getrandbits(64) for _ in range(60)}
    for fp in list(fps):
        for n in (1, 2, 3, 4, 5):
            fps.add(fp ^ sum(1 << b for b in random.sample(range(64), n)))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    table = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    found = sorted({tuple(r) for r in simhash.near_pairs(table).collect()})
    listed = sorted(map(signed, fps))
    assert found == [(a, b) for i, a in enumerate(listed) for b in listed[i + 1 :] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4]


def test_keyed_rows_are_never_broadcast(spark, tmp_path):
    """A written table below Spark's threshold has far more keyed rows than Spark sizes."""
    spark.range(1000).select(F.xxhash64("id").alias("fp")).write.parquet(f"{tmp_path}/fps")
    plan = simhash.near_pairs(spark.read.parquet(f"{tmp_path}/fps"))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_components_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for table in (docs, documents(spark)):
        found = [(r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in simhash.simhash_components(table).collect()]
        assert sorted(found, key=repr) == sorted(plain_components([(r.doc_id, r.text) for r in table.collect()]), key=repr)


def test_one_of_each_group_stays(spark):
    docs = documents(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    groups = {c for _, _, c in plain_components(ROWS)}
    found = [r.doc_id for r in kept.collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, groups))
    assert simhash.keep_one(documents(spark, [])).count() == 0
    assert simhash.simhash_components(documents(spark, [])).count() == 0
