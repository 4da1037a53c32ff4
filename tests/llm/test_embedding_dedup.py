import math

import numpy as np

from tidemark.llm import embedding_dedup

SF = "/root/testdata/sf0.001"


def plain(rows):
    good = lambda v, label: label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
    links = {i: [] for i in range(len(rows))}
    for i, (_, v, a) in enumerate(rows):
        for j in range(i):
            _, w, b = rows[j]
            if good(v, a) and good(w, b) and a == b and len(v) == len(w):
                x, y = np.array(v, np.float64), np.array(w, np.float64)
                if x @ y / (math.sqrt(x @ x) * math.sqrt(y @ y)) >= 0.98 or list(v) == list(w):
                    links[i].append(j)
                    links[j].append(i)
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        reach, todo = {i}, [i]
        while todo:
            new = [k for k in links[todo.pop()] if k not in reach]
            reach.update(new)
            todo += new
        least = min((rows[k][0] for k in reach if rows[k][0] is not None), default=None)
        out.append((vec_id, len(links[i]), least, vec_id == least))
    return sorted(out, key=repr)


def test_components_match_brute_force(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label")
    assert sorted(map(tuple, embedding_dedup.dedup(table).collect()), key=repr) == plain([tuple(r) for r in table.collect()])


def test_awkward_rows(spark):
    a, near = [1.0, 0.0, 0.5], [1.0, 0.05, 0.5]
    rows = [(1, a, 0), (2, a, 0), (2, a, 0), (3, near, 0), (4, a, 1), (5, a, None), (6, None, 0), (7, [0.0, 0.0, 0.0], 0), (8, [1.0, None, 0.5], 0), (9, [float("nan"), 1.0, 1.0], 0), (10, [float("inf"), 1.0, 1.0], 0), (None, a, 0), (None, [9.0, -1.0, 2.0], 3), (11, [], 0), (12, [1.0], 0)]
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<float>, label int, node string, n string")
    assert sorted(map(tuple, embedding_dedup.dedup(table).collect()), key=repr) == plain(rows)
    assert embedding_dedup.dedup(table.limit(0)).count() == 0


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(300):
        base = rng.standard_normal(48)
        off = rng.standard_normal(48)
        off -= base * (off @ base) / (base @ base)
        off *= np.linalg.norm(base) / np.linalg.norm(off)
        rows += [(2 * i, base.tolist(), 0), (2 * i + 1, (0.9805 * base + math.sqrt(1 - 0.9805**2) * off).tolist(), 0)]
    found = embedding_dedup.dedup(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    assert found.where("n_links = 1").count() == 600


def test_sizes_of_doubles_do_not_matter(spark):
    """Vectors near the ends of the range of doubles link by their directions alone."""
    rng = np.random.default_rng(5)
    base = rng.standard_normal(16)
    near, far = base + 0.01 * rng.standard_normal(16), base + 0.3 * rng.standard_normal(16)
    assert base @ far / math.sqrt((base @ base) * (far @ far)) < 0.98
    for size in (1e-300, 1e300):
        rows = [(i, (v * size).tolist(), 0) for i, v in enumerate((base, near, far))]
        found = embedding_dedup.dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).orderBy("vec_id").collect()
        assert [tuple(r) for r in found] == [(0, 1, 0, True), (1, 1, 0, False), (2, 0, 2, True)]
