import random

from tidemark.llm.components import connected_components


def test_components_by_either_join(spark):
    random.seed(9)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5), (2000, 2001), (2001, 2000)]
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    wanted = {n: find(n) for n in root if any(n in e and e[0] != e[1] for e in edges)}
    table = spark.createDataFrame(edges, "a long, b long")
    for bound in (10**6, 0):
        found = connected_components(table, broadcast_rows=bound).collect()
        assert {r.node: r.root for r in found} == wanted and len(found) == len(wanted)
    assert connected_components(table.limit(0)).count() == 0
