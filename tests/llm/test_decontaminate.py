import math
import random
import re

from tidemark.llm import decontaminate

from .helpers import BODY, LONG, documents


def split(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]


def shingles(words, size):
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def plain(docs, items):
    found = set()
    for d, text in docs:
        for i, item in items:
            size = min(5, len(split(item)))
            want, have = (shingles(split(t), size) if size else set() for t in (item, text))
            if want and len(want & have) >= math.ceil(len(want) * 0.8):
                found.add((d, i, len(want), len(want & have)))
    return found


def test_finds_what_brute_force_finds(spark):
    random.seed(1)
    vocabulary = [f"w{i}" for i in range(60)]
    text = lambda n: " ".join(random.choices(vocabulary, k=n))
    items = [(i, text(random.choice([1, 3, 5, 6, 9, 20, 60]))) for i in range(40)] + [(90, None), (91, ""), (92, BODY), (92, BODY), (None, "one two three four five six")]
    docs = []
    for d in range(60):
        words = text(random.choice([3, 30, 300])).split()
        if d % 2:
            part = random.choice(items[:40])[1].split()
            if d % 4 == 1 and len(part) > 10:
                part[random.randrange(len(part))] = "changed"
            words[len(words) // 2 : len(words) // 2] = part
        docs.append((d, " ".join(words)))
    docs += [(70, items[3][1]), (71, BODY.upper() + " tail"), (71, BODY), (72, None), (73, ""), (74, LONG + " " + BODY), (None, BODY), (None, "one two three four five six")]
    table = spark.createDataFrame(items, "item_id long, text string")
    expected = plain(docs, items)
    assert len(expected) > 20
    for bound in (10**6, 0):
        found = decontaminate.contained_items(documents(spark, docs), table, broadcast_rows=bound).collect()
        assert {(r.doc_id, r.item_id, r.n_item, r.n_found) for r in found} == expected
    kept = decontaminate.decontaminate(documents(spark, docs), table)
    assert kept.columns == documents(spark, docs).columns
    leaky = [(d, t) for d, t in docs if plain([(d, t)], items)]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted((x for x in docs if x not in leaky), key=repr)


def test_short_items_are_found_inside_documents(spark):
    docs = documents(spark, [(1, "The quick brown fox jumps over the lazy dog and runs away"), (2, "brown fox"), (3, "fox brown jumps"), (4, "dog"), (5, None)])
    items = spark.createDataFrame([(1, "Brown fox jumps"), (2, "dog"), (3, "lazy dog"), (4, "brown fox leaps")], "item_id long, text string")
    found = decontaminate.contained_items(docs, items).collect()
    assert sorted((r.doc_id, r.item_id, r.n_item, r.n_found) for r in found) == [(1, 1, 1, 1), (1, 2, 1, 1), (1, 3, 1, 1), (4, 2, 1, 1)]


def test_empty_tables(spark):
    none, some = spark.createDataFrame([], "item_id long, text string"), documents(spark)
    assert decontaminate.decontaminate(some, none).count() == some.count()
    assert decontaminate.contained_items(documents(spark, []), none).count() == 0


def test_plan_has_no_python(spark):
    plan = decontaminate.contained_items(documents(spark), spark.createDataFrame([(1, BODY)], "item_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
