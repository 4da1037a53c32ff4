import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import stream_dedup
from tidemark.llm.common import new_path

from .helpers import BODY, ROWS, by_id, documents

DOCS = [*ROWS, (20, " ".join(BODY)), (21, BODY.replace(" ", "\n\n")), (22, BODY + " "), (23, " "), (24, "x" * 300_000), (25, "x" * 300_000), (26, "é"), (27, "é")] + [(100 + k, "hot  copy") for k in range(40)] + [(99, "hot copy   "), (98, "hot copy   ")]


def plain(docs):
    groups = {}
    for d, text in docs:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", "", text or ""), []).append((-len(text or ""), d is None, d or 0))
    rows = []
    for body, members in groups.items():
        least = min(members)
        keep = None if least[1] else least[2]
        for k, (_, nameless, d) in enumerate(sorted(members)):
            rows.append((None if nameless else d, keep, len(members), k == 0, hashlib.sha256(body.encode()).hexdigest()))
    return sorted(rows, key=repr)


def decided(found):
    return by_id(found.withColumn("sha", F.lower(F.hex("digest"))).collect(), "doc_id", "keep_id", "group_size", "kept", "sha")


def put(spark, docs, folder, part):
    documents(spark, docs).repartition(2).write.parquet(f"{folder}/{part}")


@pytest.mark.parametrize("bound", [10**6, 0])
def test_by_brute_force(spark, bound):
    folder = new_path(spark, "arrivals")
    put(spark, DOCS, folder, "a")
    found = stream_dedup.Dedup(spark, f"{folder}/*", new_path(spark, "store"), broadcast_rows=bound).run().decisions()
    assert decided(found) == plain(DOCS)


def test_what_arrives_later_joins_the_groups_that_are_there(spark):
    folder, store = new_path(spark, "arrivals"), new_path(spark, "store")
    put(spark, DOCS[:30], folder, "a")
    one_by_one = lambda: stream_dedup.Dedup(spark, f"{folder}/*", store, files_at_once=1)
    first = one_by_one().run()
    assert decided(first.decisions()) == plain(DOCS[:30])
    put(spark, DOCS[30:], folder, "b")
    later = one_by_one().run().run()  # nothing is new the second time
    assert decided(later.decisions()) == plain(DOCS)


def test_a_digest_that_collides_is_settled_by_the_bytes(spark):
    folder = new_path(spark, "arrivals")
    put(spark, DOCS, folder, "a")
    short = lambda text: F.unhex(F.lpad(F.hex(F.ascii(text) % 2), 2, "0"))
    found = stream_dedup.Dedup(spark, f"{folder}/*", new_path(spark, "store"), digest=short).run().decisions()
    assert by_id(found.collect(), "doc_id", "keep_id", "group_size", "kept") == sorted((r[:4] for r in plain(DOCS)), key=repr)


def test_settings_are_put_back_and_state_is_on_disk(spark):
    folder, store = new_path(spark, "arrivals"), new_path(spark, "store")
    put(spark, DOCS, folder, "a")
    before = {k: spark.conf.get(k, None) for k in stream_dedup.STATE}
    dedup = stream_dedup.Dedup(spark, f"{folder}/*", store).run()
    assert {k: spark.conf.get(k, None) for k in stream_dedup.STATE} == before
    state = spark.read.format("statestore").load(f"{store}/checkpoints/groups")
    assert state.count() == dedup.groups().count() == len({r[4] for r in plain(DOCS)})
    offsets = spark.read.text(f"{store}/checkpoints/groups/offsets").where("value like '%RocksDB%'")
    assert offsets.count() > 0
    plan = dedup.decisions()._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    folder = new_path(spark, "arrivals")
    put(spark, [], folder, "a")
    assert stream_dedup.Dedup(spark, f"{folder}/*", new_path(spark, "store")).run().decisions().count() == 0
