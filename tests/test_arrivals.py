"""Streams, polls, feeds and sweeps that arrive piece by piece against what they give in one go."""

import datetime
import hashlib
import json
import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import events
from tidemark.sources import commit, feed
from tidemark.sources.storage import new_path
from tidemark.streaming import closures, marks

START = datetime.datetime(2024, 3, 1)
POSTING = "source string, scope_id string, hmac_key_version string, source_id string, observed_at timestamp_ntz, sweep_id string, removed_at timestamp_ntz"
SWEEP = "source string, scope_id string, hmac_key_version string, observed_at timestamp_ntz, sweep_id string"


def day(n):
    return START + datetime.timedelta(days=n, microseconds=n)


def history(seed):
    """Sweeps of two scopes, two of them at one time, and sightings, some repeated, some with a removal."""
    rng = random.Random(seed)
    sweeps = [("s", scope, "v1", day(n), f"{rng.randrange(99)}-{scope}-{n}-{k}") for scope in "ab" for n in range(8) for k in range(1 + (n == 3))]
    seen = []
    for source, scope, key, at, sweep in sweeps:
        for p in range(12):
            if rng.random() < 0.35:
                seen.append((source, scope, key, f"p{p}", at, sweep, day(rng.randrange(9)) if rng.random() < 0.05 else None))
    return sweeps, seen + seen[:5]


def plain(found):
    return sorted(tuple(r) for r in found.select("source", "scope_id", "hmac_key_version", "source_id", "sweep_id", "event_at", "event_type", "event_basis").collect())


@pytest.mark.parametrize("seed, pieces", [(1, 1), (2, 3), (3, 5)])
def test_closures_in_any_order_of_arrival(spark, seed, pieces):
    sweeps, seen = history(seed)
    rng = random.Random(seed + 10)
    rows = [("sweeps", r) for r in sweeps] + [("postings", r) for r in seen]
    rng.shuffle(rows)
    path, store = new_path(spark, "arrivals"), new_path(spark, "store")
    for piece in range(pieces):
        for name, schema in (("sweeps", SWEEP), ("postings", POSTING)):
            some = [r for n, r in rows[piece::pieces] if n == name]
            spark.createDataFrame(some, schema).coalesce(1).write.mode("append").parquet(f"{path}/{name}")
        arriving = [spark.readStream.schema(s).parquet(f"{path}/{n}") for n, s in (("postings", POSTING), ("sweeps", SWEEP))]
        closures.run(closures.closure_changes(*arriving, buckets=2), store)
    wanted = events.closures(spark.createDataFrame(seen, POSTING), spark.createDataFrame(sweeps, SWEEP))
    found = plain(closures.closures(spark, store))
    assert found == plain(wanted) and len(found) > 8


def feed_rows(spark, rows):
    return spark.createDataFrame(rows, "id string, status string, modified string")


def test_marks_of_polls(spark):
    polls = marks.MarkedFeed(spark, new_path(spark, "marks"))
    first = [("1", "P", "2024-01-01"), ("2", "P", "2024-01-03"), ("3", "A", "2024-01-02"), ("4", "A", None), ("5", "P", "  ")]
    assert polls.poll(feed_rows(spark, first), 0).count() == 5
    more = [*first, ("2", "P", "2024-01-05"), ("6", "A", "2024-01-01"), ("7", "P", "2024-01-04"), ("8", "N", "2024-01-01")]
    for _ in range(2):  # a repeated poll sees the marks as they were
        assert sorted(r.modified for r in polls.poll(feed_rows(spark, more), 1, budget=2, statuses=["P", "A"]).collect()) == ["2024-01-02", "2024-01-03", "2024-01-04"]
    told = {(r.status, r.batch): (r.mark, r.rows_seen, r.rows_left) for r in polls.marks().collect()}
    assert told == {("P", 0): ("2024-01-03", 3, 0), ("A", 0): ("2024-01-02", 2, 0), ("P", 1): (None, 2, 1), ("A", 1): ("2024-01-02", 1, 0)}
    assert {r.status: r.since for r in polls.current().collect()} == {"P": "2024-01-03", "A": "2024-01-02"}
    assert polls.poll(feed_rows(spark, more), 2).count() == 5
    assert {r.status: r.since for r in polls.current().collect()} == {"P": "2024-01-05", "A": "2024-01-02", "N": "2024-01-01"}
    assert marks.MarkedFeed(spark, new_path(spark, "none")).current().count() == 0


def items(spark, n):
    return spark.range(n).select("id", F.concat(F.lit("item "), "id").alias("item"))


def take(spark, path, **options):
    spark.dataSource.register(feed.RecordedFeed)
    stream = spark.readStream.format("recorded_feed").options(path=f"{path}/pages", **options).load()
    stream.writeStream.format("parquet").option("path", f"{path}/taken").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return sorted((r.page, r.place, r.item) for r in spark.read.parquet(f"{path}/taken").collect())


def test_a_feed_that_grows_is_read_once(spark):
    path = new_path(spark, "feed")
    wanted = lambda n: sorted((f"/feed/{k // 4}", k % 4, f"item {k}") for k in range(n))
    cursor = f"{path.removeprefix('file://')}/cursor/at.json"
    for n in (6, 6, 7, 13, 13):
        feed.record_pages(items(spark, n), [F.col("id")], 4, f"{path}/pages")
        if n == 7:
            os.makedirs(os.path.dirname(cursor), exist_ok=True)
            with open(cursor, "w") as f:
                f.write("{broken")
        assert take(spark, path, cursor_path=f"file://{cursor}") == wanted(n)


def test_positions_of_a_feed(spark):
    path = new_path(spark, "feed").removeprefix("file://")
    feed.record_pages(items(spark, 6), [F.col("id")], 4, f"file://{path}")
    whole = feed.FeedReader(path, "/feed/0", f"file://{path}-cursor/at.json")
    end = whole.latestOffset()
    assert (end["page"], end["items"]) == ("/feed/1", 2)
    assert whole.latestOffset() == end and whole.partitions(end, end) == []  # unchanged: nothing
    whole.commit(end)
    assert feed.FeedReader(path, "/feed/0", f"file://{path}-cursor/at.json").at == end
    for broken in ('{"page": "/feed/99", "tag": "x", "items": 1}', '{"page": 7}', "[]", "{"):
        with open(f"{path}-cursor/at.json", "w") as f:
            f.write(broken)
        anew = feed.FeedReader(path, "/feed/0", f"file://{path}-cursor/at.json")
        assert anew.at == feed.START and anew.latestOffset() == end and len(anew.partitions(anew.initialOffset(), end)) == 2
    shrunk = {**end, "tag": "other", "items": 50}
    assert [(p.url, p.first, p.last) for p in feed.FeedReader(path, "/feed/0").partitions(shrunk, end)] == [("/feed/1", 0, 2)]
    assert feed.Pages(f"{path}-none").get("/feed/0") is None


def test_tasks_of_a_long_feed_take_many_pages(spark, monkeypatch):
    """1,500 pages in six files: as many tasks as there are shelves and shares of them, and what they read is every item once."""
    path = new_path(spark, "feed").removeprefix("file://")
    feed.record_pages(items(spark, 2999), [F.col("id")], 2, f"file://{path}")
    reader, opened = feed.FeedReader(path, "/feed/0"), []
    read = feed.Pages._read
    monkeypatch.setattr(feed.Pages, "_read", lambda self, shelf, columns, **more: opened.append(shelf) or read(self, shelf, columns, **more))
    end = reader.latestOffset()
    assert (end["page"], end["items"]) == ("/feed/1499", 1) and len(opened) == 6
    tasks = reader.partitions({**feed.START, "page": "/feed/9", "tag": "changed", "items": 1}, end)
    assert len(tasks) <= feed.TASKS + 6 and [p for t in tasks for p in t.pages] == [("/feed/9", 1, 2), *((f"/feed/{k}", 0, 2) for k in range(10, 1499)), ("/feed/1499", 0, 1)]
    found = [row for t in tasks for batch in reader.read(t) for row in zip(*batch.to_pydict().values(), strict=True)]
    assert found == [(f"/feed/{k // 2}", k % 2, f"item {k}") for k in range(19, 2999)]
    with pytest.raises(OSError, match="/feed/3 was there"):
        list(reader.read(feed.PageRange([("/feed/2", 0, 2), ("/feed/3", 0, 9)])))


MANIFEST = {"source": "s", "scope_id": "a", "sweep_id": "1"}


def rows(spark, n):
    return spark.range(n).select(F.lpad(F.col("id").cast("string"), 6, "0").alias("source_id"), (F.col("id") % 7).alias("k"))


def test_a_sweep_that_fails_midway_is_not_there_and_resumes_to_the_same_bytes(spark):
    path, whole = (new_path(spark, t).removeprefix("file://") for t in ("sweep", "whole"))
    os.makedirs(f"{path}/pages/page-000003.ndjson/in-the-way")
    with pytest.raises(commit.ResumeRefused, match="in progress"):
        commit.write_sweep(rows(spark, 95), MANIFEST, path, 10)
    with pytest.raises(Exception):  # noqa: B017  the task that writes the fourth page cannot put it in place
        commit.write_sweep(rows(spark, 95), MANIFEST, path, 10, resume=True)
    assert not os.path.exists(f"{path}/manifest.json")
    os.removedirs(f"{path}/pages/page-000003.ndjson/in-the-way")
    told = commit.write_sweep(rows(spark, 95), MANIFEST, path, 10, resume=True)
    assert told["status"] == "complete" and told["completed_pages"] == 10 and told["row_count"] == 95
    once = commit.write_sweep(rows(spark, 95).repartition(7), MANIFEST, whole, 10)
    assert once["pages"] == told["pages"] and once["pages_resumed"] == 0
    for page in told["pages"]:
        name = f"pages/page-{page['index']:06d}.ndjson"
        body = open(f"{path}/{name}", "rb").read()
        assert body == open(f"{whole}/{name}", "rb").read() and hashlib.sha256(body).hexdigest() == page["safe_hash"]
    lines = [json.loads(line) for p in sorted(os.listdir(f"{path}/pages")) if p.endswith(".ndjson") for line in open(f"{path}/pages/{p}")]
    assert [r["source_id"] for r in lines] == [f"{k:06d}" for k in range(95)]
    assert commit.write_sweep(rows(spark, 95), MANIFEST, path, 10) == told  # finished: checked and left alone
    with pytest.raises(commit.ResumeRefused, match="another plan: scope_id"):
        commit.write_sweep(rows(spark, 95), MANIFEST | {"scope_id": "b"}, path, 10)
    with open(f"{path}/pages/page-000002.ndjson", "a") as f:
        f.write("x\n")
    assert [r.page for r in commit.altered_pages(spark, path).collect()] == ["page-000002.ndjson"]
    with pytest.raises(commit.ResumeRefused, match="altered"):
        commit.write_sweep(rows(spark, 95), MANIFEST, path, 10)


def test_sweeps_without_rows_or_with_bad_ids(spark):
    path = new_path(spark, "sweep").removeprefix("file://")
    told = commit.write_sweep(rows(spark, 0), MANIFEST, path, 10)
    assert told["status"] == "complete" and told["pages"] == []
    for bad in (rows(spark, 3).unionByName(rows(spark, 1)), rows(spark, 2).withColumn("source_id", F.lit("")), rows(spark, 1).withColumn("source_id", F.lit(None).cast("string"))):
        with pytest.raises(ValueError, match="missing or repeated"):
            commit.write_sweep(bad, MANIFEST, f"{path}-bad", 10)
        assert not os.path.exists(f"{path}-bad/pages")


class Kept:
    """A value of the state that counts how often it is asked."""

    def __init__(self):
        self.value, self.calls = None, 0

    def exists(self):
        return self.value is not None

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value


def test_what_closures_ask_of_the_state_does_not_grow_with_postings():
    states = {}

    class Handle:
        def getValueState(self, name, schema):
            return states.setdefault(name, Kept())

    closing = closures.Closing()
    closing.init(Handle())
    batch = lambda ids, at: pd.DataFrame({"source_id": pd.Series([*ids, None], dtype=object), "at": at, "sweep_id": f"s{at}", "removed_at": closures.NEVER})
    told = []
    for at, n in ((1, 5000), (2, 4000), (3, 4500)):
        told.append(pd.concat(closing.handleInputRows(("s", "a", "v1", 0), iter([batch([f"p{k}" for k in range(n)], at)]), None)))
    assert sum(s.calls for s in states.values()) <= 4 * 3
    assert [(len(t), int(t["closed"].sum())) for t in told] == [(0, 0), (1000, 1000), (500, 0)]
    again = told[2].set_index("source_id")
    assert tuple(again.loc["p4200", ["closed", "sweep_id", "event_at", "event_basis"]]) == (False, None, closures.NEVER, None)
