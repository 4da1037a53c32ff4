"""The frontier loop on a few segments: what is asked when, and when it stops."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import frontier, panel

SEGMENTS = "key string, level int, nuts_code string, nuts1 string, parent string, status string, recency_days int"


def run(spark, segments, held, failing=None, **more):
    """Run over ``held`` (key to items); ``failing`` is how often a key fails first."""
    asked = []
    answers = spark.createDataFrame([(k, n) for k, n in held.items()] or [("-", 0)], "key string, items long")
    fails = spark.createDataFrame([(k, n) for k, n in (failing or {}).items()] or [("-", 0)], "key string, fails int")

    def ask(due, number):
        asked.append(sorted(r.key for r in due.collect()))
        return due.select("key", "tries").join(answers, "key", "left").join(fails, "key", "left").select("key", F.coalesce("items", F.lit(0)).alias("items"), (F.coalesce("fails", F.lit(0)) > F.col("tries")).alias("failed"))

    states = spark.createDataFrame([("Bayern", "DE2"), ("Berlin", "DE3")], "name string, nuts1 string")
    codes = spark.createDataFrame([("10178", "DE300"), ("10179", "DE300"), ("80331", "DE212")], "source_code string, nuts_code string")
    found = frontier.run_to_end(spark.createDataFrame(segments, SEGMENTS), ask, states, codes, per_page=2, most=3, **more)
    return {(r.level, r.key): r for r in found.collect()}, asked


def segment(key, level, nuts=None, status="pending"):
    return (key, level, nuts, nuts and nuts[:3], None, status, None)


def test_only_what_is_cut_off_is_subdivided_until_nothing_waits(spark):
    start = [segment("", 0), segment("wo=Berlin&umkreis=0", 1), segment("wo=Berlin&umkreis=0", 2, "DE300"), segment("small", 2, "DE212"), segment("done", 2, "DE212", "complete")]
    held = {"": 6, "wo=Berlin&umkreis=0": 9, "small": 5, "wo=10178&umkreis=0": 6, "wo=10178&umkreis=0&veroeffentlichtseit=1": 7, "wo=Bayern&umkreis=0": 1}
    found, asked = run(spark, start, held)
    status = {k: (r.status, r.rows_yielded, r.round) for k, r in found.items()}
    assert status[0, ""] == ("subdivided", 6, 1) and status[1, "wo=Berlin&umkreis=0"] == ("subdivided", 0, 1) and status[1, "wo=Bayern&umkreis=0"] == ("subdivided", 0, 2)
    assert status[2, "small"] == ("complete", 5, 1) and status[2, "done"] == ("complete", None, None)
    assert status[3, "wo=10178&umkreis=0"] == ("subdivided", 6, 2) and status[3, "wo=10179&umkreis=0"] == ("complete", 0, 2)
    assert status[4, "wo=10178&umkreis=0&veroeffentlichtseit=1"] == ("subdivided", 6, 3) and status[4, "wo=10178&umkreis=0&veroeffentlichtseit=30"] == ("complete", 0, 3)
    assert len(found) == 11 and len(asked) == 3 and asked[1] == sorted(["wo=Bayern&umkreis=0", "wo=10178&umkreis=0", "wo=10179&umkreis=0"])
    assert found[3, "wo=10178&umkreis=0"].parent == "wo=Berlin&umkreis=0" and found[4, "wo=10178&umkreis=0&veroeffentlichtseit=7"].recency_days == 7


def test_failures_are_asked_again_and_given_up(spark):
    found, asked = run(spark, [segment("a", 2, "DE212"), segment("b", 2, "DE212")], {"a": 3, "b": 4}, {"a": 2, "b": 9}, tries=3)
    assert asked == [["a", "b"], ["a", "b"], ["a", "b"]]
    assert (found[2, "a"].status, found[2, "a"].round, found[2, "a"].rows_yielded) == ("complete", 3, 3)
    assert (found[2, "b"].status, found[2, "b"].round, found[2, "b"].tries) == ("failed", None, 3)


def test_a_run_that_stops_early_goes_on_from_what_it_left(spark):
    start = [segment("wo=Berlin&umkreis=0", 2, "DE300")]
    held = {"wo=Berlin&umkreis=0": 6, "wo=10178&umkreis=0": 6}
    half, _ = run(spark, start, held, rounds=1)
    assert sorted((k, r.status) for k, r in half.items()) == [((2, "wo=Berlin&umkreis=0"), "subdivided"), ((3, "wo=10178&umkreis=0"), "pending"), ((3, "wo=10179&umkreis=0"), "pending")]
    again = [tuple(getattr(r, c) for c in panel.SEGMENT) for r in half.values()]
    rest, asked = run(spark, again, held)
    whole, _ = run(spark, start, held)
    assert {k: r.status for k, r in rest.items()} == {k: r.status for k, r in whole.items()} and len(asked) == 2


def test_an_empty_country_is_drift_and_no_segments_are_none(spark):
    with pytest.raises(frontier.Drift):
        run(spark, [segment("", 0)], {})
    assert run(spark, [], {}) == ({}, [])
