"""A frontier of segments run to its end: asked, subdivided where the answer is cut off, until nothing waits.

Every round looks only at what waits. Segments that are done are written to
the round's table and not read again, but for the check that a child is not
there already; a round that was lost is repeated from the table before it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.storage import new_path
from .panel import PER_PAGE, SEGMENT, children

#: Pages that the source shows of one query.
MOST_PAGES = 400
#: Rounds in which a segment that fails is asked, while others wait.
TRIES = 3
DONE = (*SEGMENT, "rows_yielded", "last_page_full", "truncated", "tries", "round")


class Drift(RuntimeError):
    """A segment that cannot be empty gave nothing: the source's pages have changed."""


def walked(waiting: DataFrame, answers: DataFrame, per_page: int = PER_PAGE, most: int = MOST_PAGES) -> DataFrame:
    """What asking the waiting segments gave, by ``answers`` (key, items, failed); segments without an answer have no items.

    A full last page that the source shows means that rows are hidden. States
    are probed for that only: their municipalities are asked in any case.
    """
    told = waiting.join(answers, "key", "left").fillna(0, ["items"]).fillna(False, ["failed"])
    cut = F.col("items") >= per_page * most
    state = F.col("level") == 1
    status = F.when(F.col("failed"), "failed").when(cut | state, "subdivided").otherwise("complete")
    rows = F.when(F.col("failed") | state, 0).otherwise(F.least(F.col("items"), F.lit(per_page * most))).cast("long")
    return told.withColumns({"status": status, "rows_yielded": rows, "last_page_full": ~F.col("failed") & cut, "truncated": ~F.col("failed") & cut}).drop("failed")


def run_to_end(
    frontier: DataFrame, ask: Callable[[DataFrame, int], DataFrame], states: DataFrame, postcodes: DataFrame, radius: int = 0, per_page: int = PER_PAGE, most: int = MOST_PAGES, tries: int = TRIES, rounds: int = 50, path: str | None = None
) -> DataFrame:
    """The frontier (``DONE`` columns) when nothing waits any more, or after ``rounds`` rounds.

    ``ask`` gives the answers (key, items, failed) to the waiting segments in a
    round, the first of which is 1. What fails is asked again in later rounds,
    ``tries`` times in all. Segments of the country and its states that give no
    items raise ``Drift``. A segment's round is that in which it was done; what
    still waits at the end has none.
    """
    spark = frontier.sparkSession
    path = path or new_path(spark, "frontier")
    blank = {"rows_yielded": F.lit(None).cast("long"), "last_page_full": F.lit(None).cast("boolean"), "truncated": F.lit(False), "tries": F.lit(0), "round": F.lit(None).cast("int")}
    start = frontier.select(*SEGMENT).withColumns(blank)
    waits = F.col("status").isin("pending", "failed")
    start.where(~waits).select(*DONE).write.parquet(f"{path}/done/at=0")
    start.where(waits).select(*DONE).write.parquet(f"{path}/waiting/at=0")
    schema = start.select(*DONE).schema
    for number in range(1, rounds + 1):
        waiting = spark.read.schema(schema).parquet(f"{path}/waiting/at={number - 1}")
        due = waiting.where(F.col("tries") < tries)
        if due.isEmpty():
            break
        given = walked(due.drop("rows_yielded", "last_page_full", "truncated"), ask(due, number).select("key", "items", "failed"), per_page, most)
        given.withColumns({"tries": F.col("tries") + 1, "round": F.when(F.col("status") != "failed", number).cast("int")}).write.parquet(f"{path}/asked/at={number}")
        asked = spark.read.parquet(f"{path}/asked/at={number}")
        if not asked.where("level < 2 AND items = 0 AND status <> 'failed'").isEmpty():
            raise Drift("a segment of the country or a state gave no items")
        asked.where("status <> 'failed'").select(*DONE).write.parquet(f"{path}/done/at={number}")
        known = spark.read.schema(schema).parquet(f"{path}/done").select("level", "key").unionByName(waiting.select("level", "key"))
        fresh = children(asked.where("truncated AND level <> 1"), states, postcodes, radius).join(known, ["level", "key"], "left_anti").withColumns(blank)
        again = asked.where("status = 'failed'").unionByName(waiting.where(F.col("tries") >= tries), allowMissingColumns=True)
        again.select(*DONE).unionByName(fresh.select(*DONE)).write.parquet(f"{path}/waiting/at={number}")
    else:
        number = rounds + 1
    left = spark.read.schema(schema).parquet(f"{path}/waiting/at={number - 1}")
    return spark.read.schema(schema).parquet(f"{path}/done").select(*DONE).unionByName(left)
