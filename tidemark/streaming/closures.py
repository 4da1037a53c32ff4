"""Closures as sweeps and sightings arrive, in any order and in any batches.

What can close a posting is the next complete sweep of its scope, not the
passing of time, so no watermark applies. The state is keyed by the sweeps'
calendar (source, scope, key version) and a bucket of postings, so that a scope
with most postings is spread; it holds the calendar and, as one table, the last
sighting and closure of the bucket's postings. A batch reads and writes each
bucket that it touches once and works on its columns, so what it asks of the
state grows with buckets and not with postings; a task holds one bucket.
Changes are written batch by batch; the last change of a posting holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.events import CALENDAR
from ..operators.staging import IDENTITY
from .state import state_on_disk

#: Buckets of postings of a scope; each keeps the scope's calendar.
BUCKETS = 16
#: Stands for a time that is not there.
NEVER = -(1 << 63)
CHANGES = "source string, scope_id string, hmac_key_version string, source_id string, closed boolean, sweep_id string, event_at bigint, event_basis string"


def _micros(time: Column) -> Column:
    return F.coalesce(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), time.cast("timestamp_ntz")), F.lit(NEVER))


def _time(micros: Column) -> Column:
    return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


SEEN = pa.schema([("source_id", pa.string()), ("last_at", pa.int64()), ("last_sweep", pa.string()), ("removed_at", pa.int64()), ("next_at", pa.int64()), ("next_sweep", pa.string())])


class Closing(StatefulProcessor):
    """One bucket of a scope: rows (source_id, at, sweep_id, removed_at) are sightings, those without a source_id are sweeps."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.calendar = handle.getValueState("calendar", "times array<bigint>, sweeps array<string>")
        self.seen = handle.getValueState("seen", "held binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        arrived = pd.concat(list(rows), ignore_index=True)
        is_sweep = arrived["source_id"].isna()
        times, sweeps = self._noted(arrived[is_sweep].groupby("at")["sweep_id"].min().to_dict())
        old = self._seen()
        new = _following(_sighted(old, arrived[~is_sweep]), times, sweeps)
        if not new.equals(old):
            self._keep(new)
        yield _changes(key, _closures(old), _closures(new))

    def _seen(self) -> pd.DataFrame:
        if not self.seen.exists():
            return SEEN.empty_table().to_pandas()
        return pa.ipc.open_stream(bytes(self.seen.get()[0])).read_all().cast(SEEN).to_pandas()

    def _keep(self, seen: pd.DataFrame) -> None:
        table = pa.Table.from_pandas(seen, SEEN, preserve_index=False)
        for k, name in ((2, "last_sweep"), (5, "next_sweep")):
            table = table.set_column(k, name, table[name].dictionary_encode())
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, table.schema) as stream:
            stream.write_table(table.combine_chunks())
        self.seen.update((out.getvalue().to_pybytes(),))

    def _noted(self, told: dict[int, str]) -> tuple[list, list]:
        """The calendar with the sweeps of ``told``; of those at one time the least id counts."""
        known = self.calendar.get() if self.calendar.exists() else ([], [])
        calendar = dict(zip(known[0], known[1], strict=True))
        fresh = {int(t): s for t, s in told.items() if t not in calendar or s < calendar[t]}
        calendar |= fresh
        times = sorted(calendar)
        sweeps = [calendar[t] for t in times]
        if fresh:
            self.calendar.update((times, sweeps))
        return times, sweeps

    def close(self) -> None:
        pass


def _sighted(old: pd.DataFrame, sightings: pd.DataFrame) -> pd.DataFrame:
    """Last sighting and first removal of each posting, the known ones in their places and the new ones behind them."""
    names, ids = pd.factorize(pd.concat([old["source_id"], sightings["source_id"]], ignore_index=True))
    at = np.concatenate([old["last_at"].to_numpy("int64"), sightings["at"].to_numpy("int64")])
    sweep, sweep_ids = pd.factorize(pd.concat([old["last_sweep"], sightings["sweep_id"]], ignore_index=True), sort=True)
    gone = np.concatenate([old["removed_at"].to_numpy("int64"), sightings["removed_at"].to_numpy("int64")])
    order = np.lexsort((sweep, at, names))
    last = order[np.append(np.flatnonzero(np.diff(names[order])), len(order) - 1)] if len(order) else order
    first = np.full(len(ids), np.iinfo("int64").max)
    told = gone != NEVER
    np.minimum.at(first, names[told], gone[told])
    known = np.zeros(len(ids), bool)
    known[names[told]] = True
    return pd.DataFrame({"source_id": np.asarray(ids, object), "last_at": at[last], "last_sweep": np.asarray(sweep_ids, object)[sweep[last]], "removed_at": np.where(known, first, NEVER)})


def _following(seen: pd.DataFrame, times: list, sweeps: list) -> pd.DataFrame:
    """``seen`` with the first sweep of the calendar after each last sighting."""
    k = np.searchsorted(np.array(times, "int64"), seen["last_at"].to_numpy("int64"), "right")
    return seen.assign(next_at=np.array([*times, NEVER], "int64")[k], next_sweep=np.array([*sweeps, None], object)[k])


def _closures(seen: pd.DataFrame) -> pd.DataFrame:
    """Whether each posting is closed, by which sweep, when and on what basis: by the source's word, else by the next sweep."""
    reported, inferred = (seen["removed_at"] != NEVER).to_numpy(), (seen["next_at"] != NEVER).to_numpy()
    return pd.DataFrame({
        "source_id": seen["source_id"], "closed": reported | inferred, "sweep_id": np.where(reported, seen["last_sweep"], seen["next_sweep"]), "event_at": np.where(reported, seen["removed_at"], seen["next_at"]),
        "event_basis": np.where(reported, "source_reported", np.where(inferred, np.array("inferred_absence", object), None)),
    })


def _changes(key: tuple, before: pd.DataFrame, after: pd.DataFrame) -> pd.DataFrame:
    """Postings whose closure is another than before; those of ``before`` come first in ``after``, in the same places."""
    changed = after["closed"].to_numpy(copy=True)
    n = len(before)
    differs = [before[c].fillna("").to_numpy() != after[c][:n].fillna("").to_numpy() for c in ("closed", "sweep_id", "event_at", "event_basis")]
    changed[:n] = np.logical_or.reduce([np.asarray(d, bool) for d in differs])
    told = after[changed]
    return pd.DataFrame(dict(zip(CALENDAR, key, strict=False)), index=told.index).join(told)


def closure_changes(postings: DataFrame, sweeps: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Stream of changed closures from streams of admitted postings and sweeps.

    A row says what a posting's closure is now: ``closed`` with its sweep, time
    and basis, or open again. Repeated rows change nothing.
    """
    bucket = F.pmod(F.xxhash64("source_id"), F.lit(buckets)).cast("int")
    seen = postings.select(*IDENTITY, bucket.alias("bucket"), _micros(F.col("observed_at")).alias("at"), "sweep_id", _micros(F.col("removed_at")).alias("removed_at"))
    every = F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)))
    held = sweeps.select(*CALENDAR, F.lit(None).cast("string").alias("source_id"), every.alias("bucket"), _micros(F.col("observed_at")).alias("at"), "sweep_id", F.lit(NEVER).alias("removed_at"))
    return seen.unionByName(held).groupBy(*CALENDAR, "bucket").transformWithStateInPandas(Closing(), CHANGES, "Update", "None")


def run(changes: DataFrame, store: str, partitions: int | None = None) -> None:
    """Take in what is there: the changes of batch n are written, or written again, as batch=n under ``store``."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{store}/changes/batch={number}")

    with state_on_disk(changes.sparkSession, partitions):
        query = changes.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", f"{store}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()


def closures(spark: SparkSession, store: str) -> DataFrame:
    """The closures that hold after the batches so far, with the columns of the batch operator."""
    changes = spark.read.option("basePath", f"{store}/changes").schema(CHANGES + ", batch bigint").parquet(f"{store}/changes")
    last = changes.groupBy(*IDENTITY).agg(F.max_by(F.struct("closed", "sweep_id", "event_at", "event_basis"), "batch").alias("now")).where("now.closed")
    return last.select(*IDENTITY, "now.sweep_id", _time(F.col("now.event_at")).alias("event_at"), F.lit("closure").alias("event_type"), "now.event_basis")
