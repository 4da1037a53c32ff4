"""Sweeps written page by page with hashes, resumed where they broke off, and made visible by a manifest that comes last.

Each task writes whole pages under temporary names and renames them, and tells
the driver each page's number, rows and hashes. The driver writes the manifest
once all pages are there; without it there is no sweep. A run that failed
leaves its finished pages, and the next one keeps those whose bytes are the
same, so a resumed sweep has the bytes of one that never broke off.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from .storage import numbered

PAGE_FILE = "page-{:06d}.ndjson"


@dataclass
class Written(WriterCommitMessage):
    pages: list[dict]


class SweepWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, manifest: dict, page_size: int, total: int):
        self.folder, self.manifest, self.page_size, self.total = folder, manifest, page_size, total

    def _system(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.folder)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """Rows (page, place, id, line) of whole pages, sorted; only the page at hand is in memory."""
        system, root = self._system()
        system.create_dir(f"{root}/pages", recursive=True)
        told: list[dict] = []
        number, lines, ids = None, [], []

        def put() -> None:
            if number is not None:
                told.append(self._page(system, root, number, lines, ids))

        for batch in iterator:
            for page, name, line in zip(batch.column("page").to_pylist(), batch.column("id").to_pylist(), batch.column("line").to_pylist(), strict=True):
                if page != number:
                    put()
                    number, lines, ids = page, [], []
                lines.append(line)
                ids.append(name)
        put()
        return Written(told)

    def _page(self, system: fs.FileSystem, root: str, number: int, lines: list[str], ids: list[str]) -> dict:
        if len(set(ids)) != len(ids):
            raise ValueError(f"page {number} holds an id twice")
        body = "".join(f"{line}\n" for line in lines).encode()
        path = f"{root}/pages/{PAGE_FILE.format(number)}"
        known = system.get_file_info(path)
        kept = known.is_file and known.size == len(body) and _bytes(system, path) == body
        if not kept:
            part = f"{path}.{uuid.uuid4().hex}.part"
            with system.open_output_stream(part) as out:
                out.write(body)
            system.move(part, path)
        return {"index": number, "row_count": len(lines), "safe_hash": hashlib.sha256(body).hexdigest(), "ids_hash": hashlib.sha256("\n".join(ids).encode()).hexdigest(), "kept": kept}

    def commit(self, messages: list[Written | None]) -> None:
        pages = sorted((p for m in messages if m is not None for p in m.pages), key=lambda p: p["index"])
        rows, wanted = sum(p["row_count"] for p in pages), -(-self.total // self.page_size) if self.total else 0
        if [p["index"] for p in pages] != list(range(wanted)) or rows != self.total or any(p["row_count"] != self.page_size for p in pages[:-1]):
            raise ValueError("sweep totals do not reconcile")
        system, root = self._system()
        kept = sum(p.pop("kept") for p in pages)
        told = self.manifest | {"status": "complete", "expected_pages": wanted, "completed_pages": wanted, "expected_rows": self.total, "row_count": rows, "pages": pages, "pages_resumed": kept}
        part = f"{root}/manifest.json.{uuid.uuid4().hex}.part"
        system.create_dir(root, recursive=True)
        with system.open_output_stream(part) as out:
            out.write((json.dumps(told, sort_keys=True) + "\n").encode())
        system.move(part, f"{root}/manifest.json")

    def abort(self, messages: list[Written | None]) -> None:
        """Finished pages stay for the next run; without a manifest there is no sweep."""


def _bytes(system: fs.FileSystem, path: str) -> bytes:
    with system.open_input_stream(path) as stream:
        return stream.read()


class Sweep(DataSource):
    """``df.write.format("sweep")`` of rows (page, place, id, line) with options path, manifest, page_size and total."""

    @classmethod
    def name(cls) -> str:
        return "sweep"

    def schema(self) -> str:
        return "page bigint, place bigint, id string, line string"

    def writer(self, schema, overwrite: bool) -> SweepWriter:
        return SweepWriter(self.options["path"], json.loads(self.options["manifest"]), int(self.options["page_size"]), int(self.options["total"]))


class ResumeRefused(ValueError):
    """What is there belongs to another plan, was altered, or is in progress and no resume was asked for."""


def _existing(spark: SparkSession, path: str) -> dict | None:
    system, root = fs.FileSystem.from_uri(path)
    if not system.get_file_info(f"{root}/manifest.json").is_file:
        return None
    return json.loads(_bytes(system, f"{root}/manifest.json"))


def altered_pages(spark: SparkSession, path: str) -> DataFrame:
    """(page, sha256, stored_sha256): the pages of a finished sweep whose bytes are not those of its manifest, or that are missing."""
    stored = spark.read.json(f"{path}/manifest.json").select(F.explode("pages").alias("p")).select(F.format_string("page-%06d.ndjson", "p.index").alias("page"), F.col("p.safe_hash").alias("stored_sha256"))
    there = spark.read.format("binaryFile").load(f"{path}/pages/*.ndjson").select(F.regexp_extract("path", "([^/]+)$", 1).alias("page"), F.sha2("content", 256).alias("sha256"))
    return stored.join(there, "page", "left").where(~F.col("sha256").eqNullSafe(F.col("stored_sha256"))).select("page", "sha256", "stored_sha256")


def write_sweep(rows: DataFrame, manifest: dict, path: str, page_size: int, id_column: str = "source_id", resume: bool = False) -> dict:
    """Write ``rows``, in the order of their ids, as a sweep under ``path``; the manifest.

    A finished sweep is checked against its plan and its hashes and left alone.
    One in progress needs ``resume``. Rows without an id and ids that occur
    twice stop the write before anything is there.
    """
    spark = rows.sparkSession
    spark.dataSource.register(Sweep)
    there = _existing(spark, path)
    if there is not None:
        differs = sorted(k for k, v in manifest.items() if there.get(k) != v)
        if differs:
            raise ResumeRefused(f"another plan: {', '.join(differs)}")
        if not altered_pages(spark, path).isEmpty():
            raise ResumeRefused("pages were altered")
        return there
    system, root = fs.FileSystem.from_uri(path)
    if not resume and system.get_file_info(f"{root}/pages").type != fs.FileType.NotFound:
        raise ResumeRefused("a run is in progress")
    lined = rows.select(F.col(id_column).cast("string").alias("id"), F.to_json(F.struct(*sorted(rows.columns))).alias("line"))
    bad = lined.groupBy("id").count().where("id IS NULL OR id = '' OR count > 1")
    if not bad.isEmpty():
        raise ValueError("ids are missing or repeated")
    placed, total = numbered(lined, ["id"], f"{path}-lines")
    paged = placed.withColumn("page", F.floor(F.col("place") / page_size).cast("long"))
    whole = paged.repartition("page").sortWithinPartitions("page", "place").select("page", "place", "id", "line")
    whole.write.format("sweep").mode("append").options(path=path, manifest=json.dumps(manifest), page_size=str(page_size), total=str(total)).save()
    return _existing(spark, path)
