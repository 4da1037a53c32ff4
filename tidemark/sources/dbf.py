"""dBASE tables: fixed-width records, read in ranges and decoded column by column."""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StringType, StructField, StructType

#: Records of a partition, and of one batch inside it.
RECORDS, BATCH = 1 << 18, 1 << 14
DELETED = b"*"


class Header:
    """What a file's header says: number and length of records, where they begin, and (name, width) of the fields."""

    def __init__(self, system: fs.FileSystem, path: str):
        with system.open_input_stream(path) as f:
            head = f.read(32)
            self.records, self.begin, self.length = struct.unpack("<IHH", head[4:12])
            self.fields: list[tuple[str, int]] = []
            while (described := f.read(32)) and described[:1] != b"\r":
                self.fields.append((described[:11].decode("ascii", "replace").strip("\0").strip(), described[16]))


class Range(InputPartition):
    def __init__(self, path: str, first: int, last: int):
        super().__init__(path)
        self.path, self.first, self.last = path, first, last


def _files(folder: str) -> tuple[fs.FileSystem, list[str]]:
    system, root = fs.FileSystem.from_uri(folder)
    info = system.get_file_info(root)
    if info.is_file:
        return system, [root]
    found = system.get_file_info(fs.FileSelector(root))
    return system, sorted(f.path for f in found if f.is_file and f.base_name.lower().endswith(".dbf"))


class DbfReader(DataSourceReader):
    def __init__(self, folder: str, records: int, deleted: bool):
        self.folder, self.records, self.deleted = folder, records, deleted

    def partitions(self) -> list[Range]:
        system, paths = _files(self.folder)
        # Of no records there is one range as well: a source without any is asked for the range None.
        return [Range(p, k, min(k + self.records, n)) for p in paths for n in [Header(system, p).records] for k in range(0, max(n, 1), self.records)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        """The records of a range; a file that ends early ends the range, as a short record has no fields."""
        system, _ = fs.FileSystem.from_uri(self.folder)
        head = Header(system, partition.path)
        with system.open_input_file(partition.path) as f:
            for first in range(partition.first, partition.last, BATCH):
                f.seek(head.begin + first * head.length)
                raw = f.read((min(first + BATCH, partition.last) - first) * head.length)
                table = np.frombuffer(raw, np.uint8)[: len(raw) // head.length * head.length].reshape(-1, head.length)
                if not self.deleted:
                    table = table[table[:, 0] != DELETED[0]]
                at, columns = 1, []
                for _, width in head.fields:
                    columns.append(_decoded(np.ascontiguousarray(table[:, at : at + width]), width))
                    at += width
                yield pa.RecordBatch.from_arrays(columns, [n for n, _ in head.fields])


def _decoded(cells: np.ndarray, width: int) -> pa.Array:
    """Text of fixed-width cells without the blanks around it; bytes that are no UTF-8 become the replacement letter."""
    raw = cells.view(f"S{width}").ravel() if len(cells) and width else np.zeros(len(cells), "S1")
    try:
        return pc.utf8_trim_whitespace(pa.array(raw.tolist(), pa.binary()).cast(pa.string()))
    except pa.ArrowInvalid:
        return pa.array([b.decode("utf-8", "replace").strip() for b in raw.tolist()], pa.string())


class Written(WriterCommitMessage):
    def __init__(self, part: str):
        self.part = part


class DbfWriter(DataSourceArrowWriter):
    """One file a task, put in place when all tasks are done. Text that is too long for its field stops the write."""

    def __init__(self, folder: str, widths: list[tuple[str, int]]):
        self.folder, self.widths = folder, widths

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = fs.FileSystem.from_uri(self.folder)
        system.create_dir(f"{root}/_parts", recursive=True)
        part = f"{root}/_parts/{uuid.uuid4().hex}.dbf"
        bodies, n, length = [], 0, 1 + sum(w for _, w in self.widths)
        for batch in iterator:
            cells = [self._cells(batch.column(name), name, width) for name, width in self.widths]
            bodies.append(np.concatenate([np.full((batch.num_rows, 1), ord(" "), np.uint8), *cells], axis=1).tobytes())
            n += batch.num_rows
        with system.open_output_stream(part) as out:
            out.write(struct.pack("<B3sIHH20x", 3, b"\x7e\x01\x01", n, 32 + 32 * len(self.widths) + 1, length))
            for name, width in self.widths:
                out.write(struct.pack("<11sc4xB15x", name.encode("ascii")[:10], b"C", width))
            out.write(b"\r")
            for body in bodies:
                out.write(body)
            out.write(b"\x1a")
        return Written(part)

    def _cells(self, column: pa.Array, name: str, width: int) -> np.ndarray:
        texts = [b if b is not None else b"" for b in column.cast(pa.binary()).to_pylist()]
        if any(len(t) > width for t in texts):
            raise ValueError(f"a value of {name} has more than {width} bytes")
        return np.frombuffer(b"".join(t.ljust(width) for t in texts), np.uint8).reshape(len(texts), width)

    def commit(self, messages: list[Written | None]) -> None:
        system, root = fs.FileSystem.from_uri(self.folder)
        for m in messages:
            if m is not None:
                system.move(m.part, f"{root}/{m.part.rpartition('/')[2]}")

    def abort(self, messages: list[Written | None]) -> None:
        system, _ = fs.FileSystem.from_uri(self.folder)
        for m in messages:
            if m is not None and system.get_file_info(m.part).is_file:
                system.delete_file(m.part)


class Dbf(DataSource):
    """``format("dbf")`` with ``path`` (a file, or a folder of files of one shape), ``deleted`` and, to write, ``widths``."""

    @classmethod
    def name(cls) -> str:
        return "dbf"

    def schema(self) -> StructType:
        system, paths = _files(self.options["path"])
        return StructType([StructField(n, StringType()) for n, _ in Header(system, paths[0]).fields])

    def reader(self, schema) -> DbfReader:
        return DbfReader(self.options["path"], int(self.options.get("records", RECORDS)), self.options.get("deleted", "false") == "true")

    def writer(self, schema, overwrite: bool) -> DbfWriter:
        return DbfWriter(self.options["path"], [(n, int(w)) for n, _, w in (f.partition(":") for f in self.options["widths"].split(","))])


def read_dbf(spark: SparkSession, path: str, deleted: bool = False, records: int = RECORDS) -> DataFrame:
    """All fields as text; records marked deleted only if ``deleted``."""
    spark.dataSource.register(Dbf)
    return spark.read.format("dbf").options(path=path, deleted=str(deleted).lower(), records=str(records)).load()


def write_dbf(rows: DataFrame, path: str, widths: dict[str, int]) -> None:
    """A folder of dBASE files, one a task, with the given width of each field in bytes."""
    rows.sparkSession.dataSource.register(Dbf)
    text = rows.select(*(rows[c].cast("string").alias(c) for c in widths))
    text.write.format("dbf").mode("append").options(path=path, widths=",".join(f"{c}:{w}" for c, w in widths.items())).save()
