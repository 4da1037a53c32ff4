"""Sheets of XLSX workbooks as cells and rows: members of an archive, shared strings joined by their number.

A workbook's members are read as streams, one element at a time. Strings and
cells become rows of one written table; that a cell's number means a string is
settled by a join, so a table of many strings is not held by every task.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import written

MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
RELATIONS = "{http://schemas.openxmlformats.org/package/2006/relationships}Relationship"
PIECE = pa.schema([("path", pa.string()), ("kind", pa.string()), ("row", pa.int64()), ("place", pa.int32()), ("ref", pa.string()), ("type", pa.string()), ("value", pa.string())])
AT_ONCE = 50_000


def _elements(book: zipfile.ZipFile, member: str, tag: str) -> Iterator[ElementTree.Element]:
    """Elements of a member, each forgotten when the next is asked for."""
    with book.open(member) as stream:
        for _, element in ElementTree.iterparse(stream):
            if element.tag == tag:
                yield element
                element.clear()


def _target(book: zipfile.ZipFile, sheet: str) -> str | None:
    wanted = next((e.get(RELATION) for e in _elements(book, "xl/workbook.xml", f"{MAIN}sheet") if e.get("name") == sheet), None)
    if wanted is None:
        return None
    found = next((e.get("Target") for e in _elements(book, "xl/_rels/workbook.xml.rels", RELATIONS) if e.get("Id") == wanted), None)
    return found and (found.lstrip("/") if found.startswith("/") else f"xl/{found}")


def _pieces(path: str, content: bytes, sheet: str) -> Iterator[tuple]:
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        target = _target(book, sheet)
        if target is None:
            return
        if "xl/sharedStrings.xml" in book.namelist():
            for k, e in enumerate(_elements(book, "xl/sharedStrings.xml", f"{MAIN}si")):
                yield path, "string", k, None, None, None, "".join(t.text or "" for t in e.iter(f"{MAIN}t"))
        for k, e in enumerate(_elements(book, target, f"{MAIN}row")):
            yield path, "row", k, None, None, None, None
            for place, c in enumerate(e.findall(f"{MAIN}c")):
                value = c.find(f"{MAIN}v")
                yield path, "cell", k, place, c.get("r"), c.get("t"), (value.text or "").strip() if value is not None else ""


def pieces(books: DataFrame, sheet: str) -> DataFrame:
    """A written table of the strings, rows and cells of ``sheet`` in all ``books`` (path, content); without the sheet, none."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held: list[tuple] = []
                for piece in _pieces(path, content.as_py(), sheet):
                    held.append(piece)
                    if len(held) >= AT_ONCE:
                        yield _batch(held)
                        held = []
                if held:
                    yield _batch(held)

    one_a_task = books.select("path", "content").where("content IS NOT NULL")
    return written(one_a_task.mapInArrow(each, "path string, kind string, row long, place int, ref string, type string, value string"), "workbook")


def _batch(held: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), PIECE, strict=True)], schema=PIECE)


def column_number(ref: Column) -> Column:
    """Number, from 0, of the column that a reference such as AB7 names."""
    letters = F.filter(F.split(F.regexp_extract(ref, "^([A-Z]+)", 1), ""), lambda x: x != "")
    return F.when(F.size(letters) > 0, F.aggregate(letters, F.lit(0), lambda n, x: n * 26 + F.ascii(x) - 64) - 1)


def cells(found: DataFrame) -> DataFrame:
    """(path, row, place, column, value) of the cells of ``pieces``; a string's number that there is no string for stays as it is."""
    strings = found.where("kind = 'string'").select("path", F.col("row").cast("string").alias("raw"), F.col("value").alias("string"))
    told = found.where("kind = 'cell'").select("path", "row", "place", F.coalesce(column_number(F.col("ref")), F.col("place")).alias("column"), F.col("value").alias("raw"), "type")
    shared = told.where("type = 's'").join(strings, ["path", "raw"], "left").withColumn("value", F.coalesce("string", "raw"))
    plain = told.where("type IS NULL OR type <> 's'").withColumn("value", F.col("raw"))
    names = ["path", "row", "place", "column", "value"]
    return shared.select(*names).unionByName(plain.select(*names))


def sheet_rows(found: DataFrame, gaps: bool = False) -> DataFrame:
    """(path, row, values): each row's cells in order, rows without cells too; with ``gaps`` at the place of their column, '' between."""
    place = F.col("column") if gaps else F.col("place")
    listed = cells(found).groupBy("path", "row").agg(F.array_sort(F.collect_list(F.struct(place.alias("at"), "value"))).alias("held"))
    by_place = F.map_from_entries(F.transform("held", lambda c: F.struct(c["at"], c["value"])))
    last = F.element_at(F.col("held"), -1)["at"]
    filled = F.transform(F.sequence(F.lit(0), last), lambda k: F.coalesce(F.try_element_at(by_place, k), F.lit("")))
    values = filled if gaps else F.transform("held", lambda c: c["value"])
    every = found.where("kind = 'row'").select("path", "row")
    return every.join(listed, ["path", "row"], "left").select("path", "row", F.when(F.col("held").isNotNull(), values).otherwise(F.array().cast("array<string>")).alias("values"))


def make_book(name: str, rows: list[list[str | None]]) -> bytes:
    """A workbook of one sheet: texts as shared strings, each once, and no cell where a value is None."""
    strings: dict[str, int] = {}
    lines = []
    for k, row in enumerate(rows, 1):
        held = "".join(f'<c r="{_letters(j)}{k}" t="s"><v>{strings.setdefault(v, len(strings))}</v></c>' for j, v in enumerate(row) if v is not None)
        lines.append(f'<row r="{k}">{held}</row>')
    escape = lambda t: t.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;")
    main, out = MAIN[1:-1], io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        members = {
            "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{RELATION[1:].partition("}")[0]}"><sheets><sheet name="{escape(name)}" sheetId="1" r:id="rId1"/></sheets></workbook>',
            "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{RELATIONS[1:].partition("}")[0]}"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>',
            "xl/sharedStrings.xml": f'<sst xmlns="{main}">{"".join(f"<si><t>{escape(t)}</t></si>" for t in strings)}</sst>',
            "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetData>{"".join(lines)}</sheetData></worksheet>',
        }
        for member, text in members.items():
            book.writestr(zipfile.ZipInfo(member), text)
    return out.getvalue()


def _letters(number: int) -> str:
    text = ""
    number += 1
    while number:
        number, digit = divmod(number - 1, 26)
        text = chr(65 + digit) + text
    return text
