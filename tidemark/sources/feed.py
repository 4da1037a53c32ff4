"""Paged feeds as a stream: recorded pages with a cursor, entity tags and unchanged tails.

A feed is a chain of pages, oldest first; each names its successor, and the
last one grows until it is full. A reader's position is the page that it read
last, that page's tag and how many of its items it has taken. Asking again for
a page with an unchanged tag gives nothing; a changed tail gives its new items;
a position that the feed does not know any more starts anew.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from .storage import numbered

ITEM = "page string, place int, item string"
START = {"page": "", "tag": "", "items": 0}
#: Pages of a shelf, which is one file; what a page says of itself is read without its items.
SHELF = 256
HEAD = ["feed_url", "next_url", "etag", "n"]
#: A task reads pages of one shelf: all of them, or fewer where so many tasks would not come together.
TASKS = 64


def record_pages(items: DataFrame, order: list[Column], per_page: int, folder: str) -> DataFrame:
    """Write ``items`` (one column ``item`` of text, and those of ``order``) as a feed under ``folder``; pages (page, n).

    Pages lie in shelves of ``SHELF``, one Parquet file each. The places of
    items come from a range sort and a count of each range, so no task sees
    more than its own.
    """
    by = F.struct(*(c.alias(f"o{i}") for i, c in enumerate(order)))
    placed, total = numbered(items.select("item", by.alias("by")), ["by"], f"{folder}-ranged")
    number = F.floor(F.col("place") / per_page).cast("long")
    shelved = placed.select("place", "item", number.alias("page"), F.floor(number / SHELF).cast("long").alias("shelf")).repartition("shelf")
    pages = shelved.groupBy("shelf", "page").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "item"))), lambda x: x["item"]).alias("items"))
    last = max(0, -(-total // per_page) - 1)
    url = lambda n: F.concat(F.lit("/feed/"), n.cast("string"))
    told = pages.select("shelf", "page", url(F.col("page")).alias("feed_url"), F.when(F.col("page") < last, url(F.col("page") + 1)).alias("next_url"), F.md5(F.array_join("items", "\n")).alias("etag"), F.size("items").alias("n"), "items")
    told.sortWithinPartitions("shelf", "page").write.mode("overwrite").partitionBy("shelf").parquet(folder)
    return items.sparkSession.read.schema("page bigint, n int").parquet(folder).select("page", "n")


class Pages:
    """Recorded pages by their address, on any file system that Arrow opens; the heads of the shelf asked for last are kept."""

    def __init__(self, folder: str):
        self.system, self.root = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("/") else (fs.LocalFileSystem(), folder)
        self.shelf, self.heads = None, {}

    def _read(self, shelf: int, columns: list[str], **more) -> list[dict]:
        found = self.system.get_file_info(fs.FileSelector(f"{self.root}/shelf={shelf}", allow_not_found=True))
        names = [f.path for f in found if f.is_file and f.base_name.startswith("part-") and f.size]
        try:
            return pq.read_table(names[0], columns=columns, filesystem=self.system, partitioning=None, **more).to_pylist() if len(names) == 1 else []
        except ValueError:
            return []

    def head(self, url: str) -> dict | None:
        """What the page at an address such as ``/feed/7`` says of itself, and its number of items; None where there is none or it cannot be read."""
        number = url.rpartition("/")[2]
        if not number.isdecimal():
            return None
        if self.shelf != int(number) // SHELF:
            self.shelf = int(number) // SHELF
            self.heads = {head["feed_url"]: head for head in self._read(self.shelf, HEAD)}
        return self.heads.get(url)

    def get(self, url: str) -> dict | None:
        """The whole page at an address."""
        return next(iter(self.several([url])), None)

    def several(self, urls: list[str]) -> list[dict]:
        """The whole pages of one shelf at those of the addresses where there is one."""
        number = urls[0].rpartition("/")[2]
        return self._read(int(number) // SHELF, [*HEAD, "items"], filters=[("feed_url", "in", urls)]) if number.isdecimal() else []


class PageRange(InputPartition):
    """Pages of one shelf, each with the items that are taken: (address, first, last)."""

    def __init__(self, pages: list[tuple[str, int, int]]):
        super().__init__(pages[0][0])
        self.pages = pages
        self.url, self.first, self.last = pages[0]


class FeedReader(DataSourceStreamReader):
    """Walks the heads of new pages on the driver, a shelf's at a time; tasks read the pages themselves, up to a shelf each.

    The position of the last committed batch is kept at ``cursor_path``, so a
    restart walks from there; without it, or where it cannot be read or names a
    page that is gone, from the first page. Which items are new is decided by
    the offsets of the stream's own checkpoint either way.
    """

    def __init__(self, folder: str, first: str, cursor_path: str | None = None):
        self.pages, self.folder, self.first, self.cursor_path = Pages(folder), folder, first, cursor_path
        self.at = self._cursor() or dict(START)

    def _cursor(self) -> dict | None:
        if not self.cursor_path:
            return None
        try:
            system, path = fs.FileSystem.from_uri(self.cursor_path)
            with system.open_input_stream(path) as stream:
                told = json.loads(stream.read())
            return told if self.pages.head(told["page"]) is not None and told.keys() == START.keys() else None
        except (OSError, ValueError, TypeError, KeyError, AttributeError):
            return None

    def commit(self, end: dict) -> None:
        if self.cursor_path:
            system, path = fs.FileSystem.from_uri(self.cursor_path)
            system.create_dir(path.rpartition("/")[0], recursive=True)
            with system.open_output_stream(f"{path}.part") as out:
                out.write(json.dumps(end).encode())
            system.move(f"{path}.part", path)

    def initialOffset(self) -> dict:
        return dict(START)

    def _walk(self, start: dict, until: str | None = None) -> Iterator[tuple[dict, int]]:
        """Positions after ``start`` with the first new item of each page: the grown tail first, then its successors."""
        self.pages = Pages(self.folder)  # pages may have grown since
        page = self.pages.head(start["page"]) if start["page"] else None
        if page is None:
            url, taken = self.first, 0
        elif page["etag"] != start["tag"]:
            taken = start["items"] if page["n"] >= start["items"] else 0  # a page that shrank is taken whole
            url = page["feed_url"]
        else:
            url, taken = page.get("next_url"), 0
        while url and (page := self.pages.head(url)) is not None:
            yield {"page": page["feed_url"], "tag": page["etag"], "items": page["n"]}, taken
            if page["feed_url"] == until:
                return
            url, taken = page.get("next_url"), 0

    def latestOffset(self) -> dict:
        for position, _ in self._walk(self.at):
            self.at = position
        return dict(self.at)

    def partitions(self, start: dict, end: dict) -> list[PageRange]:
        new = []
        for position, taken in self._walk(start, end["page"]):
            upto = end["items"] if position["page"] == end["page"] else position["items"]
            new.append((position["page"], taken, upto))
        most = min(SHELF, -(-len(new) // TASKS))
        shelves = [list(pages) for _, pages in groupby(new, key=lambda p: int(p[0].rpartition("/")[2]) // SHELF)]
        return [PageRange(pages[k : k + most]) for pages in shelves for k in range(0, len(pages), most)]

    def read(self, partition: PageRange) -> Iterator[pa.RecordBatch]:
        held = {page["feed_url"]: page["items"] for page in Pages(self.folder).several([url for url, _, _ in partition.pages])}
        for url, first, last in partition.pages:
            if len(held.get(url, ())) < last:
                raise OSError(f"page {url} was there and is not")
            yield pa.RecordBatch.from_arrays([pa.array([url] * (last - first), pa.string()), pa.array(range(first, last), pa.int32()), pa.array(held[url][first:last], pa.string())], names=["page", "place", "item"])


class RecordedFeed(DataSource):
    """``spark.readStream.format("recorded_feed")`` with ``path``, the folder of the pages, ``first``, the first page's address, and ``cursor_path``."""

    @classmethod
    def name(cls) -> str:
        return "recorded_feed"

    def schema(self) -> str:
        return ITEM

    def streamReader(self, schema) -> FeedReader:
        return FeedReader(self.options["path"], self.options.get("first", "/feed/0"), self.options.get("cursor_path"))
