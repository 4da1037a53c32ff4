"""Breadth over any set of sweeps, from bitmaps of the codes that each sweep saw.

Codes get numbers once; a sweep's codes are then bits in blocks of a fixed
width, and the breadth of any set of sweeps is the number of bits in the union
of their blocks. Postings are read once, for the bitmaps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.storage import numbered, written


def code_numbers(rows: DataFrame, code: str) -> DataFrame:
    """(code, number) of all codes but null and empty ones, numbered from 1 in their order."""
    codes = rows.select(F.col(code).alias("code")).where("code <> ''").distinct()
    placed, _ = numbered(codes, ["code"])
    return placed.select("code", (F.col("place") + 1).alias("number"))


def sweep_bitmaps(rows: DataFrame, sweep: list[str], code: str, numbers: DataFrame | None = None) -> DataFrame:
    """(sweep..., block, bits): a written table of the codes that each sweep saw; sweeps without codes have none."""
    numbers = code_numbers(rows, code) if numbers is None else numbers
    seen = rows.select(*sweep, F.col(code).alias("code")).where("code <> ''").distinct().join(numbers, "code")
    block, place = F.bitmap_bucket_number("number"), F.bitmap_bit_position("number")
    return written(seen.groupBy(*sweep, block.alias("block")).agg(F.bitmap_construct_agg(place).alias("bits")), "bitmaps")


def union_breadth(bitmaps: DataFrame, by: list[str]) -> DataFrame:
    """(by..., breadth): different codes of all sweeps that share ``by``; ``bitmaps`` may be any rows of ``sweep_bitmaps``."""
    return bitmaps.groupBy(*by, "block").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n")).groupBy(*by).agg(F.sum("n").alias("breadth"))


def common_breadth(bitmaps: DataFrame, by: list[str], sweeps: int) -> DataFrame:
    """(by..., breadth): codes that all of ``sweeps`` sweeps of a group saw; groups with fewer sweeps are left out."""
    bits = bitmaps.groupBy(*by, "block").agg(F.count(F.lit(1)).alias("n"), F.bitmap_and_agg("bits").alias("bits"))
    whole = bits.where(F.col("n") == sweeps).select(*by, F.bitmap_count("bits").alias("n"))
    return whole.groupBy(*by).agg(F.sum("n").alias("breadth"))
