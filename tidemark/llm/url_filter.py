"""URL filters: host and path rules, and a list of canonical URLs behind a blocked Bloom filter.

The filter is a table of blocks of eight 32-bit words. A URL's hash picks one
block and one bit in each word, so a probe is one join on the block number and
eight bit tests. What passes goes on to an exact join with the list, which
removes the false positives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_broadcast, materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rules of a run: (verdict, host, path prefix).
RULES = (("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/"))
#: Odd multipliers that pick a bit in each of a block's eight words.
MULTIPLIERS = (0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31)
BITS_PER_URL = 16
WORDS = 8


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null and without ``://``."""
    rest = F.when(F.contains(url, F.lit("://")), F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def canonical(host: Column, path: Column) -> Column:
    """One form for a page's addresses: no scheme, ``www.``, query, fragment, ``.html`` or closing slashes."""
    return F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, r"(\.html|/)+$", ""))


def winning_rule(host: Column, path: Column, rules=RULES) -> Column:
    """(length, rule, verdict) of the longest fitting rule, else null; of equally long ones the greatest by name."""
    fits = [F.when(((host == h) | host.endswith(f".{h}")) & path.startswith(p), F.struct(F.lit(len(h + p)).alias("length"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for v, h, p in rules]
    return F.array_max(F.array_compact(F.array(*fits)))


def _block(hashed: Column, blocks: int) -> Column:
    return F.pmod(F.shiftright(hashed, 32), F.lit(blocks)).cast("long")


def _bit(hashed: Column, word: int) -> Column:
    low = hashed.bitwiseAND(0xFFFFFFFF)
    product = (low.bitwiseAND(0xFFFF) * MULTIPLIERS[word] + F.shiftleft((F.shiftright(low, 16) * (MULTIPLIERS[word] & 0xFFFF)).bitwiseAND(0xFFFF), 16)).bitwiseAND(0xFFFFFFFF)
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(product, 27).cast("int"))


def bloom_blocks(urls: DataFrame, blocks: int) -> DataFrame:
    """(block, w0..w7) of the distinct values of the column ``canon``."""
    hashed = F.xxhash64("canon")
    return urls.groupBy(_block(hashed, blocks).alias("block")).agg(*(F.bit_or(_bit(hashed, i)).alias(f"w{i}") for i in range(WORDS)))


def possible(urls: DataFrame, filter_blocks: DataFrame, blocks: int, rows: int) -> DataFrame:
    """The rows of ``urls`` (with a column ``canon``) that the filter lets through."""
    hashed = F.xxhash64("canon")
    probe = urls.withColumn("block", _block(hashed, blocks)).join(bounded_broadcast(filter_blocks, rows), "block")
    through = F.lit(True)
    for i in range(WORDS):
        through = through & (F.col(f"w{i}").bitwiseAND(_bit(hashed, i)) != 0)
    return probe.where(through).select(*urls.columns)


def listed_among(urls: DataFrame, listed: DataFrame, bits_per_url: int = BITS_PER_URL) -> DataFrame:
    """The distinct ``canon`` of ``urls`` that are in ``listed``; both have a column ``canon``."""
    wanted = materialize(listed.select("canon").where("canon <> ''").distinct(), "listed")
    blocks = max(1, -(-wanted.count() * bits_per_url // (32 * WORDS)))
    table = materialize(bloom_blocks(wanted, blocks), "bloom")
    through = possible(urls.select("canon").where("canon <> ''").distinct(), table, blocks, blocks)
    return through.join(wanted, "canon", "left_semi")


def judge(pages: DataFrame, listed: DataFrame, rules=RULES, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, listed.

    The longest fitting rule decides; without one the verdict is block for
    canonical URLs that ``listed`` (column url) holds, else allow. Null and
    malformed URLs have an empty host and path, fit no rule and are never
    listed. Repeated rows and null ids stay; other columns are ignored.
    """
    host, path = host_and_path(F.col("url"))
    named = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).cast("string").alias("url"))
    split = named.select("page_id", host.alias("host"), path.alias("path")).withColumn("canon", canonical(F.col("host"), F.col("path"))).withColumn("won", winning_rule(F.col("host"), F.col("path"), rules))
    on_list = listed.select(F.col("url").cast("string").alias("url")).select(host.alias("host"), path.alias("path")).select(canonical(F.col("host"), F.col("path")).alias("canon"))
    hits = materialize(listed_among(split.where("won is null"), on_list), "url-hits").withColumn("hit", F.lit(True))
    found = split.join(hits, "canon", "left")
    is_listed = F.coalesce("hit", F.lit(False)) & F.col("won").isNull()
    return found.select("page_id", "host", "path", F.col("won.rule").alias("rule"), F.coalesce("won.verdict", F.when(is_listed, "block").otherwise("allow")).alias("verdict"), is_listed.alias("listed"))
