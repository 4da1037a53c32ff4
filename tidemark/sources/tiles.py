"""Tiles of HTML list pages by built-in functions: repeated elements of a class, cut where they close, and what is in them.

Pages need not be well formed: an element that never closes goes on to the
next one of its kind, names and quotes of attributes may be written in any way,
and what cannot be read is null. An element inside one of the same kind is a
tile of its own and not part of the outer one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a German tile's link, date and place, and a Flemish tile's link look like.
REF_ID = r"/jobsuche/jobdetail/([^/\s\"'>]+)"
DATE_TITLE = "Veröffentlichungsdatum"
GERMAN_DATE = r"(\d{2})\.(\d{2})\.(\d{4})"
PLACE_ID = "-arbeitsort"
PLACE = r"^Arbeitsort:\s*([^(]+)"
VACANCY_ID = r"/vindeenjob/vacatures/(\d+)/"

ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&amp;": "&"}


def _attribute(name: str, value: str) -> str:
    """Pattern, inside an opening tag, of an attribute whose value matches ``value`` (which must not hold quotes)."""
    return rf"(?=[^>]*\s{name}\s*=\s*(?-i:\"{value}\"|'{value}'))"


def _of_class(css: str) -> str:
    return "".join(_attribute("class", rf"(?:[^\"'>]*\s)?{c}(?:\s[^\"'>]*)?") for c in css.split("."))


def opening(tag: str, css: str = "") -> str:
    """Pattern of the opening tag of ``tag`` with all classes of ``css`` (joined by dots)."""
    return rf"(?i)<{tag}(?=[\s>/])" + (_of_class(css) if css else "") + "[^>]*>"


def _closed(piece: Column, tag: str) -> Column:
    """A text that begins with an opening tag, up to where that closes."""
    low = F.regexp_replace(piece, rf"(?i)<(/?){tag}(?=[\s>/])", rf"<$1{tag}")
    steps = F.regexp_extract_all(low, F.lit(rf"<(/?){tag}(?=[\s>/])"), F.lit(1))
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("closes"), F.lit(False).alias("done"))

    def step(state: Column, slash: Column) -> Column:
        depth = state["depth"] + F.when(slash == "/", -1).otherwise(1)
        closes = state["closes"] + F.when(slash == "/", 1).otherwise(0)
        return F.when(state["done"], state).otherwise(F.struct(depth.alias("depth"), closes.alias("closes"), (depth <= 0).alias("done")))

    end = F.aggregate(steps, start, step)
    return F.when(end["done"], F.call_function("substring_index", low, F.lit(f"</{tag}"), end["closes"])).otherwise(low)


def elements(html: Column, tag: str, css: str = "") -> Column:
    """The HTML of every element of ``tag`` and ``css``, in order, without its closing tag; null pages have none."""
    pieces = F.split(F.concat(F.lit(" "), F.coalesce(html, F.lit(""))), f"(?={opening(tag, css)})", -1)
    own = F.transform(pieces, lambda p: F.when(p.rlike("^" + opening(tag, css).replace("(?i)", "(?i:", 1) + ")"), _closed(p, tag)))
    return F.filter(own, lambda p: p.isNotNull())


def attribute(tag_html: Column, name: str) -> Column:
    """Value of an attribute of a text's first opening tag; null if it has none."""
    first = F.regexp_extract(tag_html, r"^\s*(<[^>]*>?)", 1)
    value = F.regexp_extract(first, rf"(?i)\s{name}\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", 1)
    return F.when(value != "", unescaped(F.regexp_replace(value, "^[\"']|[\"']$", "")))


def unescaped(text: Column) -> Column:
    for entity, letter in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(letter))
    return text


def text_of(html: Column) -> Column:
    """The text of an element: tags are blanks, runs of white space one blank."""
    return F.trim(F.regexp_replace(unescaped(F.regexp_replace(html, "<[^>]*>?", " ")), r"[\s ]+", " "))


def _found(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def _first(html: Column, tag: str, name: str, value: str) -> Column:
    """The HTML from the first ``tag`` whose attribute ``name`` matches ``value``, closed; null if there is none."""
    start = rf"(?i)<{tag}(?=[\s>/]){_attribute(name, value)}"
    piece = F.regexp_extract(html, rf"(?s)({start}.*)$", 1)
    return F.when(piece != "", _closed(piece, tag))


def _linked(html: Column, pattern: str) -> Column:
    """The first match of ``pattern`` in the address of a link."""
    return _found(html, rf"(?i)<a(?=\s)[^>]*\shref\s*=\s*[\"']?[^\"'>]*?{pattern}")


def links(pages: DataFrame, key: str, tag: str, css: str = "", html: str = "html") -> DataFrame:
    """(key, place, href, text): every tile with its first link's address and its text; tiles without a link have a null address."""
    tiles = pages.select(key, F.posexplode(elements(F.col(html), tag, css)).alias("place", "tile"))
    link = _first(F.col("tile"), "a", "href", r"[^\"'>]*")
    return tiles.select(key, "place", attribute(link, "href").alias("href"), text_of(F.col("tile")).alias("text"))


def german_tiles(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, place, native_id, first_published, location_city) of a German list page; tiles without an id are left out."""
    tiles = pages.select(key, F.posexplode(elements(F.col(html), "li", "ba-tile.listeneintrag")).alias("place", "tile"))
    tile = F.col("tile")
    title = attribute(_first(tile, "span", "title", rf"[^\"'>]*{DATE_TITLE}[^\"'>]*"), "title")
    day = [F.regexp_extract(title, GERMAN_DATE, k) for k in (3, 2, 1)]
    city = _found(text_of(_first(tile, "span", "id", rf"[^\"'>]*{PLACE_ID}")), PLACE)
    told = tiles.select(key, "place", _linked(tile, REF_ID).alias("native_id"), F.concat_ws("-", *day).try_cast("date").alias("first_published"), F.nullif(F.trim(city), F.lit("")).alias("location_city"))
    return told.where("native_id IS NOT NULL")


def flemish_tiles(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, place, native_id, online_since): the tiles of a Flemish landing page; the id is null where a tile has none."""
    tiles = pages.select(key, F.posexplode(elements(F.col(html), "div", "product-tile")).alias("place", "tile"))
    since = F.regexp_extract(F.col("tile"), rf"(?is)<(\w+)(?=[\s>/]){_of_class('online-sinds')}[^>]*>(.*?)</\1", 2)
    return tiles.select(key, "place", _linked(F.col("tile"), VACANCY_ID).alias("native_id"), F.nullif(text_of(since), F.lit("")).alias("online_since"))


def landing_pages(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, advertised_total, tiles, tiles_without_id) of Flemish landing pages, those without tiles too."""
    total = F.regexp_extract(F.col(html), rf"(?is)<\w+(?=[\s>/]){_of_class('numbers-job')}[^>]*>.*?<strong[^>]*>(.*?)</strong", 1)
    told = pages.select(key, F.nullif(F.regexp_replace(total, r"\D", ""), F.lit("")).cast("long").alias("advertised_total"))
    counted = flemish_tiles(pages, key, html).groupBy(key).agg(F.count("native_id").alias("tiles"), F.count_if(F.col("native_id").isNull()).alias("tiles_without_id"))
    return told.join(counted, key, "left").fillna(0, ["tiles", "tiles_without_id"])
