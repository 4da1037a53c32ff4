"""Column helpers: suppression, boundary-counting date differences, pseudonyms, codes and names."""

from __future__ import annotations

import hashlib
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SMALL_COUNT = 5


def is_suppressed(count: Column) -> Column:
    """A count of 1 to 4; null stays null."""
    return (count > 0) & (count < SMALL_COUNT)


def mask_small(value: Column, count: Column) -> Column:
    """``value``, or null where ``count`` is small."""
    return F.when(is_suppressed(count), None).otherwise(value)


def hour_boundaries(start: Column, end: Column) -> Column:
    """Hour boundaries between two times, not elapsed hours."""
    return F.timestamp_diff("HOUR", F.date_trunc("HOUR", start), F.date_trunc("HOUR", end))


def day_boundaries(start: Column, end: Column) -> Column:
    return F.datediff(end, start).cast("long")


def second_boundaries(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", F.date_trunc("SECOND", start), F.date_trunc("SECOND", end))


def bucket(grain: Column, at: Column) -> Column:
    """Start of the day, Monday week or month of ``at``; zone-less."""
    return F.call_function("date_trunc", grain, at).cast("timestamp_ntz")


def last_known(value: str, order: Column) -> Column:
    """The value at the greatest ``order`` among rows where it is not null."""
    return F.max_by(F.col(value), F.when(F.col(value).isNotNull(), order))


def hmac_sha256(key: bytes, message: Column) -> Column:
    """Hex HMAC-SHA256 of a string column, inside the JVM."""
    block = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    inner = F.lit(bytes(b ^ 0x36 for b in block))
    outer = F.lit(bytes(b ^ 0x5C for b in block))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, message.cast("binary")), 256))), 256)


def pseudonym_of_source(key: bytes, source: Column, native_id: Column) -> Column:
    """The scheme that covers the source as well: source, a zero byte, the native id."""
    return hmac_sha256(key, F.concat(source, F.lit("\0"), native_id))


def pseudonym_of_id(key: bytes, native_id: Column) -> Column:
    """The scheme over the native id alone."""
    return hmac_sha256(key, native_id)


def zero_padded(code: Column, width: int) -> Column:
    """Pad with zeros on the left; longer codes stay whole."""
    return F.when(F.length(code) < width, F.lpad(code, width, "0")).otherwise(code)


def position_count(raw: Column) -> Column:
    """Whole number of positions, at least 0; 1 where unreadable."""
    return F.greatest(F.lit(0), F.coalesce(raw.try_cast("int"), raw.try_cast("double").try_cast("int"), F.lit(1)))


def score_bucket(score: Column, high: float = 0.9, medium: float = 0.6) -> Column:
    """``high``, ``medium`` or ``low``; null scores stay null."""
    return F.when(score.isNull(), None).when(score >= high, "high").when(score >= medium, "medium").otherwise("low")


def confidence(relation: Column) -> Column:
    """Confidence that a crosswalk's relation carries: only an exact match is sure."""
    return F.when(relation.isNull(), None).when(relation == "exact-match", "high").otherwise("low")


# The namespaces of the classification URIs.
UUID = "[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
ESCO = r"^https?://data\.europa\.eu/esco/"
NATIONAL = r"(?i)^https?://data\.tyomarkkinatori\.fi/esco/"


def uri_class(uri: Column) -> Column:
    """What a classification URI stands for: an occupation or skill only with its id, a group with or without C."""
    return (
        F.when(uri.isNull() | (F.trim(uri) == ""), "none")
        .when(uri.rlike(f"{ESCO}occupation/{UUID}$"), "esco_occupation")
        .when(uri.rlike(f"{ESCO}skill/{UUID}$"), "esco_skill")
        .when(uri.rlike(rf"{ESCO}isco/[cC]?\d{{1,4}}$"), "isco_group")
        .when(uri.rlike(f"(?i){ESCO}isced-f/"), "isced_field")
        .when(uri.rlike(NATIONAL), "national")
        .otherwise("unrecognised")
    )


# Letters that decomposition leaves alone, and what they fold to.
PLAIN = {"ø": "o", "æ": "ae", "å": "a", "đ": "d", "ð": "d", "ŋ": "n", "ŧ": "t", "ß": "ss"}


def unaccented(text: Column) -> Column:
    """Compatibility decomposition without its combining marks."""

    @F.pandas_udf(T.StringType())
    def bare(values: pd.Series) -> pd.Series:
        return values.map(lambda v: v if v is None or v.isascii() else "".join(c for c in unicodedata.normalize("NFKD", v) if not unicodedata.combining(c)))

    return bare(text)


def folded_name(name: Column) -> Column:
    """A place name for comparison: no brackets, the first of several languages' names, no accents, small letters, single blanks."""
    first = F.split(F.trim(F.regexp_replace(name, r"\([^)]*\)", " ")), r"\s+-\s+|/", 2)[0]
    text = F.lower(first)
    for letter, plain in PLAIN.items():
        text = F.replace(text, F.lit(letter), F.lit(plain))
    return F.coalesce(F.trim(F.regexp_replace(unaccented(text), r"[^a-z0-9]+", " ")), F.lit(""))


def plain_name(name: Column) -> Column:
    """Letters and digits of any script, small and without accents, single blanks between."""
    return F.trim(F.regexp_replace(F.lower(unaccented(name)), r"[^\p{L}\p{N}]+", " "))


def slug(text: Column, width: int = 60, empty: str = "scope") -> Column:
    """Small letters and digits joined by hyphens, cut to ``width``; ``empty`` where none is left."""
    cut = F.substring(F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", ""), 1, width)
    return F.coalesce(F.nullif(cut, F.lit("")), F.lit(empty))


def digits_as_number(text: Column) -> Column:
    return F.regexp_replace(text, r"[^0-9]", "").try_cast("long")


# Fixed value: date, hour, minute, second, fraction and zone of an ISO time, from the hour on optional.
ISO_TIME = r"^(\d{4}-?\d{2}-?\d{2})(?:[T ](\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?)?(Z|[+-]\d{2}(?::?\d{2})?)?)?$"


def iso_time(text: Column) -> Column:
    """ISO time in UTC, zone-less ones taken as UTC; null where unreadable. Whatever the session's zone is.

    Minutes, seconds and a fraction may be missing, and the separators of date,
    time and zone; beyond microseconds a fraction is cut off.
    """
    bare = F.trim(text)
    # Matched once and split: each regexp_extract would match anew, in code too long to be compiled.
    told = F.when(bare.rlike(ISO_TIME), F.split(F.regexp_replace(bare, rf"{ISO_TIME}\R?", "$1|$2|$3|$4|$5|$6"), "[|]"))
    return F.get(F.transform(F.array(told), _time_of_parts), F.lit(0))


def _time_of_parts(parts: Column) -> Column:
    """Of date, hour, minute, second, fraction and zone, as ``ISO_TIME`` parts them."""
    part = lambda k: F.get(parts, F.lit(k - 1))
    date = F.replace(part(1), F.lit("-"), F.lit(""))
    day = F.concat_ws("-", F.substring(date, 1, 4), F.substring(date, 5, 2), F.substring(date, 7, 2))
    clock = F.concat_ws(":", *(F.coalesce(F.nullif(part(k), F.lit("")), F.lit("00")) for k in (2, 3, 4)))
    naive = F.concat(day, F.lit(" "), clock, F.lit("."), F.rpad(part(5), 6, "0")).try_cast("timestamp_ntz")
    zone = F.replace(part(6), F.lit(":"), F.lit(""))
    number = lambda k: F.coalesce(F.nullif(F.substring(zone, k, 2), F.lit("")).try_cast("int"), F.lit(0))  # noqa: E731  (a cast that fails is dear)
    minutes = number(2) * 60 + number(4)
    offset = F.when(zone.startswith("-"), -minutes).otherwise(minutes)
    return F.when((part(1) != "") & (F.abs(offset) < 24 * 60), F.timestamp_add("MINUTE", -offset, naive))


def day_of(text: Column, pattern: str) -> Column:
    """A date in a fixed pattern; null where unreadable or impossible."""
    return F.try_to_timestamp(text, F.lit(pattern)).cast("date")


# Month names of the Flemish tiles, short and long.
DUTCH_MONTHS = (
    ("jan", "januari"), ("feb", "februari"), ("mrt", "maart"), ("apr", "april"), ("mei",), ("jun", "juni"),
    ("jul", "juli"), ("aug", "augustus"), ("sep", "sept", "september"), ("okt", "oktober"), ("nov", "november"), ("dec", "december"),
)


def dutch_date(text: Column) -> Column:
    """A date such as ``3 mrt. 2026`` or ``3 maart 2026``; null where unreadable or impossible."""
    months = F.create_map(*(F.lit(x) for number, names in enumerate(DUTCH_MONTHS, 1) for name in names for x in (name, str(number))))
    part = [F.regexp_extract(text, r"(\d{1,2})\s+([A-Za-z]+)\.?\s+(\d{4})", i) for i in (1, 2, 3)]
    return F.try_to_timestamp(F.concat(part[2], F.lit("-"), F.try_element_at(months, F.lower(part[1])), F.lit("-"), part[0]), F.lit("yyyy-M-d")).cast("date")


def department_of_commune(commune: Column) -> Column:
    """French département of a commune code: Corsica by letter, overseas by three digits."""
    code = F.upper(F.trim(commune))
    overseas = F.when(F.length(code) >= 3, F.substring(code, 1, 3))
    return F.when(code.rlike("^2[AB]"), F.substring(code, 1, 2)).when(code.rlike("^(97|98)"), overseas).when(code.rlike("^[0-9]{2}"), F.substring(code, 1, 2))


def is_corsican_postcode(postcode: Column) -> Column:
    """Postcodes that either of Corsica's two départements may have."""
    return F.coalesce(F.trim(postcode).rlike("^20[0-9]*$"), F.lit(False))


def department_of_postcode(postcode: Column) -> Column:
    """French département that a postcode suggests; null for Corsica and for what is no number."""
    code = F.trim(postcode)
    overseas = F.when(F.length(code) >= 3, F.substring(code, 1, 3))
    return F.when(~code.rlike("^[0-9]{2,}$") | is_corsican_postcode(code), None).when(code.rlike("^(97|98)"), overseas).otherwise(F.substring(code, 1, 2))


def department_of_label(label: Column) -> Column:
    """French département that leads a label such as ``64 - Anglet``."""
    return F.upper(F.nullif(F.regexp_extract(label, r"^\s*(9[0-9]{2}|2[AB]|[0-9]{2})\s*-", 1), F.lit("")))


def content_range_total(header: Column) -> Column:
    """The total that a ``Content-Range`` of offers states; null where it is malformed."""
    return F.regexp_extract(header, r"^\s*offres\s+(\d+)-(\d+)/(\d+)\s*$", 3).try_cast("long")


def pages_planned(total: Column, page_size: int, cap: int) -> Column:
    """Pages that a total implies, at least one and at most ``cap``; one where the total is unknown."""
    return F.greatest(F.lit(1), F.least(F.ceil(F.coalesce(total, F.lit(0)) / page_size), F.lit(cap))).cast("long")


def share_percent(part: Column, whole: Column, floor: int = 1) -> Column:
    """A share for drawing: at least ``floor`` unless nothing is there."""
    return F.when(part == 0, 0.0).otherwise(F.greatest(F.lit(float(floor)), 100 * part / whole))


def next_bucket(at: Column, grain: Column) -> Column:
    """Start of the bucket after: a day, seven days, or the first of the next month."""
    month = F.date_trunc("month", F.add_months(at, 1)).cast("timestamp_ntz")
    return F.when(grain == "month", month).when(grain == "week", at + F.expr("interval 7 days")).otherwise(at + F.expr("interval 1 day"))


def canonical_hash(*columns: str) -> Column:
    """SHA-256 of a row's columns as compact JSON."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def membership_hash(line: Column, order: Column) -> Column:
    """Aggregate: SHA-256 over the lines in order, a line feed between them."""
    lines = F.transform(F.array_sort(F.collect_list(F.struct(order.alias("order"), line.alias("line")))), lambda r: r["line"])
    return F.sha2(F.array_join(lines, "\n"), 256)


def landing_postcode(url: Column) -> Column:
    """Four digits that lead the last part of a landing page's path; null for other pages."""
    return F.nullif(F.regexp_extract(F.rtrim(F.split(url, r"\?", 2)[0], F.lit("/")), r"/vindeenjob/jobs/([1-9]\d{3})-[^/]+$", 1), F.lit(""))


def vacancy_id(href: Column) -> Column:
    return F.nullif(F.regexp_extract(href, r"/vindeenjob/vacatures/(\d+)/", 1), F.lit(""))


def grouped(number: Column, decimals: int = 0) -> Column:
    """A number with thousands separators and fixed decimals; null where there is none."""
    return F.format_number(number, decimals)


def place_query(place: Column, radius: int, days: Column | None = None) -> Column:
    """Query fragment of a place, quoted for a URL; the empty place asks for the radius alone."""
    quoted = F.replace(F.replace(F.url_encode(place), F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/"))
    named = F.concat(F.lit("wo="), quoted, F.lit(f"&umkreis={radius}"))
    if days is not None:
        named = F.when(days.isNull(), named).otherwise(F.concat(named, F.lit("&veroeffentlichtseit="), days.cast("string")))
    return F.when(place == "", f"umkreis={radius}").otherwise(named)


def locality_holds(asked: Column, resolved: Column, mode: Column) -> Column:
    """Whether a source understood the place: the first part of its echo is what was asked, and the search was valid."""
    valid = ~F.coalesce(mode == "UNGUELTIG", F.lit(False)) & (F.coalesce(resolved, F.lit("")) != "")
    return valid & F.coalesce(F.lower(F.trim(F.split(resolved, ",", 2)[0])) == F.lower(F.trim(asked)), F.lit(False))


def seat_labels(district: Column, label: Column) -> Column:
    """Names that a district's seat may have: its own, its label's first part, and their parts of over three letters."""
    whole = F.array(F.trim(district), F.trim(F.split(label, ",", 2)[0]))
    parts = F.filter(F.transform(F.flatten(F.transform(whole, lambda v: F.split(v, "[-/ ]"))), lambda v: F.trim(v)), lambda v: F.length(v) > 3)
    return F.array_sort(F.array_distinct(F.transform(F.filter(F.concat(whole, parts), lambda v: v != ""), lambda v: F.lower(v))))


def merged_ids(one: Column, other: Column, field: str = "concept_id") -> Column:
    """Distinct ids of two arrays of structs, sorted; null arrays and ids count for nothing."""
    ids = [F.transform(F.coalesce(a, F.array()), lambda s: s[field]) for a in (one, other)]
    return F.array_sort(F.array_distinct(F.array_compact(F.concat(*ids))))


def sorted_uris(mappings: Column, field: str = "uri") -> Column:
    """URIs of an array of structs, sorted, without nulls; repeated ones stay."""
    return F.array_sort(F.array_compact(F.transform(mappings, lambda m: m[field])))


def http_date(at: Column) -> Column:
    """Date of a UTC time as HTTP headers write it."""
    return F.date_format(at, "EEE, dd MMM yyyy HH:mm:ss 'GMT'")
