"""Cases of a rule, dealt over the rows of a table in turn, and what the rule has to give for each.

A rule's query runs over a whole table: row ``k`` gets case ``k`` modulo their
number. Its SQL deals the expected values in the same way, written down from
the rule's definition, so neither side can copy the other's mistake.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dealt(key: str, values: list, kind: str = "string") -> Column:
    """The case's value of each row, of type ``kind``."""
    options = F.array(*(F.lit(v).cast(kind) for v in values))
    return F.get(options, (F.col(key) % len(values)).cast("int"))


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, (list, tuple)):
        return "[" + ", ".join(map(_literal, value)) + "]"
    return str(value) if isinstance(value, (int, float)) else "'" + str(value).replace("'", "''") + "'"


def dealt_sql(key: str, values: list, kind: str = "VARCHAR") -> str:
    """SQL for the expected value of each row."""
    rows = ", ".join(_literal(v) for v in values)
    return f"CAST([{rows}][1 + {key} % {len(values)}] AS {kind})"
