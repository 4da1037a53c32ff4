"""Small tables with the awkward cases that every operator has to take."""

from pyspark.sql import types as T

LONG = " ".join(f"word{i % 997} runs{i % 31}" for i in range(20_000))
BODY = "the quick brown fox jumps over the lazy dog and runs far away from the old grey wolf near the river"
#: Columns whose names operators use inside.
CLASHING = ["row", "fp", "n", "word", "h", "ids", "score", "node", "component_id", "root", "label", "copies", "text_hash", "own_id", "order"]
ROWS = [(1, BODY), (2, BODY), (2, BODY), (3, BODY.upper()), (4, ""), (5, None), (None, BODY + " again"), (None, None), (6, LONG), (7, "  \n\t "), (8, "ÄÖ ▁▁ ab  cd \U0001f600 \x00 end "), (9, "a")]


def documents(spark, rows=ROWS, id_name="doc_id", text_name="text"):
    fields = [T.StructField(id_name, T.LongType()), T.StructField(text_name, T.StringType())]
    fields += [T.StructField(c, T.StringType()) for c in CLASHING if c not in (id_name, text_name)]
    return spark.createDataFrame([(*r, *(["x"] * (len(fields) - 2))) for r in rows], T.StructType(fields))


def by_id(rows, *columns):
    return sorted((tuple(r[c] for c in columns) for r in rows), key=repr)
