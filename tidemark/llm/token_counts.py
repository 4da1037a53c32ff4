"""Token counts without token ids: pieces are counted once per distinct pre-token."""

from __future__ import annotations

from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .pieces import MODEL, pre_tokens
from .wordbag import HEAD_WORDS, frequencies, keyed, sums_by_row, totals, with_sums

LIMIT = 4096


@lru_cache(maxsize=2)
def library(model: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))


def piece_counts(words: DataFrame, model: str = MODEL) -> DataFrame:
    """``words`` (word, total) with the number of pieces of each."""

    def rows(batches):
        for batch in batches:
            plain = batch.column(0).to_pylist()
            counts = [len(ids) if w else 1 for w, ids in zip(plain, library(model).encode(plain, num_threads=1), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts, pa.int64())], ["word", "total", "pieces"])

    return words.mapInArrow(rows, "word string, total long, pieces long")


def count_tokens(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", model: str = MODEL, limit: int = LIMIT, head_words: int = HEAD_WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens).

    Counts are those of the library on the whole text, without begin, end or
    added tokens. Null texts count as empty: no bytes, no tokens. Null and
    repeated ids and repeated rows each keep their own row; other columns are
    ignored.
    """
    rows = keyed(docs, id_column, text_column)
    words = materialize(piece_counts(totals(frequencies(rows, pre_tokens)), model), "piece-counts")
    counted = sums_by_row(rows, pre_tokens, words, ["pieces"], bound=head_words).withColumnRenamed("pieces", "n_tokens")
    found = with_sums(rows, counted, ["n_tokens"], {"n_bytes": F.octet_length("text").cast("long")}).withColumn("n_tokens", F.col("n_tokens").cast("long"))
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
