"""From raw documents to token ids: five stages, each over all that the one before kept.

Every stage is a function of (spark, docs, sf_dir) that returns a DataFrame.
Null texts are scored, linked and searched as empty ones, stay null and have
null token ids. An empty text has a score like any other, is linked with the
other wordless ones, holds no benchmark item and no personal data, and has no
token ids. Null ids, repeated rows and further columns are taken; no documents
give none. ``run`` writes each result as Parquet to the shared folder and reads it again
as the next stage's documents, so a lost executor costs one stage's tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, pieces, pii, quality, simhash
from tidemark.llm.common import materialize, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labels of the raw documents.

    Null and empty texts are scored too; rows alike in text stay or go together.
    """
    model = quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that of the smallest id.

    Texts without words, null ones too, are one group. Null ids come after all
    others. Of repeated rows of the smallest id one stays.
    """
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go, repeated rows of them too; null and empty texts contain none and stay."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pii_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked by its kind in the text, and the letters are counted anew; every row stays."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def sentencepiece_coding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the text that they stand for; empty texts have no ids, null ones null."""
    return pieces.encode_and_decode(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("PII", pii_redaction),
    ("SentencePiece encoding and decoding", sentencepiece_coding),
]

#: The learned stages have no SQL form; the tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the table ``documents`` of ``sf_dir``; each stage works on all that the one before kept."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.split()[0].lower()}")
    return docs
