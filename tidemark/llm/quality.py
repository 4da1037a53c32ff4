"""Quality classifier: nearest-neighbour voting in a latent-semantic space.

Terms of a document are three-letter parts of its words by hash, pairs of
adjacent character classes and a few marks of repetition. A bounded sample of
labelled documents gives the term weights and the latent space (a truncated
singular value decomposition), and stays as the labelled vectors. They are
broadcast; every document is compared with all of them by exact cosines, block
by block, and its nearest neighbours vote with weights that follow their
similarity, and the share of their label among all labelled documents, so that
the bound of the sample does not move the scores.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold_remainder

#: At most this many labelled documents of each label are used, chosen by hash of the id.
SAMPLE_PER_LABEL = 2000
DIMENSIONS = 32
NEIGHBOURS = 25
SHARPNESS = 16
FOLDS = 5
KEEP_SCORE = 0.3
BLOCK = 512
SLICE = 1 << 20
#: Weight of the parts of words beside the classes.
PART_SHARE = 0.25


def _classes() -> tuple[bytes, int]:
    """Byte to character class: letters by case, digits, blanks, line ends, and marks one by one."""
    names = [b"abcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100)), b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r\x0b\f"]
    names += [bytes([c]) for c in b".,!|$%&*#@\"'=-_:;?()<>/\\"]
    table = bytearray([len(names)] * 256)
    for number, members in enumerate(names):
        for byte in members:
            table[byte] = number
    return bytes(table), len(names) + 1


TABLE, N_CLASSES = _classes()
MARKS = 6
#: Three bytes, letters small, are told apart by so many hashes.
PARTS = 512
N_PAIRS = N_CLASSES * N_CLASSES
N_TERMS = N_PAIRS + PARTS + MARKS


def terms(text: str | None) -> np.ndarray:
    """Square roots of the term shares of a text; zeros for null and empty texts."""
    out = np.zeros(N_TERMS)
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return out
    codes = np.frombuffer(raw.translate(TABLE), dtype=np.uint8)
    letters = np.frombuffer(raw.lower(), dtype=np.uint8)
    # In slices, so that a long text takes no more memory than its own size.
    for start in range(0, len(raw), SLICE):
        some = codes[start : start + SLICE + 1].astype(np.int16)
        out[:N_PAIRS] += np.bincount(some[:-1] * N_CLASSES + some[1:], minlength=N_PAIRS)
        part = letters[start : start + SLICE + 2].astype(np.int32)
        if len(part) > 2:
            out[N_PAIRS:-MARKS] += np.bincount((part[:-2] * 961 + part[1:-1] * 31 + part[2:]) % PARTS, minlength=PARTS)
    out[:N_PAIRS] /= max(1, len(raw) - 1)
    out[N_PAIRS:-MARKS] *= PART_SHARE / max(1, len(raw) - 2)
    words, lines = raw.split(), raw.splitlines()
    n = max(1, len(words))
    again = sum(map(bytes.__eq__, words, words[1:])) / n
    known = len(set(words)) / n
    seen = len(set(lines)) / max(1, len(lines))
    out[-MARKS:] = (again, 1 - again, 1 - known, known, 1 - seen, min(1.0, n / max(1, len(raw)) * 4))
    return np.sqrt(out)


@dataclass
class Model:
    weights: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float
    shares: tuple[float, float] = (1.0, 1.0)  # what a vote for label 0 and 1 counts


def latent(matrix: np.ndarray, weights: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Unit vectors in the latent space; zero rows stay zero."""
    found = (matrix * weights) @ axes
    return found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-12)


def fit(matrix: np.ndarray, labels: np.ndarray, dimensions: int = DIMENSIONS, totals: tuple[int, int] | None = None) -> Model:
    """Term weights by spread over the sample, then the leading singular axes; ``totals`` are the labelled documents of each label, in the sample or not."""
    if not len(labels):
        return Model(np.ones(N_TERMS), np.zeros((N_TERMS, 1)), np.zeros((0, 1)), np.zeros(0), 0.5)
    present = (matrix > 0).sum(axis=0)
    weights = np.log((1 + len(matrix)) / (1 + present)) + 1
    # The right singular axes, from the products of terms: as large as the terms squared, however many documents there are.
    products = np.zeros((len(weights), len(weights)))
    for start in range(0, len(matrix), BLOCK):
        weighted = matrix[start : start + BLOCK] * weights
        products += weighted.T @ weighted
    axes = np.ascontiguousarray(np.linalg.eigh(products)[1][:, ::-1][:, :dimensions])
    vectors = np.concatenate([latent(matrix[start : start + BLOCK], weights, axes) for start in range(0, len(matrix), BLOCK)])
    held = [int((labels == label).sum()) for label in (0, 1)]
    every = totals or tuple(held)
    shares = tuple(t / h if h else 0.0 for t, h in zip(every, held, strict=True))
    return Model(weights, axes, vectors, labels.astype(np.float64), every[1] / max(1, sum(every)), (shares[0], shares[1]))


def vote(matrix: np.ndarray, model: Model, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Similarity-weighted share of label 1 among the nearest labelled vectors, by blocks of exact cosines."""
    scores = np.full(len(matrix), model.prior)
    k = min(neighbours, len(model.labels))
    for start in range(0, len(matrix) if k else 0, BLOCK):
        unit = latent(matrix[start : start + BLOCK], model.weights, model.axes)
        cosines = unit @ model.vectors.T
        nearest = np.argpartition(cosines, -k, axis=1)[:, -k:]
        weight = np.clip(np.take_along_axis(cosines, nearest, axis=1), 0, 1) ** SHARPNESS * np.take(model.shares, model.labels[nearest].astype(np.int64))
        total = weight.sum(axis=1)
        found = (weight * model.labels[nearest]).sum(axis=1) / np.maximum(total, 1e-12)
        scores[start : start + BLOCK] = np.where(total > 1e-12, found, model.prior)
    return scores


def _term_rows(batches):
    for batch in batches:
        rows = [terms(t.as_py()) for t in batch.column(0)]
        yield pa.RecordBatch.from_arrays([pa.array(rows, type=pa.list_(pa.float32())), *batch.columns[1:]], ["terms", "label", "order", "text_order"])


def _fit_rows(totals: tuple[int, int]):
    """One row, the model, of the bounded sample's rows (terms, label), which lie in one partition; none of none."""

    def rows(batches):
        sample = pa.Table.from_batches(batches, schema=pa.schema([("terms", pa.list_(pa.float32())), ("label", pa.int32())]))
        if not sample.num_rows:
            return
        labels = sample.column("label").to_numpy()
        matrix = sample.column("terms").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, N_TERMS)
        del sample
        model = fit(matrix, labels, totals=totals)
        lists = [model.weights, model.axes.ravel(), model.vectors.ravel(), model.labels]
        yield pa.RecordBatch.from_arrays([*(pa.array([x]) for x in lists), pa.array([model.prior]), pa.array([model.shares])], ["weights", "axes", "vectors", "labels", "prior", "shares"])

    return rows


def train(docs: DataFrame, labels: DataFrame, sample_per_label: int = SAMPLE_PER_LABEL, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality") -> Model:
    """Fit on at most ``sample_per_label`` labelled documents of each label.

    A vote counts by the share of its label among all usable labels, so scores
    don't move when the bound changes the mix. Labels come from rows outside the held-out fold (crc32 of the id as text,
    modulo 5, not 0) that are not null; an id labelled both ways is left out.
    """
    usable = labels.select(F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("int").alias("label")).where(F.col("label").isin(0, 1) & F.col("id").isNotNull()).where(fold_remainder("id", FOLDS) != 0)
    agreed = usable.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other").select("id", "label", F.xxhash64("id").alias("order"))
    counted = {r["label"]: r["count"] for r in agreed.groupBy("label").count().collect()}
    picked = None
    for label in (0, 1):
        part = agreed.where(F.col("label") == label).orderBy("order", "id").limit(sample_per_label)
        picked = part if picked is None else picked.unionByName(part)
    # Bounded by the sample size, so it may be broadcast; an id that two rows share gives two examples.
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text")).join(F.broadcast(picked), "id")
    vectors = texts.select("text", "label", "order", F.xxhash64("text").alias("text_order")).mapInArrow(_term_rows, "terms array<float>, label int, order long, text_order long")
    bounded = vectors.orderBy("order", "text_order").limit(2 * sample_per_label).select("terms", "label")
    # An executor fits, so that the driver holds neither the sample nor the fit's scratch space.
    fitted = bounded.mapInArrow(_fit_rows((counted.get(0, 0), counted.get(1, 0))), "weights array<double>, axes array<double>, vectors array<double>, labels array<double>, prior double, shares array<double>").toArrow()
    if not fitted.num_rows:
        return fit(np.zeros((0, N_TERMS)), np.zeros(0))
    found = {name: fitted.column(name).combine_chunks() for name in fitted.column_names}
    weights, axes, points, known, shares = (found[name].flatten().to_numpy() for name in ("weights", "axes", "vectors", "labels", "shares"))
    return Model(weights, axes.reshape(N_TERMS, -1), points.reshape(len(known), -1), known, found["prior"][0].as_py(), (float(shares[0]), float(shares[1])))


def scorer(model: Model):
    """A pandas UDF from text to score."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        out = np.zeros(len(texts))
        for start in range(0, len(texts), BLOCK):
            out[start : start + BLOCK] = vote(np.array([terms(t) for t in texts.iloc[start : start + BLOCK]]), model)
        return pd.Series(out)

    return score


def score_quality(docs: DataFrame, model: Model, text_column: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a score between 0 and 1 (higher: label 1 likelier) in a column ``name``.

    Null and empty texts, which have no terms, get the share of label 1 in the
    sample. A column called ``name`` is replaced; the others stay, and so do
    repeated rows. Without any usable label every score is 0.5.
    """
    return docs.withColumn(name, scorer(model)(F.col(text_column).cast("string")))


def keep_good(docs: DataFrame, model: Model, text_column: str = "text", threshold: float = KEEP_SCORE) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``; all columns as they were."""
    scored = docs.select(F.struct("*").alias("row"), scorer(model)(F.col(text_column).cast("string")).alias("score"))
    return scored.where(F.col("score") >= threshold).select("row.*")
