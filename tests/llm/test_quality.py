import os
import zlib

import numpy as np

from tidemark.llm import quality
from tidemark.llm.registry import op3_quality_classifier

from .helpers import ROWS, documents

SF = "/root/testdata/sf0.01"


def test_votes_match_a_plain_version():
    rng = np.random.default_rng(3)
    model = quality.fit(rng.random((200, quality.N_TERMS)), rng.integers(0, 2, 200))
    asked = np.vstack([rng.random((700, quality.N_TERMS)), np.zeros((1, quality.N_TERMS))])
    scores = quality.vote(asked, model)
    for row, score in list(zip(asked, scores, strict=True))[:700:50]:
        unit = (row * model.weights) @ model.axes
        cosines = model.vectors @ (unit / np.linalg.norm(unit))
        near = np.argsort(cosines)[-quality.NEIGHBOURS :]
        weight = np.clip(cosines[near], 0, 1) ** quality.SHARPNESS
        assert abs(score - (weight * model.labels[near]).sum() / weight.sum()) < 1e-9
    assert scores[-1] == model.prior


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    found = op3_quality_classifier(spark, SF).where("held_out").join(labels, "doc_id").toPandas()
    assert ((found.score >= 0.5) == (found.quality == 1)).mean() > 0.85
    assert found.score.between(0, 1).all()


def test_awkward_rows(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, 0), (None, 1), (6, None), (9, 0)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    scored = quality.score_quality(docs, model, name="made").collect()
    assert len(scored) == len(ROWS) and all(0 <= r.made <= 1 for r in scored)
    assert len({r.made for r in scored if not r.text}) == 1
    assert quality.keep_good(docs, model, threshold=0.0).columns == docs.columns
    untrained = quality.train(docs, labels.limit(0))
    assert {r.score for r in quality.score_quality(docs, untrained).collect()} == {0.5}
    assert quality.score_quality(documents(spark, []), model).count() == 0


def test_held_out_rows_teach_nothing(spark):
    docs = documents(spark, [(i, f"text number {i} " * 5) for i in range(50)])
    labels = spark.range(50).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality")
    known = labels.where((quality.fold_remainder("doc_id", 5)) != 0)
    assert len(quality.train(docs, labels).labels) == known.count() < 50


def test_query_matches_a_plain_version(spark):
    """Every row of the query, at its own threshold, with votes counted one by one."""
    small = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    model = quality.train(spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet"))
    found = op3_quality_classifier(spark, small).collect()
    assert {r.doc_id for r in found} == set(docs)
    for r in found:
        unit = (quality.terms(docs[r.doc_id]) * model.weights) @ model.axes
        unit /= max(np.linalg.norm(unit), 1e-12)
        votes = sorted(((float(v @ unit), label) for v, label in zip(model.vectors, model.labels, strict=True)), reverse=True)[: quality.NEIGHBOURS]
        weights = [(max(0.0, c) ** quality.SHARPNESS * model.shares[int(label)], label) for c, label in votes]
        total = sum(w for w, _ in weights)
        want = sum(w * label for w, label in weights) / total if total > 1e-12 else model.prior
        assert abs(r.score - want) < 1e-6 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_the_bound_does_not_move_the_prior(spark):
    docs = documents(spark, [(i, f"text number {i} " * 5) for i in range(400)])
    labels = spark.range(400).selectExpr("id AS doc_id", "CAST(id % 5 > 0 AS INT) AS quality")
    whole, bounded = quality.train(docs, labels), quality.train(docs, labels, sample_per_label=20)
    assert len(bounded.labels) == 40 and abs(whole.prior - bounded.prior) < 1e-9
    assert abs(bounded.shares[1] / bounded.shares[0] - whole.prior / (1 - whole.prior)) < 0.05


def test_words_tell_in_ordinary_prose():
    """Texts of the same letters' classes but of other words are told apart."""
    one, other = "the calm river ran past the mill " * 20, "vex quiz jump waltz nymph fjord glyph " * 20
    model = quality.fit(np.array([quality.terms(t) for t in (one, other)] * 10), np.array([1, 0] * 10), 4)
    good, bad = quality.vote(np.array([quality.terms(one + "by the calm mill"), quality.terms(other + "waltz quiz")]), model)
    assert good > 0.8 and bad < 0.2


def test_the_driver_does_not_fit(spark, monkeypatch):
    """The sample and the fit's scratch space are an executor's; the driver gets the model alone."""
    driver, real = os.getpid(), quality.fit

    def fit(*given, **named):
        assert os.getpid() != driver
        return real(*given, **named)

    docs = documents(spark, [(i, f"text number {i} " * (1 + i % 7)) for i in range(60)])
    labels = spark.range(60).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality")
    rows = {r.doc_id: r.text for r in docs.collect()}
    known = sorted((r.h, r.doc_id, r.quality) for r in labels.where(quality.fold_remainder("doc_id", 5) != 0).selectExpr("xxhash64(doc_id) AS h", "doc_id", "quality").collect())
    want = quality.fit(np.array([quality.terms(rows[i]) for _, i, _ in known], dtype=np.float32), np.array([label for _, _, label in known]))
    monkeypatch.setattr(quality, "fit", fit)
    found = quality.train(docs, labels)
    assert found.labels.tolist() == want.labels.tolist() and (found.prior, found.shares) == (want.prior, want.shares)
    asked = np.array([quality.terms(t) for t in rows.values()])
    assert np.allclose(quality.vote(asked, found), quality.vote(asked, want), atol=1e-6)
