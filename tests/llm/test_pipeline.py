import sentencepiece
import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import pieces, pii, quality

from .helpers import CLASHING, ROWS, documents
from .test_decontaminate import plain as leaks
from .test_simhash import plain_components

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark):
    """Every stage on all that the one before kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, benchmark = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("labels", "benchmark"))
    rows = {r.doc_id: r for r in docs.collect()}
    model = quality.train(docs, labels)
    scores = quality.score_quality(docs, model).select("doc_id", "score").collect()
    kept = [(r.doc_id, rows[r.doc_id].text) for r in scores if r.score >= 0.3]
    kept = [(d, rows[d].text) for d, _, least in plain_components(kept) if d == least]
    found = leaks(kept, [tuple(r) for r in benchmark.select("item_id", "text").collect()])
    kept = [x for x in kept if x[0] not in {d for d, *_ in found}]
    after = spark.createDataFrame(kept, "doc_id long, text string")
    spans = pii.train(after)
    masked = {d: pii.masked(t, every) for (d, t), (_, every) in zip(kept, pii.find_spans([t for _, t in kept], spans), strict=True)}
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))
    result = corpus_pipeline.run(spark, SF)
    assert set(docs.columns) <= set(result.columns)
    out = {r.doc_id: r for r in result.collect()}
    assert set(out) == set(masked)
    assert {d: out[d].text for d in out} == masked
    for r in out.values():
        assert r.ids == library.encode(r.text) and r.decoded == r.text and r.n_chars == len(r.text)


def test_stage_columns_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


def test_awkward_documents(spark, tmp_path):
    """Nulls, empty and long texts, one long token, repeated rows and clashing columns go through all stages; empty tables give empty results."""
    rows = [*ROWS, (20, "1" + "." * 300_000 + "1 a@b.org " + "x" * 300_000), (21, "mail me: jo@x.org or +1 (407) 555-7710"), (21, "mail me: jo@x.org or +1 (407) 555-7710"), (22, "")]
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    documents(spark, rows).withColumn("n_chars", F.length("text").cast("long")).write.parquet(f"{tmp_path}/documents.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {"doc_id", "text", "ids", "decoded"} <= set(found[0].asDict()) and set(CLASHING) - {"ids"} <= set(found[0].asDict())
    texts = {r.doc_id: r.text for r in found}
    # The classifier has few labels here and keeps by their share; copies and near copies leave one row each.
    assert len(texts) == len(found) and set(texts) <= {r[0] for r in rows}
    if 21 in texts:
        assert texts[21] == "mail me: [EMAIL] or [PHONE]"
    assert all(r.text is None or isinstance(r.decoded, str) for r in found)
    empty = tmp_path / "empty"
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{tmp_path}/{name}.parquet").limit(0).write.parquet(f"{empty}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(empty)).count() == 0
