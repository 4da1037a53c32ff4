from array import array

import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import pieces, token_counts

from .helpers import ROWS, documents

SF = "/root/testdata/sf0.001"
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab e▁ thing\nÄé😀0.", max_size=40) | st.text(max_size=30))
def test_ids_and_text_are_the_library_s(text):
    vocabulary = pieces.vocabulary(pieces.MODEL)
    try:
        wanted = LIBRARY.encode(text)
    except UnicodeEncodeError:
        return
    ids = pieces.encode_texts([text], vocabulary)[0]
    assert ids.tolist() == wanted
    assert vocabulary.decode(ids) == text.replace("▁", " ")


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = pieces.encode_and_decode(docs).collect()
    for r in found:
        assert (r.ids, r.decoded) == ((LIBRARY.encode(r.text), r.text) if r.text is not None else (None, None))


def test_awkward_rows(spark):
    docs = documents(spark)
    coded = pieces.decode(pieces.encode(docs, name="made"), ids_column="made", name="back")
    rows = coded.collect()
    assert len(rows) == len(ROWS) and coded.columns[: len(docs.columns)] == docs.columns
    for r in rows:
        assert r.back == (None if r.text is None else r.text.replace("▁", " "))
        assert r.made == (None if r.text is None else LIBRARY.encode(r.text))
    assert pieces.encode_and_decode(documents(spark, [])).count() == 0


def test_counts_are_the_library_s(spark):
    for docs in (spark.read.parquet(f"{SF}/documents.parquet"), documents(spark)):
        for head in (token_counts.HEAD_WORDS, 10):
            found = token_counts.count_tokens(docs, head_words=head).collect()
            wanted = [(r.doc_id, len((r.text or "").encode()), n := len(LIBRARY.encode(r.text or "")), n > 4096) for r in docs.collect()]
            assert sorted(map(tuple, found), key=repr) == sorted(wanted, key=repr)
    assert token_counts.count_tokens(documents(spark, [])).count() == 0


def test_a_part_that_many_words_share_is_encoded_once(monkeypatch):
    vocabulary = pieces.Pieces(public_tokenizers.path(pieces.MODEL))
    seen, forward = [], vocabulary.forward
    monkeypatch.setattr(vocabulary, "forward", lambda words: forward(seen.extend(words) or words))
    for words in (["thing\x01a", "thing\x01b"], ["thing", "thing\x01c", "thing\x02"]):
        for word, ids in vocabulary.encode_words(words).items():
            assert array("i", LIBRARY.encode(word)).tobytes() == ids
    assert seen.count("\u2581thing") == 1
