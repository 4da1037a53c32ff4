import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import range_coder, token_files

from .helpers import ROWS, documents

SF = "/root/testdata/sf0.001"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from([0, 1, 2, 5, 7, 300, 49151, 65535]), max_size=200), max_size=6))
def test_coder_round_trip(blocks):
    arrays = [np.array(b, dtype="<u4") for b in blocks]
    back = range_coder.decode_blocks(range_coder.encode_blocks(arrays), list(map(len, arrays)))
    assert [b.tolist() for b in back] == blocks


def test_coder_on_long_and_skewed_blocks():
    rng = np.random.default_rng(1)
    blocks = [rng.integers(0, 1 << 16, 2000), np.zeros(2048, np.int64), rng.zipf(1.3, 2048) % 49152, np.tile([5, 9, 5, 11], 500), np.full(1500, 65535), np.arange(2048)]
    coded = range_coder.encode_blocks(blocks)
    assert all((a == b).all() for a, b in zip(range_coder.decode_blocks(coded, list(map(len, blocks))), blocks, strict=True))
    assert len(coded[1]) < 300 and len(coded[3]) < 500 and len(coded[2]) < 1.6 * 2048
    assert range_coder.encode_blocks([blocks[3]]) == [coded[3]]  # blocks don't depend on their neighbours
    with pytest.raises(ValueError):
        range_coder.encode_blocks([np.array([1 << 16])])
    with pytest.raises(ValueError):
        range_coder.encode_blocks([np.zeros(range_coder.LONGEST + 1, np.int64)])


def test_bits_of_an_id():
    """Text is coded in fewer bits than its ids' own frequencies would take in the block alone."""
    texts = [t for (t,) in duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet' WHERE text <> ''").fetchall()]
    stream = np.concatenate(token_files.token_ids(texts))
    blocks = [stream[i : i + token_files.BLOCK_IDS] for i in range(0, len(stream), token_files.BLOCK_IDS)]
    bits = 8 * sum(map(len, range_coder.encode_blocks(blocks)))
    assert bits / len(stream) < 8.6


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=40), max_size=6))
def test_joined_crc(parts):
    assert token_files.joined_crc([(len(p), zlib.crc32(p)) for p in parts]) == zlib.crc32(b"".join(parts))


def test_words_that_hold_the_mark():
    library = Tokenizer.from_file(public_tokenizers.path(token_files.MODEL))
    new = ["plain", "a\x01b", "\x01", "", "x\ty", "<|endoftext|>", "don't", "e\u0301"]
    for part in (new, ["plain", "", "x\ty", "<|endoftext|>", "\u0301e"]):
        found = token_files._encoded(part, token_files.MODEL)
        assert {w: np.frombuffer(c, "<u4").tolist() for w, c in found.items()} == {w: library.encode(w, add_special_tokens=False).ids for w in part}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*"aZéÉßÿÀ÷×ªº 'stI.=,<|>!-_\t\n\x01µſ1²中ΣςİŠ\u0338\u0307\u0301", "<|endoftext|>", "<|ENDOFTEXT|>", "don't", "h\u0331", "H\u0331"]), max_size=25).map("".join) | st.just("Word, WORD. wörd% word's"), max_size=5))
def test_plain_words_have_the_library_s_ids(texts):
    library = token_files.library(token_files.MODEL)
    found = token_files.token_ids(texts) if texts else []
    assert [f.tolist() for f in found] == [[*library.encode(t, add_special_tokens=False).ids, 2] for t in texts]


def test_letters_are_encoded_once_however_written(monkeypatch):
    seen = []
    real = token_files._of_letters
    monkeypatch.setattr(token_files, "_of_letters", lambda strings, model: seen.extend(strings) or real(strings, model))
    token_files.token_ids(["Word word, WORD. Éa éa!", "word; word% éA"])
    assert sorted(seen) == ["word", "éa"]


def test_letters_of_the_last_texts_are_not_encoded_again(monkeypatch):
    seen = []
    real = token_files._of_new_letters
    monkeypatch.setattr(token_files, "_of_new_letters", lambda strings, model: seen.extend(strings) or real(strings, model))
    token_files.known_letters.cache_clear()
    first = token_files.token_ids(["zwölf Boxer jagen", "Boxer, zwölf"])
    assert sorted(seen) == ["boxer", "jagen", "zwölf"]
    second = token_files.token_ids(["Viktor jagen ZWÖLF boxer"])
    assert sorted(seen) == ["boxer", "jagen", "viktor", "zwölf"]
    library = token_files.library(token_files.MODEL)
    assert first[0].tolist() == [*library.encode("zwölf Boxer jagen").ids, 2] and second[0].tolist() == [*library.encode("Viktor jagen ZWÖLF boxer").ids, 2]


def test_shares_of_an_id_that_two_orders_foretell_are_added():
    """Ids in turn are foretold by orders 1 and 2 at once; they take less than a third of a bit each."""
    block = np.tile([700, 60000, 3, 65535, 0], 800)
    coded = range_coder.encode_blocks([block])
    assert (range_coder.decode_blocks(coded, [4000])[0] == block).all()
    assert len(coded[0]) < 150


@settings(max_examples=60, deadline=None)
@given(st.lists(st.dictionaries(st.sampled_from([0, 1, 2, 7, 8, 300, 32768, 65534, 65535]) | st.integers(0, 65535), st.sampled_from([1, 2, 3, 100, 400]), max_size=9), min_size=1, max_size=5))
def test_headings_round_trip(blocks):
    pairs = [sorted(b.items()) for b in blocks]
    sizes = np.array([*map(len, pairs)])
    distinct, counts = (np.array([p[at] for b in pairs for p in b], np.int64) for at in (0, 1))
    back = range_coder._headed([h + b"rest" for h in range_coder._headings(distinct, counts, sizes)])
    assert back[0].tolist() == distinct.tolist() and back[1].tolist() == counts.tolist() and back[2].tolist() == sizes.tolist() and back[3] == [b"rest"] * len(blocks)


def test_last_blocks_are_decoded_with_the_others(monkeypatch):
    monkeypatch.setattr(token_files, "LANES", 4)
    sizes = []
    real = token_files.decode_blocks
    monkeypatch.setattr(token_files, "decode_blocks", lambda payloads, lengths: sizes.append(len(payloads)) or real(payloads, lengths))
    ids = np.arange(5, dtype="<u4")
    row = {"shard": 0, "first_doc": 0, "doc_ids": [1], "doc_ends": [5], "starts": True, "n_ids": 5, "checksum": zlib.crc32(ids.tobytes()), "payload": range_coder.encode_blocks([ids])[0]}
    batch = pa.RecordBatch.from_pylist([row | {"block": b} for b in range(5)])
    assert sum(b.num_rows for b in token_files._decode({0: 0})([batch])) == 5
    assert sizes == [3, 2]  # not 4, and 1 that takes as many steps


def expected(rows):
    library, start, out = Tokenizer.from_file(public_tokenizers.path(token_files.MODEL)), 0, []
    for doc, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        out.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_files_give_the_library_s_ids(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = token_files.read(token_files.write(docs)).collect()
    assert sorted(tuple(r) for r in found) == expected(sorted((r.doc_id, r.text) for r in docs.collect()))


def test_awkward_rows(spark):
    docs = documents(spark)
    found = sorted((tuple(r) for r in token_files.read(token_files.write(docs)).collect()), key=lambda r: r[1])
    ordered = [(r.doc_id, r.text) for r in docs.withColumn("by", F.xxhash64("text")).orderBy("doc_id", "by").collect()]
    assert found == expected(ordered) and len(found) == len(ROWS)
    assert token_files.read(token_files.write(documents(spark, []))).count() == 0


def test_damage_is_found(spark):
    blocks = token_files.write(documents(spark))
    with pytest.raises(Exception, match="damaged"):
        token_files.read(blocks.withColumn("checksum", F.col("checksum") + 1)).collect()
