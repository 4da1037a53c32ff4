"""Token-id files: documents in ascending id order, their ids range-coded in checked blocks.

The table of blocks is the file: rows (shard, block, first_doc, doc_ids,
doc_ends, starts, n_ids, checksum, payload), sorted by shard and block within one file
a shard. Shards hold consecutive ranges of document ids; a block holds
``BLOCK_IDS`` ids of its shard's stream, the last one fewer, the documents that
end in it with the place where they end, how many of the shard ended before,
and whether its first id starts a document. A block is decoded and its checksum verified wherever its row lies:
documents that cross blocks give parts, which are put together by their key.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .pieces import chunks
from .range_coder import decode_blocks, encode_blocks

MODEL = "word_bpe_49k.json"
END_ID = 2
BLOCK_IDS = 4096
#: Blocks that are coded in step, so a task holds this many blocks of ids at most.
LANES = 2048
#: Stands between words that are encoded together; words that hold it are encoded on their own.
MARK = "\x01"
#: Words that are encoded together.
TOGETHER = 2000
#: Words that are put together at once, so that their places stay in the processor's memory.
AT_ONCE = 1 << 16
#: Strings of letters whose ids are kept for the next texts.
KNOWN = 500_000
#: Texts that are cut into words together, by their total bytes.
CHUNK_BYTES = 16_000_000
#: Letters that ``STEPS`` leave as they are but for their case, and marks before which they are cut and which none of its special tokens holds.
LETTERS, MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"
PLAIN = f"^[{LETTERS}]+[{re.escape(MARKS)}]*$"
#: What a tokenizer does before its model, if plain words may go to the model at once.
STEPS = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
)
FILE = "shard int, block long, first_doc long, doc_ids array<long>, doc_ends array<int>, starts boolean, n_ids int, checksum long, payload binary"

@lru_cache(maxsize=2)
def library(model: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(model))


@lru_cache(maxsize=2)
def letters_model(model: str):
    """(the tokenizer without its ``STEPS``, the letters from U+00C0 on as its model spells them, whether an id ends a word), or None if it has others."""
    found = json.loads(library(model).to_str())
    suffix = found["model"].get("end_of_word_suffix")
    if (found["normalizer"], found["pre_tokenizer"]) != STEPS or not suffix:
        return None
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel, WhitespaceSplit

    spelling = ByteLevel(add_prefix_space=False, use_regex=False)
    spelt = {at: spelling.pre_tokenize_str(chr(at))[0][0] for at in range(0xC0, 0x100)}
    alone = Tokenizer.from_str(json.dumps(found | {"normalizer": None, "pre_tokenizer": None, "added_tokens": []}))
    alone.pre_tokenizer = WhitespaceSplit()
    vocabulary = found["model"]["vocab"]
    ends = np.zeros(max(vocabulary.values()) + 1, bool)
    ends[[at for name, at in vocabulary.items() if name.endswith(suffix)]] = True
    return alone, spelt, ends


def _strung(flat: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the strings of ids that lie in ``flat``, in the given order; where each of them ends)."""
    lengths = sizes.take(order)
    ends = np.cumsum(lengths)
    shift = (np.cumsum(sizes) - sizes).take(order) - ends + lengths
    out, done = np.zeros(int(ends[-1]) if len(ends) else 0, flat.dtype), 0
    for start in range(0, len(order), AT_ONCE):
        part = slice(start, start + AT_ONCE)
        at = np.repeat(shift[part], lengths[part])
        at += np.arange(done, done + len(at))
        out[done : done + len(at)] = flat.take(at)
        done += len(at)
    return out, ends


def _listed(strings: pa.Array) -> list[str]:
    return strings.to_numpy(zero_copy_only=False).tolist()


def _joined(codes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(codes), dtype="<u4"), np.fromiter(map(len, codes), np.int64, len(codes)) // 4


class Known:
    """Strings with their ids, end to end, and the number of each one's; beyond ``KNOWN`` only those of the last texts stay."""

    def __init__(self):
        self.strings = pa.array([], pa.string())
        self.flat, self.sizes = np.zeros(0, "<u4"), np.zeros(0, np.int64)

    def ids(self, strings: pa.Array, make) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct ``strings``, end to end, and the number of each one's; ``make`` gives those that are not known."""
        at = pc.index_in(strings, value_set=self.strings)
        new = strings.filter(pc.is_null(at))
        made = make(_listed(new))
        place = pc.fill_null(at, -1).to_numpy().astype(np.int64)
        place[place < 0] = len(self.strings) + np.arange(len(new))
        flat, sizes = (np.concatenate(x) for x in zip((self.flat, self.sizes), made, strict=True))
        found = _strung(flat, sizes, place)[0], sizes.take(place)
        if len(sizes) > KNOWN:
            self.strings, (self.flat, self.sizes) = strings, found
        else:
            self.strings, self.flat, self.sizes = pa.concat_arrays([self.strings, new]), flat, sizes
        return found


@lru_cache(maxsize=4)
def known_letters(model: str, in_ascii: bool) -> Known:
    return Known()


def _of_letters(strings: list[str], model: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of distinct strings of small letters, end to end, and the number of each string's; the first of them tells whether all are of ASCII."""
    known = known_letters(model, not strings or strings[0].isascii())
    return known.ids(pa.array(strings, pa.string()), lambda new: _of_new_letters(new, model))


def _of_new_letters(strings: list[str], model: str) -> tuple[np.ndarray, np.ndarray]:
    """The library gets many at once and every last id ends a word."""
    alone, spelt, is_end = letters_model(model)
    flat, sizes = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
    for start in range(0, len(strings), TOGETHER):
        text = " ".join(strings[start : start + TOGETHER])
        ids = np.array(alone.encode_batch_fast([text if text.isascii() else text.translate(spelt)], add_special_tokens=False)[0].ids, dtype="<u4")
        flat.append(ids)
        sizes.append(np.diff(np.flatnonzero(is_end[ids]), prepend=-1))
    return np.concatenate(flat), np.concatenate(sizes)


def _of_words(words: pa.Array, model: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of distinct words, end to end, and the number of each word's.

    A plain word is its letters and the marks after them, each of which is
    encoded once however it is written and put together; others go to the
    library whole.
    """
    if not letters_model(model):
        return _joined([*map(_encoded(spelt := _listed(words), model).__getitem__, spelt)])
    is_plain = pc.match_substring_regex(words, PLAIN)
    plain, other = words.filter(is_plain), _listed(words.filter(pc.invert(is_plain)))
    letters = pc.utf8_lower(pc.ascii_rtrim(plain, MARKS))
    in_ascii = pc.string_is_ascii(letters)
    by_kind = [letters.filter(kind).dictionary_encode() for kind in (in_ascii, pc.invert(in_ascii))]
    marks = pc.replace_substring_regex(plain, f"^[{LETTERS}]+", "").dictionary_encode()
    coded = [_of_letters(_listed(x.dictionary), model) for x in by_kind]
    coded += [_joined([*map(_encoded(spelt, model).__getitem__, spelt)]) for spelt in (["", *_listed(marks.dictionary)], other)]
    first = np.cumsum([0, *(len(sizes) for _, sizes in coded)])
    pairs = np.full((len(words), 2), first[2])  # nothing
    is_plain, in_ascii = (x.to_numpy(zero_copy_only=False) for x in (is_plain, in_ascii))
    at = np.flatnonzero(is_plain)
    pairs[at[in_ascii], 0] = first[0] + by_kind[0].indices.to_numpy()
    pairs[at[~in_ascii], 0] = first[1] + by_kind[1].indices.to_numpy()
    pairs[at, 1] = first[2] + 1 + marks.indices.to_numpy()
    pairs[~is_plain, 0] = first[3] + np.arange(len(other))
    flat, ends = _strung(*map(np.concatenate, zip(*coded, strict=True)), pairs.ravel())
    return flat, np.diff(ends[1::2], prepend=0)


def _encoded(new: list[str], model: str) -> dict[str, bytes]:
    """Ids of words, as bytes: the library gets many at once, with marks between them."""
    mark = library(model).encode(MARK, add_special_tokens=False).ids
    out: dict[str, bytes] = {}
    for start in range(0, len(new), TOGETHER):
        part = new[start : start + TOGETHER]
        ids = np.array(library(model).encode_batch_fast([f" {MARK} ".join(part)], add_special_tokens=False)[0].ids, dtype="<u4")
        at = np.flatnonzero(ids == mark[0]) if len(mark) == 1 else ()
        if len(at) == len(part) - 1:
            raw = ids.tobytes()
            out.update(zip(part, map(raw.__getitem__, map(slice, [0, *(4 * at + 4).tolist()], [*(4 * at).tolist(), len(raw)])), strict=True))
        else:
            for word, found in zip(part, library(model).encode_batch_fast(part, add_special_tokens=False), strict=True):
                out[word] = np.array(found.ids, dtype="<u4").tobytes()
    return out


def column_ids(texts: pa.Array, model: str = MODEL) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, each with the end id; where each text ends in them); null texts count as empty.

    Words are the parts between blanks and line feeds, which the normaliser
    takes for white space and no token spans. Every distinct word is encoded
    once.
    """
    split = pc.split_pattern(pc.replace_substring(texts.fill_null(""), "\n", " "), " ")
    found = split.flatten().dictionary_encode()
    flat, sizes = _of_words(found.dictionary, model)
    after = np.cumsum(pc.list_value_length(split).to_numpy())
    # The end id is a last word of each text.
    every = np.insert(found.indices.to_numpy(), after, len(sizes))
    ids, ends = _strung(np.append(flat, np.array([END_ID], "<u4")), np.append(sizes, 1), every)
    return ids, ends[after + np.arange(len(after))]


def token_ids(texts: list[str], model: str = MODEL) -> list[np.ndarray]:
    """Ids of each text and the end id."""
    ids, ends = column_ids(pa.array(texts, pa.string()), model)
    return np.split(ids, ends[:-1])


def _encode(model: str):
    def blocks(batches):
        shard, block, ended, fresh = TaskContext.get().partitionId(), 0, 0, True
        parts: list[np.ndarray] = []
        held = 0  # ids in ``parts``
        ends: list[tuple[int | None, int]] = []  # documents that end in them, and where

        def cut(last: bool):
            nonlocal block, ended, fresh, parts, held, ends
            stream = np.concatenate(parts) if parts else np.zeros(0, dtype="<u4")
            whole = len(stream) if last else len(stream) // BLOCK_IDS * BLOCK_IDS
            pieces = [stream[i : i + BLOCK_IDS] for i in range(0, whole, BLOCK_IDS)]
            documents: list[list] = [[] for _ in pieces]
            for doc, at in (e for e in ends if e[1] <= whole):
                documents[(at - 1) // BLOCK_IDS].append((doc, (at - 1) % BLOCK_IDS + 1))
            before = ended + np.cumsum([0, *map(len, documents)])
            ended = int(before[-1])
            # A block starts with a new document if one ended with the last id of the block before.
            filled = [fresh, *(bool(d) and d[-1][1] == BLOCK_IDS for d in documents)]
            starts, fresh = filled[:-1], filled[-1]
            rows = {
                "shard": [shard] * len(pieces), "block": list(range(block, block + len(pieces))), "first_doc": before[:-1].tolist(), "doc_ids": [[d for d, _ in x] for x in documents], "doc_ends": [[e for _, e in x] for x in documents],
                "starts": starts, "n_ids": list(map(len, pieces)), "checksum": [zlib.crc32(p.tobytes()) for p in pieces], "payload": encode_blocks(pieces),
            }
            block += len(pieces)
            parts, held = [stream[whole:]], len(stream) - whole
            ends = [(d, at - whole) for d, at in ends if at > whole]
            return pa.RecordBatch.from_pydict(rows, schema=shape)

        for batch in batches:
            names = batch.column(0).to_pylist()
            for start, end in chunks(pc.binary_length(batch.column(1)).to_pylist(), CHUNK_BYTES):
                ids, after = column_ids(batch.column(1).slice(start, end - start), model)
                done = 0
                for doc, at in zip(names[start:end], after.tolist(), strict=True):
                    parts.append(ids[done:at])
                    held += at - done
                    done = at
                    ends.append((doc, held))
                    if held >= LANES * BLOCK_IDS:
                        yield cut(False)
        if held:
            yield cut(True)

    shape = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("first_doc", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("doc_ends", pa.list_(pa.int32())), ("starts", pa.bool_()), ("n_ids", pa.int32()), ("checksum", pa.int64()), ("payload", pa.binary())])
    return blocks


def write(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", model: str = MODEL) -> DataFrame:
    """Write the ids of ``docs`` and return the table of blocks, read from its files.

    Documents are ordered by id, nulls first, and by text hash among equal
    ids; ranges are cut by both, so an id that many rows share is no hot spot.
    Null texts count as empty, which have the end id only.
    """
    named = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    ordered = named.repartitionByRange("doc_id", "text_hash").sortWithinPartitions("doc_id", "text_hash").select("doc_id", "text")
    return materialize(ordered.mapInArrow(_encode(model), FILE), "token-file")


DIGEST = ["doc_id", "start", "n_tokens", "ids_crc32"]
PARTS = "shard int, ordinal long, block long, whole boolean, doc_id long, start long, n_tokens long, ids_crc32 long"


def _decode(offsets: dict[int, int]):
    def parts(batches):
        for batch in batches:
            rows = batch.to_pylist()
            lanes = -(-len(rows) // -(-len(rows) // LANES)) if rows else 1  # a last few would take as long as many
            for first in range(0, len(rows), lanes):
                some = rows[first : first + lanes]
                out: list[tuple] = []
                for row, ids in zip(some, decode_blocks([r["payload"] for r in some], [r["n_ids"] for r in some]), strict=True):
                    raw = ids.astype("<u4").tobytes()
                    if zlib.crc32(raw) != row["checksum"]:
                        raise ValueError(f"block {row['block']} of shard {row['shard']} is damaged")
                    shard, block = row["shard"], row["block"]
                    at, start, ordinal = 0, offsets[shard] + block * BLOCK_IDS, row["first_doc"]
                    for doc, end in zip([*row["doc_ids"], None], [*row["doc_ends"], row["n_ids"]], strict=True):
                        if end > at:
                            whole = ordinal < row["first_doc"] + len(row["doc_ids"]) and (ordinal > row["first_doc"] or row["starts"])
                            out.append((shard, ordinal, block, whole, doc, start + at, end - at, zlib.crc32(raw[4 * at : 4 * end])))
                        at, ordinal = end, ordinal + 1
                yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*out, strict=True), shape.types, strict=True)], schema=shape)

    shape = pa.schema([("shard", pa.int32()), ("ordinal", pa.int64()), ("block", pa.int64()), ("whole", pa.bool_()), ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    return parts


def _product(a: int, b: int) -> int:
    """Product of two polynomials modulo that of CRC-32, bits reversed."""
    out = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            out ^= b
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return out


@lru_cache(maxsize=64)
def _power(bit: int) -> int:
    """x to the power of 8 * 2^``bit``: what that many bytes more multiply a CRC-32 by."""
    return _product(_power(bit - 1), _power(bit - 1)) if bit else 1 << 23


def joined_crc(parts: list[tuple[int, int]]) -> int:
    """CRC-32 of byte strings put together, from the length and CRC-32 of each."""
    out = 0
    for size, crc in parts:
        bit = 0
        while size and out:
            if size & 1:
                out = _product(_power(bit), out)
            bit, size = bit + 1, size >> 1
        out ^= crc
    return out


def _put_together(batches):
    """One row for the ordered parts of each document."""
    for batch in batches:
        every = [row["parts"] for row in batch.to_pylist()]
        sizes = [sum(p["n_tokens"] for p in parts) for parts in every]
        sums = [joined_crc([(4 * p["n_tokens"], p["ids_crc32"]) for p in parts]) for parts in every]
        columns = ([parts[-1]["doc_id"] for parts in every], [parts[0]["start"] for parts in every], sizes, sums)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=DIGEST)


def read(blocks: DataFrame) -> DataFrame:
    """One row per document: doc_id, start, n_tokens, ids_crc32, all from the decoded blocks.

    A document of several blocks is put together from a part of each.
    """
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()  # one row a shard
    offsets, before = {}, 0
    for row in sizes:
        offsets[row["shard"]] = before
        before += row["n"]
    found = materialize(blocks.mapInArrow(_decode(offsets), PARTS), "token-parts")
    part = F.struct("block", *DIGEST)
    crossing = found.where(~F.col("whole")).groupBy("shard", "ordinal").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    put = crossing.select("parts").mapInArrow(_put_together, ", ".join(f"{c} long" for c in DIGEST))
    return found.where("whole").select(*DIGEST).unionByName(put)
