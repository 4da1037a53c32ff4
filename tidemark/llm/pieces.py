"""SentencePiece encoding and decoding by a shared-prefix Viterbi pass.

The distinct marked words of a batch are sorted, so that walking them in order
is a depth-first traversal of their trie: the forward state of each prefix is
computed once and reused by every word that shares it. A state is the best
last piece and where it starts. The vocabulary is a merge vocabulary, whose
scores are ranks: a path through the lattice scores 0 if merging by rank gives
each two neighbouring pieces back as they are, else minus infinity. Exactly
one path over any prefix survives, and it is the encoding by merges.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Recent

MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: A run of marks and what follows it up to the next mark: no piece reaches across.
MARKED_WORD = re.compile(f"{MARK}+[^{MARK}]*|^[^{MARK}]+")
#: Words that a worker remembers between batches, and parts of words: at most twice as many.
MEMORY = 200_000
PARTS_MEMORY = 100_000
#: Words that are cut into parts together, by their total letters.
LETTERS_TOGETHER = 1_000_000


class Pieces:
    """A merge vocabulary with byte fallback, and the forward pass over it."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.rank: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.names: list[str] = []
        self.bytes = [0] * 256
        self.byte_of: dict[int, int] = {}
        for number in range(len(model)):
            name = model.id_to_piece(number)
            self.names.append(name)
            if model.is_byte(number):
                self.bytes[int(name[3:5], 16)] = number
                self.byte_of[number] = int(name[3:5], 16)
            elif not (model.is_control(number) or model.is_unknown(number)):
                self.ids[name] = number
                self.rank[name] = -model.get_score(number)
        self.is_byte = np.zeros(len(self.names), dtype=bool)
        self.is_byte[list(self.byte_of)] = True
        self.texts = [name.replace(MARK, " ") for name in self.names]
        self.letters = {c for c in self.ids if len(c) == 1}
        #: Lengths of the pieces that end in three given letters, or in two if no longer one does, the longest first.
        self.lengths: dict[str, list[int]] = {}
        #: Neighbouring letters of some piece. No merge joins any others, so words can be cut there.
        self.joined: set[str] = set()
        for name in self.ids:
            self.joined.update(map("".join, zip(name, name[1:], strict=False)))
            if len(name) > 1:
                self.lengths.setdefault(name[-3:], []).append(len(name))
        self.lengths = {end: sorted({*n, *([2] if end[-2:] in self.ids else [])}, reverse=True) for end, n in self.lengths.items()}
        self.run = max(len(name) for name in self.ids if not name.strip(MARK))
        #: Two ids beside each other are one number; the left one is shifted by this.
        self.shift = len(self.names).bit_length()
        self._meets: dict[int, bool] = {}
        self._recent = Recent(PARTS_MEMORY)
        #: Numbers of the joined letters, 0 for all others, and which of two numbers are joined.
        joined = sorted({c for pair in self.joined for c in pair})
        self.numbers = np.zeros(max(map(ord, joined)) + 2, dtype=np.int32)
        self.numbers[list(map(ord, joined))] = np.arange(1, len(joined) + 1)
        self.side = len(joined) + 1
        self.beside = np.zeros(self.side * self.side, dtype=bool)
        self.beside[[int(self.numbers[ord(a)]) * self.side + int(self.numbers[ord(b)]) for a, b in self.joined]] = True

    def merged(self, symbols: list[str]) -> list[str]:
        """Merge the best ranked neighbours, the leftmost of equals, until none is left."""
        while True:
            best = min(((self.rank[a + b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False)) if a + b in self.rank), default=None)
            if best is None:
                return symbols
            symbols = [*symbols[: best[1]], symbols[best[1]] + symbols[best[1] + 1], *symbols[best[1] + 2 :]]

    def meets(self, left: int, right: int) -> bool:
        """Whether merging the letters of two pieces gives these two pieces again."""
        key = left << self.shift | right
        found = self._meets.get(key)
        if found is None:
            a, b = self.names[left], self.names[right]
            if len(self._meets) > 5 * MEMORY:
                self._meets.clear()
            found = self._meets[key] = self.merged(list(a + b)) == [a, b]
        return found

    def blanks(self, n: int) -> list[str]:
        """Pieces of a run of marks: their ranks are all equal, so the leftmost grows to the longest before the next begins."""
        return [MARK * self.run] * (n // self.run) + self.merged([MARK] * (n % self.run))

    def forward(self, words: list[str]):
        """Yield (word, ids) for ``words``, which must be sorted; each holds known letters only."""
        previous, last, start = "", [0], [0]
        ids, meets, known, lengths, shift = self.ids, self.meets, self._meets, self.lengths, self.shift
        for word in words:
            shared = 0
            for a, b in zip(previous, word, strict=False):
                if a != b:
                    break
                shared += 1
            del last[shared + 1 :], start[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                found = lengths.get(word[end - 3 : end]) if end > 2 else None
                if found is None:
                    found = lengths.get(word[end - 2 : end], ()) if end > 1 else ()
                for n in found:
                    begin = end - n
                    if begin < 0:
                        continue
                    piece = ids.get(word[begin:end])
                    if piece is not None:
                        if begin:
                            fits = known.get(last[begin] << shift | piece)
                            if fits is None:
                                fits = meets(last[begin], piece)
                            if not fits:
                                continue
                        last.append(piece)
                        start.append(begin)
                        break
                else:
                    last.append(ids[word[end - 1]])
                    start.append(end - 1)
            at, out = len(word), []
            while at:
                out.append(last[at])
                at = start[at]
            out.reverse()
            previous = word
            yield word, out

    def split(self, marked: str) -> list[tuple[bool, str]]:
        """Cut a marked word where no piece can reach across: (in the vocabulary, part)."""
        joined, letters, out, at = self.joined, self.letters, [], 0
        for i in range(1, len(marked)):
            if marked[i - 1 : i + 1] not in joined:
                out.append((marked[at] in letters, marked[at:i]))
                at = i
        out.append((marked[at] in letters, marked[at:]))
        return out

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of each distinct word, given without its first mark, as the bytes of their 32-bit integers."""
        plain = [w for w in words if w and MARK not in w]
        out: dict[str, bytes] = {}
        for start, end in chunks(list(map(len, plain)), LETTERS_TOGETHER):
            out.update(self._encode_plain(plain[start:end]))
        for word in words if len(plain) < len(words) else ():
            if word not in out:
                out[word] = self._encode_marked(word)
        return out

    def _encode_plain(self, words: list[str]) -> dict[str, bytes]:
        """``encode_words`` for words that hold no marks: all of them are cut into parts at once, and each distinct part is encoded once."""
        stream = MARK + MARK.join(words)
        letters = np.frombuffer(stream.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        number = self.numbers[np.minimum(letters, len(self.numbers) - 1)]
        is_word = letters == ord(MARK)
        cut = is_word.copy()
        cut[1:] |= ~self.beside[number[:-1] * self.side + number[1:]]
        starts = np.flatnonzero(cut)
        at = starts.tolist()
        parts = list(map(stream.__getitem__, map(slice, at, [*at[1:], len(stream)])))
        coded = list(map(self._recent.table(set(parts), self._encode_parts).__getitem__, parts))
        first = np.flatnonzero(is_word[starts]).tolist()
        return {word: coded[i] if j - i == 1 else b"".join(coded[i:j]) for word, i, j in zip(words, first, [*first[1:], len(coded)], strict=True)}

    def _encode_parts(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of parts that ``split`` cuts no more; a letter that is no piece is its bytes."""
        known = sorted(p for p in parts if p[0] in self.letters)
        out = {part: array("i", ids).tobytes() for part, ids in self.forward(known)}
        out.update((p, array("i", [self.bytes[b] for b in p.encode("utf-8", "surrogatepass")]).tobytes()) for p in parts if p[0] not in self.letters)
        return out

    def _encode_marked(self, word: str) -> bytes:
        """``encode_words`` for a word that is empty or holds further marks."""
        ids: list[int] = []
        for kind, part in self._parts(MARK + word):
            if kind == "word":
                ids += next(self.forward([part]))[1]
            elif kind == "blanks":
                ids += [self.ids[p] for p in self.blanks(len(part))]
            else:
                ids += [self.bytes[b] for b in part.encode("utf-8", "surrogatepass")]
        return array("i", ids).tobytes()

    def _parts(self, word: str) -> list[tuple[str, str]]:
        """Marks beyond the one that the word's first piece takes, known parts, unknown letters."""
        out = []
        for known, part in self.split(word):
            if not known:
                out.append(("unknown", part))
                continue
            blank = len(part) - len(part.lstrip(MARK))
            rest = part[max(0, blank - 1) :]
            if blank > 1 or rest == MARK:
                # The word's own mark joins the run if no piece takes it along with a letter.
                alone = rest == MARK or next(self.forward([rest]))[1][0] == self.ids[MARK]
                out.append(("blanks", part[: blank if alone else blank - 1]))
                rest = part[blank:] if alone else rest
            if rest:
                out.append(("word", rest))
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text that ids stand for, without the mark put before it."""
        if not self.is_byte[ids].any():
            return "".join(map(self.texts.__getitem__, ids.tolist()))[1:]
        out, raw = [], bytearray()
        for number in ids.tolist():
            byte = self.byte_of.get(number)
            if byte is not None:
                raw.append(byte)
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw = bytearray()
            out.append(self.names[number])
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        return "".join(out)[1:].replace(MARK, " ")


@lru_cache(maxsize=2)
def vocabulary(name: str) -> Pieces:
    return Pieces(public_tokenizers.path(name))


def pre_tokens(text: str | None) -> list[str]:
    """The marked words of a text in order, each without its first mark; an empty text has none."""
    if not text:
        return []
    if "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
        return [w[1:] for w in MARKED_WORD.findall(MARK + text.replace(" ", MARK))]
    return text.split(" ")


_recent = Recent(MEMORY)


def encode_texts(texts: list[str | None], pieces: Pieces) -> list[np.ndarray]:
    """Ids of each text; every distinct word is encoded once, and remembered while it is frequent."""
    split = [pre_tokens(t) for t in texts]
    table = _recent.table({w for words in split for w in words}, pieces.encode_words)
    return [np.frombuffer(b"".join(map(table.__getitem__, words)), dtype=np.int32) for words in split]


#: Texts that are encoded together, by their total letters.
CHUNK_LETTERS = 4_000_000


def chunks(sizes: list[int | None], most: int = CHUNK_LETTERS):
    """(start, end) of runs of neighbours that are worked on together, cut once they reach ``most``."""
    start = total = 0
    for at, size in enumerate(sizes):
        total += size or 0
        if total >= most:
            yield start, at + 1
            start, total = at + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def _lists(ids: list[np.ndarray | None]) -> pa.Array:
    sizes = np.array([0 if i is None else len(i) for i in ids], dtype=np.int32)
    flat = np.concatenate([np.zeros(0, dtype=np.int32), *(i for i in ids if i is not None)])
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(flat), mask=pa.array([i is None for i in ids], pa.bool_()))


def _mapped(docs: DataFrame, column: str, added: dict[str, T.DataType], work) -> DataFrame:
    """``docs`` with the columns that ``work`` makes of slices of ``column``, a few texts at a time."""
    base = docs.drop(*(n for n in added if n != column))
    schema = T.StructType([*base.schema.fields, *(T.StructField(n, t) for n, t in added.items())])

    def rows(batches):
        for batch in batches:
            values = batch.column(column)
            sizes = values.value_lengths() if pa.types.is_list(values.type) else pa.compute.binary_length(values)
            for start, end in chunks(sizes.to_pylist()):
                part = batch.slice(start, end - start)
                made = work(part.column(column))
                yield pa.RecordBatch.from_arrays([*part.columns, *made], [*batch.schema.names, *added])

    return base.mapInArrow(rows, schema)


def _text_column(docs: DataFrame, column: str) -> DataFrame:
    return docs if isinstance(docs.schema[column].dataType, T.StringType) else docs.withColumn(column, F.col(column).cast("string"))


def encode(docs: DataFrame, text_column: str = "text", name: str = "ids", model: str = MODEL) -> DataFrame:
    """``docs`` with the ids of the text in a column ``name``.

    Null texts have null ids, empty texts no ids. A column called ``name`` is
    replaced, the others and repeated rows stay.
    """

    def work(column):
        texts = column.to_pylist()
        return [_lists([None if t is None else i for t, i in zip(texts, encode_texts(texts, vocabulary(model)), strict=True)])]

    return _mapped(_text_column(docs, text_column), text_column, {name: T.ArrayType(T.IntegerType())}, work)


def decode(docs: DataFrame, ids_column: str = "ids", name: str = "decoded", model: str = MODEL) -> DataFrame:
    """``docs`` with the text that the ids stand for in a column ``name``; null for null.

    The inverse of ``encode``, but for marks that were in the text already:
    they come back as blanks.
    """

    def work(column):
        pieces = vocabulary(model)
        return [pa.array([None if i is None else pieces.decode(np.array(i, dtype=np.int32)) for i in column.to_pylist()], pa.string())]

    return _mapped(docs, ids_column, {name: T.StringType()}, work)


def encode_and_decode(docs: DataFrame, text_column: str = "text", ids_name: str = "ids", decoded_name: str = "decoded", model: str = MODEL) -> DataFrame:
    """``encode`` and then ``decode``, in one pass through the workers."""

    def work(column):
        pieces, texts = vocabulary(model), column.to_pylist()
        ids = [None if t is None else i for t, i in zip(texts, encode_texts(texts, pieces), strict=True)]
        return [_lists(ids), pa.array([None if i is None else pieces.decode(i) for i in ids], pa.string())]

    return _mapped(_text_column(docs, text_column), text_column, {ids_name: T.ArrayType(T.IntegerType()), decoded_name: T.StringType()}, work)
