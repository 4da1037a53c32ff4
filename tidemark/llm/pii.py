"""Personal data: fixed patterns, extended by a skip-chain conditional random field.

The patterns give the base spans, which always stay. The nodes of the random
field are the candidates of a document (tokens without white space that hold a
digit, an at sign or a plus sign) and the tokens next to them. Neighbouring
tokens share transition potentials; repeated or similar candidates share
agreement potentials however far apart they are. Loopy message passing over a
slice of documents, in which base spans are certain, gives the marginals, and
confident candidates outside base spans are added.

All potentials are trained together by pseudo-likelihood: each node's label is
predicted from its own features, the words around it and the labels of its
neighbours in both kinds of links. The labels come from the base spans. So that
the field does not just repeat the patterns, every node is seen a second time
with its own features hidden: then only its surroundings tell.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pieces import chunks

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *KINDS)
K = len(LABELS)
#: Labelled tokens come from the whole texts of at most this many different documents with candidates, chosen by hash.
TRAINING_DOCS = 4000
#: And from at most this many different cases (features, surroundings, label), chosen by hash, each with how often it occurs.
TRAINING_CASES = 6000
#: Tokens on either side of a candidate that training sees, so that it knows how rare personal data is.
TRAINING_AROUND = 12
CONFIDENCE = 0.9
#: Messages are passed until none changes by more than a thousandth, this often at most.
ROUNDS = 60
#: Repeated tokens are taken as alike by this much, until the sample says otherwise.
ALIKE = 6.0
#: Weight of a label that a base span makes certain.
CERTAIN = 30.0
#: Words around a token are told apart by hash.
WORDS = 64
#: Texts whose graphs are built together, by their total bytes.
SLICE_BYTES = 1_000_000

#: Characters before an at sign, and what has to follow it.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
HOST = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: A match can only begin where a run of digits does; saying so keeps long runs linear.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
CANDIDATE_MARK = re.compile(r"[0-9@+]")
FIRST, LAST = re.compile("[A-Za-z0-9+]"), re.compile("[A-Za-z0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def is_card(match: str) -> bool:
    digits = NOT_DIGIT.sub("", match)
    return 14 <= len(digits) <= 19 and luhn(digits)


def is_phone(match: str) -> bool:
    return 10 <= len(NOT_DIGIT.sub("", match)) <= 15


def is_ip(match: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in match.split("."))


def emails(text: str) -> list[tuple[int, int, int]]:
    """Leftmost matches of local part, at sign and dotted host, found from the at signs in linear time."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = free + len(text[free:at].rstrip(LOCAL))
        host = HOST.match(text, at + 1) if start < at else None
        free = at + 1
        if host:
            found.append((start, 0, host.end()))
            free = host.end()
        at = text.find("@", free)
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' matches, sorted; kind is an index into KINDS."""
    found = []
    if "@" in text:
        found += emails(text)
    if CANDIDATE_MARK.search(text):
        if "." in text:
            found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if is_ip(m.group())]
        found += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if m.end() - m.start() >= 14 and is_card(m.group())]
        if "+" in text:
            found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if is_phone(m.group())]
    return sorted(found)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


FEATURES = (
    "bias", "at sign", "dotted host", "three dots", "four number parts", "parts in range", "plus first", "brackets", "dash", "letters", "hex run",
    "1-2 digits", "3-4 digits", "5-7 digits", "8-10 digits", "11-13 digits", "14-19 digits", "20 or more digits", "checksum holds", "only digits", "quoted",
)


def core_of(token: str) -> str:
    """``token`` from its first letter, digit or plus sign to its last letter or digit, in linear time."""
    first, last = FIRST.search(token), LAST.search(token[::-1])
    return token[first.start() : len(token) - last.start()] if first and last else ""


def features(token: str) -> int:
    """The features that hold of a token, as bits in the order of ``FEATURES``."""
    core = core_of(token)
    digits = NOT_DIGIT.sub("", core)
    n = len(digits)
    parts = core.split(".", 4)
    numbers = len(parts) == 4 and all(p.isdigit() and p.isascii() for p in parts)
    at = core.find("@")
    letters = any(c.isalpha() for c in core)
    held = (
        True, at > 0, at > 0 and "." in core[at:], core.count(".") == 3, numbers, numbers and is_ip(core), token[:1] == "+", "(" in token, "-" in core, letters, n > 3 and letters and at < 0,
        1 <= n <= 2, 3 <= n <= 4, 5 <= n <= 7, 8 <= n <= 10, 11 <= n <= 13, 14 <= n <= 19, n >= 20, 14 <= n <= 19 and luhn(digits), 0 < n == len(core), '"' in token,
    )
    return sum(1 << i for i, holds in enumerate(held) if holds)


def word_hash(token: str) -> int:
    """Which of the words around a token it is: letters only, folded; numbers are one word."""
    word = core_of(token).casefold()
    return zlib.crc32((word if word.isalpha() else "0").encode()) % WORDS


def similarity_keys(token: str) -> list[str]:
    """Tokens that share one of these are repeated or similar: the folded core, its digits, the part before an at sign."""
    core = core_of(token).casefold()
    digits = NOT_DIGIT.sub("", core)
    keys = [f"c{core}"] if len(core) > 3 else []
    keys += [f"d{digits}"] if len(digits) > 6 else []
    return keys + ([f"l{core.split('@')[0]}"] if core.find("@") > 3 else [])


@dataclass
class Graph:
    """Tokens of many documents, and the links between them."""

    spans: list[tuple[int, int, int]]  # document, start, end
    marked: np.ndarray  # whether it is a candidate; the others are neighbours of one
    bits: np.ndarray
    before: np.ndarray  # word before and after, by hash
    after: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def graph(texts: list[str], around: int = 1) -> Graph:
    """The candidates and the ``around`` tokens on either side of each; words around are told of candidates only."""
    spans, marked, bits, before, after, chain, skip = [], [], [], [], [], [], []
    for doc, text in enumerate(texts):
        if not CANDIDATE_MARK.search(text):
            continue
        tokens = [m.span() for m in TOKEN.finditer(text)]
        held = [i for i, span in enumerate(tokens) if CANDIDATE_MARK.search(text, *span)]
        nodes = sorted({j for i in held for j in range(max(0, i - around), min(len(tokens), i + around + 1))})
        held_set, last, previous = set(held), {}, -2
        for i in nodes:
            node, (start, end) = len(spans), tokens[i]
            follows = previous == i - 1
            if follows:
                chain.append((node - 1, node))
            token = text[start:end]
            for key in similarity_keys(token) if i in held_set else ():
                # Each mention is linked to the one before it, so a token repeated n times has n - 1 links, chain links included.
                if key in last and not (follows and last[key] == node - 1):
                    skip.append((last[key], node))
                last[key] = node
            spans.append((doc, start, end))
            marked.append(i in held_set)
            bits.append(features(token))
            before.append(word_hash(text[slice(*tokens[i - 1])]) if i and marked[-1] else WORDS)
            after.append(word_hash(text[slice(*tokens[i + 1])]) if i + 1 < len(tokens) and marked[-1] else WORDS)
            previous = i
    pairs = [np.array(sorted(set(x)), dtype=np.int64).reshape(-1, 2) for x in (chain, skip)]
    return Graph(spans, np.array(marked, bool), *(np.array(x, np.int64) for x in (bits, before, after)), *pairs)


@dataclass
class Model:
    """Weights by label: of the features, of the words before and after, and of links (label of the one, label of the other)."""

    weights: np.ndarray
    before: np.ndarray
    after: np.ndarray
    transition: np.ndarray
    agreement: np.ndarray

    def unary(self, bits: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        return _held(bits) @ self.weights + self.before[before] + self.after[after]


def _held(bits: np.ndarray) -> np.ndarray:
    return (bits[:, None] >> np.arange(len(FEATURES)) & 1).astype(np.float64)


def gold(texts: list[str], found: Graph) -> np.ndarray:
    """Label of each node: the kind of the base span that covers it, -1 inside a pattern's match that ran on over several tokens and so failed, else O."""
    labels = np.zeros(len(found.spans), dtype=np.int64)
    docs = np.array([d for d, _, _ in found.spans], dtype=np.int64)
    starts, ends = (np.array([s[i] for s in found.spans], dtype=np.int64) for i in (1, 2))
    for doc in np.unique(docs):
        text, first, until = texts[doc], *np.searchsorted(docs, (doc, doc + 1))
        failed = [(m.start(), -2, m.end()) for pattern in (CARD, PHONE) for m in pattern.finditer(text) if " " in m.group() and len(NOT_DIGIT.sub("", m.group())) >= 14]
        # Later ones win: of overlapping spans the first by start and kind, as in the list of spans.
        for start, kind, end in [*failed, *reversed(base_spans(text))]:
            low = first + np.searchsorted(ends[first:until], start, side="right")
            high = first + np.searchsorted(starts[first:until], end)
            labels[low:high] = kind + 1
    return labels


def cases(texts: list[str]) -> list[tuple[int, int, int, int, int, int, int]]:
    """Every node of ``texts`` for training: features, words, neighbours' labels (5: none, or unknown), agreement votes, label.

    The votes count the labels at the other ends of the skip links, four bits each.
    """
    found = graph(texts, TRAINING_AROUND)
    labels = gold(texts, found)
    left, right = np.full(len(labels), K), np.full(len(labels), K)
    known = labels >= 0
    for ends, (one, two) in ((right, (0, 1)), (left, (1, 0))):
        seen = found.chain[known[found.chain[:, two]]]
        ends[seen[:, one]] = labels[seen[:, two]]
    votes = np.zeros(len(labels), np.int64)
    for one, two in ((0, 1), (1, 0)):
        seen = found.skip[known[found.skip[:, two]]]
        np.add.at(votes, seen[:, one], 1 << 4 * labels[seen[:, two]])
    rows = np.column_stack([found.bits, found.before, found.after, left, right, votes, labels])[known]
    return list(map(tuple, rows.tolist()))


def fit(rows: list[tuple], counts: list[int], steps: int = 300, rate: float = 0.3, decay: float = 1e-4) -> Model:
    """All potentials by pseudo-likelihood over ``rows`` of ``cases`` and how often each occurs."""
    model = Model(np.zeros((len(FEATURES), K)), np.zeros((WORDS + 1, K)), np.zeros((WORDS + 1, K)), np.zeros((K + 1, K)), np.zeros((K, K)))
    if not rows:
        return Model(model.weights, model.before, model.after, model.transition[:K], ALIKE * np.eye(K))
    table, weight = np.array(rows, dtype=np.int64), np.array(counts, dtype=np.float64)
    votes = table[:, 5, None] >> 4 * np.arange(K) & 15
    bits, before, after, left, right, _, label = table.T
    own = np.concatenate([_held(bits), np.zeros((len(bits), len(FEATURES)))])
    before, after, left, right, label, votes, weight = (np.concatenate([x, x]) for x in (before, after, left, right, label, votes, weight))
    # Rare kinds count for more than their number, by its square root.
    weight = weight / np.sqrt(np.bincount(label, weight, K))[label]
    weight /= weight.sum()
    into = np.eye(K + 1)
    parts = {"weights": own, "before": np.eye(WORDS + 1)[before], "after": np.eye(WORDS + 1)[after], "agreement": votes.astype(np.float64)}
    design = np.concatenate([*parts.values(), into[left], into[right]], axis=1)
    edges = np.cumsum([0, *(x.shape[1] for x in parts.values()), K + 1, K + 1])
    prior = np.zeros((design.shape[1], K))
    prior[edges[3] : edges[4]] = ALIKE * np.eye(K)
    shrink = np.full((design.shape[1], 1), decay)
    shrink[edges[1] : edges[3]] *= 30  # the words around are many and rare
    theta, moment, scale, truth = prior.copy(), 0.0, 0.0, np.eye(K)[label]
    for step in range(1, steps + 1):
        logits = design @ theta
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        slope = design.T @ ((truth - p) * weight[:, None]) - shrink * (theta - prior)
        # A link's potential is one: seen from the right it is the transpose, and agreement is symmetric.
        to_left, to_right, both = (slice(edges[i], edges[i] + K) for i in (4, 5, 3))
        slope[to_left] = slope[to_left] + slope[to_right].T
        slope[to_right] = slope[to_left].T
        slope[both] = slope[both] + slope[both].T
        slope[[edges[2] - 1, edges[3] - 1, edges[4] + K, edges[5] + K]] = 0  # no word, no neighbour
        moment, scale = 0.9 * moment + 0.1 * slope, 0.999 * scale + 0.001 * slope**2
        theta += rate * (moment / (1 - 0.9**step)) / (np.sqrt(scale / (1 - 0.999**step)) + 1e-6) / np.sqrt(step)
    cut = {name: theta[edges[i] : edges[i + 1]] for i, name in enumerate(parts)}
    return Model(cut["weights"], cut["before"], cut["after"], theta[edges[4] : edges[4] + K], cut["agreement"])


def marginals(found: Graph, model: Model, known: np.ndarray | None = None, rounds: int = ROUNDS) -> np.ndarray:
    """Label probabilities of every node by damped loopy sum-product over chain and skip links.

    ``known`` has the labels of nodes that are certain, 0 or less for the others.
    """
    unary = model.unary(found.bits, found.before, found.after)
    if known is not None:
        unary[known > 0] = CERTAIN * np.eye(K)[known[known > 0]]
    belief = unary
    pairs = np.concatenate([found.chain, found.skip])
    if len(pairs):
        potentials = np.concatenate([np.repeat(model.transition[None], len(found.chain), 0), np.repeat(model.agreement[None], len(found.skip), 0)])
        source = np.concatenate([pairs[:, 0], pairs[:, 1]])
        target = np.concatenate([pairs[:, 1], pairs[:, 0]])
        potentials = np.concatenate([potentials, potentials.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(pairs)) + len(pairs), np.arange(len(pairs))])
        messages = np.zeros((len(source), K))
        for _ in range(rounds):
            belief = unary.copy()
            np.add.at(belief, target, messages)
            out = (belief[source] - messages[back])[:, :, None] + potentials
            top = out.max(axis=1)
            new = top + np.log(np.exp(out - top[:, None, :]).sum(axis=1))
            new -= new.max(axis=1, keepdims=True)
            moved = np.abs(new - messages).max()
            messages = 0.5 * messages + 0.5 * new
            if moved < 1e-3:
                break
        belief = unary.copy()
        np.add.at(belief, target, messages)
    p = np.exp(belief - belief.max(axis=1, initial=-np.inf, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def find_spans(texts: list[str], model: Model, confidence: float = CONFIDENCE) -> list[tuple[list, list]]:
    """For each text its base spans and all its spans, the random field's included."""
    out: list[tuple[list, list]] = []
    for first, until in chunks([len(t) for t in texts], SLICE_BYTES):
        out += _find_spans(texts[first:until], model, confidence)
    return out


def _find_spans(texts: list[str], model: Model, confidence: float) -> list[tuple[list, list]]:
    base = [base_spans(t) for t in texts]
    every = [list(b) for b in base]
    found = graph(texts)
    p = marginals(found, model, gold(texts, found))
    before = None
    for node in np.flatnonzero(found.marked & (p[:, 1:].max(axis=1, initial=0) >= confidence)):
        doc, start, end = found.spans[node]
        core, kind = core_of(texts[doc][start:end]), int(p[node, 1:].argmax())
        at = texts[doc].find(core, start)
        taken = base[doc]
        near = bisect_left(taken, (at + len(core),))
        if not core or any(s < end and start < e for s, _, e in taken[max(0, near - K) : near]):
            continue
        if kind == 3 and before == (doc, kind, start - 1):  # a phone number's next part
            every[doc][-1] = (every[doc][-1][0], kind, at + len(core))
        else:
            every[doc].append((at, kind, at + len(core)))
        before = (doc, kind, end)
    return [(b, sorted(e)) for b, e in zip(base, every, strict=True)]


CASE = ("bits", "before", "after", "chain_left", "chain_right", "votes", "label")


def train(docs: DataFrame, text: str = "text", sample: int = TRAINING_DOCS, most: int = TRAINING_CASES) -> Model:
    """Fit on the whole texts of at most ``sample`` different documents, chosen by hash among those that have candidates.

    Their cases are counted where the texts lie; ``most`` of them, chosen by
    hash so that rare ones teach as well, travel to the driver. Null and empty texts have no candidates.
    """
    hashed = docs.where(F.col(text).rlike("[0-9@+]")).select(F.xxhash64(text).alias("order"), F.col(text).alias("text"))
    last = hashed.select("order").distinct().orderBy("order").limit(sample).agg(F.max("order")).first()[0]
    chosen = hashed.where(F.col("order") <= F.lit(last).cast("long")).dropDuplicates(["order"])

    def rows(batches):
        for batch in batches:
            known = _texts(batch.column(0))
            for first, until in chunks([len(t) for t in known], SLICE_BYTES):
                found = np.array(cases(known[first:until]), dtype=np.int64).reshape(-1, len(CASE))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found.T], names=CASE)

    counted = chosen.select("text").mapInArrow(rows, ", ".join(f"{c} long" for c in CASE)).groupBy(*CASE).agg(F.count(F.lit(1)).alias("times"))
    found = counted.orderBy(F.xxhash64(*CASE), *CASE).limit(most).collect()
    return fit([tuple(r)[:-1] for r in found], [r["times"] for r in found])


def _texts(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def detect(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", model: Model | None = None, confidence: float = CONFIDENCE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, added.

    The counts and the digest are of the base spans; ``spans`` lists all of
    them as kind:start:end in code points, ``added`` counts the random field's.
    Null texts count as empty, null ids stay null, repeated rows stay repeated,
    other columns are ignored.
    """
    model = model or train(docs, text_column)

    def rows(batches):
        for batch in batches:
            out = {"doc_id": batch.column(0).to_pylist(), **{f"n_{k}": [] for k in KINDS}, "base_sha256": [], "spans": [], "added": []}
            for base, every in find_spans(_texts(batch.column(1)), model, confidence):
                for kind, name in enumerate(KINDS):
                    out[f"n_{name}"].append(sum(s[1] == kind for s in base))
                out["base_sha256"].append(hashlib.sha256(written(base).encode()).hexdigest())
                out["spans"].append(written(every))
                out["added"].append(len(every) - len(base))
            yield pa.RecordBatch.from_pydict(out, schema=shape)

    shape = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string()), ("added", pa.int64())])
    named = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return named.mapInArrow(rows, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, added long")


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with each span replaced by its kind in brackets; of overlapping spans the whole run, by the first kind."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, text_column: str = "text", model: Model | None = None, confidence: float = CONFIDENCE) -> DataFrame:
    """``docs`` with all spans masked in the text column; null texts stay null, other columns as they were."""
    model = model or train(docs, text_column)

    @F.pandas_udf("string")
    def mask(texts: pd.Series) -> pd.Series:
        known = [t or "" for t in texts]
        done = [masked(t, spans) for t, (_, spans) in zip(known, find_spans(known, model, confidence), strict=True)]
        return pd.Series([None if t is None else d for t, d in zip(texts, done, strict=True)], dtype=object)

    return docs.withColumn(text_column, mask(F.col(text_column).cast("string")))
