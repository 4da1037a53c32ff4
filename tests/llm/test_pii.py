import collections
import dataclasses
import hashlib
import itertools
import re
import time

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import pii

from .helpers import LONG, ROWS, documents

PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def plain(text):
    found = []
    for kind, (name, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if name == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if name == "card" and not (14 <= len(digits) <= 19 and sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0):
                continue
            if name == "phone" and not 10 <= len(digits) <= 15:
                continue
            found.append((m.start(), kind, m.end()))
    return sorted(found)


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="a1@.+-() 4205%Z\n", max_size=60) | st.lists(st.sampled_from(["4111 1111 1111 1111", "a@b.c", "1.2.3.4", "+1 555 123 4567", "300.1.1.1", "@", ".", " ", "-", "x", "9"]), max_size=12).map("".join))
def test_base_spans_match_the_patterns(text):
    assert pii.base_spans(text) == plain(text)


def test_detection_keeps_base_spans_and_masks(spark):
    rows = [*ROWS, (20, "mail Jo.Do@x.org, call +44 20 7946 0958 from 10.0.0.1"), (21, "card 4111-1111-1111-1111 é a@b.co a@b.co"), (22, LONG + " z@y.com")]
    docs = documents(spark, rows)
    model = pii.train(docs)
    found = pii.detect(docs, model=model).collect()
    assert len(found) == len(rows)
    texts = {}
    for i, t in rows:
        texts.setdefault(i, set()).add(t or "")
    for r in found:
        base = {t: pii.written(plain(t)) for t in texts[r.doc_id]}
        fit = [t for t, b in base.items() if hashlib.sha256(b.encode()).hexdigest() == r.base_sha256]
        assert fit and any([r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for _, k, _ in plain(t)) for kind in range(4)] for t in fit)
        assert any(set(base[t].split(",")) - {""} <= set(r.spans.split(",")) for t in fit)
    masked = {r.doc_id: r.text for r in pii.redact(docs, model=model).collect()}
    assert masked[20].startswith("mail [EMAIL], call [PHONE] from [IP]") and "[CARD]" in masked[21] and masked[5] is None
    assert pii.detect(documents(spark, [])).count() == 0


def exact(graph, model):
    """Label probabilities by adding up all labellings."""
    unary, n = model.unary(graph.bits, graph.before, graph.after), len(graph.spans)
    out = np.zeros((n, pii.K))
    for labels in itertools.product(range(pii.K), repeat=n):
        score = sum(unary[i, y] for i, y in enumerate(labels))
        score += sum(model.transition[labels[i], labels[j]] for i, j in graph.chain) + sum(model.agreement[labels[i], labels[j]] for i, j in graph.skip)
        for i, y in enumerate(labels):
            out[i, y] += np.exp(score)
    return out / out.sum(axis=1, keepdims=True)


def random_model(seed, scale=1.0):
    rng = np.random.default_rng(seed)
    draw = lambda *shape: scale * rng.normal(size=shape)
    agreement = draw(pii.K, pii.K)
    return pii.Model(draw(len(pii.FEATURES), pii.K), draw(pii.WORDS + 1, pii.K), draw(pii.WORDS + 1, pii.K), draw(pii.K, pii.K), agreement + agreement.T)


@pytest.mark.parametrize("text", ["call 555-7710 or\n\n5557710", "x@y.z\n\nand x@y.z", "a 12 b", "7 8 9 10", "9 and one 9999 or 9999"])
def test_marginals_equal_enumeration(text):
    """On a tree of links the messages are exact; on a loop they are near."""
    graph = pii.graph([text])
    assert 3 <= len(graph.spans) + len(graph.skip) <= 8
    for seed in range(3):
        model = random_model(seed)
        far = np.abs(pii.marginals(graph, model, rounds=400) - exact(graph, model)).max()
        assert far < (2e-3 if len(graph.chain) + len(graph.skip) < len(graph.spans) else 0.2)


@pytest.fixture(scope="module")
def trained():
    texts = [t for (t,) in duckdb.sql("SELECT text FROM '/root/testdata/sf0.1/documents.parquet' WHERE regexp_matches(text, '[0-9@+]') AND doc_id % 4 = 0").fetchall()]
    counted = collections.Counter(pii.cases(texts))
    return pii.fit(list(counted), list(counted.values()))


def test_skip_links_change_what_is_found(trained):
    """A number is told in full once; later its parts alone follow it, but only through the skip links."""
    first, later = "Ring us: +1 (407) 555-7710 today. ", "As said, 5557710 is the number, or 555-7710 at night."
    text = first + "Some other words here. " * 5 + later
    without = dataclasses.replace(trained, agreement=np.zeros((pii.K, pii.K)))
    spans = lambda model: [text[a:b] for a, _, b in pii.find_spans([text], model)[0][1]]
    assert spans(trained) == ["+1 (407) 555-7710", "5557710", "555-7710"]
    assert spans(without) == ["+1 (407) 555-7710"]
    assert pii.find_spans([later], trained)[0][1] == []


def test_hidden_features_are_told_by_the_surroundings(trained):
    """The potentials come from training: alike ones attract, unlike ones don't."""
    assert (np.diag(trained.agreement) > 1).all()
    assert (trained.agreement - np.diag(np.diag(trained.agreement)) < 1).all()
    assert trained.transition[4, 4] > 1  # parts of a phone number


def test_candidates_in_a_row_keep_their_links_to_earlier_mentions():
    text = "+1 (407) 555-7710 was called, then +1 (407) 555-7710"
    tokens = lambda t, g: [(t[g.spans[a][1] : g.spans[a][2]], t[g.spans[b][1] : g.spans[b][2]]) for a, b in g.skip]
    assert tokens(text, pii.graph([text])) == [("555-7710", "555-7710")]
    text = "jo@x.org ann@y.org wrote, so did jo@x.org ann@y.org ann@y.org"
    found = pii.graph([text])
    # The last two are neighbours with one key: their chain link stands for the skip link.
    assert tokens(text, found) == [("jo@x.org", "jo@x.org"), ("ann@y.org", "ann@y.org")]
    n = len(found.spans)
    assert (n - 2, n - 1) in map(tuple, found.chain) and (n - 2, n - 1) not in map(tuple, found.skip)


@pytest.mark.parametrize("text", ["1" + "." * 1_000_000 + "1", "1@" * 500_000, "1" * 1_000_000, "@" * 1_000_000, "1.2.3." * 170_000])
def test_long_tokens_take_linear_time(text, trained):
    start = time.process_time()
    pii.find_spans([text], trained)
    assert time.process_time() - start < 20


def test_training_takes_whole_texts_and_its_bounds(spark):
    rows = [(i, f"mail a{i}@b.org or ring +1 (407) 555-{i:04d}" + " and so on" * 5000 + f" then late{i}@end.org") for i in range(40)]
    docs = documents(spark, [*rows, *rows, (50, None), (51, "")])
    assert np.isfinite(pii.train(docs).weights).all() and not np.allclose(pii.train(docs).weights, pii.train(docs, most=3).weights)
    sizes = []
    original = pii.fit
    try:
        pii.fit = lambda cases, times: sizes.append(sum(times)) or original(cases[:5], times[:5])
        pii.train(docs)
        pii.train(docs, sample=10)
        pii.train(documents(spark, []))
    finally:
        pii.fit = original
    # Candidates and the tokens around them; copies of a text count once.
    per_text = len(pii.cases([rows[0][1]]))
    assert sizes == [40 * per_text, 10 * per_text, 0]


def test_slices_don_t_change_results(trained, monkeypatch):
    texts = [t for (t,) in duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()] + ["", "1"]
    whole = pii.find_spans(texts, trained)
    monkeypatch.setattr(pii, "SLICE_BYTES", 1)
    assert pii.find_spans(texts, trained) == whole
