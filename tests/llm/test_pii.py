"""Personal data: fixed patterns and exact marginals by brute force, repeats by planted documents."""

import hashlib
import itertools
import random
import re
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest
from test_llm import collect, docs, rows  # noqa: F401

from fluvion.llm import pii

DOCUMENTS = "/root/testdata/sf0.1/documents.parquet"


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit_pii(spark.read.parquet(DOCUMENTS))


def named(model, text):
    """What the field adds to the fixed patterns: kinds with texts."""
    return [(k, text[a:b]) for k, a, b in model.spans(text, pii.base_spans(text))]


def test_pii(spark, docs, rows):
    tricky = [(40_000, "call +49 (30) 1234-5678, mail a.b@c-d.example.org, x@y@z.com 1.2.3.4.5 999.1.1.1 256.1.1.1 4111 1111 1111 1111 +1234"), (40_001, "@ a@b @c.d ...@e.f +1-2-3-4-5-6-7-8-9 4111-1111-1111-1112 10.0.0.1"), (40_002, "9" * 5000 + " " + "a" * 5000)]
    every = docs.select("doc_id", "text").unionByName(spark.createDataFrame(tricky, "doc_id long, text string"))
    got = collect(pii.pii_scan(every))

    def luhn(d):
        return sum(x if k % 2 == 0 else x * 2 - 9 * (x > 4) for k, x in enumerate(map(int, reversed(d)))) % 10 == 0

    for i, text in [*rows, *tricky]:
        t = text or ""
        base = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t if i != 40_002 else "")]
        base += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t if i != 40_002 else "") if all(int(p) <= 255 for p in m[0].split("."))]
        base += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(d := re.sub("[ -]", "", m[0])) <= 19 and luhn(d)]
        base += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
        n = Counter(k for k, _, _ in base)
        text_base = [f"{k}:{a}:{b}" for k, a, b in sorted(base, key=lambda s: (pii.KINDS.index(s[0]), s[1]))]
        for r in got[i]:
            assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(n[k] for k in pii.KINDS), i
            assert r.base_sha256 == hashlib.sha256(",".join(text_base).encode()).hexdigest()
            assert set(text_base) <= set(r.spans.split(","))


def without_skip(model):
    return replace(model, skip=np.zeros_like(model.skip))


def test_repeats_are_found_by_skip_edges_alone(model):
    """Each of these is lost as soon as the skip edges are."""
    for text, want in [
        ("Ring +49 30 1234567 at noon. Later ring 1234567 again.", [("phone", "1234567")]),
        ("mail john.smith@example.com now, as john.smith said", [("email", "john.smith")]),
        ("mail Mary.Jones@example.com now. (Mary.Jones) waits", [("email", "Mary.Jones")]),
    ]:
        assert named(model, text) == want
        assert named(without_skip(model), text) == []


def test_a_bare_word_is_no_address(model):
    for text in "user377 and room 12", "mail user377@a.example.com, then user377 said so", "mail bo@example.com, as bo said", "version 2.0 of 2020-01-02, page 7":
        assert named(model, text) == []


def test_features_name_what_no_pattern_takes(model):
    """Two card numbers in a row are one run of 32 digits to the pattern; the field reads them as tokens, and believes the valid ones."""
    text = "to 4845168114407329 4111111111111111 or so"
    assert pii.base_spans(text) == []
    assert named(model, text) == [("card", "4845168114407329"), ("card", "4111111111111111")]
    assert named(model, "to 4845168114407328 4111111111111112 or so") == []


def exact(model, found):
    """Marginals by listing every labelling; hubs are summed out one by one."""
    n, size = len(found), len(pii.LABELS)
    own = np.tile(model.prior, (n, 1))
    for i, m in enumerate(found):
        own[i] += sum((model.unary.get(f, 0) for f in itertools.chain(*m.features)), np.zeros(size))
        if m.label >= 0:
            own[i] = np.where(np.arange(size) == m.label, 0, -30.0)
    hubs = {tuple(i for i, m in enumerate(found) if key in m.keys) for m in found for key in m.keys}
    total = np.zeros((n, size))
    for labels in itertools.product(range(size), repeat=n):
        w = sum(own[i, y] for i, y in enumerate(labels)) + sum(model.chain[a, b] for a, b in itertools.pairwise(labels))
        w += sum(np.log(sum(np.exp(sum(model.skip[labels[i], h] for i in who)) for h in range(size))) for who in hubs if len(who) > 1)
        total[range(n), labels] += np.exp(w)
    return total / total.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("text", ["x1 y2 z3", "see 12.5 and +49 30 1234567 or 1.2.3.4 then 77"])
def test_beliefs_are_exact_on_chains(model, text):
    found = pii.mentions(text, pii.base_spans(text))
    assert np.abs(model.labels(found) - exact(model, found)).max() < 1e-5


def test_beliefs_are_exact_on_hubs(model):
    text = "1234567 2000001 +49 30 1234567 or 001234567 and 1234567"
    found = pii.mentions(text, pii.base_spans(text))
    alone = replace(model, chain=np.zeros_like(model.chain))
    assert len(found) == 5
    # Equal tokens meet at two hubs, which closes a loop; one key a mention leaves a tree.
    tree = [replace(m, keys=tuple(k for k in m.keys if k.startswith("n:"))) for m in found]
    assert np.abs(alone.labels(tree) - exact(alone, tree)).max() < 1e-5


def test_beliefs_are_near_the_exact_ones_with_loops(model):
    draw = random.Random(5)
    parts = ["1234567", "+49 30 1234567", "john.smith", "john.smith@example.com", "@john.smith", "4111111111111111", "7", "1.2.3.4", "2.0"]
    for _ in range(25):
        text = " and ".join(draw.choices(parts, k=draw.randint(2, 6)))
        found = pii.mentions(text, pii.base_spans(text))
        got, want = model.labels(found), exact(model, found)
        assert np.abs(got - want).mean() < 0.05
        for g, w in zip(got, want, strict=True):
            if np.sort(w)[-1] - np.sort(w)[-2] > 0.4:
                assert g.argmax() == w.argmax(), text


def test_clean_documents_are_left_alone(spark, model):
    rows = [r for r in spark.read.parquet(DOCUMENTS).collect() if r.text]
    clean = [r.text for r in rows if not pii.base_spans(r.text)]
    false = sum(bool(named(model, t)) for t in clean)
    assert false <= 0.001 * len(clean)


def test_many_mentions_and_long_tokens_stay_linear(model):
    text = " ".join(f"{i % 50}1234567" for i in range(20_000)) + " " + "a" * 300_000 + " " + "1" * 100_000
    assert len(pii.mentions(text, pii.base_spans(text))) > 20_000
    named(model, text)
