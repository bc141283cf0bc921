"""Texts that are made to be slow or large."""

import itertools
import random
import re
import resource
import time

import numpy as np
import pytest

from fluvion.llm import html_extract, near_dedup, pii
from fluvion.llm.decontamination import decontaminate


def seconds(f, *args):
    start = time.process_time()
    f(*args)
    return time.process_time() - start


def test_words_with_many_marks_take_linear_time():
    for text in ("a" + "_b" * 200 + "(x1", "a_" * 100_000 + "(1", "a." * 100_000 + "(1", "a" + "_" * 200_000 + "."):
        assert seconds(pii.PARTED.fullmatch, text) < 0.5
    assert seconds(pii.mentions, "see " + "a_b_" * 100 + "a(x1 now", []) < 0.1


def test_parted_words_are_those_with_an_inner_mark():
    def parted(word):
        """By trying every split."""
        if len(word) < 3 or not (word[0].isalpha()):
            return False
        good = lambda run: bool(run) and all(c.isalnum() or c == "_" for c in run)
        ends = {k for k in range(1, len(word)) if all(c.isalnum() or c == "_" for c in word[1:k])}
        held, seen = set(ends), set()
        while held:
            k = held.pop()
            seen.add(k)
            if word[k] in "._%+-":
                for e in range(k + 2, len(word) + 1):
                    if good(word[k + 1 : e]):
                        if e == len(word):
                            return True
                        if e not in seen:
                            held.add(e)
        return False

    for n in range(1, 7):
        for word in map("".join, itertools.product("a1_.", repeat=n)):
            assert bool(pii.PARTED.fullmatch(word)) == parted(word), word


def test_unclosed_tags_and_values_take_linear_time_and_leave_no_markup():
    for page in ("<a " * 330_000 + '"', "<a x=" * 200_000 + '"', "<p>a</p>" + "<a x='" * 160_001, "<" * 1_000_000, "<!-- " * 200_000, "<![" * 300_000, '<a b= ' * 160_000 + '">'):
        assert seconds(html_extract.blocks_of, page) < 5
        assert "<a" not in " ".join(b.text for b in html_extract.blocks_of(page)[0])
    held = lambda page: [b.text for b in html_extract.blocks_of(page)[0]]
    assert held('<p>one</p><a href="foo>link</a>') == ["one"]
    assert held('<p>one <a href="a>b">two</a> three</p>') == ["one two three"]
    assert held("<p>one <a title=it's>two</a></p>") == ["one two"]
    assert held('<p>one <a b = "x" c=\'y>\' d>two</a></p>') == ["one two"]
    assert held("<p>1 < 2 <!--> <b>x</b> --> y</p>") == ["1 < 2 x --> y"]


def test_large_sets_are_signed_in_parts(monkeypatch):
    rnd = np.random.default_rng(1)
    sets = [rnd.integers(0, 1 << 63, n, dtype=np.uint64) for n in (1, 7, 400, 1, 2500)]
    whole = near_dedup.superminhash(sets, 400)
    monkeypatch.setattr(near_dedup, "CHUNK", 100)
    assert (near_dedup.superminhash(sets, 400) == whole).all()
    assert near_dedup.superminhash([], 400).shape == (0, 400)


def test_a_long_text_takes_bounded_memory():
    text = " ".join(f"w{i}" for i in range(1_000_000))
    _, held = near_dedup.shingles(text)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    near_dedup.superminhash([held], near_dedup.BANDS * near_dedup.ROWS)
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 300_000


@pytest.mark.parametrize("n", [5, 13])
def test_items_without_an_id_are_hit_but_not_listed(spark, n):
    words = " ".join(f"t{k}" for k in range(n))
    docs = spark.createDataFrame([(1, "before " + words + " after"), (2, "nothing here")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, words), (None, "t1 t2"), (4, "t0 t1")], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate(docs, bench).collect()}
    assert (got[1].n_hit, got[1].n_items, got[1].contaminated) == (n, 1, True)
    assert (got[2].n_hit, got[2].n_items) == (0, 0)


def test_random_pages_have_no_tags_left():
    rnd = random.Random(6)
    parts = ["<p>", "</p>", "<a href=", '"', "'", ">", "<", "word ", "<div class='x'>", "</div>", "<!--", "-->", "=", " ", "<br/>", "&lt;"]
    for _ in range(500):
        page = "".join(rnd.choices(parts, k=30))
        for b in html_extract.blocks_of(page)[0]:
            assert not re.search(r"<(p|div|a href)\b", b.text), page
