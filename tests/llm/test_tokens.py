"""Packing and alignment of token ids against whole-text encoding and brute force."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fluvion.llm import alignment, packing, queries, wordcuts
from fluvion.llm.packing import Lengths, best_fit, pack_lengths, reduce_lengths

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string"
BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
HARD = [
    "", " ", "\n", "a", " a", "a ", "a  b", "\n a", "a\n\nb", "a \n b", "it's we'll 'tis x's", "tab\tbed\t\tx", "a b   c", "naïve Straße ﬁn İ 1½ x²", "<|endoftext|> a<|endoftext|>b <|endoftext|>", "<s> </s> <unk> <0x0A>",
    "漢字かな 한국어 123456", "x y z\x85w", "a\x00b \x1c c", "▁x a▁b", "😀😀 é ‍", "...?! a,b;c:d e.f. (g) [h] {i}", "A" * 3000, "word " * 400, "don't\nstop\nnow's", "ǅ ªº ʰ éÉ ß. Ω≈ç", "﻿bom", "a\r\nb\rc",
]


def texts_of_all_kinds(n=400):
    rnd = random.Random(5)
    atoms = ["a", "The", "don't", "'s", " ", "  ", "\n", "\t", ".", ",", "12", "é", "ß.", "漢", "<|endoftext|>", "▁", " ", " ", "x1y", "…", "--", "\r\n", "\x1f", "ﬁ", "Z" * 70]
    return HARD + ["".join(rnd.choices(atoms, k=rnd.randint(1, 12))) for _ in range(n)]


def test_words_encode_as_whole_texts():
    texts = texts_of_all_kinds()
    encoder = packing.DocumentEncoder(BYTES)
    assert encoder.words.cuts_safely
    want = Tokenizer.from_file(BYTES)
    for some in (texts, texts[::-1]):
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(some)] == [want.encode(t, add_special_tokens=False).ids for t in some]


def test_a_full_store_of_words_starts_anew(monkeypatch):
    monkeypatch.setattr(wordcuts, "KEPT", 5)
    test_words_encode_as_whole_texts()


def fewest(lengths, capacity):
    """Fewest sequences by trying every set that holds the longest piece."""
    if not lengths:
        return 0
    first, rest = lengths[0], lengths[1:]
    best = len(lengths)
    for k in range(len(rest) + 1):
        for pick in itertools.combinations(range(len(rest)), k):
            if first + sum(rest[i] for i in pick) <= capacity:
                best = min(best, 1 + fewest([rest[i] for i in range(len(rest)) if i not in pick], capacity))
    return best


@pytest.mark.parametrize("seed", range(40))
def test_reduction_never_costs_a_sequence(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([10, 12, 20])
    lengths = sorted(rnd.choices(range(rnd.choice([1, capacity // 4]), capacity + 1), k=rnd.randint(1, 8)), reverse=True)
    left = Lengths(Counter(lengths))
    fixed = reduce_lengths(left, capacity)
    rest = sorted((v for v, n in left.n.items() for _ in range(n)), reverse=True)
    assert sum(n for _, n in fixed) + fewest(rest, capacity) == fewest(lengths, capacity)


def plain_best_fit(lengths, capacity):
    rooms = []
    for v in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= v]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - v)
        else:
            rooms.append(capacity - v)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(20))
def test_best_fit_by_patterns_is_best_fit(seed):
    rnd = random.Random(seed)
    lengths = rnd.choices(rnd.sample(range(1, 61), rnd.choice([3, 20, 60])), k=300)
    got = best_fit(Lengths(Counter(lengths)), 60)
    assert sorted(60 - sum(v * k for v, k in p) for p, n in got for _ in range(n)) == plain_best_fit(lengths, 60)


def test_patterns_hold_every_piece_and_come_near_the_bound():
    rnd = random.Random(2)
    for low, high in ((1, 1024), (200, 700), (341, 400)):
        counts = Counter(rnd.choices(range(low, high + 1), k=50_000))
        found = pack_lengths(counts, 1024)
        held = Counter()
        for p, n in found:
            assert sum(v * k for v, k in p) <= 1024
            for v, k in p:
                held[v] += n * k
        assert held == counts
        used = sum(n for _, n in found)
        bound = math.ceil(max(sum(v * n for v, n in counts.items()) / 1024, sum(n for v, n in counts.items() if v > 512), sum(n for v, n in counts.items() if v > 341) / 2))
        assert used <= 1.02 * bound
    with pytest.raises(ValueError):
        pack_lengths({1025: 1}, 1024)


@pytest.fixture(scope="module")
def docs(spark):
    odd = [(10**6 + k, t, None) for k, t in enumerate(HARD)] + [(None, "no id", "aa"), (7, None, "aa"), (7, "twice", "aa"), (7, "twice", "aa"), (8, " ".join(f"w{i % 977}" for i in range(30_000)), "aa")]
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").unionByName(spark.createDataFrame(odd, SCHEMA))
    return table.withColumn("part", F.lit("x")).withColumn("length", F.lit(1)).withColumn("chunk", F.lit(0)).cache()


def test_packed_documents(spark, docs):
    encode = Tokenizer.from_file(BYTES)
    want = Counter()
    for r in docs.collect():
        ids = np.array([*encode.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids), 1024), len(ids)]
        want.update((r.doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
    packed = packing.packed_documents(docs, BYTES).cache()
    rows = packed.collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length, bytes(r.ids)))
    for places in held.values():
        places.sort()
        assert [p[0] for p in places] == [0, *itertools.accumulate(p[1] for p in places)][:-1] and sum(p[1] for p in places) <= 1024
    assert len(held) <= math.ceil(sum(r.length for r in rows) / 1024) + 2
    joined = {r.sequence_id: (r.length, bytes(r.ids)) for r in packing.sequences(packed).collect()}
    assert joined == {s: (sum(p[1] for p in v), b"".join(p[2] for p in v)) for s, v in held.items()}


def cut_at(ids, parts, ends):
    """Ids in lists that end where the bytes of their parts reach one of ``ends``."""
    out, some = [], []
    for i, end in zip(ids, itertools.accumulate(map(len, parts)), strict=True):
        some.append(i)
        if end in ends:
            out.append(some)
            some = []
    return out


def brute_alignment(rows):
    """The contract's columns, from whole texts and byte offsets."""
    a_model = Tokenizer.from_file(BYTES)
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a_bytes = wordcuts.ByteWords(BYTES, True).token_bytes()
    spelling = lambda p: bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()
    held, docs_of = [], Counter()
    for doc_id, text in rows:
        a = a_model.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_model.encode(text) if text else []
        x, y = [a_bytes[i] for i in a], [spelling(b_model.id_to_piece(i)) for i in b]
        if not text or b"".join(x) != (" " + text).encode() or b"".join(y) != (" " + text).encode():
            held.append((doc_id, [], Counter()))
            continue
        both = set(itertools.accumulate(map(len, x))) & set(itertools.accumulate(map(len, y)))
        groups = list(zip(cut_at(a, x, both), cut_at(b, y, both), strict=True))
        links = Counter((i, j) for g, h in groups for i in g for j in h)
        docs_of.update(links.keys())
        held.append((doc_id, groups, links))
    most = Counter()
    for (i, _), n in docs_of.items():
        most[i] = max(most[i], n)
    out = Counter()
    for doc_id, groups, links in held:
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out[
            doc_id, sum(len(g) for g, _ in groups), sum(len(h) for _, h in groups), len(groups), sum(links.values()), sum(n for (i, j), n in links.items() if docs_of[i, j] == most[i]),
            sum(n * docs_of[p] for p, n in links.items()), hashlib.sha256(text.encode()).hexdigest() if text else "",
        ] += 1
    return out


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("entries", [alignment.ENTRIES, 500])
def test_alignment(docs, monkeypatch, entries):
    # Local mode: workers import the package from here only where they are forked, so the smaller chunks are set in the function's own module.
    monkeypatch.setattr(alignment, "ENTRIES", entries)
    got = alignment.token_alignments(docs, BYTES, PIECES).cache()
    assert Counter(tuple(r[c] for c in COLUMNS) for r in got.collect()) == brute_alignment([(r.doc_id, r.text) for r in docs.collect()])
    one = got.where("n_a > 0").first()
    assert hashlib.sha256(one.groups.encode()).hexdigest() == one.groups_sha256


def test_words_align_as_whole_texts():
    texts = texts_of_all_kinds(200)
    found = alignment.Aligner(BYTES, PIECES).documents(texts)
    want = brute_alignment(list(enumerate(texts)))
    got = Counter({(k, f.n_a, f.n_b, f.n_groups, f.n_links, hashlib.sha256(f.text).hexdigest() if f.text else ""): 1 for k, f in enumerate(found)})
    assert got == Counter({(*w[:5], w[7]): 1 for w in want})


def test_groups_end_where_no_token_spans():
    rnd = random.Random(3)
    for _ in range(200):
        n = rnd.randint(1, 40)
        a = np.array(sorted({*rnd.sample(range(1, n + 1), rnd.randint(1, n)), n}))
        b = np.array(sorted({*rnd.sample(range(1, n + 1), rnd.randint(1, n)), n}))
        first, last = alignment.overlaps(a, b)
        a_spans, b_spans = list(zip([0, *a], a)), list(zip([0, *b], b))
        for i, (s, e) in enumerate(a_spans):
            hit = [j for j, (x, y) in enumerate(b_spans) if x < e and y > s]
            assert (first[i], last[i]) == (hit[0], hit[-1])
        assert [int(a[i]) for i in alignment.group_ends(first, last)] == sorted(set(a.tolist()) & set(b.tolist()))


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert packing.packed_documents(docs, BYTES).count() == 0
    assert alignment.token_alignments(docs, BYTES, PIECES).count() == 0


def test_registered_queries(spark):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert queries.op11_interval_alignment(spark, SF).columns == COLUMNS
    assert queries.op11_interval_alignment(spark, SF).count() == n
    packed = queries.op13_dominance_packing(spark, SF)
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and packed.select("doc_id").distinct().count() == n
