"""The corpus operators against brute force, SQL, round trips and held-out accuracy, with awkward rows."""

import hashlib
import itertools
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fluvion.llm import decontamination, html_extract, language, near_dedup, pii, quality, queries, sampled_pieces, secrets, sharding, tokenfiles
from fluvion.llm.decontamination import decontaminate

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
ODD = [
    (9001, None, None, None, None), (9002, "", "aa", "s", 0), (9003, " \n\t ", None, "s", 4), (9004, "one two three", "bb", None, 13), (9004, "one two three", "bb", None, 13),
    (9005, LONG, "aa", "s", len(LONG)), (9006, "naïve Straße İstanbul é ﬁn don't <|endoftext|> x▁y 😀", "aa", "s", 50), (9007, "12345 !!! ###", "aa", "s", 13), (None, "no id here but words enough", "aa", "s", 27),
]


@pytest.fixture(scope="module")
def docs(spark):
    odd = spark.createDataFrame(ODD, SCHEMA)
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").unionByName(odd).withColumn("_words", F.lit(1)).withColumn("digest", F.lit("x")).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def collect(df, key="doc_id"):
    out = defaultdict(list)
    for r in df.collect():
        out[r[key]].append(r)
    return out


def same_multiset(df, rows):
    assert Counter(r.doc_id for r in df.select("doc_id").collect()) == Counter(i for i, _ in rows)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    bench = spark.createDataFrame([], "item_id long, text string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    for df in (
        quality.robust_quality(docs), sharding.balanced_shards(docs), tokenfiles.token_files(docs, public_tokenizers.path("word_bpe_49k.json")), near_dedup.near_duplicates(docs), language.language_ids(docs),
        decontaminate(docs, bench), html_extract.extract_pages(pages), secrets.secret_scan(docs), sampled_pieces.sample_pieces(docs, public_tokenizers.path("piece_bpe_32k.model")), pii.pii_scan(docs),
    ):
        assert df.count() == 0


def test_quality_statistics(docs, rows):
    out = quality.robust_quality(docs, min_group=30)
    same_multiset(out, rows)
    got = collect(out)
    for i, text in rows:
        w = words(text)
        lines = [x for x in (text or "").split("\n") if words(x)]
        windows = defaultdict(list)
        for k in range(len(w) - 7):
            windows[tuple(w[k : k + 8])].append(k)
        inside = {p for starts in windows.values() if len(starts) > 1 for s in starts for p in range(s, s + 8)}
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside))
        for r in got[i]:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, i
            assert r.base_failed == (len(w) < 20 or 100 * len(inside) > 30 * len(w))
            assert r.kept <= (not r.base_failed)


def test_quality_rejects_planted_outliers(spark):
    draw = random.Random(1)
    text = lambda: " ".join("".join(draw.choices("abcdefghij", k=draw.randint(3, 8))) for _ in range(120))
    rows = [(i, text(), "aa", "web") for i in range(400)] + [(1000 + i, re.sub("[aeiou]", "#", text()), "aa", "web") for i in range(30)]
    got = {r.doc_id: r.kept for r in quality.robust_quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(got[1000 + i] for i in range(30))
    assert sum(got[i] for i in range(400)) >= 395


def test_quality_judges_small_groups_by_their_own_kind(spark):
    draw = random.Random(5)
    text = lambda letters, low, high: " ".join("".join(draw.choices(letters, k=draw.randint(low, high))) for _ in range(120))
    short, long = (lambda: text("abcdefghij", 2, 5)), (lambda: text("klmnopqrst", 9, 16))
    rows = [(i, short(), "aa", "web") for i in range(120)] + [(1000 + i, long(), "bb", "web") for i in range(120)]
    # Texts of one language's kind in a group of the other, and groups too small to bear an estimate.
    rows += [(2000 + i, long(), "aa", "web") for i in range(4)] + [(3000 + i, short(), "aa", "s") for i in range(3)] + [(4000, short(), "cc", "s"), (5000, "too short", "dd", "s")]
    got = {r.doc_id: r for r in quality.robust_quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(r.distance is not None for r in got.values())
    assert not any(got[2000 + i].kept for i in range(4))
    assert all(got[3000 + i].kept for i in range(3)) and got[4000].kept and not got[5000].kept
    assert sum(got[i].kept and got[1000 + i].kept for i in range(120)) >= 115


def test_mcd_matches_all_subsets_of_small_groups(spark):
    """Against the subset of least determinant among all of its size, in groups of ten points of which two lie far off."""
    draw = np.random.default_rng(3)
    names, floors, h = ["a", "b"], [0.05, 0.05], 0.8
    groups = {}
    for g in range(12):
        points = draw.normal(0, 1, (10, 2)) @ np.array([[1.0, 0.4 * (g % 3)], [0.0, 0.7]])
        points[:2] = [[9 + g % 4, -8], [-9, 7 + g % 3]]
        groups[f"g{g}"] = points
    rows = spark.createDataFrame([(g, *map(float, x)) for g, xs in groups.items() for x in xs], "_group string, a double, b double")
    got = {r["_group"]: r for r in quality.mcd(rows, names, floors, h).collect()}
    factor = h / quality.chi2_cdf(quality.chi2_quantile(h, 2), 4)
    same = 0
    for g, xs in groups.items():
        def scatter(subset):
            x = xs[list(subset)]
            return x.mean(axis=0), factor * np.cov(x.T, bias=True) + np.diag(np.square(floors))

        best = min(itertools.combinations(range(10), 8), key=lambda s: np.linalg.det(scatter(s)[1]))
        assert set(best) == set(range(2, 10))
        centre, cov = scatter(best)
        r = got[g]
        mine = np.array([[r.a_c_0_0, r.a_c_1_0], [r.a_c_1_0, r.a_c_1_1]])
        same += bool(np.allclose([r.a_m_0, r.a_m_1], centre, atol=1e-9) and np.allclose(mine, cov, rtol=1e-2))
        far = lambda m, c: np.einsum("ij,jk,ik->i", xs - m, np.linalg.inv(c), xs - m) > quality.chi2_quantile(0.999, 2)  # noqa: B023, E731
        assert far(np.array([r.a_m_0, r.a_m_1]), mine).tolist() == far(centre, cov).tolist() == [True, True] + [False] * 8
    assert same >= 11


def test_shards_and_contamination_match_sql(spark, docs, rows):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name in ("op2_balanced_shards", "op6_decontamination"):
        got = queries.QUERIES[name](spark, SF)
        names = sorted(got.columns)
        want = con.execute(f"SELECT {', '.join(names)} FROM ({queries.ORACLES[name]})").fetchall()
        assert sorted(map(str, (tuple(r[n] for n in names) for r in got.collect()))) == sorted(map(str, want))
    out = sharding.balanced_shards(docs)
    same_multiset(out, rows)
    for mine in collect(out, "shard").values():
        assert sorted(r.slot for r in mine) == list(range(len(mine)))


def test_contamination_brute_force(spark, docs, rows):
    items = [(1, "one TWO three"), (2, " ".join(f"w{k}" for k in range(100, 130))), (3, None), (4, "..."), (None, "one two"), (5, "words enough"), (5, "words enough")]
    fold = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    got = collect(decontaminate(docs, spark.createDataFrame(items, "item_id long, text string")))
    for i, text in rows:
        w, hit, found = fold(text), set(), set()
        for item, t in items:
            v = fold(t)
            n = min(13, len(v))
            grams = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)} if v and item is not None else set()
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in grams:
                    hit |= set(range(k, k + n))
                    found.add(str(item))
        for r in got[i]:
            assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (len(w), len(hit), len(found), bool(hit) and 20 * len(hit) >= len(w)), i
            assert r.items_sha256 == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


def test_proximity_matches_brute_force(spark):
    """Against a count over every window of alignments; the rarest words altered, drift up to the slop."""
    draw = random.Random(12)
    common = [f"c{k}" for k in range(30)]
    items = [(k, " ".join([f"rare{k}", *draw.choices(common, k=12 + 9 * (k % 3))])) for k in range(6)] + [(6, "one two"), (7, " ".join(f"z{k}" for k in range(15)))]
    rows = [(k, " ".join(draw.choices(common, k=80))) for k in range(30)]
    for k, text in items[:6]:
        w = text.split()
        rows += [(100 + k, " ".join(["unseen", *w[1:]])), (200 + k, " ".join(draw.choices(common, k=9) + ["altered", *w[1:6], "x", *w[6:9], "y", "y", *w[9:]])), (300 + k, " ".join([*w[:5], *["gap"] * 5, *w[5:]]))]
    z = [f"z{k}" for k in range(15)]
    rows += [(400, " ".join(["q", *z[:7], "q", "q", "q", *z[7:]])), (401, " ".join([*z[:7], "q", "q", "q", "q", *z[7:]])), (402, " ".join([*z[:7], "q", "q", "q", "q", "q", *z[7:]])), (403, "one x two"), (404, None)]
    tables = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got, counted = collect(decontamination.proximity_matches(*tables)), collect(decontaminate(*tables))
    for i, text in rows:
        w, near = (text or "").split(), []
        for item, t in items:
            v = t.split()
            at = defaultdict(set)
            for p, word in enumerate(w):
                for q, other in enumerate(v):
                    if word == other:
                        at[p - q].add(q)
            if any(5 * len(set().union(*(at.get(low + d, set()) for d in range(5)))) >= 4 * len(v) for low in list(at)):
                near.append(str(item))
        assert [(r.n_words, r.n_near_items, r.near_items) for r in got[i]] == [(len(w), len(near), near)], i
        assert [r.n_near_items for r in counted[i]] == [len(near)], i
    assert all(str(k) in got[100 + k][0].near_items for k in range(6))
    assert got[401][0].near_items == ["7"] and got[402][0].near_items == []


def test_a_registered_query_returns_proximity_matches():
    import __spark_entry__ as entry

    assert list(entry.queries()).index("op6_decontamination") < list(entry.queries()).index("op6_proximity")


def test_token_files(spark, docs, rows):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    want = Counter()
    for i, text in rows:
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 2]
        want[i, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))] += 1
    got = tokenfiles.token_files(docs, path).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda x: -1 if x is None else x)


def test_word_encoder_on_awkward_words():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain, own = Tokenizer.from_file(path), tokenfiles.encoder(path)
    draw = random.Random(4)
    letters = "abzXYZ019'.,;:!?-_<|>éßÇŁłøİıµ€▁́​😀 \n\t 's't've"
    texts = ["".join(draw.choices(letters, k=draw.randint(0, 40))) for _ in range(3000)] + ["a<|endoftext|>b", "<|startoftext|>", "DON'T we'll I'VE"]
    for t, data in zip(texts, own.encode(texts), strict=True):
        assert list(struct.unpack(f"<{len(data) // 4}I", data)) == plain.encode(t, add_special_tokens=False).ids, repr(t)


@pytest.mark.parametrize("change", ["normalizer", "pre_tokenizer", "added"])
def test_other_tokenizers_encode_whole_texts(tmp_path, change):
    """A file that differs in one point gives that tokenizer's own ids, not those of the usual cut."""
    import json

    from tokenizers import Tokenizer

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        spec = json.load(file)
    if change == "normalizer":
        spec["normalizer"] = {"type": "NFC"}
    elif change == "pre_tokenizer":
        spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = "[\\p{L}\\p{N}]+|[^\\s\\p{L}\\p{N}]+"
    else:
        spec["added_tokens"].append({"id": 49408, "content": "harbour", "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": False})
    path = str(tmp_path / "other.json")
    with open(path, "w", encoding="utf-8") as file:
        json.dump(spec, file)
    plain, own = Tokenizer.from_file(path), tokenfiles.WordEncoder(path)
    texts = ["The harbour Of 1234 towns, don't", "", "x y"]
    assert not own.certain and tokenfiles.cut_as_assumed(public_tokenizers.path("word_bpe_49k.json"))
    assert [list(struct.unpack(f"<{len(d) // 4}I", d)) for d in own.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("n, top", [(0, 5), (1, 0), (7, 2), (70_000, 49_407), (65_536, 2**32 - 1)])
def test_bit_planes_round_trip(n, top):
    ids = np.random.default_rng(n).integers(0, top + 1, n).astype("<u4")
    payload = tokenfiles.pack(ids, block=4096)
    assert (tokenfiles.unpack(payload) == ids).all()
    if n > 9000:
        assert (tokenfiles.unpack_block(payload, 2) == ids[8192 : 8192 + 4096]).all()


def components(sets, percent=85):
    ids = sorted(sets)
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(ids, 2):
        if sets[a] and sets[b]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def test_near_duplicates_brute_force(spark, docs, rows):
    draw = random.Random(9)
    base = [f"t{k}" for k in range(60)]
    near = [(20_000 + k, " ".join(base[:k] + ["other"] + base[k + 1 :])) for k in range(0, 60, 3)] + [(20_100 + k, "Same TEXT again") for k in range(20)] + [(20_200, " ".join(draw.sample(base, 60)))]
    every = docs.select("doc_id", "text").where("doc_id is null or doc_id <> 9004").unionByName(spark.createDataFrame(near, "doc_id long, text string"))
    out = near_dedup.near_duplicates(every)
    got = collect(out)
    sets = {}
    for i, text in [(r.doc_id, r.text) for r in every.collect()]:
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    want = components({i: s for i, s in sets.items() if i is not None})
    for i, component in want.items():
        assert [(r.n_shingles, r.component_id, r.kept) for r in got[i]] == [(len(sets[i]), component, component == i)], i
    assert [(r.component_id, r.kept) for r in got[None]] == [(None, True)]


def test_bit_tables_lose_no_partner(spark):
    from fluvion.llm.bits import may_hold

    rows = spark.createDataFrame([(i % 700 if i % 9 else None, i) for i in range(2000)], "k long, v long")
    ids = spark.createDataFrame([(i,) for i in range(0, 700, 5)] + [(None,)], "k long")
    for places in (64, 1 << 24):
        got = may_hold(rows, ids, "k", places)
        assert got.columns == rows.columns
        kept = {r.v for r in got.collect()}
        assert {r.v for r in rows.join(ids, "k", "left_semi").collect()} <= kept
        assert places == 64 or len(kept) == rows.join(ids, "k", "left_semi").count()


def test_superminhash_estimates_similarity():
    draw = np.random.default_rng(2)
    common, left, right = (draw.integers(0, 2**63, n).astype(np.uint64) for n in (800, 100, 100))
    a, b = np.unique(np.concatenate([common, left])), np.unique(np.concatenate([common, right]))
    sign = near_dedup.superminhash([a, b, a], 400)
    assert (sign[0] == sign[2]).all()
    assert abs((sign[0] == sign[1]).mean() - 0.8) < 0.07


def test_language_held_out_accuracy(spark, docs, rows):
    out = language.language_ids(docs)
    same_multiset(out, rows)
    truth = {r.doc_id: r.lang for r in docs.where("lang is not null and doc_id < 9000").collect()}
    got = collect(out)
    held = [(truth[i], r.lang_pred) for i, rs in got.items() for r in rs if r.held_out and i in truth and r.lang_pred != "und"]
    assert sum(a == b for a, b in held) >= 0.95 * len(held) > 20
    for i, text in rows:
        for r in got[i]:
            assert r.held_out == (i is not None and zlib.crc32(str(i).encode()) % 3 == 1)
            assert (r.lang_pred == "und") == (not any(c.isalpha() for c in text or ""))
            assert 0 <= r.score <= 1


def test_language_filter_by_brute_force(spark):
    """The filter against sets of trigrams: none is missed, false ones are as rare as corrected for, and counts are those of the table."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("text is not null and lang is not null")
    model = language.fit_languages(docs)
    trigrams = lambda t: [x for x in (f"{a if a.isalpha() else ' '}{b}{c if c.isalpha() else ' '}" for a, b, c in zip("\0" + t.lower(), t.lower(), t.lower()[1:] + "\0")) if x[1].isalpha()]
    counts = defaultdict(Counter)
    learned = docs.where(~language.held_out(F.col("doc_id"))).collect()
    for r in learned:
        counts[r.lang].update(trigrams(r.text))
    known = {k: {g for g, n in c.items() if n >= language.MIN_SHARE * sum(c.values())} for k, c in counts.items()}
    assert model.languages == sorted(known)
    texts = [r.text for r in docs.collect()][:150]
    shares, _ = model.shares(texts)
    for t, row in zip(texts, shares, strict=True):
        grams = trigrams(t)
        for k, lang in enumerate(model.languages):
            true = sum(g in known[lang] for g in grams) / max(1, len(grams))
            found = row[k] * (1 - model.false_rate[k]) + model.false_rate[k] if row[k] > 0 else 0
            # No trigram is missed; false ones are few.
            assert found >= true - model.false_rate[k] - 1e-9 and abs(row[k] - true) < 0.05 + 3 / max(1, len(grams)) ** 0.5 * model.false_rate[k] ** 0.5
    assert (model.false_rate < 0.05).all()


def test_pipeline_on_odd_and_empty_tables(spark, docs):
    """Every stage takes nulls, empty and long texts, repeated rows and extra columns, and an empty table."""
    for table in (docs, docs.limit(0)):
        left = table
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, left, SF)
            assert out.columns == docs.columns, name
            assert out.exceptAll(left.select(*docs.columns)).where("text not like '%[SECRET]%'").isEmpty() or name == "secret_scan"
            left = out.cache()
        last = corpus_pipeline.STAGES[-1][1](spark, left, SF)
        assert last.count() == left.count()
    ids = [r.doc_id for r in left.collect()]
    assert ids == []


def test_sampled_pieces(docs, rows):
    out = sampled_pieces.sample_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"), with_ids=True)
    same_multiset(out, rows)
    for i, rs in collect(out).items():
        for r in rs:
            assert r.round_trip or i == 9006
            assert len({tuple(x) for x in r.ids}) == len(r.ids) == r.n_samples
            assert all(0 <= p <= 1 for p in r.inclusion)
            assert [zlib.crc32(struct.pack(f"<{len(x)}I", *x)) for x in r.ids] == r.ids_crc32
        assert all(r.ids == rs[0].ids for r in rs)


def test_registered_pieces_hold_their_ids(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(5)
    for out in (queries.op9_gumbel_pieces(spark, SF).limit(5), dict(corpus_pipeline.STAGES)["sentencepiece"](spark, docs, SF)):
        for r in out.collect():
            assert [zlib.crc32(struct.pack(f"<{len(x)}I", *x)) for x in r.ids] == r.ids_crc32 and [len(x) for x in r.ids] == r.n_tokens


def listed_segmentations(model, text):
    """Every way to spell a text by pieces, with its probability, listed by brute force from the vocabulary."""
    text = "▁" + text.replace(" ", "▁")
    ids = {model.id_to_piece(i): i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))}
    weight = {p: 1 / (2 + max(0.0, -model.get_score(i))) for p, i in ids.items()}

    def ways(at):
        if at == len(text):
            yield (), 1.0
        for end in range(at + 1, min(len(text), at + 16) + 1):
            if (piece := text[at:end]) in ids:
                for rest, w in ways(end):
                    yield (ids[piece], *rest), w * weight[piece] / sum(weight.values())

    found = list(ways(0))
    total = sum(w for _, w in found)
    return {s: w / total for s, w in found}


@pytest.mark.parametrize("text", ["abc", "at 1, so"])
def test_sampling_without_replacement_follows_the_listed_lattice(text):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    listed = listed_segmentations(sentencepiece.SentencePieceProcessor(model_file=path), text)
    n = 6000
    seeds = np.random.default_rng(8).integers(0, 2**63, n).astype(np.uint64)
    pairs, held, weighted = Counter(), Counter(), Counter()
    for found in sampled_pieces.Sampler(path).sample([text] * n, seeds, 2):
        (a, log_a, in_a), (b, log_b, in_b) = ((tuple(ids.tolist()), logp, inclusion) for ids, logp, inclusion in found)
        assert abs(np.exp(log_a) - listed[a]) < 1e-8 and abs(np.exp(log_b) - listed[b]) < 1e-8
        pairs[a, b] += 1
        held.update((a, b))
        # The inverse of the inclusion chance makes sums over samples unbiased.
        weighted[a] += listed[a] / in_a
        weighted[b] += listed[b] / in_b
    near = lambda got, p: abs(got / n - p) < 5 * np.sqrt(p * (1 - p) / n) + 1e-3
    for a, p in listed.items():
        for b, q in listed.items():
            if a != b:
                assert near(pairs[a, b], p * q / (1 - p))
    assert abs(sum(weighted.values()) / n - 1) < 0.05
    top = max(listed, key=listed.get)
    assert near(held[top], listed[top] + sum(p * listed[top] / (1 - p) for s, p in listed.items() if s != top))


def test_samples_do_not_depend_on_the_batch_and_long_units_have_their_own_draws():
    own = sampled_pieces.Sampler(public_tokenizers.path("piece_bpe_32k.model"))
    texts = ["one two three", "", "x" * 9000 + " " + "x" * 9000, "naïve Straße 12.5", "the"]
    seeds = np.arange(5, dtype=np.uint64)
    whole = own.sample(texts, seeds, 3)
    for i, t in enumerate(texts):
        alone = own.sample([t], seeds[i : i + 1], 3)[0]
        assert [(x[0].tolist(), x[1], x[2]) for x in alone] == [(x[0].tolist(), x[1], x[2]) for x in whole[i]]
    ids = whole[2][0][0].tolist()
    middle = next(j for j in range(len(ids)) if sum(len(own.pieces.bytes[x]) for x in ids[:j]) > 9000)
    assert ids[:500] != ids[middle : middle + 500]


def test_pipeline(spark):
    """Each stage's decisions take effect on what the one before kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    spoken = stages["language_id"](spark, docs, SF).cache()
    single = stages["near_dedup"](spark, spoken, SF).cache()
    clean = stages["decontamination"](spark, single, SF).cache()
    assert spoken.columns == single.columns == clean.columns == docs.columns
    fold = lambda t: words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    sets = {}
    for r in spoken.collect():
        w = fold(r.text)
        sets[r.doc_id] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    assert {r.doc_id for r in single.collect()} == {i for i, c in components(sets).items() if i == c}
    dirty = {r.doc_id for r in decontaminate(single, spark.read.parquet(f"{SF}/benchmark.parquet")).where("contaminated").collect()}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in single.collect()} - dirty
    safe = stages["secret_scan"](spark, clean, SF).cache()
    assert safe.columns == docs.columns and not any(secrets.base_spans(r.text or "") for r in safe.collect())
    last = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in last.collect()} == {r.doc_id for r in clean.collect()}
