"""Operators 11 to 13 against plain restatements and the library, on small tables with odd rows."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm import brute
from tomeloom.llm import bpe, lexical, vector_codes
from tomeloom.llm.tokens import vocabulary

# --- 11


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 20), st.integers(1, 9), st.integers(1, 4), st.sampled_from([3, 40, 4096, 1 << 27]), st.randoms(use_true_random=False))
def test_bounds_lose_no_nearest_entry(k, d, bits, size, rng):
    entries = np.array([[rng.randint(-size, size) for _ in range(d)] for _ in range(k)])
    parts = np.array([[rng.randint(-size, size) for _ in range(d)] for _ in range(30)] + entries.tolist())
    which, dist = vector_codes.nearest(parts, entries, bits, block=7)
    for x, w, s in zip(parts.tolist(), which.tolist(), dist.tolist(), strict=True):
        all_ = [sum((a - b) ** 2 for a, b in zip(x, e, strict=True)) for e in entries.tolist()]
        assert (s, w) == (min(all_), all_.index(min(all_)))


def codes_of(rows, parts=8, entries=16, rounds=6):
    """rows of (id, vector, label) that can be coded, in order of id."""
    q = [[math.floor(4096 * float(np.float32(x))) for x in v] for _, v, _ in rows]
    n = len(q[0]) // parts
    cut = [[v[p * n : (p + 1) * n] for p in range(parts)] for v in q]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def near(p, x):
        all_ = [sum((a - b) ** 2 for a, b in zip(x, e, strict=True)) for e in books[p]]
        return all_.index(min(all_)), min(all_)

    for _ in range(rounds):
        for p in range(parts):
            met = {}
            for c in cut:
                met.setdefault(near(p, c[p])[0], []).append(c[p])
            books[p] = [[sum(col) // len(met[e]) for col in zip(*met[e], strict=True)] if e in met else old for e, old in enumerate(books[p])]
    found = [[near(p, c[p]) for p in range(parts)] for c in cut]
    return [("".join(f"{e:02x}" for e, _ in f), sum(s for _, s in f)) for f in found], hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


VECTORS = "vec_id long, embedding array<float>, label int, Q string, code string"


@pytest.mark.parametrize("n", [5, 60])
def test_vector_codes(spark, n):
    rng = random.Random(n)
    rows = [(i, [rng.choice([rng.uniform(-1, 1), 0.25]) for _ in range(16)], rng.choice([None, 1, 2])) for i in range(n)]
    rows.append(rows[3])  # repeats
    odd = [(900, None, 1), (901, [1.0] * 15 + [None], 1), (902, [float("nan")] * 16, 2), (903, [float("inf")] * 16, 2)]
    uncoded = [(904, [1.0] * 8, 2), (-1, [], None), (-2, [1.0] * 3, 7), (906, [3e38] * 16, 1)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows + odd + uncoded], VECTORS).repartition(3)
    coded, books = vector_codes.compress(df)
    got = vector_codes.with_label_error(coded).collect()
    want, sha = codes_of(sorted(rows, key=lambda r: (r[0], r[1])))
    assert books.sha256() == sha
    by_label = Counter()
    for (_, _, label), (_, error) in zip(sorted(rows, key=lambda r: (r[0], r[1])), want, strict=True):
        by_label[label] += error
    plain = [(r[0], *w, by_label[r[2]]) for r, w in zip(sorted(rows, key=lambda r: (r[0], r[1])), want, strict=True)]
    plain += [(i, None, None, by_label[label] if label in by_label else None) for i, _, label in uncoded]
    assert sorted(map(repr, plain)) == sorted(repr((r.vec_id, r.code, r.error, r.label_error)) for r in got)
    near = vector_codes.decode(coded, books).where("vec_id = 0").select("approx").first()[0]
    assert len(near) == 16 and all(abs(x - (e + 0.5) / 4096) < 1e-9 for x, e in zip(near, [v for p in range(8) for v in books.entries[p][int(want[0][0][2 * p : 2 * p + 2], 16)]], strict=True))


def test_vector_codes_of_nothing(spark):
    for rows in ([], [(1, None, 2, "", "")], [(1, [1.0], None, "", "")]):
        coded, books = vector_codes.compress(spark.createDataFrame(rows, VECTORS))
        assert [(r.vec_id, r.code) for r in vector_codes.with_label_error(coded).collect()] == [(1, None)] * (bool(rows) and rows[0][1] is not None)
        assert books.sha256() == hashlib.sha256(b"").hexdigest()


# --- 12


def ranked(docs, items, k):
    w = [brute.words(t) for _, t in docs]
    n_docs, n_terms = sum(bool(x) for x in w), sum(map(len, w))
    df, asked = Counter(t for x in w for t in set(x)), {}
    for i, t in items:
        asked.setdefault(i, set()).update(brute.words(t))
    out = []
    for i, terms in asked.items():
        found = []
        for (d, _), x in zip(docs, w, strict=True):
            tf, m = Counter(x), 50 + 50 * len(x) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 20 * m)) for t in terms if tf[t])
            found += [(-s, d is None, d or 0, d)] * (s > 0)
        out += [(i, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(found, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


def test_ranked_search_is_exact(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["É", "été", "X9", "日本"]
    text = lambda n: "".join(rng.choice(words[: rng.choice([3, 20, 64])]) + rng.choice([" ", ". ", "\n", "-", "\x00"]) for _ in range(n))
    docs = [(i, text(rng.choice([0, 1, 5, 40]))) for i in range(150)] + [(7, None), (None, "w1 w2 W1"), (None, "w1 w2"), (8, ""), (200, "w1 " * 30_000 + "w5")]
    docs += [(300 + i % 20, "w1 W2 w3") for i in range(40)]  # ties and repeated rows
    items = [(i, text(rng.randint(1, 12))) for i in range(9)] + [(9, "w1 w2 w3"), (9, "w4 w4"), (10, None), (11, "nowhere"), (12, ""), (None, "w5"), (-1, "w5")]
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, TERM string, df int").repartition(3)
    asked = spark.createDataFrame([(*x, 0) for x in items], "item_id long, text string, doc_id int")
    terms = lexical.item_terms(asked)
    plain = lambda rows: sorted([(r.item_id, r["rank"], r.doc_id, r.score) for r in rows.collect()], key=repr)
    for k in (3, 50):
        want = ranked(docs, items, k)
        assert plain(lexical.rank(df, asked, k)) == want
        assert plain(lexical.search(lexical.build(df, terms, shard_docs=16), terms, k)) == want
    full = lexical.build(df, shard_docs=10)  # of all terms
    assert plain(lexical.search(full, terms, 50)) == want
    assert {r.term for r in full.terms.collect()} == {t for _, x in docs for t in brute.words(x)}
    assert full.shards.where(F.size("doc_ids") > 10).count() == 0


def test_ranked_search_in_blocks_of_items(spark, monkeypatch):
    docs = [(i, f"a{i % 7} b{i % 11} c") for i in range(80)]
    items = [(i, f"a{i % 9} b{i % 5} c") for i in range(40)]
    df, asked = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 7)
    monkeypatch.setattr(lexical, "MOST_TERMS", 4)  # so the index has all terms
    assert sorted([(r.item_id, r["rank"], r.doc_id, r.score) for r in lexical.rank(df, asked, 5).collect()], key=repr) == ranked(docs, items, 5)


def test_ranked_search_of_nothing(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.withColumn("text", F.lit(None).cast("string")), items), (docs, items.withColumn("text", F.lit(" .")))):
        assert lexical.rank(d, i).count() == 0
    assert [tuple(r) for r in lexical.rank(docs, items).collect()] == [(1, 1, 1, ranked([(1, "a b")], [(1, "a")], 1)[0][3])]


def test_bounds_hold(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 300)))) for i in range(200)], "doc_id long, text string")
    index = lexical.build(df)
    for batch in index.shards.toArrow().to_batches():
        for i in range(batch.num_rows):
            shard = lexical.Shard({c: batch.column(c)[i] for c in batch.schema.names}, index.n_docs, index.n_terms)
            query = [(rng.randint(1, 9000), *span) for span in shard.span.values()]
            lower, upper = shard.bounds(query)
            score = shard.scores(query, np.ones(len(shard.m), bool))
            assert (lower <= score).all() and (score <= upper).all() and (upper - lower <= sum(w for w, _, _ in query) * lexical.STEP).all()


# --- 13


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))


PIECES = ["a", "b", "th", "E", " ", "  ", "\n", "\n\n", "\t", "'s", "'ll", "é", "日", "1", "²", "<|endoftext|>", "<|end", "՘", "\x85", "᠎", "​", "İ", "!", "...", "😀", "\x00", "\r\n", "़", "﻿", " \n", "\n ", "word", " word,", "it's "]


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.lists(st.sampled_from(PIECES), max_size=14).map("".join), st.text(max_size=30)))
def test_ids_are_the_librarys(text):
    from tokenizers import Tokenizer

    if "tok" not in globals():
        globals()["tok"] = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    enc = bpe.pairs(vocabulary("byte_bpe_50k.json"))
    ids = np.frombuffer(enc.encode(text), "<u4").tolist()
    assert ids == tok.encode(text, add_special_tokens=False).ids  # noqa: F821
    assert enc.decode(ids) == tok.decode(ids, skip_special_tokens=False) == text  # noqa: F821


def test_decoding_of_any_ids(library):
    rng, enc = random.Random(4), bpe.pairs(vocabulary("byte_bpe_50k.json"))
    for _ in range(3000):
        ids = [rng.choice([rng.randint(0, 300), rng.randint(0, 60_000)]) for _ in range(rng.randint(0, 7))]
        assert enc.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_merges_follow_rank_from_the_left():
    enc = bpe.pairs(vocabulary("byte_bpe_50k.json"))
    rng = random.Random(6)
    for _ in range(300):
        word = "".join(rng.choice("aehinrst ") for _ in range(rng.randint(1, 40)))
        symbols = [enc.symbol[b] for b in word.encode()]
        plain = list(symbols)
        while True:  # the lowest rank, the leftmost of equals, until there is none
            ranks = [(enc.ranks[a].get(b, 1 << 30), i) for i, (a, b) in enumerate(zip(plain, plain[1:], strict=False))]
            if not ranks or min(ranks)[0] == 1 << 30:
                break
            r, i = min(ranks)
            plain[i : i + 2] = [enc.made[r]]
        assert enc.merge(symbols) == plain


def test_round_trip_of_a_table(spark, library):
    path = vocabulary("byte_bpe_50k.json")
    texts = ["Hello  world\n", "", None, "x<|endoftext|>y", "same", "same", "日本" * 5000, "ab" * 60_000, "a\n\n\nb \t c " * 400]
    df = spark.createDataFrame([(i, t, "old", 1.5) for i, t in enumerate(texts)], "doc_id long, text string, ids string, Text2 double").repartition(2)
    got = {r.doc_id: r for r in bpe.digests(bpe.round_trip(df, path)).collect()}
    apart = {r.doc_id: r for r in bpe.decode(bpe.encode(df, path), path).collect()}
    plain = {r.doc_id: r.ids for r in bpe.encode(df, path, specials=False).collect()}
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert got[i].ids == apart[i].ids == ids and got[i].decoded == apart[i].decoded == (t or "") and got[i].Text2 == 1.5
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert 50256 in got[3].ids and 50256 not in plain[3]
    assert bpe.round_trip(df.limit(0), path).count() == 0
    lists = spark.createDataFrame([(1, None), (2, [87, None, 10**6]), (3, [])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.decoded for r in bpe.decode(lists, path).collect()} == {1: None, 2: "x", 3: ""}


def test_other_files_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        bpe.BytePairs(vocabulary("word_bpe_49k.json"))


def test_caches_are_bounded(monkeypatch, library):
    monkeypatch.setattr(bpe, "MOST_WORDS", 5)
    monkeypatch.setattr(bpe, "MOST_PIECES", 5)
    enc = bpe.BytePairs(vocabulary("byte_bpe_50k.json"))
    texts = [re.sub("x", " ", f"somexwords {i} here, and{i}\nthere") for i in range(40)]
    for t in texts * 2:
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids
    assert len(enc.words) <= 5 and len(enc.pieces) <= 5
