"""The ten operators against brute force, exact round trips and held-out accuracy, on small tables with odd rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm import brute
from tomeloom.llm import decontaminate, langid, license_scan, line_dedup, near_dedup, packing, simple8b, tokens, topk, toxicity, url_filter, wordvec
from tomeloom.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows):
    """rows: (doc_id, text)."""
    return spark.createDataFrame([(d, t, "en", "s", None if t is None else len(t)) for d, t in rows], DOCS)


def prose(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "of", "the", "and", "rho", "été", "x9"]) + str(rng.randint(0, 40)) for _ in range(n))


# --- words and hashes


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aB9é. \n日", max_size=40), min_size=1, max_size=6))
def test_words_and_shingles_match_plain_python(texts):
    raw = [t.encode() for t in texts]
    data, ends = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    h, first = wordvec.words(data, ends)
    names = {}
    for i, t in enumerate(texts):
        mine = brute.words(t)
        assert first[i + 1] - first[i] == len(mine)
        for w, x in zip(mine, h[first[i] : first[i + 1]].tolist(), strict=True):
            assert names.setdefault(w, x) == x
    assert len(set(names.values())) == len(names)
    sh, where = wordvec.shingles(h, first)
    seen = {}
    for i, t in enumerate(texts):
        plain = brute.shingles(t)
        assert sum(plain.values()) == (where == i).sum()
        for s in plain:
            seen.setdefault(s, set())
        assert len(set(sh[where == i].tolist())) == len(plain)


# --- 1


def test_top_k_is_exact_with_ties_and_odd_vectors(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 1.0]) for _ in range(4)]) for i in range(60)] + [(60, None), (61, [1.0, None]), (62, [float("nan")]), (63, [float("inf"), 0.0]), (None, [1.0]), (64, []), (65, [1.0])]
    rows += [rows[3], rows[20]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))
    got = topk.top_k(df, F.col("id") % 20 == 0, k=5, query_block=2, cand_block=16).collect()
    good = {i: [int(np.floor(1024 * x)) for x in v] for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for q in sorted(i for i in good if i % 20 == 0):
        best = sorted((-sum(a * b for a, b in zip(good[q], v, strict=False)), i) for i, v in good.items() if i != q)[:5]
        want += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    assert sorted(map(tuple, got)) == want


def test_top_k_of_an_empty_table(spark):
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("id") % 2 == 0).count() == 0


# --- 2


def test_language_id_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    model = langid.fit(docs, part != 1)
    got = langid.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(part == 1).toPandas()
    assert (got.lang_pred == got.lang).mean() > 0.95
    assert got.score.between(0, 1).all() and got.accepted.mean() > 0.8


def test_language_id_of_odd_rows(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr"), (3, None, "fr"), (4, "", None), (5, "123 !?", "en"), (6, "the the", None), (6, "the the", None), (None, "le", "fr")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit(1))
    got = langid.identify(docs, langid.fit(docs, F.lit(True), epochs=30)).collect()
    assert len(got) == 24
    for r in got:
        assert r.lang_pred == ("und" if r.doc_id in (3, 4, 5) else r.lang_pred) and r.lang_pred in ("und", "en", "fr")
        if r.doc_id in (3, 4, 5):
            assert (r.score, r.accepted) == (0.0, False)
    assert {r.lang_pred for r in got if r.doc_id == 1} == {"en"}
    none = langid.identify(docs, langid.fit(docs, F.lit(False)))
    assert {r.lang_pred for r in none.collect()} == {"und"}


# --- 3


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 70_000), st.integers(0, 2**64 - 1)), max_size=400))
def test_simple8b_round_trip(values):
    v = np.array(values, np.uint64)
    coded, offsets = simple8b.pack(v)
    assert (simple8b.unpack(coded) == v).all()
    for i, n in enumerate(offsets.tolist()):  # a reader may start at a noted word unless it is the second of an escape
        at = i * simple8b.SKIP
        if at == 0 or coded[at - 1] >> np.uint64(60) != 0:
            assert (simple8b.unpack(coded[at:]) == v[n:]).all()


def test_simple8b_is_tight_and_checks_blocks():
    coded, _ = simple8b.pack(np.ones(600, np.uint64))
    assert len(coded) == 10
    with pytest.raises(ValueError):
        simple8b.from_block(b"\0" * 64)


def test_token_files_read_back_what_the_library_gives(spark):
    from tokenizers import Tokenizer

    path = tokens.vocabulary("word_bpe_49k.json")
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.randint(0, 80))) for i in range(40, 0, -1)] + [(7, "again"), (7, "again"), (None, "no id"), (50, None), (51, "a  b\t\n c\n\n\nİ"), (52, "x" * 30_000), (-3, "")]
    got = sorted(simple8b.round_trip(docs_of(spark, rows), path).collect(), key=lambda r: r.start)
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    assert len(got) == len(rows)
    assert [r.doc_id for r in got] == sorted([d for d, _ in rows], key=lambda d: (d is not None, d or 0))
    want = sorted((d is not None, d or 0, np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()) for d, t in rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, bytes(r.ids)) for r in got) == want
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids) // 4
        at += r.n_tokens
    assert simple8b.round_trip(docs_of(spark, []), path).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_the_encoder_equals_the_library(name):
    from tokenizers import Tokenizer

    path, rng = tokens.vocabulary(name), random.Random(8)
    parts = ["a", "B", "th", " ", "\n", ",", ".", "'", "'s", "-", "é", "1", "23", "\t", "€", "!?", "日本", "\u0301", "İ", "ß", "  ", "<|endoftext|>", "Σ", "(", "\n\n", "…", "²", "\x1c"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    want = [np.array(e.ids, "<u4").tobytes() for e in tok.encode_batch(texts, add_special_tokens=False)]
    enc = tokens.Encoder(path)
    assert enc.encode_all(texts) == want
    assert enc.encode_all(texts) == want  # from the caches


# --- 4


def near_rows(seed=0):
    rng = random.Random(seed)
    rows = []
    for _ in range(14):
        base = prose(rng, rng.randint(20, 90)).split()
        for _ in range(rng.randint(1, 7)):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = "edit" + str(rng.randint(0, 9))
            rows.append((len(rows) * 3, " ".join(w)))
    rows += [(900, None), (901, None), (902, ""), (903, ""), (904, "!!"), (905, "one two"), (906, "One, two!"), (907, "one two three"), (908, rows[0][1]), (909, "la " * 3000), (910, "la " * 3100)]
    return rows


def test_near_duplicates_match_brute_force(spark):
    rows = near_rows()
    got = near_dedup.classes(docs_of(spark, rows)).collect()
    assert {r.doc_id: r.class_id for r in got} == brute.near_classes(rows)
    assert sum(r.kept for r in got) == len({r.class_id for r in got})
    sizes = {}
    for r in got:
        sizes[r.class_id] = sizes.get(r.class_id, 0) + 1
    assert all(r.class_size == sizes[r.class_id] for r in got)


def test_links_reach_every_pair_of_a_bucket(spark):
    """A bucket of chains whose hub is far from most: nothing may be lost, with few members asked at once."""
    texts = {}
    for c in range(3):
        w = [f"c{c}w{i}" for i in range(60)]
        for step in range(12):
            texts[c * 100 + step] = " ".join([f"c{c}n{i}" for i in range(step * 2)] + w[step * 2 :])
    texts[5000] = "alone in this bucket of texts here"
    member = spark.createDataFrame([(i, [i + 1000, 7]) for i in texts], "id long, bands array<long>")
    wanted = spark.createDataFrame(list(texts.items()), "id long, text string")
    comp = near_dedup.links(member, lambda ids: wanted.join(ids, "id"), 0.8, block=5)
    want = brute.near_classes(sorted(texts.items()))
    got = {r.id: r.comp for r in comp.collect()}
    assert {i: got.get(i, i) for i in texts} == want and len(set(want.values())) == 4


def test_dart_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(2)
    elem = rng.integers(0, 2**63, 300).astype(np.uint64)
    a, b = rng.uniform(0, 5, 300), rng.uniform(0, 5, 300)
    w = np.concatenate([a, b])
    sig = near_dedup.signatures(np.concatenate([elem, elem]), w, np.repeat([0, 1], 300), 2, 4000)
    assert (sig != 0).all()
    assert abs((sig[0] == sig[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.04


def test_keep_one_keeps_columns_and_one_row_of_each_class(spark):
    rows = near_rows(3) + [(5, "same row here twice"), (5, "same row here twice")]
    df = docs_of(spark, rows).withColumn("h1", F.lit("clash"))
    got = near_dedup.keep_one(df)
    assert got.columns == df.columns
    ids = [r.doc_id for r in got.collect()]
    classes = brute.near_classes([r for i, r in enumerate(rows) if r not in rows[:i]])
    assert sorted(ids) == sorted(set(classes.values()))
    assert near_dedup.keep_one(docs_of(spark, [])).count() == 0


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(110)] + [(i, i + 1) for i in range(200, 260)]
    rows = [(d, str(d)) for d in range(300)]
    parent = {d: d for d, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    got = {r.id: r.comp for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got.get(d, d) == find(d) for d in parent)


# --- 5


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    model = toxicity.fit(docs, labels, part != 2)
    assert len(model[0]) < 20_000
    got = toxicity.score(docs, model).join(labels, "doc_id").where(part == 2).toPandas()
    pos, neg = got[got.toxic == 1].score, got[got.toxic == 0].score
    assert (pos >= 0.3).mean() > 0.5 and (neg >= 0.3).mean() < 0.05


def test_toxicity_of_odd_rows(spark):
    rows = [(i, "you idiot " + w) for i, w in enumerate("abcdefgh")] + [(i + 10, "a fine day " + w) for i, w in enumerate("abcdefgh")] + [(30, None), (31, ""), (32, "!?"), (33, "idiot"), (33, "idiot"), (None, "fine day")]
    labels = spark.createDataFrame([(i, 0, 1) for i in range(8)] + [(i + 10, 1, 0) for i in range(8)] + [(10, 1, None), (0, 0, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")
    df = docs_of(spark, rows).withColumn("y", F.lit("clash"))
    model = toxicity.fit(df, labels, F.lit(True), l1=0.01, epochs=40)
    got = toxicity.score(df, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add(r.score)
    assert len(by[33]) == 1 and by[30] == by[31] == by[32]
    assert min(by[33]) > max(by[None])
    kept = toxicity.keep_clean(df, model, 0.5)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} >= {10, 11} and 1 not in {r.doc_id for r in kept.collect()}
    empty = toxicity.fit(df, labels.where("false"), F.lit(True))
    assert all(r.score < 0.3 for r in toxicity.score(df, empty).collect())


# --- 6


def test_urls_rules_and_propagation(spark):
    far = '<a href="http://bad.com/x">x</a><a href="//bad.com/y">'
    rows = [
        (1, "http://WWW.Example.NET/en/a?x", ""), (2, "http://example.net/fr/", None), (3, "https://a.org/fr/1#t", '<a href="http://friend.com/">'), (4, "https://friend.com/p", ""),
        (5, "http://bad.com/q", '<a href="http://friend.com/x">'), (6, None, ""), (7, "no scheme", ""), (8, "http://q.example.com/de/1", ""), (9, "http://linker.com/", far),
        (10, "x://h.net", ""), (11, "http://far.away/", ""), (12, "http://notexample.com/de/", ""), (13, "a://b://c.net/", ""), (13, "a://b://c.net/", ""), (14, "http://evil.net/", '<a href="https://bad.com">'),
        (15, "http://bad.com/z", '<a href="http://evil.net/">'),
    ]
    got = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(0))).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    assert [(by[i].host, by[i].path, by[i].rule, by[i].verdict) for i in (1, 2, 3, 6, 7, 8, 10, 12)] == [
        ("www.example.net", "/en/a", "example.net/en/", "allow"), ("example.net", "/fr/", "net/", "block"), ("a.org", "/fr/1", "org/fr/", "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("q.example.com", "/de/1", "example.com/de/", "block"), ("h.net", "", None, "allow"), ("notexample.com", "/de/", None, "allow"),
    ]
    assert (by[13].host, by[13].path) == ("b:", "//c.net/")
    assert (by[5].verdict, by[9].verdict, by[4].verdict, by[11].verdict) == ("block", "block", "allow", "allow")


def test_propagation_matches_power_iteration(spark):
    rng = random.Random(6)
    edges = sorted({(rng.randint(0, 9), rng.randint(0, 9)) for _ in range(30)})
    edges = [(f"h{a}", f"h{b}", rng.randint(1, 3)) for a, b in edges if a != b]
    seeds = [("h0", 1.0, 0.0), ("h1", 0.0, 0.5)]
    got = url_filter.propagate(spark.createDataFrame(edges, "src string, dst string, n long"), spark.createDataFrame(seeds, "host string, trust double, distrust double"), rounds=9)
    names = [f"h{i}" for i in range(10)]
    for kind, col in (("trust", 1), ("distrust", 2)):
        out = {}
        for a, b, n in edges:
            a, b = (a, b) if kind == "trust" else (b, a)
            out.setdefault(a, []).append((b, n))
        base = {s[0]: s[col] * 0.15 for s in seeds}
        rank = dict(base)
        for _ in range(9):
            new = dict(base)
            for a, r in rank.items():
                for b, n in out.get(a, []):
                    new[b] = new.get(b, 0) + 0.85 * r * n / sum(x for _, x in out[a])
            rank = new
        have = {r.host: r[kind] for r in got.collect()}
        assert all(abs(have.get(h, 0) - rank.get(h, 0)) < 1e-8 for h in names)


# --- 7


def test_license_scan(spark):
    texts = {
        1: "Released under the MIT License. And MIT\n--license again; mit licensed", 2: "nothing here", 3: None, 4: "", 5: "GNU General Public License gnu general public", 6: "Licensed under CC BY-NC 4.0.",
        7: "x " * 40 + "redistribution and use in source and also binary forms with or without modification are permitted provided that the following conditions are met", 8: "apache license " * 500,
        9: "redistribution and use in source", 10: "ccby cc bys",
    }
    rows = list(texts.items()) + [(1, texts[1]), (None, "cc by")]
    got = license_scan.scan(docs_of(spark, rows).withColumn("label", F.lit(1))).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for d, t in texts.items():
        w = brute.words(t)
        places = [i for p, _ in license_scan.PHRASES for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        assert (by[d].n_words, by[d].n_base, by[d].first_word, by[d].last_word) == (len(w), len(places), min(places, default=None), max(places, default=None))
    assert (by[1].base_labels, by[1].labels, by[1].score) == ("mit", "mit", 1.0)
    assert (by[6].base_labels, by[6].labels) == ("cc-by", "cc-by,cc-by-nc-4.0")
    assert (by[7].base_labels, by[7].labels) == ("", "bsd") and by[7].score == 1.0 and by[7].spans[0]["first"] == 40
    assert (by[5].labels, by[8].n_base, by[None].labels) == ("gpl", 500, "cc-by")
    assert by[2].labels == by[9].labels == by[10].labels == "" and 0 < by[9].score < 0.75
    assert license_scan.scan(docs_of(spark, [])).count() == 0


def test_license_scan_of_null_ids(spark):
    text = "Released under the MIT License. Licensed under CC BY-NC 4.0."
    got = license_scan.scan(docs_of(spark, [(None, text), (1, text), (None, "all rights reserved")])).collect()
    found = sorted((str(r.doc_id), r.n_base, r.base_labels, r.labels) for r in got)
    assert found == [("1", 2, "cc-by,mit", "cc-by,cc-by-nc-4.0,mit"), ("None", 0, "", "all-rights-reserved"), ("None", 2, "cc-by,mit", "cc-by,cc-by-nc-4.0,mit")]


# --- 8


def test_packing_pieces_and_sequences(spark):
    from tokenizers import Tokenizer

    path = tokens.vocabulary("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    rng = random.Random(9)
    rows = [(i, prose(rng, rng.randint(0, 400))) for i in range(120)] + [(200, None), (201, ""), (202, "word " * 5000), (203, "a"), (203, "a"), (None, "b")]
    got = packing.pack(packing.pieces(docs_of(spark, rows), path), group=32).toPandas()
    have = {}
    for r in got.sort_values("piece").itertuples():
        have.setdefault(None if r.doc_id != r.doc_id else int(r.doc_id), []).append(r)
    for d, t in rows:
        want = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
        if d == 203:
            assert len(have[d]) == 2 and {bytes(r.ids) for r in have[d]} == {want}
            continue
        assert b"".join(bytes(r.ids) for r in have[d]) == want
        at = 0
        for k, r in enumerate(have[d]):
            assert (r.piece, r.start, r.length) == (k, at, len(r.ids) // 4) and (k == 0 or r.length == 1024)
            at += r.length
    for _, s in got.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert (s.offset.to_numpy() == np.cumsum([0, *s.length])[:-1]).all() and s.length.sum() <= 1024
    assert got.sequence_id.nunique() <= 1.06 * -(-got.length.sum() // 1024) + 4
    assert packing.pack(packing.pieces(docs_of(spark, []), path)).count() == 0


def test_sum_of_squares_takes_the_least_sum():
    rng = random.Random(3)
    lengths = [rng.randint(1, 20) for _ in range(300)]
    seq, offset = packing.sum_of_squares(np.array(lengths), 20)
    gaps, total = {}, lambda g: sum(x * x for x in np.bincount([v for v in g.values() if v], minlength=21))
    for s, where, at in zip(lengths, seq.tolist(), offset.tolist(), strict=True):
        choices = [total(gaps | {k: v - s}) for k, v in gaps.items() if v >= s] or [total(gaps | {-1: 20 - s})]
        assert at == 20 - gaps.get(where, 20)
        gaps[where] = gaps.get(where, 20) - s
        assert gaps[where] >= 0 and total(gaps) == min(choices)


# --- 9


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_ROWS, 0])
def test_decontamination_matches_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", limit)
    rng = random.Random(11)
    items = [(i, prose(rng, rng.choice([3, 9, 10, 11, 25, 40]))) for i in range(14)] + [(20, None), (21, ""), (22, "la " * 30), (3, prose(rng, 12)), (None, prose(rng, 20)), (23, "Un deux; trois")]
    rows = []
    for i in range(60):
        w = prose(rng, rng.randint(0, 50)).split()
        src = brute.words(rng.choice(items)[1])
        if src and i % 2:
            a = rng.randrange(len(src))
            w[len(w) // 2 : len(w) // 2] = src[a : a + rng.randint(5, 30)]
        rows.append((i, " ".join(w)))
    rows += [(70, None), (71, ""), (72, "la " * 200), (73, "un deux trois"), (73, "un deux trois"), (74, "UN. DEUX, TROIS un deux trois"), (None, "x un deux trois y")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("pos", F.lit(1))
    df = docs_of(spark, rows).withColumn("size", F.lit(1))
    got = decontaminate.decontaminate(df, bench).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    n = 0
    for d, t in rows:
        hit, found = brute.contaminated(t, items)
        r = by[d]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (len(brute.words(t)), len(hit), len(found), bool(hit)), (d, t)
        assert r.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()
        n += bool(hit)
    assert 4 < n < len(rows)
    clean = decontaminate.keep_clean(df, bench)
    assert clean.columns == df.columns and sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(d) for d, t in rows if not brute.contaminated(t, items)[0])
    assert decontaminate.decontaminate(docs_of(spark, []), bench).count() == 0
    assert not any(r.contaminated for r in decontaminate.decontaminate(df, bench.where("false")).collect())


# --- 10


def plain_chunks(text):
    lines = text.split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
    out, at = [], 0
    for i in range(len(lines)):
        if i == len(lines) - 1 or (i and (h[i - 1] * 31 + h[i]) % line_dedup.PRIME % line_dedup.CUT == 0):
            out.append(lines[at : i + 1])
            at = i + 1
    return out


def test_line_dedup_matches_brute_force(spark):
    rng = random.Random(12)
    shared = ["\n".join(prose(rng, 9) for _ in range(8)) for _ in range(4)]
    rows = [(i, "\n".join([prose(rng, 5) for _ in range(rng.randint(0, 6))] + [rng.choice(shared)] + [prose(rng, 5) for _ in range(rng.randint(0, 4))])) for i in range(30)]
    rows += [(40, None), (41, ""), (42, "\n\n\n"), (43, rows[0][1]), (44, rows[0][1] + "\n" + rows[0][1]), (45, "é" * 5000)]
    df = docs_of(spark, rows).withColumn("first", F.lit("clash"))
    got = line_dedup.dedup_lines(df, stats=True)
    assert got.columns == [*df.columns, "n_lines", "n_removed", "n_chunks"]
    seen, want = set(), {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        if t is None:
            want[d] = None
            continue
        left = []
        for c in plain_chunks(t):
            x = "\n".join(c)
            if len(c) < 2 or len(x) < line_dedup.MIN_CHARS or x not in seen:
                left.append(x)
            if len(c) > 1:
                seen.add(x)
        want[d] = "\n".join(left)
    rows_got = got.collect()
    assert {r.doc_id: r.text for r in rows_got} == want
    assert sum(r.n_removed for r in rows_got) > 50
    assert line_dedup.dedup_lines(docs_of(spark, [])).count() == 0
    twice = [(1, shared[0]), (1, shared[0]), (None, shared[0]), (2, shared[0] + "\nend")]
    out = sorted((str(r.doc_id), r.text) for r in line_dedup.dedup_lines(docs_of(spark, twice)).collect())
    assert out[0] == out[1] == ("1", shared[0]) and len(out[2][1]) < len(shared[0]) and len(out[3][1]) < len(shared[0])


def plain_runs(rows):
    """Lines to remove of each document, by comparing all pairs of places."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    lines = [t.split("\n") for _, t in order]
    places, out = {}, {}
    for d, x in enumerate(lines):
        for i, line in enumerate(x):
            places.setdefault(line, []).append((d, i))
    for d, x in enumerate(lines):
        gone = set()
        for i in range(len(x)):
            for e, j in places[x[i]]:
                if (e, j) >= (d, i):
                    break
                n, most = 0, i - j if e == d else len(x)
                while n < most and i + n < len(x) and j + n < len(lines[e]) and x[i + n] == lines[e][j + n]:
                    n += 1
                run = "\n".join(x[i : i + n])
                if n > 1 and len(run) >= 40 or len(x[i].split()) > 50:
                    gone |= set(range(i, i + (n if n > 1 and len(run) >= 40 else 1)))
        out[order[d][0]] = gone if len(x) > 1 else set()
    return out


def test_line_runs_match_brute_force(spark):
    rng = random.Random(31)
    passages = ["\n".join(prose(rng, 60 // k if k > 1 else 60) for _ in range(k)) for k in range(1, 7)]
    around = lambda p: "\n".join([prose(rng, 6) for _ in range(rng.randint(1, 4))] + [p] + [prose(rng, 6) for _ in range(rng.randint(1, 4))])
    rows = [(i, around(passages[i % 6])) for i in range(48)]
    short = ["a", "b b", "", "c c c", "a line of thirty characters ab"]
    rows += [(100 + i, "\n".join(rng.choice(short) for _ in range(rng.randint(1, 30)))) for i in range(40)]
    rows += [(200, ""), (201, "\n\n\n"), (202, rows[5][1]), (203, rows[7][1] + "\n" + rows[7][1]), (204, passages[0]), (205, "\n" * 90), (None, rows[9][1]), (206, "\n".join(["the same line of some length again"] * 7))]
    want = plain_runs(rows)
    got = {r.doc_id: r for r in line_dedup.dedup_runs(docs_of(spark, rows + [(300, None)]), stats=True).collect()}
    for d, t in rows:
        x = t.split("\n")
        assert (got[d].text, got[d].n_lines, got[d].n_removed) == ("\n".join(y for i, y in enumerate(x) if i not in want[d]), len(x), len(want[d])), d
    assert all(len(want[i]) == i % 6 + 1 and passages[i % 6] not in got[i].text for i in range(6, 48))
    assert got[300].text is None and got[300].n_lines == 0
    assert want[202] == set(range(len(rows[5][1].split("\n")))) and got[202].text == got[None].text == "" and got[204].text == passages[0]
    assert line_dedup.dedup_runs(docs_of(spark, [])).count() == 0


def test_crc_is_unsigned(spark):
    row = spark.range(1).select(F.crc32(F.lit("a").cast("binary")).alias("c")).first()
    assert row.c == zlib.crc32(b"a")
