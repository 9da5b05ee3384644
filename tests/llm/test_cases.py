"""Plain restatements of features and training, bounds of samples, recall near the threshold, and odd tables for each operator."""

import hashlib
import random
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from tests.llm.test_operators import docs_of, prose
from tomeloom.llm import decontaminate, langid, license_scan, line_dedup, near_dedup, packing, simple8b, tokens, topk, toxicity, url_filter, wordvec

# --- 1


def test_top_k_of_long_vectors_and_of_ids_with_several(spark):
    rng = random.Random(1)
    rows = [(i, [float(rng.randint(-3, 3)) for _ in range(rng.choice([3, 4000]))]) for i in range(24)] + [(0, [1.0, 2.0]), (5, [9.0])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") % 6 == 0, k=7, query_block=3, cand_block=8).collect()
    want = []
    for q in (0, 6, 12, 18):
        scores = [(-(1 << 20) * int(sum(a * b for a, b in zip(v, w, strict=False))), i) for j, v in rows if j == q for i, w in rows if i != q]
        want += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:7], 1)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == want


# --- 2


def plain_subwords(text):
    low = [b if 97 <= b < 123 or b >= 128 else 32 for b in (c + 32 if 65 <= c <= 90 else c for c in text.encode())]
    s, found = [32, *low, *[32] * 5], []
    for n in (3, 4):
        for i in range(len(low) + 1):
            if all(b != 32 for b in s[i + 1 : i + n - 1]):
                h = s[i]
                for b in s[i + 1 : i + n]:
                    h = h * 0x01000193 % 2**32 ^ b
                found.append(h * 0x9E3779B1 % 2**32 >> 32 - langid.BITS)
    return Counter(found)


def as_batch(texts, **columns):
    return pa.RecordBatch.from_pydict({"text": texts, **columns})


def test_subwords_match_plain_python():
    texts = ["The cat's  tail", "", "é日本 x", "ab", None, "A-b c9d " * 30]
    data = next(langid.features([as_batch(texts, lang=["x"] * 6, luck=[0] * 6)]))
    for t, ids, ws in zip(texts, data.column("ids").to_pylist(), data.column("ws").to_pylist(), strict=True):
        want, got = plain_subwords(t or ""), dict(zip(np.frombuffer(ids, "<i4").tolist(), np.frombuffer(ws, "<f4").tolist(), strict=True))
        assert set(got) == set(want)
        assert all(abs(got[u] - c / sum(want.values())) < 1e-6 for u, c in want.items())


def test_sgd_matches_a_plain_loop():
    rng = np.random.default_rng(3)
    rows = []
    for i in range(40):
        ids = np.sort(rng.choice(50, 6, False)).astype("<i4") + (60 if i % 2 else 0)
        rows.append((("a", "b")[i % 2], ids.tobytes(), np.full(6, 1 / 6, "<f4").tobytes()))
    model = langid.train(rows, ["a", "b"], dim=3, epochs=2, seed=9)
    rng = np.random.default_rng(9)
    x = [rows[i] for i in rng.permutation(40)]
    fit = x[8:]
    emb = rng.normal(0, 0.1, (1 << langid.BITS, 3)).astype(np.float32).astype(float)
    out = rng.normal(0, 0.1, (3, 2)).astype(np.float32).astype(float)
    step = 0
    for _ in range(2):
        for i in rng.permutation(len(fit)):
            lang, ids, w = fit[i]
            ids, w = np.frombuffer(ids, "<i4").tolist(), np.frombuffer(w, "<f4").tolist()
            rate, step = 0.5 * (1 - step / (2 * len(fit))), step + 1
            hidden = [sum(a * emb[u][d] for u, a in zip(ids, w, strict=True)) for d in range(3)]
            z = [sum(hidden[d] * out[d][c] for d in range(3)) for c in range(2)]
            p = [np.exp(v) / (np.exp(z[0]) + np.exp(z[1])) for v in z]
            p["ab".index(lang)] -= 1
            back = [sum(out[d][c] * p[c] for c in range(2)) for d in range(3)]
            for d in range(3):
                for c in range(2):
                    out[d][c] -= rate * hidden[d] * p[c]
                for u, a in zip(ids, w, strict=True):
                    emb[u][d] -= rate * min(50.0, 1 / sum(v * v for v in w)) * a * back[d]
    assert np.abs(model["table"].T - emb @ out).max() < 1e-3
    assert 0 <= model["threshold"] <= 1


def test_samples_for_languages_keep_their_bounds(spark, monkeypatch):
    sent = []
    monkeypatch.setattr(langid, "train", lambda rows, langs, **_: sent.append((rows, langs)) or {})
    rows = [(1, f"word{i} text", "en") for i in range(3000)] + [(2, "the same", "fr")] * 2000 + [(i, f"mot{i}", "de") for i in range(30)] + [(9, None, "xx"), (9, "no lang", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("luck", F.lit("clash"))
    langid.fit(docs, F.lit(True), per_lang=100)
    langid.fit(docs, F.lit(True), per_lang=100, per_lang_bytes=2000, most_langs=2)
    count = Counter(r[0] for r in sent[0][0])
    assert count["en"] == 100 and count["fr"] in (0, 100) and count["de"] == 30 and sent[0][1] == ["de", "en", "fr"]
    assert sent[1][1] == ["en", "fr"] and all(sum(len(i) + len(w) for a, i, w in sent[1][0] if a == lang) <= 2000 for lang in ("en", "fr")) and sent[1][0]


def test_language_id_of_empty_tables_and_long_texts(spark):
    docs = spark.createDataFrame([(1, "the cat and the dog " * 60_000, "en"), (2, "le chat et le chien", "fr"), (3, "the dog", "en"), (4, "le chat", "fr")] * 6, "doc_id long, text string, lang string")
    model = langid.fit(docs, F.lit(True), epochs=30)
    assert {r.doc_id: r.lang_pred for r in langid.identify(docs, model).collect()} == {1: "en", 2: "fr", 3: "en", 4: "fr"}
    assert langid.identify(docs.where("false"), model).count() == 0 and langid.fit(docs.where("false"), F.lit(True))["langs"] == []


# --- 3


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_marks_after_any_letter(name):
    from tokenizers import Tokenizer

    path = tokens.vocabulary(name)
    tok, enc = Tokenizer.from_file(path), tokens.Encoder(path)
    tok.encode_special_tokens = True
    chars = [chr(c) for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) not in ("Cn", "Co")]
    apart = [c for c in chars if c.isalnum() and not unicodedata.normalize("NFC", c)[-1].isalnum()]
    assert len(apart) > 50
    texts = [f"x {c}{m} y" for c in apart for m in tokens.MARKS] + [f"a {c}. b{c}, c" for c in chars[::5]]
    assert enc.encode_all(texts) == [np.array(e.ids, "<u4").tobytes() for e in tok.encode_batch_fast(texts, add_special_tokens=False)]


def test_a_range_of_a_block_is_read_alone():
    rng = random.Random(5)
    lengths = np.array([rng.choice([0, 1, 3, 900]) for _ in range(80)])
    ids = np.array([rng.choice([0, 5, 70_000, 2**40, 2**63, 2**64 - 1]) for _ in range(int(lengths.sum()))], np.uint64)
    block, ends = simple8b.to_block(lengths, ids), np.concatenate([[0], np.cumsum(lengths)])
    assert (simple8b.from_block(block)[1] == ids).all()
    for _ in range(200):
        a, b = sorted(rng.randint(0, 80) for _ in range(2))
        n, got = simple8b.from_block(block, a, b)
        assert n.tolist() == lengths[a:b].tolist() and (got == ids[ends[a] : ends[b]]).all()
    with pytest.raises(ValueError):
        simple8b.from_block(block[:-8])
    assert [len(x) for x in simple8b.from_block(simple8b.to_block(np.zeros(0), np.zeros(0)))] == [0, 0]


def test_token_files_of_tables_with_more_columns(spark):
    df = docs_of(spark, [(2, "b"), (1, "a b")]).select("*", F.lit("x").alias("part"), F.lit("x").alias("block"), F.lit(1).alias("start"))
    got = simple8b.round_trip(df, tokens.vocabulary("word_bpe_49k.json")).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens) for r in got] == [(1, 0, 3), (2, 3, 2)]


# --- 4


def test_a_first_text_far_from_hundreds_of_near_copies(spark):
    rng = random.Random(8)
    base = [f"w{i}" for i in range(70)]
    texts = {0: "a first text that is like no other one in its bucket"}
    for i in range(1, 301):
        w = list(base)
        w[rng.randrange(70)] = f"e{i}"
        texts[i] = " ".join(w)
    member = spark.createDataFrame([(i, [7]) for i in texts], "id long, bands array<long>")
    wanted = spark.createDataFrame(list(texts.items()), "id long, text string")
    got = {r.id: r.comp for r in near_dedup.links(member, lambda ids: wanted.join(ids, "id"), 0.8, block=32).collect()}
    assert {i: got.get(i, i) for i in texts} == brute.near_classes(sorted(texts.items()))


@pytest.mark.parametrize("block_bytes", [1 << 24, 2000])
def test_texts_of_one_template_meet_by_rare_shingles(spark, monkeypatch, block_bytes):
    """A bucket of texts from one template, few of them similar; blocks of few texts, so that what is left is regrouped."""
    rng, texts, asked, rare = random.Random(9), {}, [], near_dedup.rarest
    frame = [prose(rng, 12) for _ in range(8)]
    for i in range(240):
        texts[i] = " ".join(f"{part} f{i}x{k} g{i}y{k}" for k, part in enumerate(frame))
        if i % 6 == 1:  # like the one before, but for a word
            w = texts[i - 1].split()
            w[rng.randrange(len(w))] = "edit"
            texts[i] = " ".join(w)
    texts[240], texts[241] = "la " * 300, "la " * 310
    member = spark.createDataFrame([(i, [7]) for i in texts], "id long, bands array<long>")
    wanted = spark.createDataFrame(list(texts.items()), "id long, text string")
    monkeypatch.setattr(near_dedup, "rarest", lambda *a: asked.append(1) or rare(*a))
    got = {r.id: r.comp for r in near_dedup.links(member, lambda ids: wanted.join(ids, "id"), 0.8, block=4, block_bytes=block_bytes).collect()}
    want = brute.near_classes(sorted(texts.items()))
    assert {i: got.get(i, i) for i in texts} == want and asked and 190 < len(set(want.values())) < 240


def test_a_block_gives_back_a_forest():
    rng = np.random.default_rng(4)
    for _ in range(30):
        x, y = rng.integers(0, 9, 14), rng.integers(0, 9, 11)
        near = rng.random((14, 11)) < 0.15
        found = near_dedup.forest(near, x, y)
        groups = lambda edges: {frozenset(v for v in range(9) if join(edges, u, v)) for u in range(9)}

        def join(edges, u, v):
            seen, todo = {u}, [u]
            while todo:
                at = todo.pop()
                for a, b in edges:
                    for p, q in ((a, b), (b, a)):
                        if p == at and q not in seen:
                            seen.add(q)
                            todo.append(q)
            return v in seen

        assert groups(found) == groups([(int(x[i]), int(y[j])) for i, j in zip(*np.nonzero(near), strict=True)])
        assert len(found) < len(set(x.tolist()) | set(y.tolist()))


def test_recall_close_to_the_threshold():
    rng, pairs = random.Random(6), []
    while len(pairs) < 1500:
        w = [f"w{rng.randint(0, 10**6)}" for _ in range(rng.randint(40, 160))]
        v = list(w)
        for _ in range(rng.randint(1, 3)):
            v[rng.randrange(len(v))] = f"e{rng.randint(0, 10**6)}"
        a, b = " ".join(w), " ".join(v)
        if 0.8 <= brute.weighted_jaccard(brute.shingles(a), brute.shingles(b)) <= 0.85:
            pairs.append((a, b))
    flat = [t for p in pairs for t in p]
    rows = near_dedup.to_bands([as_batch(flat, doc_id=list(range(len(flat))), h1=[0] * len(flat), h2=[0] * len(flat))])
    bands = [set(b) for part in rows for b in part.column("bands").to_pylist()]
    met = [bool(bands[i] & bands[i + 1]) for i in range(0, len(flat), 2)]
    assert np.mean(met) >= 0.99


def test_classes_of_one_passage_in_many_texts(spark):
    rng = random.Random(2)
    passage = prose(rng, 30)
    rows = [(i, f"{passage} {prose(rng, 25)}") for i in range(60)] + [(70, passage), (71, passage), (None, passage), (None, None)]
    df = docs_of(spark, rows).select("*", F.lit(1).alias("row"), F.lit(1).alias("bands"), F.lit(1).alias("id"))
    got = near_dedup.classes(df).collect()
    assert {(r.doc_id, r.class_id) for r in got} == {(i, i) for i in range(60)} | {(70, 70), (71, 70), (None, 70), (None, None)}
    assert sum(r.kept for r in got) == 62 and near_dedup.classes(docs_of(spark, [])).count() == 0


# --- 5

U64 = 2**64


def plain_mix(x):
    x ^= x >> 33
    x = x * int(wordvec.K1) % U64
    x ^= x >> 33
    x = x * int(wordvec.K2) % U64
    return x ^ x >> 33


def test_word_grams_match_plain_python():
    texts = ["you are a bad bad dog", "", "one", "one two", "a b c a b c"]
    raw = [t.encode() for t in texts]
    h, first = wordvec.words(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    data = next(toxicity.features([as_batch(texts, y=[0] * 5, luck=[0] * 5)]))
    for i in range(5):
        w = [int(x) for x in h[first[i] : first[i + 1]]]
        want = {x * int(wordvec.K1) % U64 >> 64 - toxicity.BITS for x in w}
        for gap, key in ((1, wordvec.K2), (2, wordvec.K3)):
            want |= {plain_mix((a * int(key) + b) % U64) >> 64 - toxicity.BITS for a, b in zip(w, w[gap:], strict=False)}
        assert set(np.frombuffer(data.column("ids")[i].as_py(), "<i4").tolist()) == want


def test_ftrl_matches_a_plain_loop():
    rng = np.random.default_rng(5)
    rows = [(int(i % 3 == 0), np.unique(rng.integers(0, 40, 6)).astype("<i4")) for i in range(60)]
    kept, weight, bias = toxicity.train(rows, l1=0.3, epochs=2, seed=4)
    z, n, order, alpha = Counter({"bias": 6.0}), Counter(), np.random.default_rng(4), 0.5

    def w(i):
        if i == "bias":
            return -z[i] / ((1 + n[i] ** 0.5) / alpha)
        return 0.0 if abs(z[i]) <= 0.3 else -(z[i] - np.sign(z[i]) * 0.3) / ((1 + n[i] ** 0.5) / alpha + 0.5)

    for _ in range(2):
        for k in order.permutation(len(rows)):
            y, ids = rows[k]
            ids = [*ids.tolist(), "bias"]
            old = {i: w(i) for i in ids}
            g = 1 / (1 + np.exp(-sum(old.values()))) - y
            for i in ids:
                z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha * old[i]
                n[i] += g * g
    want = {i: w(i) for i in z if i != "bias" and w(i)}
    assert abs(bias - w("bias")) < 1e-9 and set(kept.tolist()) == set(want)
    assert all(abs(want[i] - x) < 1e-5 for i, x in zip(kept.tolist(), weight.tolist(), strict=True))


def test_samples_for_toxicity_keep_their_bounds(spark, monkeypatch):
    sent = []
    monkeypatch.setattr(toxicity, "train", lambda rows, **_: sent.append(rows) or (np.zeros(0, np.int32), np.zeros(0, np.float32), 0.0))
    monkeypatch.setattr(toxicity, "threshold_shift", lambda rows, **_: 0.0)  # it trains on parts of the same rows
    docs = docs_of(spark, [(1, f"bad word{i}") for i in range(3000)] + [(i, f"fine word{i}") for i in range(2, 400)] + [(500, None), (None, "x")])
    labels = spark.createDataFrame([(i, 0, int(i < 20)) for i in range(1, 400)] + [(500, 0, 1), (None, 0, 1), (3, 0, None)], "doc_id long, quality int, toxic int")
    toxicity.fit(docs, labels, F.lit(True), sample=100)
    toxicity.fit(docs, labels, F.lit(True), sample=100, sample_bytes=600)
    toxicity.fit(docs, labels.where("false"), F.lit(True))
    assert 20 < len(sent[0]) <= 101 and sum(y for y, _ in sent[0]) <= 7
    assert 0 < sum(ids.nbytes for _, ids in sent[1]) <= 601 and sent[2] == []


def test_toxicity_of_empty_tables_and_long_texts(spark):
    docs = docs_of(spark, [(i, f"you idiot {i}") for i in range(9)] + [(i + 10, f"a fine day {i}") for i in range(9)] + [(30, "a fine day " * 100_000), (31, "idiot " * 100_000)])
    labels = spark.createDataFrame([(i, 0, int(i < 9)) for i in range(19)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels, F.lit(True), l1=0.01, epochs=40)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert got[30] < 0.3 < got[31]
    empty = docs.where("false")
    assert toxicity.score(empty, model).count() == toxicity.keep_clean(empty, model).count() == 0 and toxicity.fit(empty, labels, F.lit(True))[2] == -3.0


# --- 6


def test_urls_of_odd_tables(spark):
    many = "".join(f'<a href="http://h{i % 50}.com/{i}">' for i in range(20_000))
    rows = [(1, "http://a.net/", many), (2, "http://h3.com/x", None), (3, "http://lone.com/", "<a href=http://a.net/z>")] + [(3, "http://lone.com/", "<a href=http://a.net/z>")] * 2 + [(None, "http://h3.com/y", "")]
    got = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("trust", F.lit("clash"))).collect()
    assert sorted((str(r.page_id), r.verdict) for r in got) == [("1", "block"), ("2", "allow")] + [("3", "block")] * 3 + [("None", "allow")]
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# --- 7


def test_notices_in_long_texts_and_ties(spark):
    notice = license_scan.TEMPLATES[0][0]
    rows = [(1, ("x " * 30_000) + notice + (" y" * 30_000)), (2, f"{notice} {notice}"), (3, f"{notice} z {notice}")]
    got = {r.doc_id: r for r in license_scan.scan(docs_of(spark, rows)).collect()}
    assert all(r.labels == "apache,apache-2.0" and r.score == 1.0 for r in got.values())
    assert (got[1].first_word, got[1].n_words, got[2].n_base) == (30_003, 60_008, 2)
    assert [s["first"] for s in got[1].spans if s["label"] == "apache-2.0"] == [30_000]


# --- 8


def test_packing_tables_with_clashing_names(spark):
    df = docs_of(spark, [(1, "a b"), (2, "c")]).select("*", *[F.lit("x").alias(c) for c in ("length", "row", "piece", "grp", "ids")])
    got = packing.pack(packing.pieces(df, tokens.vocabulary("byte_bpe_50k.json"))).collect()
    assert sorted((r.doc_id, r.length, r.offset) for r in got) == [(1, 3, 0), (2, 2, 3)] and len({r.sequence_id for r in got}) == 1


# --- 9


def test_a_window_of_thousands_of_items_and_a_long_text(spark):
    rng = random.Random(3)
    common, own = prose(rng, 12), [prose(rng, 12) for _ in range(3000)]
    items = spark.createDataFrame([(i, f"{common} {t}" if i % 3 else t) for i, t in enumerate(own)], "item_id long, text string")
    rows = [(1, f"{prose(rng, 40)} before {common} after {prose(rng, 40)}"), (2, prose(rng, 60_000) + " " + own[4]), (3, prose(rng, 50)), (4, own[3])]
    got = {r.doc_id: r for r in decontaminate.decontaminate(docs_of(spark, rows), items).collect()}
    shared = sorted(str(i) for i in range(3000) if i % 3)
    assert (got[1].n_hit, got[1].n_items, got[1].items_sha256) == (12, 2000, hashlib.sha256(",".join(shared).encode()).hexdigest())
    assert (got[2].n_hit, got[2]["items"], got[3].contaminated, got[4]["items"]) == (12, ["4"], False, ["3"])


# --- 10


def test_a_document_with_thousands_of_removed_chunks(spark):
    rng = random.Random(5)
    lines = [prose(rng, 8) for _ in range(6000)]
    changed = [prose(rng, 8) if i % 50 == 25 else x for i, x in enumerate(lines)]
    df = docs_of(spark, [(1, "\n".join(lines)), (2, "\n".join(changed))])
    got = {r.doc_id: r for r in line_dedup.dedup_lines(df, stats=True).collect()}
    assert (got[1].n_removed, got[1].n_lines) == (0, 6000) and got[2].n_chunks > 1000
    gone = {r.doc_id: r for r in line_dedup.dedup_runs(df, stats=True).collect()}
    assert gone[2].text == "\n".join(x for i, x in enumerate(changed) if i % 50 == 25) and gone[1].n_removed == 0


# --- pipeline


def pipeline_tables(spark, path, rows):
    docs = docs_of(spark, rows).select("*", F.lit("x").alias("key"), F.lit("x").alias("h1"), F.lit("x").alias("score"), F.lit("x").alias("at"))
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)] if rows else [], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, "a window of ten words that no document here has at all")] if rows else [], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")


def test_pipeline_of_odd_rows(spark, tmp_path):
    rng = random.Random(4)
    long = prose(rng, 30_000)
    rows = [(1, "one row here that stands twice"), (1, "one row here that stands twice"), (2, long), (3, None), (4, ""), (None, "a row without an id is still a row"), (None, None)]
    pipeline_tables(spark, tmp_path, rows)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in got if r.piece == 0) == Counter([1, 2, 3, 4, None, None])
    assert sum(r.length for r in got if r.doc_id == 2) > 30_000


def test_pipeline_of_empty_tables(spark, tmp_path):
    pipeline_tables(spark, tmp_path, [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
