"""Links between near vectors against all pairs, and groups that later runs find again."""

import random

import numpy as np
from pyspark.sql import functions as F

from tests.test_store import many_books
from tomeloom.operators import dedup, near_vectors
from tomeloom.operators.components import components
from tomeloom.plans import queries
from tomeloom.sources.snapshots import Store

VECTORS = "vec_id long, embedding array<double>"


def near(rng, v, noise):
    return [x + rng.gauss(0, noise) for x in v]


def planted(rng, n, d=24):
    """n random vectors, some with near copies of cosines around 0.9."""
    rows = [[rng.gauss(0, 1) for _ in range(d)] for _ in range(n)]
    for _ in range(n):
        rows.append(near(rng, rng.choice(rows), rng.uniform(0.1, 0.5)))
    return [(i, v) for i, v in enumerate(rows)]


def connected(links):
    return {r.id: r.comp for r in components(links.select(F.col("vec_a").alias("a"), F.col("vec_b").alias("b")), "t").collect()}


def test_links_against_all_pairs(spark):
    df = spark.createDataFrame(planted(random.Random(3), 1200), VECTORS)
    pairs = dedup.near_dup_cosine(df, 0.9)
    exact = {(r.vec_a, r.vec_b): r.cosine for r in pairs.collect()}
    links = near_vectors.near_links(df, 0.9)
    got = {(r.vec_a, r.vec_b): r.cosine for r in links.collect()}
    assert len(exact) > 300 and set(got) <= set(exact) and all(abs(c - exact[p]) < 1e-5 for p, c in got.items())
    comp = connected(links)
    found = sum(a in comp and comp.get(a) == comp.get(b) for a, b in exact)
    assert found >= 0.95 * len(exact)
    bits, bands = near_vectors.plan(2400, 0.9, 0.98)
    assert bits == 9 and bands < 12


def test_each_vector_is_sent_to_as_many_blocks_whatever_their_number():
    sent = [-(-n // dedup.block_rows(n, 64)) for n in (10_000, 100_000, 250_000)]
    assert max(sent) <= dedup.BLOCKS and dedup.block_rows(10**7, 64) == dedup.BLOCK_ROWS and dedup.block_rows(10**7, 4096) == 512 and dedup.block_rows(0, 1) == 512


def test_spanning_links_connect_what_all_pairs_do(spark):
    rng = random.Random(6)
    base = [rng.gauss(0, 1) for _ in range(24)]
    rows = planted(rng, 300) + [(5000 + i, near(rng, base, 0.05)) for i in range(700)] + [(9000, [1.0, 2.0]), (9001, [2.0, 4.0])]
    df = spark.createDataFrame(rows, VECTORS)
    want = connected(dedup.near_dup_cosine(df, 0.8))
    for block in (None, 100):
        links = dedup.near_dup_cosine(df, 0.8, block, spanning=True)
        assert connected(links) == want and links.count() <= len(rows) * (len(rows) // (block or 512) + 2)


def test_codes_grow_no_faster_than_the_vectors():
    plans = [near_vectors.plan(n, 0.9, 0.98) for n in (20_512, 205_120, 1_000_000)]
    assert len(set(plans)) == 1 and near_vectors.plan(4_000_000, 0.9, 0.98)[0] == 14


def test_short_vectors_keep_their_bound():
    rng = np.random.default_rng(1)
    v = rng.standard_normal((50, 24))
    v /= np.sqrt((v * v).sum(1))[:, None]
    short, scale, lost = near_vectors.shortened(v)
    x = short * scale[:, None]
    assert short.dtype == np.int16 and (np.abs(v @ v.T - x @ x.T) <= lost[:, None] * (1 + lost) + lost + 1e-12).all() and lost.max() < 1e-4


def test_a_crowd_gives_few_links(spark):
    rng = random.Random(4)
    base = [rng.gauss(0, 1) for _ in range(16)]
    rows = [(i, near(rng, base, 0.02)) for i in range(1500)] + [(5000 + i, [2 * x for x in base]) for i in range(400)]  # crowded buckets, and one vector often
    df = spark.createDataFrame(rows, VECTORS)
    links = near_vectors.near_links(df, 0.9)
    comp = connected(links)
    assert len(comp) == 1900 and len(set(comp.values())) == 1
    assert links.count() < 40 * 1900  # not the 1.8 million pairs


def test_vectors_of_odd_shape(spark):
    rows = [(1, [1.0, 2.0]), (2, [2.0, 4.0]), (3, [1.0]), (4, [3.0]), (5, [1.0, None]), (6, None), (None, [1.0, 2.0]), (7, [float("nan"), 1.0]), (8, [0.0, 0.0]), (9, []), (10, [1e300, 2e300]), (1, [1.0, 2.0])]
    df = spark.createDataFrame(rows, VECTORS)
    assert sorted((r.vec_a, r.vec_b) for r in near_vectors.near_links(df).collect()) == [(1, 2), (1, 10), (3, 4)]
    assert near_vectors.near_links(df.limit(0)).count() == 0


def test_cosines_count_as_rounded(spark):
    at = lambda c: [c, (1 - c * c) ** 0.5]
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, at(0.8999997)), (3, [0.0, -5.0, 0.0]), (4, [0.0, -0.8999993, -((1 - 0.8999993**2) ** 0.5)])], VECTORS)
    for links in (dedup.near_dup_cosine(df, 0.9), near_vectors.near_links(df, 0.9)):
        assert [tuple(r) for r in links.collect()] == [(1, 2, 0.9)]


def test_texts_that_differ_have_far_vectors(spark):
    concepts = ["Erhe", "Eare", "Oued", "Erntha", "Ntndea", "Edshou", "Diech", "Onwher", ""]  # of each pair, the first 16 bytes of a hash were near
    df = spark.createDataFrame([(i, c) for i, c in enumerate([*concepts, "Oued"])], "vec_id long, c string")
    vectors = df.select("vec_id", queries.hash_vector(F.col("c")).alias("embedding"))
    assert {len(r.embedding) for r in vectors.collect()} == {64}
    assert [tuple(r) for r in near_vectors.near_links(vectors, 0.9).collect()] == [(2, 9, 1.0)]


def test_groups_are_found_again(spark, tmp_path):
    rng, path = random.Random(5), str(tmp_path / "s")
    many_books(spark, 6).save(path, buckets=4)
    store = Store(spark, path)
    ideas = sorted((r.id, r.core_idea_text) for r in store.table("key_ideas").collect())
    kinds = [[rng.gauss(0, 1) for _ in range(16)] for _ in range(3)]
    rows = [(i, near(rng, kinds[n % 3], 0.05)) for n, (i, _) in enumerate(ideas)]
    first = spark.createDataFrame(rows[:6], "id long, vector array<double>")
    got = {r.id: r.idea_group_id for r in near_vectors.save_groups(store, first).collect()}
    want = {i: min(j for m, (j, _) in enumerate(ideas[:6]) if m % 3 == n % 3) for n, (i, _) in enumerate(ideas[:6])}
    assert got == want
    version = store.snapshot().version
    assert {r.id: r.idea_group_id for r in near_vectors.save_groups(store, first).collect()} == want and store.snapshot().version == version
    rest = spark.createDataFrame([*rows[6:], (ideas[3][0], kinds[0]), (12345, kinds[1])], "id long, vector array<double>")
    near_vectors.save_groups(store, rest)
    stored = {r.id: r.idea_group_id for r in store.table("key_ideas").collect()}
    assert all(stored[i] == want[ideas[n % 3][0]] for n, (i, _) in enumerate(ideas))
    groups = {r.id: r.canonical_idea_text for r in store.table("idea_groups").collect()}
    assert groups == {g: dict(ideas)[g] for g in set(want.values())}
    assert store.lookup("idea_groups", id=ideas[0][0]).count() == 1 and store.lookup("key_ideas", idea_group_id=ideas[1][0]).count() == 6
    alone = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "id long, vector array<double>")
    nobody = store.table("idea_vectors").limit(0)
    assert {r.id: r.idea_group_id for r in near_vectors.grouped(alone, nobody).collect()} == {1: 1, 2: 2}
