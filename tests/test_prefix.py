"""Running values in blocks against plain loops, and a book that holds most of all pages."""

import random

from pyspark.sql import functions as F

from tests.test_store import many_books
from tomeloom.functions import prefix
from tomeloom.operators import pages as P


def test_running_values_match_loops(spark):
    rng, rows = random.Random(1), []
    for g in (1, 2, None):
        for o in sorted(rng.sample(range(-40, 200), 60)) + ([None] if g == 2 else []):
            rows.append((g, o, rng.choice([None, *range(-5, 6)])))
    df = spark.createDataFrame(rows, "g long, o int, v int").repartition(5)
    kinds = {"s": ("sum_before", F.col("v")), "m": ("max_before", F.col("v")), "f": ("min_after", F.col("v")), "n": ("next", F.col("v")), "x": ("max_before", F.struct("v", "o"))}
    for block in (0, 1, 7, 64, 4096):
        got = {(r.g, r.o): r for r in prefix.running(df, ["g"], "o", kinds, block or 1, small=block == 0).collect()}
        assert len(got) == len(rows)
        for g in (1, 2, None):
            mine = sorted([r for r in rows if r[0] == g], key=lambda r: (r[1] is not None, r[1] or 0))
            for i, (_, o, _) in enumerate(mine):
                before, after, r = [x[2] for x in mine[:i] if x[2] is not None], [x[2] for x in mine[i + 1 :] if x[2] is not None], got[g, o]
                assert (r.s, r.m, r.f, r.n) == (sum(before), max(before, default=None), min(after, default=None), mine[i + 1][2] if i + 1 < len(mine) else None)


def test_both_plans_give_the_same_book(spark, monkeypatch):
    made = lambda: {n: sorted(map(repr, rows.drop("created_at", "last_attempt_at", "completed_at", "updated_at").collect())) for n, rows in many_books(spark, 3).tables().items()}
    small = made()
    monkeypatch.setattr(prefix, "SMALL", 0)
    monkeypatch.setattr(prefix, "BLOCK", 2)
    assert made() == small


def test_one_book_of_many_pages_is_spread(spark, monkeypatch):
    n = 60_000
    monkeypatch.setattr(prefix, "SMALL", 1000)
    big = spark.range(n).select(F.lit(1).cast("long").alias("book_id"), F.col("id").cast("int").alias("page_num"), F.concat(F.lit("page "), F.col("id").cast("string"), F.when(F.col("id") % 7 == 0, "-").otherwise("")).alias("text"))
    some = spark.range(50).select((F.col("id") + 2).alias("book_id"), F.lit(0).alias("page_num"), F.lit("x").alias("text"))
    df = big.union(some)
    for made in (P.page_positions(df), P.normalized_pages(df)):
        placed = made.withColumn("task", F.spark_partition_id()).where("book_id = 1")
        sizes = [r["count"] for r in placed.groupBy("task").count().collect()]
        assert len(sizes) > 2 and max(sizes) < n / 2
        last = made.where(f"book_id = 1 and page_num = {n - 1}").first()
        text = [f"page {i}" + ("-" if i % 7 == 0 else "") for i in range(n)]
        raw = made.columns[-1] == "text"
        assert last.end_char == (sum(len(t) + 1 for t in text) if raw else sum(len(t.removesuffix("-") if i + 1 < n else t) for i, t in enumerate(text)) + 2 * (n - 1))
