"""Benchmark decontamination by winnowing, with DataFrame functions only.

The word hashes of a text give rolling hashes of five words; of each six in a row, the fingerprint is the least, and
it is kept once for each place where it is chosen (the rightmost of equals). Two texts that share ten words in a row
share those six hashes, and so a fingerprint: none is lost. Documents' fingerprints are joined with the
items'; each hit is extended to the windows of ten words that chose it, and these are compared word by
word with the items' windows. Items of fewer words are one window, looked up by its own length.

The items' tables are broadcast up to BROADCAST_ROWS rows, counted first; beyond that Spark shuffles both sides.

Defined cases: null and empty texts have no words; items without an id or words are left out; items that share an id count as one; rows
that agree in doc_id and text get the same result, each its own row; extra columns are ignored. A document that has a window of
many items lists them all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import n_words, stored, text_key, word_array

WINDOW, GRAM = 10, 5
CHOICES = WINDOW - GRAM + 1
BROADCAST_ROWS = 500_000


def sized(df: DataFrame, n: int) -> DataFrame:
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def winnowed(texts: DataFrame, *keep: str) -> DataFrame:
    """keep, words, pos, fp: for each place where the choice of a window's fingerprint changes, its first window.

    The rolling hashes are an array of the document's row; the choice is made after the array is exploded, in generated
    code that is short enough to be compiled. (A plain explode would make Spark filter on the array's size at the scan, and
    build the array for that once more.)
    """
    each = texts.select(*keep, "words", F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    gram = lambda i: F.xxhash64(*[F.get("hashes", i + j) for j in range(GRAM)])
    grams = F.when(F.size("hashes") >= WINDOW, F.transform(F.sequence(F.lit(0), F.size("hashes") - GRAM), gram))
    each = each.select(*keep, "words", grams.alias("grams"))
    each = each.select(*keep, "words", "grams", F.posexplode_outer("grams").alias("pos", "g"))
    after = [F.get("grams", F.col("pos") + i) for i in range(1, CHOICES)]
    each = each.where(F.col("pos") + CHOICES <= F.size("grams"))
    each = each.select(*keep, "words", "pos", F.get("grams", F.col("pos") - 1).alias("before"), F.least("g", *after[:-1]).alias("head"), after[-1].alias("entering"))
    now, was = F.least("head", "entering"), F.least("before", "head")
    return each.where((F.col("pos") == 0) | (now != was) | (F.col("entering") == now)).select(*keep, "words", "pos", now.alias("fp"))


def item_windows(items: DataFrame) -> DataFrame:
    """(item_id, size, window): the distinct windows of each item."""
    words = items.where("item_id is not null").select(F.col("item_id").cast("string").alias("item_id"), word_array(F.col("text")).alias("words")).where("size(words) > 0")
    size = F.least(F.size("words"), F.lit(WINDOW))
    each = words.select("item_id", "words", size.alias("size"), F.explode(F.sequence(F.lit(0), F.size("words") - size)).alias("pos"))
    each = each.select("item_id", "size", F.array_join(F.slice("words", F.col("pos") + 1, F.col("size")), " ").alias("window"))
    return each.distinct()


def hits(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Places in documents where a window of items stands: doc_id, key, start, size, owners; and what owners names: owners, item_id.

    owners names the set of items that have the window: their number and two sums of hashes of their ids. A hit carries that and no list, so a phrase of
    all items is one row in the first table for each place, and one row for each item in the second.
    """
    owned = stored(item_windows(items), "item-windows")
    total = lambda salt: F.sum(F.xxhash64(F.lit(salt), "item_id").cast("decimal(20,0)")).cast("string")
    windows = owned.groupBy("size", "window").agg(F.concat_ws(" ", F.count("*").cast("string"), total(3), total(4)).alias("owners"))
    windows = stored(windows, "item-sets")
    words = items.where("item_id is not null").select(word_array(F.col("text")).alias("words"))
    prints = stored(winnowed(words).select("fp").distinct(), "item-prints")
    n_windows, n_prints = windows.count(), prints.count()
    short = sorted(r.size for r in windows.where(F.col("size") < WINDOW).select("size").distinct().collect())  # nine at most

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("key"), word_array(F.col("text")).alias("words"))
    near = winnowed(texts, "doc_id", "key").select("doc_id", "key", "pos", F.slice("words", F.col("pos") + 1, WINDOW + CHOICES - 1).alias("near"), "fp")
    near = near.join(sized(prints, n_prints), "fp", "left_semi")
    extended = near.select("doc_id", "key", "pos", "near", F.explode(F.sequence(F.lit(0), F.size("near") - WINDOW)).alias("i"))
    found = extended.select("doc_id", "key", (F.col("pos") + F.col("i")).alias("start"), F.lit(WINDOW).alias("size"), F.array_join(F.slice("near", F.col("i") + 1, WINDOW), " ").alias("window"))
    if short:
        begin = stored(windows.where(F.col("size") < WINDOW).select(F.substring_index("window", " ", 1).alias("w0")).distinct(), "item-begins")  # stored: a join with it can be split at a hot word
        each = texts.select("doc_id", "key", "words", F.posexplode_outer("words").alias("pos", "w0"))
        near = F.slice("words", F.col("pos") + 1, short[-1]).alias("near")
        if begin.count() <= BROADCAST_ROWS:
            each = each.join(F.broadcast(begin), "w0", "left_semi").select("doc_id", "key", "pos", near)
        else:  # the shuffle carries a few words for each place, not the text
            each = each.select("doc_id", "key", "pos", "w0", near).join(begin, "w0", "left_semi")
        firsts = [F.struct(F.lit(n).alias("size"), F.when(F.size("near") >= n, F.array_join(F.slice("near", 1, n), " ")).alias("window")) for n in short]
        each = each.select("doc_id", "key", F.col("pos").alias("start"), F.inline(F.array(*firsts))).where("window is not null")
        found = found.union(each.select("doc_id", "key", "start", "size", "window"))
    found = found.join(sized(windows, n_windows), ["size", "window"]).select("doc_id", "key", "start", "size", "owners").distinct()
    one = windows.groupBy("owners").agg(F.min(F.struct("size", "window")).alias("w")).select("owners", "w.size", "w.window")  # one window names the set
    return found, one.join(owned, ["size", "window"]).select("owners", "item_id")


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items and hit spans of each row of docs."""
    found, sets = hits(docs, items)
    found, sets = stored(found, "window-hits"), stored(sets, "item-owners")
    by = found.groupBy("doc_id", "key").agg(F.array_sort(F.collect_set(F.struct("start", F.expr("start + size").alias("end")))).alias("spans"))
    owned = found.select("doc_id", "key", "owners").distinct().join(sized(sets, sets.count()), "owners").groupBy(F.col("doc_id").alias("d"), F.col("key").alias("k")).agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    by = by.join(owned, (F.col("key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("d"))).drop("d", "k")
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("reach"))
    cover = F.aggregate("spans", zero, lambda a, x: F.struct((a.n + F.greatest(F.lit(0), x.end - F.greatest(x.start, a.reach))).cast("long").alias("n"), F.greatest(a.reach, x.end).alias("reach")), lambda a: a.n)
    by = by.select(F.col("doc_id").alias("d"), F.col("key").alias("k"), cover.alias("hit"), "items", "spans")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("key"), n_words(F.col("text")).alias("n_words"))
    out = rows.join(by, (F.col("key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("d")), "left")
    ids = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("hit", F.lit(0).cast("long"))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"), F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), ids.alias("items"), "spans")


def keep_clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """docs without the rows in which a window of an item stands; columns as they were."""
    names = [F.col(f"`{c}`") for c in docs.columns]
    k1, k2 = (f"__{k}_" + "_".join(sorted(docs.columns)) for k in ("doc", "key"))  # clash with no column
    bad = stored(hits(docs, items)[0].select(F.col("doc_id").alias(k1), F.col("key").alias(k2)).distinct(), "contaminated")
    rows = docs.select(*names, text_key(F.col("text")).alias("__" + k2))
    out = rows.join(sized(bad, bad.count()), (F.col("__" + k2) == F.col(k2)) & F.col("doc_id").cast("long").eqNullSafe(F.col(k1)), "left_anti")
    return out.select(*names)
