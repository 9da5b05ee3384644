"""MinHash near-duplicates with DartMinHash signatures.

A document is the weighted set of its five-word shingles (weight: how often it has them). Over each element
stands a weight axis that is cut into regions [2^v - 1, 2^(v+1) - 1) and a rank axis. Hashed darts fall on a
region as a Poisson process along the rank; a dart hits if its weight lies below the element's. Each dart
belongs to one of BANDS * ROWS coordinates, and the hit of least rank in a coordinate is its value, so two
documents agree in a coordinate with the probability of their weighted Jaccard similarity. Only about
k ln k + 2k darts of a document are looked at: those below a rank that falls with its total weight; where a
coordinate stays empty, that rank is doubled.

Bands of ROWS coordinates are joined. A bucket never emits all pairs: each member is compared with the bucket's
first text, links are verified exactly (weighted Jaccard >= threshold) and merged to components. In large buckets that
still hold several, the members outside the largest component are compared with the first of them, some rounds long; texts of
buckets that are still large (made from one template, say) are regrouped by their rarest shingles, of which similar texts must share one; what
is left then is compared with the members of all other components, as blocks of texts by matrix products, and only a
spanning forest of the links leaves a block. So every pair of a bucket is either verified or inside one
component, and no link between different texts is lost to that. Components are merged by contraction: a later
round sees components, not texts.
With 24 bands of 5, two texts of similarity 0.8 share no bucket with a probability of 7e-5, less when nearer.

Defined cases: copies are collapsed before (two 64-bit hashes of the text); texts of 1 to 4 words have one
shingle, of all their words; texts without a word are linked with exact copies only; a null text is a class
of its own, and a null doc_id stays null and sorts last; the class id is the smallest doc_id of the class; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship
from .common import batches, stored
from .components import components
from .wordvec import K1, K2, K3, mix, shingles, words

BANDS, ROWS = 24, 5


def unit(h: np.ndarray) -> np.ndarray:
    """Uniform in (0, 1)."""
    return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54


def darts(elem: np.ndarray, weight: np.ndarray, text: np.ndarray, most: np.ndarray):
    """(id, rank, text) of all darts that hit an element and whose rank is at most most[text]."""
    found, some, v = [], np.arange(len(elem)), 0
    while len(some):
        width = float(1 << v)
        live, s, rank = some, mix(elem[some] + np.array([v + 1], np.uint64) * K2), np.zeros(len(some))
        while len(live):
            s = mix(s + K3)
            rank = rank - np.log(unit(s)) / width
            ok = rank <= most[text[live]]
            live, s, rank = live[ok], s[ok], rank[ok]
            hit = width - 1 + width * unit(mix(s ^ K1)) < weight[live]
            found.append((s[hit], rank[hit], text[live[hit]]))
        v += 1
        some = some[weight[some] > (1 << v) - 1]
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.uint64), np.zeros(0), np.zeros(0, int))


def signatures(elem: np.ndarray, weight: np.ndarray, text: np.ndarray, n: int, k: int) -> np.ndarray:
    """n x k coordinates (0 rows for texts without elements)."""
    sig, total = np.zeros((n, k), np.uint64), np.bincount(text, weight, n)
    todo, t = total > 0, k * (np.log(k) + 2)
    while todo.any():
        most = np.where(todo, t / np.maximum(total, 1e-300), -1.0)
        mine = todo[text]
        ident, rank, where = darts(elem[mine], weight[mine], text[mine], most)
        cell = where * k + (mix(ident ^ K2) % np.uint64(k)).astype(np.int64)
        order = np.argsort(-rank)
        sig.reshape(-1)[cell[order]] = ident[order]  # the last one written, of least rank, stays
        todo &= (sig == 0).any(1)
        t *= 2
    return sig


def weighted(data, ends, n=5):
    """Distinct shingles of each text, their counts and their texts."""
    sh, text = shingles(*words(data, ends), n)
    order = np.lexsort((sh, text))
    sh, text = sh[order], text[order]
    new = np.ones(len(sh), bool)
    new[1:] = (sh[1:] != sh[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return sh[at], np.diff(np.append(at, len(sh))).astype(np.float64), text[at]


def to_bands(rows):
    import pyarrow as pa

    for part, data, ends in batches(rows):
        elem, weight, text = weighted(data, ends)
        n = len(ends) - 1
        sig = signatures(elem, weight, text, n, BANDS * ROWS).reshape(n, BANDS, ROWS)
        band = np.tile(np.arange(1, BANDS + 1).astype(np.uint64) * K3, (n, 1))
        for i in range(ROWS):
            band = mix(band * K1 + sig[:, :, i])
        some = np.zeros(n, bool)
        some[text] = True
        keys = [b if s else None for b, s in zip(band.astype(np.int64), some, strict=True)]
        yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", "h1", "h2")), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "h1", "h2", "bands"])


def similarity(rows):
    """(a, b, sim) of pairs of texts."""
    import pyarrow as pa

    for batch in rows:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            n, sides = part.num_rows, []
            for c in ("text_a", "text_b"):
                one = pa.RecordBatch.from_arrays([part.column(c), pa.array(np.arange(n))], ["text", "i"])
                for piece, data, ends in batches([one]):
                    sh, text = shingles(*words(data, ends))
                    sides.append((mix(sh ^ mix((text + piece.column("i")[0].as_py() + 1).astype(np.uint64))), text + piece.column("i")[0].as_py(), c == "text_b"))
            key, pair, side = (np.concatenate([np.broadcast_to(s[i], len(s[0])) for s in sides]) for i in range(3))
            _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
            x = np.bincount(inverse, ~side, len(first))
            y = np.bincount(inverse, side, len(first))
            owner = pair[first]
            both, all_ = np.bincount(owner, np.minimum(x, y), n), np.bincount(owner, np.maximum(x, y), n)
            yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(both / np.maximum(all_, 1))], ["a", "b", "sim"])


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(97), "text").alias("h2"))


def verified(pairs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(a, b, sim) of pairs of text ids. Skewed joins: a bucket's first text may stand in many pairs."""
    one = pairs.join(wanted.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    two = one.join(wanted.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    return stored(two.select("a", "b", "text_a", "text_b").mapInArrow(similarity, "a long, b long, sim double"), "dart-pairs")


def elements(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles of texts as (hash of shingle and occurrence, text), sorted by hash, and each text's number: sets, whose Jaccard is the weighted one of shingles."""
    raw = [t.encode() for t in texts]
    sh, count, text = weighted(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    count = count.astype(np.int64)
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    key, text = mix(np.repeat(sh, count) + nth.astype(np.uint64) * K3), np.repeat(text, count)
    order = np.argsort(key, kind="stable")
    return key[order], text[order], np.bincount(text, minlength=len(texts))


def shared(x, y) -> np.ndarray:
    """Sizes of the intersections of all texts of x with all of y, by matrix products over slices of their common vocabulary."""
    (kx, tx, nx), (ky, ty, ny) = x, y
    vocab = np.intersect1d(kx, ky)
    out = np.zeros((len(nx), len(ny)), np.float32)
    for at in range(0, len(vocab), 4096):
        part = vocab[at : at + 4096]
        a, b = np.zeros((len(nx), len(part)), np.float32), np.zeros((len(ny), len(part)), np.float32)
        for m, k, t in ((a, kx, tx), (b, ky, ty)):
            i, j = np.searchsorted(k, part[0]), np.searchsorted(k, part[-1], "right")
            col = np.searchsorted(part, k[i:j])
            ok = part[np.minimum(col, len(part) - 1)] == k[i:j]
            m[t[i:j][ok], col[ok]] = 1
        out += a @ b.T
    return out


def forest(near: np.ndarray, x: np.ndarray, y: np.ndarray) -> list[tuple[int, int]]:
    """Edges that join the labels x of rows and y of columns as the cells of near do: fewer than there are labels."""
    labels, at = np.unique(np.concatenate([x, y]), return_inverse=True)
    rows, cols = at[: len(x)], at[len(x) :]
    i, j = np.nonzero(near)
    a, b = np.divmod(np.unique(rows[i] * len(labels) + cols[j]), len(labels))
    root, out = list(range(len(labels))), []

    def find(u):
        while root[u] != u:
            root[u] = u = root[root[u]]
        return u

    for u, v in zip(a.tolist(), b.tolist(), strict=True):
        r, t = find(u), find(v)
        if r != t:
            root[max(r, t)] = min(r, t)
            out.append((int(labels[u]), int(labels[v])))
    return out


def crossed(asks: pd.DataFrame, members: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """(a, b): a spanning forest over components, of links between asked texts and members of other components in the first bucket that both are in."""
    none = pd.DataFrame({"a": [], "b": []}, dtype="int64")
    if asks.empty or members.empty:
        return none
    open_ = asks["comp"].to_numpy()[:, None] != members["comp"].to_numpy()
    x, y = np.stack(asks["bands"]), np.stack(members["bands"])
    for i in range(int(np.argmax(x[0] == asks["bucket"].iloc[0])) if x.size else 0):
        open_ &= x[:, i][:, None] != y[:, i]
    rows, cols = np.flatnonzero(open_.any(1)), np.flatnonzero(open_.any(0))
    if not len(rows):
        return none
    one, two = elements(asks["text"].iloc[rows].tolist()), elements(members["text"].iloc[cols].tolist())
    both = shared(one, two)
    near = (both >= threshold * (one[2][:, None] + two[2] - both) - 1e-6) & open_[np.ix_(rows, cols)]
    return pd.DataFrame(forest(near, asks["comp"].to_numpy()[rows], members["comp"].to_numpy()[cols]), columns=["a", "b"], dtype="int64")


def merged(comp: DataFrame, pairs: DataFrame) -> DataFrame:
    """comp (id, comp) after components have been joined by pairs (a, b) of them, or of ids that have none yet."""
    up = components(pairs).withColumnsRenamed({"id": "old", "comp": "new"})
    moved = comp.join(up, comp["comp"] == F.col("old"), "left").select("id", F.coalesce("new", "comp").alias("comp"))
    fresh = up.join(comp, F.col("old") == comp["id"], "left_anti").select(F.col("old").alias("id"), F.col("new").alias("comp"))
    return stored(moved.union(fresh), "dart-components", comp.count() + up.count())


def mixed_buckets(crowded: DataFrame, comp: DataFrame) -> DataFrame:
    """bucket, id, comp, big, n, m: members of buckets that hold several components; big: the largest; m: how many of the n members it lacks. The first texts are left out: all have met them."""
    rows = crowded.count()
    seen = stored(crowded.where("id <> hub").select("bucket", "id").join(comp, "id", "left").select("bucket", "id", F.coalesce("comp", "id").alias("comp")), "dart-seen", rows)
    each = seen.groupBy("bucket", "comp").agg(F.count("*").alias("c"))
    groups = each.groupBy("bucket").agg(F.sum("c").alias("n"), F.max("c").alias("most"), F.count("*").alias("k"), F.max_by("comp", F.struct("c", "comp")).alias("big")).where("k > 1")
    groups = stored(groups.select("bucket", "big", "n", (F.col("n") - F.col("most")).alias("m")), "dart-groups", rows // 2)
    return stored(seen.join(groups, "bucket"), "dart-mixed", rows)


def costly(left: DataFrame, block: int) -> bool:
    """Would comparing what is left of the buckets in blocks cost more than some blocks for each text?"""
    each = left.groupBy("bucket").agg(F.max(F.col("n") * F.col("m")).alias("c"), F.max("m").alias("m"))
    cost = each.agg(F.sum("c").alias("c"), F.sum("m").alias("m")).first()
    return bool(cost.c) and cost.c > 4 * block * cost.m


def rarest(texts: DataFrame, threshold: float) -> DataFrame:
    """(bucket, id, hub): each text's rarest elements, as many as two texts of that similarity can't both lack: of n elements, n - ceil(threshold * n) + 1.

    An element is a shingle with its occurrence, so weighted Jaccard is that of sets. In one order of all elements by the number of
    texts (id, text) that have them, two texts with a similarity of at least the threshold share one of these. hub is -1, no text.
    """

    def sets(rows):
        import pyarrow as pa

        for part, data, ends in batches(rows):
            sh, count, text = weighted(data, ends)
            count = count.astype(np.int64)
            nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            key, text = mix(np.repeat(sh, count) + nth.astype(np.uint64) * K3).astype(np.int64), np.repeat(text, count)
            size = np.bincount(text, minlength=len(ends) - 1)[text]
            ids = part.column("id").to_numpy()[text]
            for i in range(0, len(key), 65536):
                yield pa.RecordBatch.from_arrays([pa.array(c[i : i + 65536]) for c in (ids, size, key)], ["id", "n", "bucket"])

    each = stored(texts.select("id", "text").mapInArrow(sets, "id long, n long, bucket long"), "dart-elements")
    often = stored(each.groupBy("bucket").agg(F.count("*").alias("often")).where("often > 1"), "dart-often")  # stored: the join below can be split at a frequent element
    order = Window.partitionBy("id").orderBy(F.coalesce("often", F.lit(1)), "bucket")
    first = each.join(often, "bucket", "left").withColumn("place", F.row_number().over(order)).where("often > 1").where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1)
    return stored(first.select("bucket", "id", F.lit(-1).cast("long").alias("hub")), "dart-rarest")


def links(banded: DataFrame, wanted_of, threshold: float, block: int = 256, rounds: int = 4, block_bytes: int = 1 << 24) -> DataFrame:
    """(id, comp): components under verified links among texts (id, bands) that share a bucket, a value in bands.

    wanted_of gives (id, text) for a table of ids. First each member is compared with its bucket's first text. As long as buckets
    hold several components and comparing the rest in blocks would cost more than it has texts (at most `rounds` times), the members
    outside the largest component are compared with the first of them. Where blocks would still cost that much, texts that are left meet by their rarest
    elements instead, which loses no pair either: texts made from one template share most shingles, but hardly the rare ones. Those then left meet all members of
    other components, in units of at most about block x block texts, and block_bytes of them on a side, that give back a spanning forest of their links alone.
    """
    most = BANDS * banded.count()
    member = banded.select("id", F.explode("bands").alias("bucket"))
    # aggregates are stored before they are joined back: a join right above one can't be split where a key is skewed
    hubs = stored(member.groupBy("bucket").agg(F.min("id").alias("hub"), F.count("*").alias("n")).where("n > 1").select("bucket", "hub"), "dart-hubs", most // 2)
    crowded = stored(member.join(hubs, "bucket"), "dart-crowded", most)
    wanted = stored(wanted_of(crowded.select("id").distinct()), "dart-wanted")
    tried = verified(crowded.where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct(), wanted)
    comp = components(tried.where(F.col("sim") >= threshold).select("a", "b"))
    left = mixed_buckets(crowded, comp)
    while rounds and costly(left, block):
        rest = left.where("comp <> big")
        firsts = stored(rest.groupBy("bucket").agg(F.min(F.struct("id", "comp")).alias("hub")), "dart-hubs", left.count())
        asked = rest.join(firsts, "bucket").where("comp <> hub.comp").select(F.col("hub.id").alias("a"), F.col("id").alias("b"), F.col("hub.comp").alias("comp_a"), F.col("comp").alias("comp_b")).distinct()
        asked = stored(asked, "dart-asked", left.count())
        near = verified(asked.select("a", "b"), wanted).where(F.col("sim") >= threshold)
        comp = merged(comp, asked.join(near, ["a", "b"]).select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b")))
        left, rounds = mixed_buckets(crowded, comp), rounds - 1
    if costly(left, block):
        left = mixed_buckets(rarest(wanted.join(left.select("id").distinct(), "id", "left_semi"), threshold), comp)
        banded = banded.select("id", F.array().cast("array<bigint>").alias("bands"))
    if left.isEmpty():
        return comp
    full = left.join(wanted, "id").join(banded, "id")
    size, small = F.octet_length("text"), F.col("comp") != F.col("big")
    units = lambda count, size: F.greatest(F.lit(1), F.ceil(count / block), F.ceil(size / block_bytes)).cast("int")
    parts = full.groupBy("bucket").agg(units(F.count("*"), F.sum(size)).alias("ns"), units(F.count_if(small), F.sum(F.when(small, size))).alias("ms"))
    full = full.join(stored(parts, "dart-units", left.count() // 2), "bucket")
    mine = lambda c, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    own = lambda: [F.col(c).alias(c) for c in ("bucket", "id", "comp", "bands", "text")]  # noqa: E731  new columns for each side
    asks = full.where("comp <> big").select(*own(), mine("ms", 1).alias("p"), every("ns").alias("q"))
    others = full.select(*own(), mine("ns", 2).alias("q"), every("ms").alias("p"))
    met = asks.groupBy("bucket", "p", "q").cogroup(others.groupBy("bucket", "p", "q")).applyInPandas(lambda x, y: crossed(x, y, threshold), "a long, b long")
    found = stored(met, "dart-crossed")
    return comp if found.isEmpty() else merged(comp, found)


def classes(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """doc_id, h1, h2, class_id, class_size, kept: one row for each row of docs; kept in one row of each class."""
    ship(docs.sparkSession)
    rows = keyed(docs)
    marks = stored(rows.where("text is not null").mapInArrow(to_bands, "doc_id long, h1 long, h2 long, bands array<long>").withColumn("row", F.monotonically_increasing_id()), "dart-signatures")
    at = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("row").alias("row"))
    texts = stored(marks.groupBy("h1", "h2").agg(F.min(at).alias("at"), F.count("*").alias("n"), F.first("bands").alias("bands")).withColumn("id", F.col("at.row")), "dart-texts")
    dk = F.coalesce("doc_id", F.lit(-1)).alias("dk")

    def wanted(ids: DataFrame) -> DataFrame:
        keys = texts.join(ids, "id").select("id", "h1", "h2", F.coalesce("at.doc_id", F.lit(-1)).alias("dk"))
        found = rows.where("text is not null").select(dk, "h1", "h2", "text").join(keys, ["dk", "h1", "h2"])
        return found.groupBy("dk", "h1", "h2", "id").agg(F.first("text").alias("text")).select("id", "text")

    comp = links(texts.where("bands is not null").select("id", "bands"), wanted, threshold)
    linked = stored(texts.select("h1", "h2", "at", "n", "id").join(comp, "id").drop("id"), "dart-linked", comp.count())
    each = stored(linked.groupBy("comp").agg(F.min("at").alias("best"), F.sum("n").alias("class_size")), "dart-classes", comp.count())
    best = linked.join(each, "comp").select("h1", "h2", "best", "class_size")
    alone = texts.select("h1", "h2", F.col("at").alias("own"), "n").join(best, ["h1", "h2"], "left")
    info = alone.select("h1", "h2", F.coalesce("best", "own").alias("best"), F.coalesce("class_size", "n").alias("class_size"))
    info = stored(info, "dart-info", texts.count())  # stored: the join below can be split where a text has very many copies
    found = marks.select("doc_id", "h1", "h2", "row").join(info, ["h1", "h2"])
    found = found.select("doc_id", "h1", "h2", F.col("best.doc_id").alias("class_id"), "class_size", (F.col("row") == F.col("best.row")).alias("kept"))
    alone = rows.where("text is null").select("doc_id", "h1", "h2", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("kept"))
    return found.union(alone)


def keep_one(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """docs with one row of each class, the one of smallest doc_id; rows without a text stay. Columns as they were."""
    names = [F.col(f"`{c}`") for c in docs.columns]
    k1, k2, k3 = (f"__{k}_" + "_".join(sorted(docs.columns)) for k in ("dk", "h1", "h2"))  # clash with no column
    kept = stored(classes(docs, threshold).where("kept").select(F.coalesce("doc_id", F.lit(-1)).alias(k1), F.col("h1").alias(k2), F.col("h2").alias(k3)), "dart-kept")
    rows = docs.where("text is not null").select(*names, F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias(k1), F.xxhash64("text").alias(k2), F.xxhash64(F.lit(97), "text").alias(k3))
    one = rows.join(kept, [k1, k2, k3], "left_semi")
    if not rows.groupBy(k1, k2, k3).count().where("count > 1").isEmpty():  # rows that repeat in both doc_id and text
        one = one.dropDuplicates([k1, k2, k3])
    return one.select(*names).union(docs.where("text is null").select(*names))
