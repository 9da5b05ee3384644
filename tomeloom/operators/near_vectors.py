"""Near vectors by an index of signed projections, and groups of ideas that later runs find again.

Vectors meet in buckets: each band of random projections gives a code of signs, and a vector is put into the bucket of its code and into those with one of its least certain
signs turned. How long codes are follows the number of vectors, so buckets stay small; how many bands there are follows from the recall that is asked for at the threshold. Vectors of
a bucket are compared exactly, crowded buckets in pairs of blocks. Links are exact, and span what they find: two vectors that a bucket shows to be near are linked by a chain of
links, not always by one of their own, so a crowd of near vectors gives about as many links as it has members for each bucket.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship, stored
from ..sources.snapshots import Conflict, Store, bucket_column
from .components import components
from .dedup import ROUNDING

BUCKET, WIDE_BUCKET, WIDE_BITS, BLOCK = 8, 256, 12, 2048
PROBES = 4


def plan(n: int, threshold: float, recall: float) -> tuple[int, int]:
    """Bits of a code and bands, for n vectors: a pair at the threshold shares a bucket with a chance of at least recall."""
    few, many = (math.ceil(math.log2(max(n, 2) / b)) for b in (BUCKET, WIDE_BUCKET))
    bits = max(6, min(few, max(WIDE_BITS, min(40, many))))  # longer codes need more bands: from 32,768 to a million vectors buckets grow instead, so that each vector is sent as often
    same = 1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi
    # all signs agree, or one differs that is among the probes of either; nearly always one of the least certain
    hit = same**bits + 0.8 * bits * same ** (bits - 1) * (1 - same)
    return bits, max(2, math.ceil(math.log(1 - recall) / math.log(1 - min(hit, 0.999))))


def distinct_vectors(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, v) of different vectors by their least id, and (a, b) links of the ids that share a vector. Vectors are scaled to length 1.

    Null ids and vectors, zero vectors and those with null, NaN or infinite components take no part.
    """
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    v = vectors.where("vec_id is not null and embedding is not null").select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("v")).where(F.forall("v", fine))
    top = F.array_max(F.transform("v", F.abs))
    v = v.withColumn("top", top).where("top > 0").select("id", F.transform("v", lambda x: x / F.col("top")).alias("v"))  # squares of huge components stay finite
    size = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    v = stored(v.withColumn("size", size).select("id", F.transform("v", lambda x: x / F.col("size")).alias("v")).withColumn("h", F.xxhash64("v")), "vectors")
    first = stored(v.groupBy("h", "v").agg(F.min("id").alias("a")), "first-vectors")
    same = v.join(first, ["h", "v"]).where("id > a").select("a", F.col("id").alias("b")).distinct()
    return first.select(F.col("a").alias("id"), "v"), same


def shortened(v):
    """A matrix of rows as 16-bit integers, the scale of each row, and the length of what that leaves out."""
    import numpy as np

    scale = np.maximum(np.abs(v).max(1), 1e-300) / 32767
    short = np.rint(v / scale[:, None]).astype(np.int16)
    return short, scale, np.sqrt(((v - short * scale[:, None]) ** 2).sum(1))


def near_links(vectors: DataFrame, threshold: float = 0.9, recall: float = 0.98, seed: int = 7) -> DataFrame:
    """vec_a, vec_b, cosine: links between vectors (vec_id, embedding) of cosine threshold or more, vec_a < vec_b, which connect near vectors.

    What travels to the buckets is each vector in 16-bit integers, with a bound on what that changes: pairs that may be near by these bounds are links that are then
    checked with the vectors themselves. Equal vectors are linked with the one of least id. Vectors of different length are no pair. near_dup_cosine() gives all pairs, exactly, at a
    cost that grows with the square.
    """
    ship(vectors.sparkSession)
    first, same = distinct_vectors(vectors)
    bits, bands = plan(first.count(), threshold, recall)

    def codes(with_vector):
        def run(rows):
            import numpy as np
            import pyarrow as pa

            from tomeloom.operators.near_vectors import shortened

            planes: dict[int, np.ndarray] = {}
            for batch in rows:
                ids, lists = batch.column("id").to_numpy(), batch.column("v")
                sizes = np.diff(lists.offsets.to_numpy())
                flat, at = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(sizes)])
                for d in np.unique(sizes).tolist():
                    which = np.flatnonzero(sizes == d)
                    if d not in planes:
                        planes[d] = np.random.default_rng([seed, d]).standard_normal((d, bands * bits))
                    for lo in range(0, len(which), 1024):
                        mine = which[lo : lo + 1024]
                        v = flat[at[mine][:, None] + np.arange(d)]
                        x = (v @ planes[d]).reshape(len(mine), bands, bits)
                        power = 1 << np.arange(bits, dtype=np.int64)
                        own = ((x > 0) * power).sum(2)
                        weak = np.argsort(np.abs(x), axis=2, kind="stable")[:, :, : min(PROBES, bits)]
                        all_ = np.concatenate([own[:, :, None], own[:, :, None] ^ power[weak]], axis=2)
                        m = all_.shape[2]
                        copies = bands * m
                        columns = {
                            "band": pa.array(np.tile(np.repeat(np.arange(bands, dtype=np.int32), m), len(mine))), "code": pa.array(all_.reshape(-1)), "d": pa.array(np.full(len(mine) * copies, d, np.int32)),
                            "id": pa.array(np.repeat(ids[mine], copies)), "own": pa.array(np.tile(np.arange(m) == 0, len(mine) * bands)),
                        }
                        if with_vector:
                            short, scale, lost = shortened(v)
                            body = pa.array([r.tobytes() for r in short], pa.binary()).take(pa.array(np.repeat(np.arange(len(mine)), copies)))
                            columns |= {"v": body, "scale": pa.array(np.repeat(scale, copies)), "lost": pa.array(np.repeat(lost, copies))}
                        yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

        kind = "band int, code long, d int, id long, own boolean" + (", v binary, scale double, lost double" if with_vector else "")
        return first.mapInArrow(run, kind)

    key = ["band", "code", "d"]
    crowded = stored(codes(False).groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > BLOCK), "crowded-buckets")
    put = codes(True).join(crowded, key, "left").withColumn("blocks", F.coalesce(F.ceil(F.col("n") / BLOCK).cast("int"), F.lit(1)))
    met = put.withColumn("block", F.pmod(F.xxhash64("id", "band"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.withColumns({"p": F.least("block", "other"), "q": F.greatest("block", "other")}).withColumns({"is_p": F.col("block") == F.col("p"), "is_q": F.col("block") == F.col("q")})
    met = met.select(F.xxhash64(*key, "p", "q").alias("meeting"), *key, "p", "q", "id", "own", "is_p", "is_q", "v", "scale", "lost")

    def compare(batches):
        import numpy as np
        import pyarrow as pa

        from tomeloom.operators.dedup import forest

        def meetings():
            now, held = None, []
            for batch in batches:
                k = np.stack([batch.column(c).to_numpy() for c in ("meeting", "band", "code", "d", "p", "q")], axis=1)
                cuts = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1).tolist(), len(k)]
                for i, j in zip(cuts[:-1], cuts[1:]):
                    if i == j:
                        continue
                    if held and not (k[i] == now).all():
                        yield held, int(now[3])
                        held = []
                    now = k[i]
                    held.append(batch.slice(i, j - i))
            if held:
                yield held, int(now[3])

        def column(held, name):
            return np.concatenate([b.column(name).to_numpy(zero_copy_only=False) for b in held])

        found = []
        for held, d in meetings():
            if sum(b.num_rows for b in held) < 2:
                continue
            own, ids = column(held, "own"), column(held, "id")
            if not own.any():
                continue
            order = np.argsort(ids, kind="stable")
            own, ids = own[order], ids[order]
            is_p, is_q, scale, lost = (column(held, c)[order] for c in ("is_p", "is_q", "scale", "lost"))
            short = np.frombuffer(b"".join(x for b in held for x in b.column("v").to_pylist()), np.int16).reshape(len(ids), d)[order]
            x = short * scale[:, None]
            label, owners = np.arange(len(ids)), np.flatnonzero(own)  # two that are here by a turned sign each may be far apart: others show them
            for lo in range(0, len(owners), 256):
                mine = owners[lo : lo + 256]
                sim, bound = x[mine] @ x.T, lost[mine][:, None] * (1 + lost) + lost + 1e-12
                i, j = np.nonzero(sim + bound >= threshold - ROUNDING)
                cosine, bound, i = sim[i, j], bound[i, j], mine[i]
                ok = (ids[i] != ids[j]) & (is_p[i] & is_q[j] | is_q[i] & is_p[j])
                i, j, cosine, bound = i[ok], j[ok], cosine[ok], bound[ok]
                sure = cosine - bound >= threshold
                a, b, _ = forest(i[sure], j[sure], cosine[sure], label)
                open_ = ~sure & ((i < j) | ~own[j]) & (label[i] != label[j])  # the vectors themselves tell: such a link stands for no other
                a, b = np.concatenate([a, i[open_]]), np.concatenate([b, j[open_]])
                found.append((np.minimum(ids[a], ids[b]), np.maximum(ids[a], ids[b])))
            if sum(len(a) for a, _ in found) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], ["vec_a", "vec_b"])
                found = []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], ["vec_a", "vec_b"])

    links = stored(met.repartition("meeting").sortWithinPartitions("meeting", *key, "p", "q").mapInArrow(compare, "vec_a long, vec_b long").distinct(), "near-links")
    ends = links.join(first.select(F.col("id").alias("vec_a"), F.col("v").alias("x")), "vec_a").join(first.select(F.col("id").alias("vec_b"), F.col("v").alias("y")), "vec_b")
    cosine = F.aggregate(F.zip_with("x", "y", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    exact = ends.select("vec_a", "vec_b", F.round(cosine, 6).alias("cosine")).where(F.col("cosine") >= threshold)
    return exact.unionByName(same.select(F.col("a").alias("vec_a"), F.col("b").alias("vec_b"), F.lit(1.0).alias("cosine")))


def grouped(ideas: DataFrame, known: DataFrame, threshold: float = 0.9, recall: float = 0.98) -> DataFrame:
    """id, idea_group_id of ideas (id, vector): the least group of the known ideas (id, idea_group_id, vector) that a chain of links reaches, else the least id of the ideas that it does.

    A known idea keeps its group; ideas without a usable vector are groups of their own.
    """
    all_ = known.select("id", "vector").unionByName(ideas.select("id", "vector").join(known.select("id"), "id", "left_anti"))
    links = near_links(all_.select(F.col("id").alias("vec_id"), F.col("vector").alias("embedding")), threshold, recall)
    comp = components(links.select(F.col("vec_a").alias("a"), F.col("vec_b").alias("b")), "idea-groups")
    old = known.select("id", "idea_group_id").join(comp, "id").groupBy("comp").agg(F.min("idea_group_id").alias("old"))
    mine = ideas.select("id").join(known.select("id", F.col("idea_group_id").alias("own")), "id", "left").join(comp, "id", "left")
    return mine.join(stored(old, "known-groups"), "comp", "left").select("id", F.coalesce("own", "old", "comp", "id").alias("idea_group_id"))


def save_groups(store: Store, vectors: DataFrame, threshold: float = 0.9, recall: float = 0.98) -> DataFrame:
    """Group the stored ideas that vectors (id, vector) name, with those that were grouped before, and store vectors, groups and each idea's group in one commit; id, idea_group_id.

    A new group's text is that of its idea of least id. Ideas that are grouped already keep their group, so a rerun changes nothing.
    """
    vectors = stored(vectors.select(F.col("id").cast("long").alias("id"), F.col("vector").cast("array<double>").alias("vector")).dropDuplicates(["id"]), "idea-vectors")
    while True:
        at = store.snapshot()
        known = store.table("idea_vectors", at)
        ideas = stored(vectors.join(store.table("key_ideas", at).select("id", "book_id", "core_idea_text"), "id").join(known.select("id"), "id", "left_anti"), "ideas-to-group")
        if not ideas.head(1):
            return known.select("id", "idea_group_id").join(vectors.select("id"), "id", "left_semi")
        found = stored(grouped(ideas, known, threshold, recall), "groups")
        groups = ideas.join(found, "id").where("id = idea_group_id").select("id", F.col("core_idea_text").alias("canonical_idea_text"))
        rows = ideas.join(found, "id").select("id", "book_id", "idea_group_id", "vector")
        touched = [r.b for r in ideas.select(bucket_column("key_ideas", at.buckets).alias("b")).distinct().collect()]
        named = found.withColumnRenamed("idea_group_id", "given")

        def with_group(x: DataFrame, named: DataFrame = named) -> DataFrame:
            return x.join(named, "id", "left").withColumn("idea_group_id", F.coalesce("idea_group_id", "given")).drop("given")

        new, old = store.rewrite("key_ideas", touched, with_group, at)
        # what was known must not have grown meanwhile: its folders are replaced by themselves and the new ones
        staged = store.stage("idea_vectors", rows, at.buckets)
        seen = at.folders.get("idea_vectors", {})
        both = {b: seen.get(b, []) + staged.get(b, []) for b in {*seen, *staged}}
        try:
            store.commit({"idea_groups": store.stage("idea_groups", groups, at.buckets), "idea_vectors": both, "key_ideas": new}, {"key_ideas": old, "idea_vectors": {b: seen.get(b, []) for b in both}})
            return store.table("idea_vectors").select("id", "idea_group_id").join(vectors.select("id"), "id", "left_semi")
        except Conflict:
            continue
