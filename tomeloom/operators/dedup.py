"""Keep-first dedup of concepts, dedup against a store, and near-duplicates by cosine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship, stored
from .components import components

ORDER = ["chapter_number", "toc_idx", "section_paragraph_index", "chunk_id"]
ROUNDING = 1e-6  # cosines are compared as rounded to six digits: one just under the threshold may reach it
BLOCKS, BLOCK_ROWS, BLOCK_BYTES, STRIP = 16, 16384, 16 << 20, 1 << 21  # of near_dup_cosine: blocks, the most rows and bytes of one, and products at a time


def _place(order: list[str]):
    """What orders rows: a number alone can be aggregated by hash, a struct takes a sort."""
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def first_places(ideas: DataFrame, within: list[str], order: list[str] | None = None) -> DataFrame:
    """within, concept, first_place: an aggregate with a map-side part, written before it is joined back, so that Spark can split that join where a third of all rows have one concept."""
    some = ideas.where("concept <> ''")
    return stored(some.groupBy(*within, "concept").agg(F.min(_place(order or ORDER)).alias("first_place")), "first-places")


def mark_duplicates(ideas: DataFrame, within: list[str], order: list[str] | None = None) -> DataFrame:
    """ideas with is_duplicate: a concept that an earlier row of the same `within` has. Empty and null concepts never are.

    ideas is read twice: store it first where it is costly.
    """
    first = first_places(ideas, within, order)
    marked = ideas.join(first, [*within, "concept"], "left")
    return marked.select(*ideas.columns, F.coalesce(_place(order or ORDER) > F.col("first_place"), F.lit(False)).alias("is_duplicate"))


def keep_first(ideas: DataFrame, within: list[str], order: list[str] | None = None) -> DataFrame:
    """The first row of each concept in the same `within`, and all rows without a concept.

    The concept and the place together are the join's key, so a very common concept is spread over tasks. ideas is read twice: store it first where
    it is costly. Rows that agree in all of these are all kept.
    """
    first = first_places(ideas, within, order).withColumn("is_first", F.lit(True))
    rows = ideas.withColumn("first_place", _place(order or ORDER))
    found = rows.join(first, [*within, "concept", "first_place"], "left")
    return found.where("is_first or concept is null or concept = ''").select(*ideas.columns)


def dedup_within_book(ideas: DataFrame, order: list[str] | None = None) -> DataFrame:
    return keep_first(ideas, ["book_id"], order)


def dedup_global(ideas: DataFrame, order: list[str] | None = None) -> DataFrame:
    """As within a book, over all books, in the order of book_id first."""
    return keep_first(ideas, [], ["book_id", *(order or ORDER)])


def dedup_against_store(ideas: DataFrame, stored: DataFrame, per_book: bool = True) -> DataFrame:
    """ideas whose concept the store (book_id, core_idea_text) lacks; empty concepts stay."""
    keys = ["book_id", "concept"] if per_book else ["concept"]
    known = stored.withColumnRenamed("core_idea_text", "concept").where("concept <> ''").select(*keys).distinct()
    return ideas.join(known, keys, "left_anti")


def duplicates_skipped(ideas: DataFrame, order: list[str] | None = None) -> DataFrame:
    return mark_duplicates(ideas, ["book_id"], order).where("is_duplicate").drop("is_duplicate")


def finite(vectors: DataFrame) -> DataFrame:
    """vec_id and v, in doubles; null vectors and ids and vectors with null, NaN or infinite components are left out."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vectors.where("embedding is not null and vec_id is not null").select("vec_id", F.col("embedding").cast("array<double>").alias("v")).where(F.forall("v", fine))


def block_rows(n: int, width: int) -> int:
    """Rows of a block, for n vectors of width components: BLOCKS blocks, so that each vector is sent as often whatever n is, until a block has BLOCK_ROWS rows or BLOCK_BYTES."""
    return max(512, min(-(-n // BLOCKS), BLOCK_ROWS, BLOCK_BYTES // (8 * max(width, 1))))


def compare_blocks(batches, threshold: float, spanning: bool):
    """Pairs of each unit, whose rows (unit, is_right, vec_id, v) come one after the other; a unit without a right side is a block against itself. Arrow batches in and out."""
    import numpy as np
    import pyarrow as pa

    def units():
        now, held = None, []
        for batch in batches:
            unit, lists = batch.column("unit").to_numpy(), batch.column("v")
            right, ids = batch.column("is_right").to_numpy(zero_copy_only=False), batch.column("vec_id").to_numpy()
            offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            starts = [0, *(np.flatnonzero(unit[1:] != unit[:-1]) + 1).tolist(), len(unit)]
            for i, j in zip(starts[:-1], starts[1:]):
                if i == j:
                    continue
                if held and unit[i] != now:
                    yield held
                    held = []
                now = unit[i]
                held.append((right[i:j], ids[i:j], np.diff(offsets[i : j + 1]), flat[offsets[i] : offsets[j]]))
        if held:
            yield held

    def of_length_one(x):
        top = np.abs(x).max(1, keepdims=True, initial=0)
        x = np.divide(x, top, out=np.zeros_like(x), where=top > 0)  # squares of huge components stay finite
        size = np.sqrt((x * x).sum(1, keepdims=True))
        return np.divide(x, size, out=np.zeros_like(x), where=size > 0)

    for held in units():
        right, ids, sizes, flat = (np.concatenate(c) for c in zip(*held, strict=True))
        ends = np.cumsum(sizes)
        for d in np.unique(sizes).tolist():
            sides = [np.flatnonzero((sizes == d) & (right == r)) for r in (False, True)]
            same = not right.any()
            sides[1] = sides[0] if same else sides[1]
            if not len(sides[0]) or not len(sides[1]):
                continue
            x, y = (of_length_one(flat[(ends[rows] - d)[:, None] + np.arange(d)]) for rows in sides)
            (va, vb), label = (ids[rows] for rows in sides), np.arange(len(ids))
            step = max(1, STRIP // len(y))
            for lo in range(0, len(x), step):
                sim = x[lo : lo + step] @ y.T
                i, j = np.nonzero(sim >= threshold - ROUNDING)
                cosine = sim[i, j]
                i += lo
                ok = ((va[i] < vb[j]) if same else (va[i] != vb[j])) & (np.round(cosine, 6) >= threshold)
                i, j, cosine = i[ok], j[ok], cosine[ok]
                if spanning:
                    i, j, cosine = forest(sides[0][i], sides[1][j], cosine, label)
                    a, b = ids[i], ids[j]
                else:
                    a, b = va[i], vb[j]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(cosine)], ["vec_a", "vec_b", "cosine"])


def forest(i, j, cosine, label):
    """Of the links (i, j), those that join what label (each node's smallest known neighbour, changed in place) does not: a link for each node at a time, so a crowd takes few steps."""
    import numpy as np

    kept = [(i[:0], j[:0], cosine[:0])]
    while True:
        open_ = label[i] != label[j]
        i, j, cosine = i[open_], j[open_], cosine[open_]
        if not len(i):
            return tuple(np.concatenate(c) for c in zip(*kept, strict=True))
        joins = []
        for n in np.unique(i, return_index=True)[1].tolist():
            a, b = int(i[n]), int(j[n])
            while label[a] != a:
                a = int(label[a])
            while label[b] != b:
                b = int(label[b])
            if a != b:
                label[max(a, b)] = min(a, b)
                joins.append(n)
        while (label != label[label]).any():
            label[:] = label[label]
        kept.append((i[joins], j[joins], cosine[joins]))


def near_dup_cosine(vectors: DataFrame, threshold: float, block: int | None = None, spanning: bool = False) -> DataFrame:
    """vec_a, vec_b, cosine of all pairs vec_a < vec_b at or over threshold: exact, in blocks. The cosine counts as rounded to six digits.

    Vectors are dealt into blocks of about `block` rows (see block_rows); each pair of blocks is one unit of bounded size, multiplied as matrices, a strip of rows at a time.
    spanning: of each unit only links that join what others of it don't (a forest), which connect the same vectors as all pairs do, and are at most as many as the unit has rows.
    Null vectors and ids and vectors with null, NaN or infinite components take no part; vectors of different length are no pair; a zero vector has cosine 0.
    """
    ship(vectors.sparkSession)
    good = finite(vectors)
    n, width = good.agg(F.count("*"), F.max(F.size("v"))).first()
    blocks = max(1, -(-n // (block or block_rows(n, width or 1))))
    mine = good.withColumn("b", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    mine = mine.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    unit = F.least("b", "other") * blocks + F.greatest("b", "other")
    rows = mine.select(unit.cast("long").alias("unit"), (F.col("b") > F.col("other")).alias("is_right"), F.col("vec_id").cast("long").alias("vec_id"), "v")

    def compare(batches):
        from tomeloom.operators.dedup import compare_blocks

        return compare_blocks(batches, threshold, spanning)

    found = rows.repartition("unit").sortWithinPartitions("unit").mapInArrow(compare, "vec_a long, vec_b long, cosine double")
    return found.withColumn("cosine", F.round("cosine", 6)).where(F.col("cosine") >= threshold)


def idea_groups(pairs: DataFrame, ideas: DataFrame) -> DataFrame:
    """idea_group_id, canonical_idea_text and members: ideas (id, core_idea_text) that chains of pairs (vec_a, vec_b) link. The smallest id names the group and gives its text."""
    comp = components(pairs.select(F.col("vec_a").alias("a"), F.col("vec_b").alias("b")), "idea-groups")
    label = ideas.select("id").join(comp, "id", "left").select("id", F.coalesce("comp", "id").alias("grp"))
    named = ideas.select(F.col("id").alias("grp"), F.col("core_idea_text").alias("canonical_idea_text"))
    return label.groupBy("grp").agg(F.count("*").alias("members")).join(named, "grp").select(F.col("grp").alias("idea_group_id"), "canonical_idea_text", "members")
