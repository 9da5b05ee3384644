"""Running values along an order inside a group, where one group may hold a third of all rows.

Rows of a group are dealt into blocks by their place in the order. Each block is summed up by an aggregate; a window over the blocks, one row each, gives
what comes before and after every block; joined back and added to what a window inside the block gives, that is the running value. So a group is spread over as many
tasks as it has blocks, and only its blocks' sums meet in one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

BLOCK, SMALL = 4096, 1 << 20
NONE = -(1 << 62)  # stands for a null group or place; places of null come first


def is_small(rows: DataFrame) -> bool:
    """Whether all rows together are few enough for one task, so that plain windows do."""
    return rows.limit(SMALL + 1).count() <= SMALL


def running(rows: DataFrame, by: list[str], order: str, values: dict[str, tuple[str, Column]], block: int | None = None, small: bool = False) -> DataFrame:
    """rows with a column for each of values, name: (kind, value), along `order`, a column of integers, in the groups of `by` (columns of integers).

    Kinds: sum_before (0 at first), max_before, min_after, next (the value of the next row); of rows before or after this one, null where there is none or all are null.
    Rows of equal place come in any order. rows is read twice: store it first where it is costly. small (see is_small): windows over whole groups give the same, in fewer steps.
    """
    if small:
        group = Window.partitionBy(*by)
        up, down = group.orderBy(order).rowsBetween(Window.unboundedPreceding, -1), group.orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, -1)
        plain = {"sum_before": lambda v: F.coalesce(F.sum(v).over(up), F.lit(0)), "max_before": lambda v: F.max(v).over(up), "min_after": lambda v: F.min(v).over(down), "next": lambda v: F.lead(v).over(group.orderBy(order))}
        return rows.select("*", *[plain[kind](value).alias(name) for name, (kind, value) in values.items()])
    block = block or BLOCK
    key = [f"_k{i}" for i in range(len(by))] + ["_block"]
    keyed = rows.withColumns({f"_k{i}": F.coalesce(F.col(c).cast("long"), F.lit(NONE)) for i, c in enumerate(by)} | {"_block": F.coalesce(F.floor(F.col(order) / block).cast("long"), F.lit(NONE))})
    within = {"sum_before": F.sum, "max_before": F.max, "min_after": F.min, "next": lambda v: F.min_by(v, F.coalesce(F.col(order).cast("long"), F.lit(NONE)))}
    sums = stored(keyed.groupBy(*key).agg(*[within[kind](value).alias(f"_{name}") for name, (kind, value) in values.items()]), "block-sums")
    blocks = Window.partitionBy(*key[:-1])
    ahead, behind = blocks.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1), blocks.orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    carried = {
        "sum_before": lambda c: F.coalesce(F.sum(c).over(ahead), F.lit(0)), "max_before": lambda c: F.max(c).over(ahead), "min_after": lambda c: F.min(c).over(behind), "next": lambda c: F.lead(c).over(blocks.orderBy("_block")),
    }
    carry = sums.select(*key, *[carried[kind](F.col(f"_{name}")).alias(f"_{name}") for name, (kind, _) in values.items()])
    mine = Window.partitionBy(*key)
    up, down = mine.orderBy(order).rowsBetween(Window.unboundedPreceding, -1), mine.orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, -1)
    last = F.lead(F.lit(1)).over(mine.orderBy(order)).isNull()
    whole = {
        "sum_before": lambda v, c: F.coalesce(F.sum(v).over(up), F.lit(0)) + c, "max_before": lambda v, c: F.greatest(F.max(v).over(up), c), "min_after": lambda v, c: F.least(F.min(v).over(down), c),
        "next": lambda v, c: F.when(last, c).otherwise(F.lead(v).over(mine.orderBy(order))),
    }
    found = keyed.join(carry, key).withColumns({name: whole[kind](value, F.col(f"_{name}")) for name, (kind, value) in values.items()})
    return found.select(*rows.columns, *values)
