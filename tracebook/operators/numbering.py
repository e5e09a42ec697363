"""Sequence numbers within a group that do not need the group in one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracebook.session import checkpointed

_AT = "__at"
_ROW = "__row"


def _block_shifts(sizes: DataFrame, width: int, levels: int) -> DataFrame:
    """Per finest block the number of rows in all earlier blocks of its group.

    ``sizes`` has the block's place ``__at`` (a struct of ``width`` key fields and one field
    per level) and its ``__size``. Only sizes are looked at, level by level, so that no
    window sees more rows than a coarser block has finer ones.
    """
    fields = sizes.schema[_AT].dataType.fieldNames()

    def prefix(length: int) -> Column:
        return F.struct(*[F.col(_AT)[f] for f in fields[:length]])

    def shifted(totals: DataFrame, place: str, depth: int, name: str) -> DataFrame:
        window = (
            Window.partitionBy(F.struct(*[F.col(place)[f] for f in fields[:depth]]))
            .orderBy(F.col(place)[fields[depth]])
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        before = F.coalesce(F.sum("__size").over(window), F.lit(0)).cast("long")
        return totals.select(place, before.alias(name))

    shifts = shifted(sizes, _AT, width + levels - 1, "__shift")
    for depth in range(width, width + levels - 1):
        totals = sizes.groupBy(prefix(depth + 1).alias("__upto")).agg(
            F.sum("__size").alias("__size")
        )
        earlier = shifted(totals, "__upto", depth, "__before")
        shifts = (
            shifts.withColumn("__upto", prefix(depth + 1))
            .join(earlier, "__upto")
            .select(_AT, (F.col("__shift") + F.col("__before")).alias("__shift"))
        )
    return shifts


def number_within(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column],
    name: str,
    blocks: Sequence[Column] = (),
) -> DataFrame:
    """Add ``name`` = 0, 1, 2, … in the given order within each group.

    ``blocks`` are coarse forms of the order, from coarse to fine, each ascending in step
    with ``order_by`` (such as ``floor(id / 4096)`` for rows ordered by ``id``). A group is
    numbered block by block and shifted by the running size of the earlier blocks. Only
    block sizes, counted before the shuffle, are brought together per group; the rows of a
    hot group stay spread over its blocks and are shuffled once.
    """
    if not blocks:
        window = Window.partitionBy(*keys).orderBy(*order_by)
        return df.withColumn(name, (F.row_number().over(window) - 1).cast("long"))

    # one struct as key: its null fields compare equal, and window, count and join share it
    parts = [*[F.col(k) for k in keys], *blocks]
    place = F.struct(*[part.alias(f"p{i}") for i, part in enumerate(parts)])
    placed = df.withColumn(_AT, place)
    sizes = placed.groupBy(_AT).agg(F.count(F.lit(1)).alias("__size"))
    shifts = _block_shifts(sizes, len(keys), len(blocks))

    window = Window.partitionBy(_AT).orderBy(*order_by)
    local = placed.withColumn("__local", F.row_number().over(window) - 1)
    return local.join(shifts, _AT).select(
        *df.columns, (F.col("__local") + F.col("__shift")).cast("long").alias(name)
    )


def number_by_range(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column],
    name: str,
    size: str | None = None,
    keep: Callable[[DataFrame], DataFrame] = checkpointed,
) -> DataFrame:
    """Add ``name`` = 0, 1, 2, … in the given order within each group, by one distributed sort.

    Rows are dealt to ranges of (keys, order), so that a hot group lies over many ranges, and
    numbered where they lie; rows of a group in earlier ranges are then added, of which there is
    one count per range and group. Rows that the order leaves equal are dealt out too and numbered
    as they come. With ``size`` the number of rows of the group is added as well. ``keep`` stores
    the sorted rows, which are read once for the counts and once for the numbers.
    """
    order = [*[F.col(k) for k in keys], *order_by, F.col(_ROW)]
    placed = keep(
        df.withColumn(_ROW, F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(_AT, F.monotonically_increasing_id())
        .drop(_ROW)
    )
    # the id is the number of the range, shifted by 33 bits, and the place within it
    group = F.struct(F.shiftright(_AT, 33).alias("range"), *[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    counts = placed.groupBy(group.alias("__group")).agg(F.min(_AT).alias("__first"), F.count(F.lit(1)).alias("__n"))
    same = F.struct(*[F.col("__group")[f"k{i}"] for i in range(len(keys))]) if keys else F.lit(0)
    every = Window.partitionBy(same)
    before = every.orderBy("__group.range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "__group",
        (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__shift"),
        F.sum("__n").over(every).alias("__size"),
    )
    more = [F.col("__size").alias(size)] if size else []
    return (
        placed.withColumn("__group", group)
        .join(starts, "__group")
        .select(*df.columns, (F.col(_AT) + F.col("__shift")).cast("long").alias(name), *more)
    )
