"""Row numbers, tiles and medians over a global order, without bringing the rows into one task.

A window without a partition would sort everything in a single task. Here the rows are range-partitioned and
sorted, written once with their partition number and offset, and the global position follows from the row
counts of the earlier partitions (one small row per partition).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starbazaar.session import remove_work, work_table

_OFFSET_MASK = (1 << 33) - 1  # monotonically_increasing_id keeps the row's offset in its low 33 bits


def _sorted_layout(df: DataFrame, order: list[str], label: str) -> DataFrame:
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({
        "_part": F.spark_partition_id(),
        "_offset": F.monotonically_increasing_id().bitwiseAND(F.lit(_OFFSET_MASK)),
    })
    return work_table(placed, label)


def _partition_starts(layout: DataFrame, rows: Column) -> DataFrame:
    """One row per partition of the layout: its first global position. As small as the partition count."""
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = layout.groupBy("_part").agg(rows.alias("_rows"))
    return sizes.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))


def with_position(df: DataFrame, order: list[str], name: str = "position", label: str = "layout") -> DataFrame:
    """Add a dense position from 0 in the ascending order of ``order``.

    End ``order`` with a unique column: that makes the numbers reproducible and lets equal leading values
    spread over several partitions.
    """
    layout = _sorted_layout(df, order, label)
    starts = F.broadcast(_partition_starts(layout, F.count("*")))
    return layout.join(starts, "_part").select(*df.columns, (F.col("_start") + F.col("_offset")).alias(name))


def with_sums_below(df: DataFrame, order: list[str], sums: list[str], label: str = "layout") -> DataFrame:
    """Add ``<column>_below`` for each of ``sums``: its sum over all rows before a row in the ascending order of ``order``, which must be unique."""
    layout = _sorted_layout(df, order, label)
    before = Window.partitionBy("_part").orderBy("_offset").rowsBetween(Window.unboundedPreceding, -1)
    placed = layout
    for c in sums:
        placed = placed.join(F.broadcast(_partition_starts(layout, F.sum(c)).withColumnRenamed("_start", f"_start_{c}")), "_part")
    return placed.select(*df.columns, *(
        (F.col(f"_start_{c}") + F.coalesce(F.sum(c).over(before), F.lit(0))).alias(f"{c}_below") for c in sums))


def with_surrogate_key(df: DataFrame, natural_key: str, name: str, ties: tuple[str, ...] = ()) -> DataFrame:
    """Dense key from 1 in the order of the natural key, as the first column. Rows that may share it go by ``ties``."""
    numbered = with_position(df, [natural_key, *ties], "_position", label=name)
    return numbered.select((F.col("_position") + 1).alias(name), *df.columns)


def tile(df: DataFrame, tiles: int, order: dict[str, Column], label: str = "tiles") -> Column:
    """NTILE as an expression on ``df``'s own rows, from the first row of each tile.

    ``order`` names ascending sort expressions, the last one unique. Only these columns are sorted; the
    ``tiles - 1`` border rows come to the driver, so scoring ``df`` needs neither a shuffle nor a join.
    """
    own = df.select(*(e.alias(k) for k, e in order.items()))
    # A folder of its own rather than a scope: several threads may share their scope.
    folder = f"tiles-{uuid.uuid4().hex}"
    try:
        placed = with_position(own, list(order), "_position", f"{folder}/{label}")
        size, larger = divmod(placed.count(), tiles)
        starts = [i * size + min(i, larger) for i in range(1, tiles)]
        borders = placed.where(F.col("_position").isin(starts)).orderBy("_position").take(tiles - 1)
    finally:
        remove_work(df.sparkSession, folder)
    key = F.struct(*(e.alias(k) for k, e in order.items()))
    passed = (
        (key >= F.struct(*(F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in own.schema))).cast("int")
        for row in borders
    )
    return sum(passed, F.lit(1))


def group_medians(df: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Exact medians per key of several numeric columns, the mean of the two middle values for an even count.
    NULL values are skipped; a key with none gets no row or a NULL.

    The built-in median keeps all of a group's distinct values in one task. Here equal values of a key combine
    into one weighted row first, the distinct ones are laid out in order over all tasks, and each covers a range
    of global positions. A group's middle positions then pick its one or two middle values. All columns share
    one layout, told apart by their name.
    """
    group = [key, "_column"]
    named = F.explode(F.array(*(F.struct(F.lit(v).alias("_column"), F.col(v).alias("_value")) for v in values)))
    pairs = (
        df.select(key, named.alias("_named")).select(key, "_named.*").where("_value IS NOT NULL")
        .groupBy(*group, "_value").agg(F.count("*").alias("_weight"))
    )
    layout = _sorted_layout(pairs, [*group, "_value"], "medians")
    starts = F.broadcast(_partition_starts(layout, F.sum("_weight")))
    so_far = Window.partitionBy("_part").orderBy("_offset").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        layout.withColumn("_end", F.sum("_weight").over(so_far))
        .join(starts, "_part")
        .select(*group, "_value", "_weight", (F.col("_start") + F.col("_end")).alias("_end"))
        .withColumn("_begin", F.col("_end") - F.col("_weight"))
    )
    # Written, so that the join below shuffles both sides itself and a hot key's values can be split.
    spans = work_table(
        placed.groupBy(*group).agg(F.min("_begin").alias("_first"), F.sum("_weight").alias("_rows")), "spans")
    middles = spans.select(
        *group, F.expr("_first + (_rows - 1) div 2").alias("_low"), F.expr("_first + _rows div 2").alias("_high"))

    def at(column: str, position: str) -> Column:
        inside = (F.col("_begin") <= F.col(position)) & (F.col(position) < F.col("_end"))
        return F.max(F.when(inside & (F.col("_column") == column), F.col("_value")))

    touched = (F.col("_begin") <= F.col("_high")) & (F.col("_low") < F.col("_end"))
    return placed.join(middles, group).where(touched).groupBy(key).agg(*(
        ((at(v, "_low") + at(v, "_high")) / 2).alias(v) for v in values))
