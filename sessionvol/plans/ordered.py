"""Ordered windows per key that never put a whole key into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from sessionvol.plans.joins import lookup_join
from sessionvol.session import settle

BLOCK_ROWS = 4096


def ordered_blocks(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    lookback: int,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Cut each key's ordered rows into blocks of ``block_rows`` rows.

    Each block also holds copies of the ``lookback`` rows before it, marked
    ``_context``, so a frame of up to ``lookback`` preceding rows gives the same
    result inside a block as over the whole key.  Use ``block_window`` for the
    frames and ``own_rows`` afterwards.

    Rows are range-partitioned by key and order and stored with their number in the
    partition.  A row's position is that number, counted from the key's first row there, plus the
    key's rows in the partitions before.  So no task holds a key, a period or equal rows
    of any number; a NULL key is a key like the others.  Runs a job when called.
    """
    if block_rows < lookback:
        raise ValueError("a block must hold at least the rows it passes on")
    # The input partition's number splits equal rows, and is the same when a task is run again.
    ranged = df.withColumn("_spread", F.spark_partition_id()).repartitionByRange(key, *order, "_spread")
    rows = settle(
        ranged.sortWithinPartitions(key, *order).drop("_spread").withColumn("_id", F.monotonically_increasing_id())
    )
    part, number = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    rows = rows.select(*df.columns, part.cast("int").alias("_part"), number.alias("_number"))
    earlier = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy(key, "_part")
        .agg(F.count(F.lit(1)).alias("_rows"), F.min("_number").alias("_first"))
        .select(key, "_part", (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_start"))
    )
    placed = lookup_join(rows, starts, [key, "_part"], "inner", null_safe=True, spread=("_number",))
    placed = placed.select(*df.columns, (F.col("_start") + F.col("_number")).alias("_position"))
    block = F.floor(F.col("_position") / block_rows)
    own = F.struct(block.alias("block"), F.lit(False).alias("context"))
    next_one = F.struct((block + 1).alias("block"), F.lit(True).alias("context"))
    passed_on = F.col("_position") % block_rows >= block_rows - lookback
    copies = F.when(passed_on, F.array(own, next_one)).otherwise(F.array(own))
    return placed.select("*", F.inline(copies).alias("_block", "_context"))


def with_previous(
    df: DataFrame, key: str, order: Sequence[str], column: str, name: str, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``df`` with ``name``: the value of ``column`` in the row of the same key before, by ``order``; NULL in a key's first row.

    Rows are range-partitioned by key and order and stored, in one pass over ``df``.  In a partition the row before is found
    within pieces of ``block_rows`` rows; over its border every piece gets the key and value of the last row before it, from the piece
    before or the last partition that has rows.  So no key, equal rows of any number among them, has to be in one task, and
    nothing is joined.  A NULL key is a key like the others.  Runs a job when called.
    """
    ranged = df.withColumn("_spread", F.spark_partition_id()).repartitionByRange(key, *order, "_spread")
    rows = settle(
        ranged.sortWithinPartitions(key, *order).drop("_spread").withColumn("_id", F.monotonically_increasing_id())
    )
    number = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    pair = F.struct(F.col(key).alias("k"), F.col(column).alias("v"))
    rows = rows.withColumns({"_part": F.shiftright("_id", 33).cast("int"), "_number": number}).drop("_id")
    piece = F.floor(F.col("_number") / block_rows)
    own = rows.select(*df.columns, "_part", piece.alias("_piece"), "_number", pair.alias("_pair"), F.lit(True).alias("_own"))
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields]

    def carry(borders: DataFrame) -> DataFrame:
        return borders.select(*blank, "_part", "_piece", "_number", "_pair", F.lit(False).alias("_own"))

    inner = rows.where(F.col("_number") % block_rows == block_rows - 1)
    inner = inner.select("_part", (piece + 1).alias("_piece"), "_number", pair.alias("_pair"))
    # One row per range partition.
    last = rows.groupBy("_part").agg(F.max_by(pair, "_number").alias("_pair"))
    outer = last.select(
        "_part", F.lit(0).cast("bigint").alias("_piece"), F.lit(-1).cast("bigint").alias("_number"),
        F.lag("_pair").over(Window.orderBy("_part")).alias("_pair"),
    ).where(F.col("_pair").isNotNull())
    pieces = own.unionByName(carry(inner)).unionByName(carry(outer))
    before = F.lag("_pair").over(Window.partitionBy("_part", "_piece").orderBy("_number"))
    found = pieces.withColumn("_before", before).where("_own")
    value = F.when(F.col("_before.k").eqNullSafe(F.col(key)), F.col("_before.v"))
    return found.select(*df.columns, value.alias(name))


def block_window(key: str) -> WindowSpec:
    return Window.partitionBy(key, "_block").orderBy("_position")


def own_rows(blocks: DataFrame) -> DataFrame:
    return blocks.where(~F.col("_context")).drop("_block", "_context", "_position")
