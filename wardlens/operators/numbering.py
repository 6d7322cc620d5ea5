"""Numbering and ordering of whole tables without one task that sees all rows.

A range partitioner cuts the order into pieces; each piece is numbered by itself, and the pieces' sizes, summed up
in order, say where each piece begins. Only one number per piece is ever gathered. Rows that are equal in the order
would all fall into one piece: a row tag as the last key spreads them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlens.session import cut_lineage


def _cols(order) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in ([order] if isinstance(order, (str, Column)) else order)]


def _tagged(df: DataFrame) -> DataFrame:
    """``df`` with ``_tag``, different for every row. The rows are written first (a reliable checkpoint), so a
    retried task gives its rows the same tags."""
    return cut_lineage(df).withColumn("_tag", F.monotonically_increasing_id())


def total_order(df: DataFrame, order, pieces: int | None = None) -> DataFrame:
    """``df`` sorted by ``order`` (columns, or expressions with their direction) over all partitions, equal rows
    included: written files follow the order by name. A group of copies spreads over as many pieces as its size asks for."""
    tagged = _tagged(df)
    keys = [*_cols(order), F.col("_tag")]
    spread = tagged.repartitionByRange(pieces, *keys) if pieces else tagged.repartitionByRange(*keys)
    return spread.sortWithinPartitions(*keys).drop("_tag")


def number_rows(df: DataFrame, order, number_col: str = "row_number", pieces: int | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY order)``: gapless from 1; rows equal in the order are numbered in any
    order among themselves. ``order`` may be empty (a constant order): rows are numbered as they are stored."""
    tagged = _tagged(df)
    keys = [*_cols(order), F.col("_tag")]
    spread = tagged.repartitionByRange(pieces, *keys) if pieces else tagged.repartitionByRange(*keys)
    placed = cut_lineage(spread.withColumn("_piece", F.spark_partition_id()))
    sizes = placed.groupBy("_piece").agg(F.count(F.lit(1)).alias("_size"))
    # one row per piece
    before = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_piece", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy("_piece").orderBy(*keys))
    return (placed.withColumn("_within", within).join(starts, "_piece")
            .withColumn(number_col, F.col("_start") + F.col("_within")).drop("_piece", "_tag", "_within", "_start"))


def first_appearance(df: DataFrame, key: str, order, number_col: str = "group_number", pieces: int | None = None) -> DataFrame:
    """Every distinct non-NULL ``key`` with its number in order of first appearance, gapless from 0. ``order``
    (columns) is the position of a row; keys first seen at equal positions come in their own order. The first
    position is a minimum with map-side combine, so a key that holds a third of the rows is one row per task."""
    order = [order] if isinstance(order, str) else list(order)
    first = (df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*order)).alias("_first")))
    return number_rows(first, ["_first", key], "_n", pieces).select(key, (F.col("_n") - 1).alias(number_col))


def with_group_number(df: DataFrame, key: str, order, number_col: str = "group_number") -> DataFrame:
    """Rows of ``df`` with the number of their ``key`` (NULL for a NULL key)."""
    numbers = first_appearance(df, key, order, number_col).withColumnRenamed(key, "_key")
    # rows without a key match nothing; each gets a key of its own, so they do not end in one partition
    spread = F.concat(F.lit("\x00"), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("string"))
    keyed = df.withColumn("_key", F.coalesce(F.col(key).cast("string"), spread))
    return keyed.join(numbers.withColumn("_key", F.col("_key").cast("string")), "_key", "left").drop("_key")
