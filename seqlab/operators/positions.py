"""Exact positions (1, 2, 3, ...) without putting a whole group, or the whole table, into one task.

Rows are split into buckets that follow the wanted order; bucket counts give each bucket its offset, and
``row_number`` runs inside one bucket only.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqlab.functions import draw_hash
from seqlab.session import land

#: Rows that one task may number; larger groups are ranked by ranges.
PLAIN = 1 << 20


def rank_by_bucket(
    df: DataFrame, group: list[str], bucket: Column, order: list[Column], out: str
) -> DataFrame:
    """Add ``out``: the position of each row in its group.

    Group columns are not NULL. ``bucket`` must not decrease along ``order`` and must hold few rows per value. The
    window and the offset join use the same (group, bucket) partitioning, so the rows are shuffled once.
    """
    keys = [*group, "_bucket"]
    rows = df.withColumn("_bucket", bucket)
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inner = Window.partitionBy(*keys).orderBy(*order)
    numbered = rows.withColumn("_rank", F.row_number().over(inner)).join(offsets, keys)
    return numbered.select(*df.columns, (F.col("_before") + F.col("_rank")).alias(out))


def rank_by_range(df: DataFrame, group: list[str], order: list[str], out: str, plain: int = PLAIN) -> DataFrame:
    """Add ``out``: the position of each row in its group, for any order columns that tell all rows apart.

    Groups of up to ``plain`` rows, which are counted before the shuffle, are numbered by one window. In larger ones the buckets are
    Spark's own range partitions over (group, order), so a group, or a run of equal first order values, of any size is
    spread evenly. Only these columns are landed, to fix the partition numbers, and ranked; the rows of large groups are joined
    with the positions.
    """
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_size")).where(F.col("_size") > plain)
    window = Window.partitionBy(*group).orderBy(*order)
    numbered = lambda rows: rows.withColumn(out, F.row_number().over(window).cast("bigint"))
    if sizes.isEmpty():
        return numbered(df)
    if not group:
        return ranged_rank(df, group, order, out)
    large = land(sizes.select(*[F.col(c).alias(f"_large_{c}") for c in group]), "large_groups")
    same = reduce(and_, (df[c].eqNullSafe(large[f"_large_{c}"]) for c in group))
    return numbered(df.join(large, same, "left_anti")).unionByName(ranged_rank(df.join(large, same, "left_semi"), group, order, out))


def ranged_rank(df: DataFrame, group: list[str], order: list[str], out: str) -> DataFrame:
    """The positions of ``rank_by_range`` by range partitions."""
    keys = [*group, *order]
    ranged = df.select(*keys).repartitionByRange(*keys).withColumn("_range", F.spark_partition_id())
    landed = land(ranged, "ranged")
    # A struct is never NULL, so a NULL group is one too.
    grouped = landed.withColumn("_group", F.struct(*group)) if group else landed
    ranked = rank_by_bucket(grouped, ["_group"] if group else [], F.col("_range"), [F.col(c) for c in order], out)
    named = ranked.select(*[F.col(c).alias(f"_key_{c}") for c in keys], out)
    same = [df[c].eqNullSafe(named[f"_key_{c}"]) for c in keys]
    return df.join(named, same).select(*[df[c] for c in df.columns], F.col(out).cast("bigint").alias(out))


def shuffled_position(df: DataFrame, key: str, seed: int, purpose: str, out: str) -> DataFrame:
    """Position of each row in a seeded shuffle of the whole table; ``key`` is unique."""
    hashed = df.withColumn("_h", draw_hash(seed, purpose, key))
    ranked = rank_by_bucket(hashed, [], F.shiftright("_h", 20), [F.col("_h"), F.col(key)], out)
    return ranked.drop("_h")


def ordered_position(df: DataFrame, key: str, out: str) -> DataFrame:
    """Position of each row when the table is sorted by the unique column ``key``."""
    return rank_by_range(df, [], [key], out)
