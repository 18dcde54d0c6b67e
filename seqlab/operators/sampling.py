"""Exact-size sampling of pairs and rows, per group, on any partitioning.

The sample of size n of a group is its first n rows in (hash, key) order. Instead of ranking all rows, the
row that closes the sample is found from bucket counts; keeping the sample is then a plain filter, and the
wide rows are never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqlab.functions import div, draw_hash, draw_uniform
from seqlab.operators.positions import rank_by_bucket, shuffled_position
from seqlab.session import land

BUCKET_BITS = 12


def bucket_counts(keys: DataFrame, seed: int, purpose: str) -> DataFrame:
    """(grp, bucket, n): how many pairs of each group fall into each hash bucket; landed, at most 4096 rows a group.

    keys: (grp, key), one row per pair, key unique in its group. This is the only full count of the keys: group
    sizes and closing rows follow from it.
    """
    counts = _bucketed(keys, seed, purpose).groupBy("grp", "bucket").agg(F.count(F.lit(1)).alias("n"))
    return land(counts, "counts")


def _bucketed(keys: DataFrame, seed: int, purpose: str) -> DataFrame:
    hashed = keys.select("grp", "key", draw_hash(seed, purpose, "grp", "key").alias("h"))
    return hashed.withColumn("bucket", F.shiftright("h", 32 - BUCKET_BITS))


def group_sizes(counts: DataFrame) -> DataFrame:
    """(grp, pairs) from bucket counts."""
    return counts.groupBy("grp").agg(F.sum("n").alias("pairs"))


def sampling_cuts(keys: DataFrame, counts: DataFrame, quotas: DataFrame, seed: int, purpose: str) -> DataFrame:
    """Closing row of each wanted sample: (grp, slot, taken, cut_h, cut_key), one row per quota.

    quotas: (grp, slot, quota); one group can have many slots, which gives nested samples. A group smaller than
    its quota is kept whole, and cut_h is -1 where nothing is kept.
    """
    upto = Window.partitionBy("grp").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    prefix = counts.select(
        "grp",
        "bucket",
        "n",
        F.sum("n").over(upto).alias("upto"),
        F.sum("n").over(Window.partitionBy("grp")).alias("total"),
    )
    want = F.least("quota", "total")
    wanted = (
        prefix.join(quotas, "grp")
        .where((want > F.col("upto") - F.col("n")) & (want <= F.col("upto")))
        .select("grp", "slot", "bucket", (want - F.col("upto") + F.col("n")).alias("nth"), want.alias("taken"))
    )
    wanted = land(wanted, "wanted")
    # Only the buckets that hold a closing row are ranked: one in 4096 of a group, narrow rows. They are split by
    # the next hash bits once more, so that no task ranks more than a 2**24th of a group.
    edge = _bucketed(keys, seed, purpose).join(wanted.select("grp", "bucket"), ["grp", "bucket"], "left_semi")
    ranked = rank_by_bucket(
        land(edge, "edge"), ["grp", "bucket"], F.shiftright("h", 32 - 2 * BUCKET_BITS), [F.col("h"), F.col("key")], "nth"
    )
    found = ranked.join(wanted, ["grp", "bucket", "nth"]).select(
        "grp", "slot", "taken", F.col("h").alias("cut_h"), F.col("key").alias("cut_key")
    )
    cuts = quotas.select("grp", "slot").join(found, ["grp", "slot"], "left")
    return land(
        cuts.select(
            "grp",
            "slot",
            F.coalesce("taken", F.lit(0).cast("bigint")).alias("taken"),
            F.coalesce("cut_h", F.lit(-1).cast("bigint")).alias("cut_h"),
            "cut_key",
        ),
        "cuts",
    )


def within_cut(h: Column, key: Column) -> Column:
    """Whether a row with hash ``h`` belongs to the sample closed by columns cut_h, cut_key."""
    return (h < F.col("cut_h")) | ((h == F.col("cut_h")) & (key <= F.col("cut_key")))


def subsample_fraction(df: DataFrame, key: str, fraction, seed: int = 42) -> DataFrame:
    """Keep each pair with the given probability (number or column); all rows of a pair share the decision."""
    if not isinstance(fraction, (Column, str)) and not 0 < fraction <= 1:
        raise ValueError("Subsample fraction must be between 0 and 1.")
    wanted = F.col(fraction) if isinstance(fraction, str) else fraction
    return df.where(draw_uniform(seed, "fraction", key) < wanted)


def pair_keys(df: DataFrame, group, key: str, first: str | None = None) -> DataFrame:
    """(grp, key) with one row per pair.

    ``first`` is a condition that holds for exactly one row of every pair (its first mate); without it the keys are made
    distinct, which costs a shuffle of the keys.
    """
    source = df if first is None else df.where(first)
    keys = source.select(group.alias("grp"), F.col(key).alias("key"))
    return keys.distinct() if first is None else keys


def subsample_count(df: DataFrame, key: str, n: int, seed: int = 42, first: str | None = None) -> DataFrame:
    """Keep exactly n pairs of the whole table (all of them if there are fewer)."""
    quotas = df.sparkSession.range(1).select(
        F.lit("all").alias("grp"), F.lit("all").alias("slot"), F.lit(n).cast("bigint").alias("quota")
    )
    keys = pair_keys(df, F.lit("all"), key, first)
    cut = sampling_cuts(keys, bucket_counts(keys, seed, "count"), quotas, seed, "count").first()
    # One group has one closing row: it becomes a constant of the filter.
    h = draw_hash(seed, "count", F.lit("all"), key)
    return df.where((h < cut.cut_h) | ((h == cut.cut_h) & (F.col(key) <= F.lit(cut.cut_key))))


def subsample_quota(
    df: DataFrame, group: str, key: str, quotas: DataFrame, seed: int = 42, first: str | None = None
) -> DataFrame:
    """Keep exactly ``quota`` pairs of each group; quotas: (grp, slot, quota) with one slot per group.

    ``df`` may hold several rows per pair (mates): pairs are counted once and kept or dropped whole.
    """
    keys = pair_keys(df, F.col(group), key, first)
    return _keep(df, group, key, keys, bucket_counts(keys, seed, "count"), quotas, seed)


def subsample_share(
    df: DataFrame, group: str, key: str, quota: Callable[[DataFrame], DataFrame], seed: int = 42, first: str | None = None
) -> DataFrame:
    """As ``subsample_quota``, with quotas that depend on the group sizes: ``quota`` maps (grp, pairs) to
    (grp, slot, quota)."""
    keys = pair_keys(df, F.col(group), key, first)
    counts = bucket_counts(keys, seed, "count")
    return _keep(df, group, key, keys, counts, quota(group_sizes(counts)), seed)


def _keep(df: DataFrame, group: str, key: str, keys: DataFrame, counts: DataFrame, quotas: DataFrame, seed: int) -> DataFrame:
    cuts = sampling_cuts(keys, counts, quotas, seed, "count")
    named = cuts.select(F.col("grp").alias(group), "cut_h", "cut_key")
    kept = df.join(named, group).where(within_cut(draw_hash(seed, "count", group, key), F.col(key)))
    return kept.select(*df.columns)


def low_coverage(
    df: DataFrame, group: str, key: str, percent: DataFrame, seed: int = 42, first: str | None = None
) -> DataFrame:
    """Keep ``percent`` % of the pairs of each group by count; percent: (grp, percent)."""

    def quota(sizes: DataFrame) -> DataFrame:
        share = div(F.col("pairs") * F.col("percent"), F.lit(100))
        return sizes.join(percent, "grp").select("grp", F.lit("all").alias("slot"), share.alias("quota"))

    return subsample_share(df, group, key, quota, seed, first)


def sample_n(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """n rows without replacement, for a small fixed n; ``key`` is unique."""
    h = draw_hash(seed, "sample", key)
    return df.orderBy(h, F.col(key)).limit(n)


def proportion_size(rows: int, proportion: float) -> int:
    """floor(rows * proportion)."""
    return int(rows * proportion)


def sample_proportion(df: DataFrame, proportion: float, key: str, seed: int = 42) -> DataFrame:
    """floor(rows * proportion) rows without replacement, for sheets; no single task holds the sample."""
    placed = shuffled_position(df, key, seed, "sample", "_place")
    return placed.where(F.col("_place") <= proportion_size(df.count(), proportion)).drop("_place")
