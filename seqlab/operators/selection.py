"""Seeded selection and assignment over sheets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqlab.functions import draw_choice, draw_hash, draw_int, draw_uniform
from seqlab.operators.positions import shuffled_position
from seqlab.operators.sampling import proportion_size

# Error names, the mates that corruption may hit, and the chances in the order they are tried.
ERROR_TYPES = ("TRUNCATED", "CORRUPT", "CONTAMINATED", "POOR_QUALITY", "LOW_COVERAGE")
CORRUPT_MATES = ("r1", "r2", "both")
CHANCE_CONTAMINATED = 0.4
CHANCE_LOW_COVERAGE = 0.2

# Ranges of the per-sample parameters, both ends included.
PARAMETER_RANGES = {
    "truncate_length": (5, 100),
    "contamination_percent": (20, 80),
    "min_quality": (5, 9),
    "max_quality": (10, 20),
    "coverage": (40, 60),
    "exam_truncate_length": (1, 50),
    "exam_coverage_percent": (1, 20),
    "exam_contamination_percent": (60, 90),
    "exam_decrement": (10, 30),
}
LOW_COVERAGE_FRACTION = (0.1, 0.4)


def drawn_parameter(name: str, seed: int, *keys) -> Column:
    low, high = PARAMETER_RANGES[name]
    return draw_int(low, high, seed, name, *keys)


def drawn_fraction(seed: int, *keys) -> Column:
    low, high = LOW_COVERAGE_FRACTION
    return F.lit(low) + draw_uniform(seed, "fraction", *keys) * F.lit(high - low)


def draw_params(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """All per-sample parameters as columns; draws are keyed by sample, so no two samples share them."""
    draws = {name: drawn_parameter(name, seed, key) for name in PARAMETER_RANGES}
    return df.withColumns({**draws, "fraction": drawn_fraction(seed, key)})


def sample_with_topup(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """n rows: without replacement if there are enough, else all rows plus independent extra draws.

    Adds ``replicate``: 0 for the row itself, k for the k-th extra draw of the whole table.
    """
    rows = df.count()
    if n <= rows:
        placed = shuffled_position(df, key, seed, "topup", "_index")
        chosen = placed.where(F.col("_index") <= n).drop("_index")
        return chosen.withColumn("replicate", F.lit(0).cast("bigint"))
    if rows == 0:
        return df.withColumn("replicate", F.lit(0).cast("bigint"))
    indexed = shuffled_position(df, key, seed, "topup", "_index")
    extra = df.sparkSession.range(1, n - rows + 1).select(
        F.col("id").alias("replicate"), draw_int(1, rows, seed, "topup draw", "id").alias("_index")
    )
    drawn = extra.join(indexed, "_index").select(*df.columns, "replicate")
    return df.withColumn("replicate", F.lit(0).cast("bigint")).unionByName(drawn)


def choose_one(df: DataFrame, key: str, seed: int = 42, purpose: str = "choose") -> DataFrame:
    """One row of the table, uniformly."""
    row = F.min_by(F.struct(*df.columns), F.struct(draw_hash(seed, purpose, key), F.col(key)))
    return df.agg(row.alias("r")).where(F.col("r").isNotNull()).select("r.*")


def sample_groups(df: DataFrame, group: str, key: str, k: int, seed: int = 42) -> DataFrame:
    """One random row from each of k randomly chosen groups."""
    row = F.min_by(F.struct(*df.columns), F.struct(draw_hash(seed, "in group", key), F.col(key)))
    per_group = df.groupBy(group).agg(row.alias("r")).select("r.*")
    return per_group.orderBy(draw_hash(seed, "groups", group), F.col(group)).limit(k)


def error_label(seed: int, key: str) -> Column:
    """Weighted error name: first contamination, then low coverage, then any type uniformly."""
    return (
        F.when(draw_uniform(seed, "contaminated", key) < CHANCE_CONTAMINATED, F.lit("CONTAMINATED"))
        .when(draw_uniform(seed, "low coverage", key) < CHANCE_LOW_COVERAGE, F.lit("LOW_COVERAGE"))
        .otherwise(draw_choice(ERROR_TYPES, seed, "error type", key))
    )


def assign_errors(df: DataFrame, key: str, proportion: float, seed: int = 42) -> DataFrame:
    """Give floor(rows * proportion) samples an error; adds qc, error, notes, which replace columns of these names."""
    placed = shuffled_position(df, key, seed, "sample", "_place")
    chosen = F.col("_place") <= proportion_size(df.count(), proportion)
    return placed.select(
        *[c for c in df.columns if c not in ("qc", "error", "notes")],
        F.when(chosen, F.lit("FAILED")).otherwise(F.lit("PASSED")).alias("qc"),
        F.when(chosen, error_label(seed, key)).otherwise(F.lit("NONE")).alias("error"),
        F.when(chosen, F.lit("Error introduced")).otherwise(F.lit("None")).alias("notes"),
    )


def deal_labels(df: DataFrame, key: str, counts: dict[str, int], seed: int = 42, rest: str = "NORMAL") -> DataFrame:
    """Deal a fixed multiset of labels to the rows in seeded random order; the other rows get ``rest``."""
    placed = shuffled_position(df, key, seed, "labels", "_place")
    label, upto = None, 0
    for name, count in counts.items():
        upto += count
        condition = F.col("_place") <= upto
        label = F.when(condition, F.lit(name)) if label is None else label.when(condition, F.lit(name))
    label = F.lit(rest) if label is None else label.otherwise(F.lit(rest))
    return placed.withColumn("label", label).drop("_place")


def deal_pool(
    df: DataFrame, key: str, pool: DataFrame, pool_key: str, seed: int = 42, empty: str = "The pool is empty."
) -> DataFrame:
    """Give every row one pool row, without replacement until the pool is used up, then from the start again."""
    size = pool.count()
    if size == 0:
        raise ValueError(empty)
    placed = shuffled_position(df, key, seed, "deal", "_place")
    slots = shuffled_position(pool, pool_key, seed, "pool", "_slot")
    wanted = placed.withColumn("_slot", (F.col("_place") - 1) % F.lit(size) + 1)
    return wanted.join(slots, "_slot").drop("_slot", "_place")
