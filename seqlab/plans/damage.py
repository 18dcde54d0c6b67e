"""Apply every sample's error to its reads in one pass.

All errors of all samples are columns of one small parameter table; NULL means "not applied". The reads are
joined with it once and changed by column expressions, whatever mix of errors the samples have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqlab.functions import draw_hash, draw_uniform, scale_hash
from seqlab.operators.mixing import foreign_reads, within_own_cut
from seqlab.operators.reads import decremented_quality, degraded_quality, overwritten, truncated

DAMAGE = {
    "truncate_to": "int",
    "min_q": "int",
    "max_q": "int",
    "decrement": "int",
    "keep_fraction": "double",
    "cut_h": "bigint",
    "cut_key": "bigint",
    "corrupt_r1": "bigint",
    "corrupt_r2": "bigint",
}


def damage_columns(**given: Column) -> list[Column]:
    """The damage columns of a parameter table; those that are not given are NULL."""
    return [given.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in DAMAGE.items()]


def corrupt_targets(reads: DataFrame, samples: DataFrame, seed: int) -> DataFrame:
    """One uniformly chosen pair id per mate of each given sample: where a byte will be overwritten."""
    place = F.struct(draw_hash(seed, "corrupt read", "sample_id", "pair_id", "mate").alias("h"), F.col("pair_id"))
    chosen = reads.select("sample_id", "pair_id", "mate").join(samples.select("sample_id"), "sample_id", "left_semi")
    picks = [F.min(F.when(F.col("mate") == m, place))["pair_id"].alias(f"pick_r{m}") for m in (1, 2)]
    return chosen.groupBy("sample_id").agg(*picks)


def damage_reads(
    reads: DataFrame, params: DataFrame, seed: int, marker: str = "\x00", degrade: bool = True, mates: tuple[int, ...] = (1, 2)
) -> DataFrame:
    """Reads of the samples in ``params`` (sample_id and the damage columns), changed; ``origin`` is host.

    Only the reads of samples that have a min_q go through Python for their qualities, and none without ``degrade``.
    Truncation hits the given ``mates``.
    """
    if degrade:
        poor = F.col("min_q").isNotNull()
        low, rest = params.where(poor), params.where(~poor)
        return _damaged(reads, low, seed, marker, True, mates).unionByName(_damaged(reads, rest, seed, marker, False, mates))
    return _damaged(reads, params, seed, marker, False, mates)


def _damaged(reads: DataFrame, params: DataFrame, seed: int, marker: str, degrade: bool, mates: tuple[int, ...]) -> DataFrame:
    joined = reads.join(params.select("sample_id", *DAMAGE), "sample_id")
    fraction_ok = F.col("keep_fraction").isNull() | (
        draw_uniform(seed, "keep", "sample_id", "pair_id") < F.col("keep_fraction")
    )
    cut_ok = F.col("cut_h").isNull() | within_own_cut(seed)
    kept = joined.where(fraction_ok & cut_ok)

    sequence, quality = F.col("sequence"), F.col("quality")
    h = draw_hash(seed, "quality", "sample_id", "pair_id", "mate")
    cut = F.col("truncate_to").isNotNull() & F.col("mate").isin(*mates)
    if degrade:
        quality = degraded_quality(sequence, h, F.col("min_q"), F.col("max_q"))
    else:
        quality = (
            F.when(F.col("decrement").isNotNull(), decremented_quality(quality, F.col("decrement")))
            .when(cut, truncated(quality, F.col("truncate_to")))
            .otherwise(quality)
        )
    hit = ((F.col("mate") == 1) & (F.col("pair_id") == F.col("corrupt_r1"))) | (
        (F.col("mate") == 2) & (F.col("pair_id") == F.col("corrupt_r2"))
    )
    size = F.length("sequence")
    position = scale_hash(draw_hash(seed, "corrupt base", "sample_id", "pair_id", "mate"), 1, size)
    sequence = (
        F.when(cut, truncated(sequence, F.col("truncate_to")))
        .when(hit & (size > 0), overwritten(sequence, position, marker))
        .otherwise(sequence)
    )
    changed = {"sequence": sequence, "quality": quality}
    columns = [changed[c].alias(c) if c in changed else F.col(c) for c in reads.columns]
    return kept.select(*columns, F.lit("host").alias("origin"))


def with_foreign_reads(damaged: DataFrame, contaminants: DataFrame, cuts: DataFrame, seed: int) -> DataFrame:
    """Append the sampled foreign reads of the contaminated samples."""
    return foreign_reads(contaminants, cuts, seed).withColumn("origin", F.lit("contaminant")).unionByName(damaged)
