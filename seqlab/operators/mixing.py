"""Mixing foreign reads into samples, and titration series."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqlab.functions import div, draw_hash
from seqlab.operators.sampling import bucket_counts, group_sizes, pair_keys, sampling_cuts, within_cut
from seqlab.session import land

PURPOSE = "mix"


def own_group(sample) -> Column:
    return F.concat(F.lit("own|"), F.col(sample).cast("string"))


def foreign_group(sample) -> Column:
    return F.concat(F.lit("foreign|"), F.col(sample).cast("string"))


@dataclass
class Mixture:
    """Sampled sides of planned mixtures: target counts per sample, and the closing rows of both sides."""

    sized: DataFrame
    cuts: DataFrame


def plan_mixture(
    host: DataFrame,
    contaminants: DataFrame,
    plan: DataFrame,
    seed: int,
    first: str | None = None,
    n_foreign: Column | None = None,
    n_own: Column | None = None,
) -> Mixture:
    """plan: (sample_id, contaminant_id, pct, ...), a small table read from storage.

    The total stays the number of host pairs, a fractional foreign count is rounded down; other counts can be given
    as expressions over ``pairs`` and the plan's columns. A contaminant set that serves several samples is ranked
    once; ``slot`` is the sample that receives the reads.
    """
    own_keys = host.join(plan.select("sample_id"), "sample_id", "left_semi")
    foreign_keys = contaminants.join(plan.select(F.col("contaminant_id").alias("sample_id")), "sample_id", "left_semi")
    keys = pair_keys(own_keys, own_group("sample_id"), "pair_id", first).unionByName(
        pair_keys(foreign_keys, foreign_group("sample_id"), "pair_id", first)
    )
    counts = bucket_counts(keys, seed, PURPOSE)
    foreign = div(F.col("pairs") * F.col("pct"), F.lit(100)) if n_foreign is None else n_foreign
    own = F.col("pairs") - foreign if n_own is None else n_own
    sizes = group_sizes(counts)
    sized = (
        plan.withColumn("grp", own_group("sample_id"))
        .join(sizes, "grp")
        .select(*plan.columns, "pairs", own.alias("n_own"), foreign.alias("n_foreign"))
    )

    def quotas(grp: Column, quota: str) -> DataFrame:
        return sized.select(grp.alias("grp"), F.col("sample_id").alias("slot"), F.col(quota).alias("quota"))

    wanted = quotas(own_group("sample_id"), "n_own").unionByName(quotas(foreign_group("contaminant_id"), "n_foreign"))
    return Mixture(sized, sampling_cuts(keys, counts, wanted, seed, PURPOSE))


def within_own_cut(seed: int) -> Column:
    return within_cut(draw_hash(seed, PURPOSE, own_group("sample_id"), "pair_id"), F.col("pair_id"))


def join_cuts(reads: DataFrame, grp: Column, cuts: DataFrame, seed: int) -> DataFrame:
    """Reads within the closing rows of their group, one copy per slot, with the columns of ``cuts``.

    The hash is taken before the join: once per read, however many samples a contaminant serves.
    """
    hashed = reads.withColumn("grp", grp).withColumn("_h", draw_hash(seed, PURPOSE, "grp", "pair_id"))
    return hashed.join(cuts, "grp").where(within_cut(F.col("_h"), F.col("pair_id")))


def foreign_reads(contaminants: DataFrame, cuts: DataFrame, seed: int) -> DataFrame:
    """The sampled foreign reads, one copy per receiving sample, under that sample's id."""
    kept = join_cuts(contaminants, foreign_group("sample_id"), cuts, seed)
    return kept.select(F.col("slot").alias("sample_id"), *[c for c in contaminants.columns if c != "sample_id"])


def mix_contaminant(
    host: DataFrame, contaminants: DataFrame, plan: DataFrame, seed: int = 42, first: str | None = None
) -> tuple[DataFrame, Mixture]:
    """Replace pct % of the pairs of each planned sample by pairs of its contaminant.

    Adds ``origin``: contaminant or host. Samples without a plan row are not in the result.
    """
    mixture = plan_mixture(host, contaminants, land(plan, "plan"), seed, first)
    own = join_cuts(host, own_group("sample_id"), mixture.cuts, seed)
    own = own.select(*host.columns, F.lit("host").alias("origin"))
    foreign = foreign_reads(contaminants, mixture.cuts, seed).withColumn("origin", F.lit("contaminant"))
    return foreign.unionByName(own), mixture


def mixing_audit(mixed: DataFrame, sized: DataFrame, first: str | None = None) -> DataFrame:
    """Expected and obtained pair counts of each mixed sample."""
    one = F.expr(first or "true")
    got = mixed.groupBy("sample_id").agg(
        F.count(F.when((F.col("origin") == "host") & one, 1)).alias("got_own"),
        F.count(F.when((F.col("origin") == "contaminant") & one, 1)).alias("got_foreign"),
    )
    return sized.join(got, "sample_id", "left").select(
        "sample_id",
        "contaminant_id",
        "pct",
        "pairs",
        "n_own",
        "n_foreign",
        F.coalesce("got_own", F.lit(0)).alias("got_own"),
        F.coalesce("got_foreign", F.lit(0)).alias("got_foreign"),
    )


def contamination_series(
    host: DataFrame, contaminant: DataFrame, steps: int, seed: int = 42, first: str | None = None
) -> DataFrame:
    """Samples 1..steps with 100/steps * step % foreign pairs, the last one fully foreign.

    Both sides are ranked once for all steps. Adds ``step`` and ``origin``.
    """
    keys = pair_keys(host, F.lit("own"), "pair_id", first).unionByName(
        pair_keys(contaminant, F.lit("foreign"), "pair_id", first)
    )
    counts = bucket_counts(keys, seed, PURPOSE)
    pairs = counts.where(F.col("grp") == "own").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("pairs"))
    sized = pairs.select("pairs", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step"))
    foreign = div(F.col("pairs") * F.col("step"), F.lit(steps))

    def quotas(grp: str, quota: Column) -> DataFrame:
        return sized.select(F.lit(grp).alias("grp"), F.col("step").cast("string").alias("slot"), quota.alias("quota"))

    wanted = quotas("own", F.col("pairs") - foreign).unionByName(quotas("foreign", foreign))
    cuts = sampling_cuts(keys, counts, wanted, seed, PURPOSE)

    def expand(reads: DataFrame, grp: str, origin: str) -> DataFrame:
        kept = join_cuts(reads, F.lit(grp), cuts, seed)
        return kept.select(F.col("slot").cast("int").alias("step"), *reads.columns, F.lit(origin).alias("origin"))

    return expand(contaminant, "foreign", "contaminant").unionByName(expand(host, "own", "host"))
