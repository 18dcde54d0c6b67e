"""Typing, assembly and outbreak exams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqlab.functions import div
from seqlab.operators.joins import apply_names, enrich_sheet, have_table, unnamed
from seqlab.operators.mixing import own_group, plan_mixture
from seqlab.operators.selection import choose_one, deal_labels, drawn_parameter, sample_groups
from seqlab.operators.sheet import (
    anonymise_contigs,
    blank_sheet,
    content_digest,
    digest_names,
    exam_answer,
    typing_results,
)
from seqlab.plans.damage import corrupt_targets, damage_columns, damage_reads, with_foreign_reads
from seqlab.plans.errors import Exam
from seqlab.session import land

# Error labels of the practice and the real assembly exam (the other samples are NORMAL), the
# number of sequence types of both typing exams, and the suffix of outbreak names.
PRACTICE_LABELS = {"CONTAMINATED": 1}
REAL_LABELS = {"CONTAMINATED": 2, "POOR_QUALITY": 1, "TRUNCATED": 1, "LOW_COVERAGE": 1}
PRACTICE_STS = 5
REAL_STS = 20
OUTBREAK_SUFFIX = "12"


def assembly_names(contigs: DataFrame, samples: DataFrame) -> DataFrame:
    """(sample_name, public_name): digest names over all contigs of each sample."""
    wanted = contigs.join(samples.select(F.col("sample_name").alias("sample_id")), "sample_id", "left_semi")
    digests = content_digest(wanted, "sample_id", "contig_index", "sequence")
    return digest_names(digests.withColumnRenamed("sample_id", "sample_name"), "digest", "sample_name")


def typing_exam(
    sheet: DataFrame, contigs: DataFrame, results: DataFrame, species: str, sts: int = PRACTICE_STS, seed: int = 42
) -> Exam:
    """One sample from each of ``sts`` sequence types, contigs renamed, typing results as answers.

    results: sample_name and the long typing columns. The ``reads`` of this exam are contigs.
    """
    chosen = land(sample_groups(sheet.where(F.col("species") == species), "st", "sample_name", sts, seed), "chosen")
    names = land(assembly_names(contigs, chosen), "names")
    answers = enrich_sheet(apply_names(chosen, names, "sample_name"), typing_results(results, "sample_name"), "sample_name")
    # Contigs are numbered by their keys alone; the sequences are joined to the finished names and not shuffled.
    public = names.select(F.col("sample_name").alias("sample_id"), "public_name")
    keys = contigs.select("sample_id", "contig_index").join(public, "sample_id")
    numbered = land(anonymise_contigs(keys, "public_name", "contig_index"), "contigs")
    renamed = contigs.drop("contig_name").join(numbered, ["sample_id", "contig_index"]).drop("sample_id")
    return Exam(renamed.withColumnRenamed("public_name", "sample_id"), answers, blank_sheet(answers, "typing"))


def exam_parameter(seed: int) -> Column:
    """The drawn parameter of a labelled sample."""
    label = F.col("label")
    return (
        F.when(label == "TRUNCATED", drawn_parameter("exam_truncate_length", seed, "sample_name"))
        .when(label == "LOW_COVERAGE", drawn_parameter("exam_coverage_percent", seed, "sample_name"))
        .when(label == "CONTAMINATED", drawn_parameter("exam_contamination_percent", seed, "sample_name"))
        .when(label == "POOR_QUALITY", drawn_parameter("exam_decrement", seed, "sample_name"))
    )


def assembly_parameters(samples: DataFrame, contaminant: DataFrame, labels: dict[str, int], seed: int = 42) -> DataFrame:
    """Samples with a dealt label, its drawn parameter and the contaminant's name; landed."""
    one = contaminant.first()
    if one is None:
        raise ValueError("No contaminant.")
    dealt = deal_labels(samples, "sample_name", labels, seed)
    return land(
        dealt.withColumns({"parameter": exam_parameter(seed), "contaminant_id": F.lit(one["sample_name"])}), "dealt"
    )


def assembly_answers(params: DataFrame) -> DataFrame:
    files = [F.concat("contaminant_id", F.lit(f"_R{m}.fastq.gz")) for m in (1, 2)]
    answered = params.withColumns(
        {
            **exam_answer(F.col("label"), F.col("parameter"), *files),
            **{f"r{m}": F.concat("public_name", F.lit(f"_R{m}.fastq.gz")) for m in (1, 2)},
        }
    )
    return answered.drop("contaminant_id", "parameter", "label")


def assembly_reads(
    reads: DataFrame, foreign_reads: DataFrame, params: DataFrame, seed: int = 42, first: str | None = None
) -> DataFrame:
    """The reads of all samples, changed by label."""
    samples = params.withColumn("sample_id", F.col("sample_name"))
    label, parameter = F.col("label"), F.col("parameter")
    # Contamination and low coverage are both exact counts: one plan serves them.
    plan = samples.where(label.isin("CONTAMINATED", "LOW_COVERAGE")).select("sample_id", "contaminant_id", "label", "parameter")
    share = div(F.col("pairs") * parameter, F.lit(100))
    foreign = F.when(label == "CONTAMINATED", share).otherwise(F.lit(0).cast("bigint"))
    own = F.when(label == "CONTAMINATED", F.col("pairs") - share).otherwise(share)
    mixture = plan_mixture(reads, foreign_reads, plan, seed, first, foreign, own)
    targets = corrupt_targets(reads, samples.where(label == "CORRUPTED"), seed)

    def only(name: str) -> Column:
        return F.when(label == name, parameter)

    damage = land(
        samples.withColumn("grp", own_group("sample_id"))
        .join(mixture.cuts.select("grp", "cut_h", "cut_key"), "grp", "left")
        .join(targets, "sample_id", "left")
        .select(
            "sample_id",
            *damage_columns(
                truncate_to=only("TRUNCATED"),
                decrement=only("POOR_QUALITY"),
                cut_h=F.col("cut_h"),
                cut_key=F.col("cut_key"),
                corrupt_r1=F.col("pick_r1"),
                corrupt_r2=F.col("pick_r2"),
            ),
        ),
        "damage",
    )
    return with_foreign_reads(damage_reads(reads, damage, seed, degrade=False), foreign_reads, mixture.cuts, seed)


def assembly_exam(
    reads: DataFrame,
    samples: DataFrame,
    contaminant: DataFrame,
    foreign_reads: DataFrame,
    labels: dict[str, int],
    seed: int = 42,
    first: str | None = None,
) -> Exam:
    """Deal error labels to the samples and damage their reads accordingly.

    samples: sample_name, public_name, species, ...; contaminant: one row with sample_name; foreign_reads: its
    reads.
    """
    params = assembly_parameters(samples, contaminant, labels, seed)
    answers = assembly_answers(params)
    names = params.select(F.col("sample_name").alias("sample_id"), "public_name")
    corrupt = params.where(F.col("label") == "CORRUPTED").select(F.col("sample_name").alias("sample_id"), F.explode(F.array(F.lit(1), F.lit(2))).alias("mate"))
    return Exam(assembly_reads(reads, foreign_reads, params, seed, first), answers, blank_sheet(answers, "basic"), names, corrupt)


def choose_tree(trees: DataFrame, tables: DataFrame, stem: str, seed: int = 42) -> DataFrame:
    """One of the trees that have a cluster table of the same stem."""
    return choose_one(have_table(trees, tables, stem), stem, seed, "tree")


def outbreak_sheets(metadata: DataFrame, digests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Answer and blank sheet of an outbreak: digest names for the tips of the tree.

    metadata: Sample, Cluster, Host, ...; digests: Sample, digest (md5 of its genome file).
    """
    names = land(digest_names(digests, "digest", "Sample", OUTBREAK_SUFFIX), "names")
    lost = unnamed(metadata, names, "Sample").select("Sample").limit(1).collect()
    if lost:
        raise ValueError(f"No public name for sample {lost[0][0]}.")
    answers = apply_names(metadata, names, "Sample").withColumns(
        {f"R{m}": F.concat("public_name", F.lit(f"_R{m}.fastq.gz")) for m in (1, 2)}
    )
    return answers, blank_sheet(answers, "outbreak")
