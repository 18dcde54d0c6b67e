"""The practice and the real round of the typing and assembly exams from one sheet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqlab.operators.selection import choose_one
from seqlab.plans.errors import Exam
from seqlab.plans.exams import PRACTICE_LABELS, PRACTICE_STS, REAL_LABELS, REAL_STS, assembly_exam, typing_exam
from seqlab.session import land


def exam_set(
    sheet: DataFrame,
    contigs: DataFrame,
    results: DataFrame,
    reads: DataFrame,
    species: str,
    seed: int = 42,
    first: str | None = None,
) -> dict[str, Exam]:
    """Exams by name; the real round uses twice the seed.

    The samples of an assembly exam are those of its typing exam, and its contaminant is one sample of another
    species. ``reads`` and ``contigs`` cover all samples of the sheet.
    """
    exams: dict[str, Exam] = {}
    rounds = {"practice": (PRACTICE_STS, PRACTICE_LABELS, seed), "real": (REAL_STS, REAL_LABELS, 2 * seed)}
    others = sheet.where(F.col("species") != species)
    for name, (sts, labels, round_seed) in rounds.items():
        typing = typing_exam(sheet, contigs, results, species, sts, round_seed)
        samples = land(typing.answers.select(*sheet.columns, "public_name"), "samples")
        contaminant = land(choose_one(others, "sample_name", round_seed, "contaminant"), "contaminant")
        foreign = reads.join(contaminant.select(F.col("sample_name").alias("sample_id")), "sample_id", "left_semi")
        exams[f"typing_{name}"] = typing
        with_file = samples.withColumn("assembly_file", F.concat("public_name", F.lit(".fasta")))
        exams[f"assembly_{name}"] = assembly_exam(reads, with_file, contaminant, foreign, labels, round_seed, first)
    return exams
