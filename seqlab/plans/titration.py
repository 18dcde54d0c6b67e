"""Contamination titration: one main sample, one contaminant, n mixtures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqlab.functions import zfill
from seqlab.operators.joins import strain_candidates
from seqlab.operators.mixing import contamination_series
from seqlab.operators.selection import choose_one
from seqlab.operators.sheet import blank_sheet, contamination_verdict
from seqlab.plans.errors import Exam
from seqlab.session import land


def choose_samples(sheet: DataFrame, species: str, kind: str, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """One main sample of the species, and one contaminant of another species ("Species") or ST ("ST")."""
    main = land(choose_one(sheet.where(F.col("species") == species), "sample_name", seed, "main"), "main")
    if kind == "Species":
        candidates = sheet.where(F.col("species") != species)
    elif kind == "ST":
        candidates = strain_candidates(sheet, main)
    else:
        raise ValueError("Invalid type")
    return main, land(choose_one(candidates, "sample_name", seed, "contaminant"), "contaminant")


def titration_sheet(main: DataFrame, contaminant: DataFrame, steps: int) -> DataFrame:
    """Answer rows of the mixtures: step, public name, percentage, verdict, note."""
    other = contaminant.first()
    if other is None:
        raise ValueError("No contaminant.")
    rows = main.select("*", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step"))
    percent = F.lit(100 / steps) * F.col("step")
    named = rows.withColumns({"percentage": percent, "public_name": F.concat(F.lit("sample"), zfill("step", 2))})
    files = {f"r{m}": F.concat("public_name", F.lit(f"_R{m}.fastq.gz")) for m in (1, 2)}
    note = F.concat(
        F.lit(f"Contamination with {other['species']} - {other['sample_name']} at "),
        F.col("percentage").cast("string"),
        F.lit("%"),
    )
    return named.withColumns({**contamination_verdict("percentage"), "notes": note, **files})


def titration(
    reads: DataFrame, sheet: DataFrame, species: str, kind: str, steps: int = 10, seed: int = 42, first: str | None = None
) -> Exam:
    """Mixtures with 100/steps, 2*100/steps, ..., 100 % foreign pairs, and their sheets."""
    main, contaminant = choose_samples(sheet, species, kind, seed)

    def of(sample: DataFrame) -> DataFrame:
        return reads.join(sample.select(F.col("sample_name").alias("sample_id")), "sample_id", "left_semi")

    series = contamination_series(of(main), of(contaminant), steps, seed, first)
    mixed = series.withColumn("sample_id", F.concat(F.lit("sample"), zfill("step", 2))).drop("step")
    answers = titration_sheet(main, contaminant, steps)
    return Exam(mixed, answers, blank_sheet(answers.withColumn("assembly_file", F.lit("")), "basic"))
