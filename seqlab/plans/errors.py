"""Introduce errors over a whole sheet and its reads in one job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqlab.functions import draw_choice
from seqlab.operators.joins import contaminant_pool
from seqlab.operators.mixing import own_group, plan_mixture
from seqlab.operators.selection import CORRUPT_MATES, assign_errors, deal_pool, drawn_fraction, drawn_parameter
from seqlab.operators.sheet import blank_sheet, number_samples
from seqlab.plans.damage import corrupt_targets, damage_columns, damage_reads, with_foreign_reads
from seqlab.session import land
from seqlab.sources.sinks import write_contig_files, write_read_files, write_sheet


@dataclass
class Exam:
    """Reads (or contigs), the answer sheet, and the participant's sheet of one exam.

    names: (sample_id, public_name) of the reads if they are under the hidden names; corrupt: (sample_id, mate) of the read files
    that are to be damaged, by the name in ``reads``; mixed: the planned mixtures (sample_id, contaminant_id, pct, pairs, n_own, n_foreign).
    """

    reads: DataFrame
    answers: DataFrame
    blank: DataFrame
    names: DataFrame | None = None
    corrupt: DataFrame | None = None
    mixed: DataFrame | None = None

    def published(self, table: DataFrame) -> DataFrame:
        """A table of sample_ids under the public names."""
        if self.names is None:
            return table
        return table.join(self.names, "sample_id").drop("sample_id").withColumnRenamed("public_name", "sample_id")

    def write(self, path: str, seed: int = 42) -> DataFrame | None:
        """The files that the sheets name, in ``reads`` or ``contigs``, and the sheets; no path holds a hidden name or an origin.

        Returns the audit of the read files, a row for each sample under its public name: the pairs written, got_own and
        got_foreign, beside what was planned if it is a mixture. It is made from the counts of the writing, without another pass.
        """
        audit = None
        if "contig_name" in self.reads.columns:
            write_contig_files(self.published(self.reads), f"{path}/contigs")
        else:
            corrupt = None if self.corrupt is None else self.published(self.corrupt)
            audit = self.audit(write_read_files(self.published(self.reads), f"{path}/reads", corrupt, seed))
        write_sheet(self.answers, f"{path}/answer_sheet", order_by="public_name")
        first = self.blank.columns[0]
        write_sheet(self.blank, f"{path}/sample_sheet", order_by=first)
        return audit

    def audit(self, files: DataFrame) -> DataFrame:
        """(sample_id, got_own, got_foreign, planned columns) of written files; the mate with more reads gives the pairs."""
        sample = F.regexp_replace("target", r"_R\d+\.fastq\.gz$", "").alias("sample_id")
        got = files.groupBy(sample).agg(F.max("own").alias("got_own"), F.max("foreign").alias("got_foreign"))
        return got if self.mixed is None else got.join(self.published(self.mixed), "sample_id", "left")


def one_output_per_row(sheet: DataFrame, reads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A dataset sheet and its reads for ``introduce_errors``: every row has its own name, and its own copy of the reads.

    ``sheet`` has sample_name, which may repeat, and public_name, which does not and becomes the sample_name.
    """
    copies = sheet.select(F.col("sample_name").alias("sample_id"), F.col("public_name").alias("_copy"))
    own = reads.join(copies, "sample_id").withColumn("sample_id", F.col("_copy")).select(*reads.columns)
    return sheet.withColumn("sample_name", F.col("public_name")).drop("public_name"), own


def error_parameters(sheet: DataFrame, contaminants: DataFrame, proportion: float, seed: int, order_by: str = "sample_name") -> DataFrame:
    """Sheet with public name, error, drawn parameters and, for contaminated samples, the contaminant.

    Public names follow ``order_by``, a unique column of the sheet. Reads are found by sample_name, so it must not repeat.
    """
    twice = sheet.groupBy("sample_name").count().where("count > 1").first()
    if twice:
        raise ValueError(f"Sample {twice['sample_name']} occurs {twice['count']} times; see one_output_per_row.")
    pool = land(contaminant_pool(contaminants, sheet).select(F.col("sample_name").alias("contaminant")), "pool")
    labelled = assign_errors(number_samples(sheet.drop("public_name"), order_by), "sample_name", proportion, seed)
    contaminated = labelled.where(F.col("error") == "CONTAMINATED").select("sample_name")
    dealt = deal_pool(contaminated, "sample_name", pool, "contaminant", seed, "No contaminants found in the contamination list.")
    draws = {
        name: drawn_parameter(name, seed, "sample_name")
        for name in ("truncate_length", "contamination_percent", "min_quality", "max_quality")
    }
    given = labelled.join(dealt, "sample_name", "left")
    given = given.withColumns({**draws, "fraction": drawn_fraction(seed, "sample_name")})
    return land(given.withColumn("corrupt_mates", draw_choice(CORRUPT_MATES, seed, "corrupt mates", "sample_name")), "parameters")


def error_notes() -> Column:
    """Note text of the answer sheet, by error."""
    error = F.col("error")
    return (
        F.when(error == "NONE", F.lit("No changes."))
        .when(error == "TRUNCATED", F.format_string("Truncated reads to %d bp", "truncate_length"))
        .when(error == "CORRUPT", F.concat(F.lit("Corrupted "), F.when(F.col("corrupt_mates") == "both", F.lit("both reads")).otherwise(F.col("corrupt_mates"))))
        .when(error == "CONTAMINATED", F.format_string("Contaminated with %s at %d%%", "contaminant", "contamination_percent"))
        .when(
            error == "POOR_QUALITY",
            F.format_string("Error introduced Quality degraded to %d-%d", "min_quality", "max_quality"),
        )
        .when(error == "LOW_COVERAGE", F.concat(F.lit("Low coverage at "), two_places(F.col("fraction"))))
    )


def two_places(value: Column) -> Column:
    """A number below one with two decimals, rounded half to even, trailing zeros cut to one decimal at least."""
    return F.bround(value, 2).cast("string")


def error_answers(params: DataFrame, columns: list[str]) -> DataFrame:
    """The answer sheet: the sheet's own columns, public name, file names, verdict and note; these win over the sheet's."""
    made = {"public_name", "r1", "r2", "qc", "error", "notes"}
    return params.withColumn("notes", error_notes()).select(
        *[c for c in columns if c not in made],
        "public_name",
        F.concat("public_name", F.lit("_R1.fastq.gz")).alias("r1"),
        F.concat("public_name", F.lit("_R2.fastq.gz")).alias("r2"),
        "qc",
        "error",
        "notes",
    )


def damaged_reads(
    reads: DataFrame, foreign_reads: DataFrame, params: DataFrame, seed: int, first: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """The reads of all samples with the errors of ``params``, and the planned mixtures."""
    error = F.col("error")
    samples = params.withColumn("sample_id", F.col("sample_name"))
    plan = samples.where(error == "CONTAMINATED").select(
        "sample_id", F.col("contaminant").alias("contaminant_id"), F.col("contamination_percent").alias("pct")
    )
    mixture = plan_mixture(reads, foreign_reads, plan, seed, first)
    targets = corrupt_targets(reads, samples.where(error == "CORRUPT"), seed)

    def only(name: str, column: str) -> Column:
        return F.when(error == name, F.col(column))

    damage = land(
        samples.withColumn("grp", own_group("sample_id"))
        .join(mixture.cuts.select("grp", "cut_h", "cut_key"), "grp", "left")
        .join(targets, "sample_id", "left")
        .select(
            "sample_id",
            *damage_columns(
                truncate_to=only("TRUNCATED", "truncate_length"),
                min_q=only("POOR_QUALITY", "min_quality"),
                max_q=only("POOR_QUALITY", "max_quality"),
                keep_fraction=only("LOW_COVERAGE", "fraction"),
                cut_h=F.col("cut_h"),
                cut_key=F.col("cut_key"),
                corrupt_r1=F.when(F.col("corrupt_mates") != "r2", F.col("pick_r1")),
                corrupt_r2=F.when(F.col("corrupt_mates") != "r1", F.col("pick_r2")),
            ),
        ),
        "damage",
    )
    return with_foreign_reads(damage_reads(reads, damage, seed), foreign_reads, mixture.cuts, seed), mixture.sized


def introduce_errors(
    reads: DataFrame,
    sheet: DataFrame,
    contaminants: DataFrame,
    foreign_reads: DataFrame,
    proportion: float = 0.6,
    seed: int = 42,
    first: str | None = None,
    order_by: str = "sample_name",
) -> Exam:
    """Damage the reads of a share of the samples and write down what was done.

    sheet: sample_name, species, ... (sample_name is the sample_id of ``reads``); contaminants: sample_name,
    species, assembly; foreign_reads: reads whose sample_id is a contaminant's sample_name.
    """
    params = error_parameters(sheet, contaminants, proportion, seed, order_by)
    answers = error_answers(params, sheet.columns)
    mates = F.when(F.col("corrupt_mates") == "both", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.substring("corrupt_mates", 2, 1).cast("int")))
    corrupt = params.where(F.col("error") == "CORRUPT").select(F.col("sample_name").alias("sample_id"), F.explode(mates).alias("mate"))
    names = params.select(F.col("sample_name").alias("sample_id"), "public_name")
    made, mixed = damaged_reads(reads, foreign_reads, params, seed, first)
    return Exam(made, answers, blank_sheet(answers), names, corrupt, mixed)
