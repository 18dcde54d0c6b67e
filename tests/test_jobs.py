import gzip
from collections import Counter

import pytest
from pyspark.sql import functions as F

from seqlab.operators.mixing import mixing_audit
from seqlab.plans import errors, exams, titration
from seqlab.plans.damage import DAMAGE
from seqlab.session import land
from seqlab.sources import read_sheet
from seqlab.streaming import damage_stream, land_stream

FIRST = "mate = 1"


@pytest.fixture
def sheet(spark):
    return spark.createDataFrame([(f"s{i:02}", "sp1", f"ST{i % 6}") for i in range(24)], "sample_name string, species string, st string")


@pytest.fixture
def contaminants(spark):
    rows = [("x", "sp2", "GCA_1"), ("y", "sp3", "GCA_2"), ("own", "sp1", "GCA_3"), ("bare", "sp4", None)]
    return spark.createDataFrame(rows, "sample_name string, species string, assembly string")


def test_introduce_errors(spark, tmp_path, sheet, contaminants, make_reads):
    reads = make_reads({f"s{i:02}": 40 for i in range(24)})
    foreign = make_reads({"x": 60, "y": 60, "own": 5})
    exam = errors.introduce_errors(reads, sheet, contaminants, foreign, 0.9, 2, FIRST)
    answers = {r.sample_name: r for r in exam.answers.collect()}
    assert len(answers) == 24 and sum(r.qc == "FAILED" for r in answers.values()) == 21
    assert sorted(r.public_name for r in answers.values()) == [f"sample{i:02}" for i in range(1, 25)]
    assert {r.QC for r in exam.blank.collect()} == {"Unknown"}

    before = {(r.sample_id, r.pair_id, r.mate): r for r in reads.collect()}
    rows = exam.reads.collect()
    by_sample = {}
    for r in rows:
        by_sample.setdefault(r.sample_id, []).append(r)
    seen = Counter(a.error for a in answers.values())
    assert len(seen) == 6
    for name, answer in answers.items():
        mine = by_sample[name]
        assert Counter(r.mate for r in mine)[1] == Counter(r.mate for r in mine)[2]
        if answer.error == "NONE":
            assert answer.notes == "No changes." and all(before[(name, r.pair_id, r.mate)][:7] == tuple(r)[:7] for r in mine)
        elif answer.error == "TRUNCATED":
            n = int(answer.notes.split()[-2])
            assert all(len(r.sequence) == len(r.quality) == min(n, 12) for r in mine)
        elif answer.error == "CORRUPT":
            hit = {"both reads": {1: 1, 2: 1}, "r1": {1: 1}, "r2": {2: 1}}[answer.notes.removeprefix("Corrupted ")]
            assert Counter(r.mate for r in mine if "\x00" in r.sequence) == hit
        elif answer.error == "CONTAMINATED":
            percent = int(answer.notes.split()[-1][:-1])
            origin = Counter(r.origin for r in mine if r.mate == 1)
            assert 20 <= percent <= 80 and origin["contaminant"] == 40 * percent // 100 and sum(origin.values()) == 40
            assert {r.header[1] for r in mine if r.origin == "contaminant"} <= {"x", "y"}
        elif answer.error == "POOR_QUALITY":
            low, high = map(int, answer.notes.split()[-1].split("-"))
            scores = {ord(c) - 33 for r in mine for c in r.quality}
            assert min(scores) >= low and max(scores) <= high and all(len(r.quality) == 12 for r in mine)
        else:
            assert answer.error == "LOW_COVERAGE" and 0 < len(mine) < 50

    audit = exam.write(str(tmp_path / "exam")).collect()
    wanted = {r.sample_id: r for r in mixing_audit(exam.reads, exam.mixed, "mate = 1").collect()}
    own_names = {r.public_name: r.sample_id for r in exam.names.collect()}
    assert len(audit) == len(answers) and sum(r.n_own is not None for r in audit) == len(wanted) > 0
    for r in audit:
        mine = by_sample[own_names[r.sample_id]]
        assert (r.got_own, r.got_foreign) == tuple(sum(x.origin == o and x.mate == 1 for x in mine) for o in ("host", "contaminant"))
        if r.n_own is not None:
            same = wanted[own_names[r.sample_id]]
            assert all(r[c] == same[c] for c in ("contaminant_id", "pct", "pairs", "n_own", "n_foreign", "got_own", "got_foreign"))
    back = spark.read.format("fastq").load(str(tmp_path / "exam" / "reads"))
    corrupt = {(r.sample_id, r.mate) for r in exam.published(exam.corrupt).collect()}
    names = {r.public_name: r.sample_name for r in exam.answers.collect()}
    by_name = Counter((r.sample_id, r.mate) for r in rows)
    for sheet in ("answer_sheet", "sample_sheet"):
        for row in read_sheet(spark, str(tmp_path / "exam" / sheet)).collect():
            public, *files = (row[c] for c in (("public_name", "r1", "r2") if sheet == "answer_sheet" else ("ID", "R1", "R2")))
            for mate, file in zip((1, 2), files):
                path = tmp_path / "exam" / "reads" / file
                assert path.exists() and file == f"{public}_R{mate}.fastq.gz"
                if (public, mate) not in corrupt:
                    assert gzip.open(path, "rt").read().count("\n") == 4 * by_name[names[public], mate]
    paths = " ".join(str(p.relative_to(tmp_path)) for p in (tmp_path / "exam" / "reads").rglob("*"))
    assert "origin" not in paths and "host" not in paths and not any(f"{n}_" in paths for n in names.values())
    assert set(back.columns) == {"sample_id", "pair_id", "mate", "header", "sequence", "plus", "quality"}


def test_result_does_not_depend_on_partitions_or_order(spark, sheet, contaminants, make_reads):
    results = []
    for parts in (1, 17):
        reads = make_reads({f"s{i:02}": 9 for i in range(24)}, parts)
        exam = errors.introduce_errors(reads, sheet.repartition(parts), contaminants, make_reads({"x": 9, "y": 9}, parts), 0.6, 42, FIRST)
        results.append((sorted(map(tuple, exam.reads.collect())), sorted(map(tuple, exam.answers.collect()))))
    assert results[0] == results[1]


def test_order_of_the_sheet(spark, contaminants):
    sheet = spark.createDataFrame([(0, "z_last", "sp1"), (1, "a_first", "sp1"), (2, "m", "sp1")], "place long, sample_name string, species string")
    named = errors.error_parameters(sheet, contaminants, 0.0, 42, order_by="place").collect()
    assert {r.sample_name: r.public_name for r in named} == {"z_last": "sample01", "a_first": "sample02", "m": "sample03"}


def test_repeated_names(spark, sheet, contaminants, make_reads):
    twice = sheet.union(sheet.limit(1))
    with pytest.raises(ValueError, match="s00 occurs 2 times"):
        errors.error_parameters(twice, contaminants, 0.6, 42)
    rows = [("s00", "s00", "sp1", "x"), ("s00", "s00_1", "sp1", "x"), ("s01", "s01", "sp1", "x")]
    made = spark.createDataFrame(rows, "sample_name string, public_name string, species string, qc string")
    one, reads = errors.one_output_per_row(made, make_reads({"s00": 10, "s01": 7}))
    exam = errors.introduce_errors(reads, one, contaminants, make_reads({"x": 5, "y": 5}), 0.0, 42, FIRST)
    assert Counter(r.sample_id for r in exam.reads.collect()) == {"s00": 20, "s00_1": 20, "s01": 14}
    assert exam.answers.columns.count("qc") == 1 and exam.answers.count() == 3


def test_other_exams_are_written_under_public_names(spark, tmp_path, sheet, make_reads):
    reads = make_reads({f"s{i:02}": 20 for i in range(6)})
    samples = sheet.limit(6).withColumns({"public_name": F.concat(F.lit("P"), "sample_name"), "assembly_file": F.lit("")})
    contaminant = spark.createDataFrame([("x",)], "sample_name string")
    labels = {"CONTAMINATED": 1, "CORRUPTED": 1}
    exam = exams.assembly_exam(reads, samples, contaminant, make_reads({"x": 20}), labels, 42, FIRST)
    plan = exam.reads._jdf.queryExecution().toString()
    assert "ArrowEvalPython" not in plan
    exam.write(str(tmp_path / "a"))
    assert sorted(p.name for p in (tmp_path / "a" / "reads").glob("P*")) == sorted(f"Ps{i:02}_R{m}.fastq.gz" for i in range(6) for m in (1, 2))
    other = spark.createDataFrame([("o1", "sp9", "ST1")], sheet.schema)
    steps = titration.titration(make_reads({f"s{i:02}": 20 for i in range(24)} | {"o1": 20}), sheet.unionByName(other), "sp1", "Species", 3, 42, FIRST)
    steps.write(str(tmp_path / "t"))
    assert sorted(p.name for p in (tmp_path / "t" / "reads").glob("s*")) == [f"sample0{i}_R{m}.fastq.gz" for i in (1, 2, 3) for m in (1, 2)]


def test_no_contaminant_is_an_error(spark, sheet, contaminants):
    with pytest.raises(ValueError, match="No contaminants found in the contamination list."):
        errors.error_parameters(sheet, contaminants.where("species = 'sp1'"), 0.6, 42)


def test_titration(spark, sheet, make_reads):
    other = spark.createDataFrame([("o1", "sp9", "ST1")], sheet.schema)
    rows = sheet.unionByName(other)
    reads = make_reads({f"s{i:02}": 20 for i in range(24)} | {"o1": 20})
    exam = titration.titration(reads, rows, "sp1", "Species", 20, 42, FIRST)
    answers = exam.answers.orderBy("step").collect()
    assert [a.qc for a in answers[:3]] == ["PASSED", "FAILED", "FAILED"] and answers[0].notes.endswith("sp9 - o1 at 5.0%")
    counts = Counter((r.sample_id, r.origin) for r in exam.reads.where(FIRST).collect())
    assert counts[("sample03", "contaminant")] == 3 and counts[("sample20", "contaminant")] == 20 and counts[("sample20", "host")] == 0
    main, strain = titration.choose_samples(rows, "sp1", "ST")
    assert main.first().st != strain.first().st and strain.first().species == "sp1"
    with pytest.raises(ValueError, match="Invalid type"):
        titration.choose_samples(rows, "sp1", "Other")


def test_typing_exam(spark, sheet):
    contigs = spark.range(72).select(
        F.format_string("s%02d", F.col("id") % 24).alias("sample_id"), (F.col("id") / 24 + 1).cast("bigint").alias("contig_index"),
        F.lit("secret").alias("contig_name"), F.concat(F.lit("ACGT"), F.col("id").cast("string")).alias("sequence"),
    )
    from seqlab.operators.sheet import TYPING_COLUMNS, TYPING_PREFIX

    results = sheet.select("sample_name", *[F.lit(c).alias(TYPING_PREFIX + c) for c in TYPING_COLUMNS])
    exam = exams.typing_exam(sheet, contigs, results, "sp1", 5)
    answers = exam.answers.collect()
    assert len(answers) == 5 and len({a.st for a in answers}) == 5 and len({a.public_name for a in answers}) == 5
    names = sorted(r.contig_name for r in exam.reads.collect())
    assert names == sorted(f"{a.public_name}_contig_000{i}" for a in answers for i in (1, 2, 3))
    assert all(r.k_locus == "" for r in exam.blank.collect())


def test_assembly_exam(spark, sheet, make_reads):
    samples = sheet.withColumn("public_name", F.concat(F.lit("P"), "sample_name")).withColumn("assembly_file", F.lit("a.fasta"))
    contaminant = spark.createDataFrame([("x",)], "sample_name string")
    labels = exams.REAL_LABELS | {"CORRUPTED": 1}
    exam = exams.assembly_exam(make_reads({f"s{i:02}": 30 for i in range(24)}), samples, contaminant, make_reads({"x": 30}), labels, 42, FIRST)
    answers = {a.sample_name: a for a in exam.answers.collect()}
    assert Counter(a.error for a in answers.values()) == {"NONE": 18, "CONTAMINATED": 2, "DEGRADED": 1, "TRUNCATED": 1, "LOW_COVERAGE": 1, "CORRUPTED": 1}
    rows = exam.reads.collect()
    for name, a in answers.items():
        mine = [r for r in rows if r.sample_id == name and r.mate == 1]
        if a.error == "LOW_COVERAGE":
            assert len(mine) == 30 * int(a.notes.split()[-1][:-1]) // 100
        elif a.error == "DEGRADED":
            points = int(a.notes.split()[-2])
            assert {r.quality for r in mine} == {chr(max(33, ord("I") - points)) * 12}
        elif a.error == "CONTAMINATED":
            percent = int(a.notes.split()[3][:-1])
            assert 60 <= percent <= 90 and sum(r.origin == "contaminant" for r in mine) == 30 * percent // 100
        else:
            assert len(mine) == 30


def test_choose_tree(spark):
    trees = spark.createDataFrame([("t1",), ("t2",), ("t3",)], "stem string")
    tables = spark.createDataFrame([("t2",)], "stem string")
    assert exams.choose_tree(trees, tables, "stem").first().stem == "t2"


def test_stream_gives_the_batch_result(spark, tmp_path, make_reads):
    reads = make_reads({"a": 30, "b": 30})
    none = {name: F.lit(None).cast(kind) for name, kind in DAMAGE.items()}
    params = spark.createDataFrame([("a", 4, None), ("b", None, 20)], "sample_id string, truncate_to int, decrement int")
    params = land(params.withColumns({k: v for k, v in none.items() if k not in params.columns}), "params")
    source = str(tmp_path / "in")
    reads.write.parquet(source)
    stream = damage_stream(spark.readStream.schema(reads.schema).parquet(source), params)
    for _ in range(2):
        land_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
    from seqlab.plans.damage import damage_reads

    batch = damage_reads(reads, params, 42)
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == sorted(map(tuple, batch.collect()))


def test_exam_set(spark, tmp_path, make_reads):
    from seqlab.operators.sheet import TYPING_COLUMNS, TYPING_PREFIX
    from seqlab.plans.exam_set import exam_set

    rows = [(f"s{i:02}", "sp1", f"ST{i % 22}") for i in range(24)] + [("o1", "sp2", "ST1")]
    sheet = spark.createDataFrame(rows, "sample_name string, species string, st string")
    contigs = sheet.select(
        F.col("sample_name").alias("sample_id"), F.lit(1).cast("bigint").alias("contig_index"), F.lit("x").alias("contig_name"),
        F.concat(F.lit("ACGT"), "sample_name").alias("sequence"),
    )
    results = sheet.select("sample_name", *[F.lit(c).alias(TYPING_PREFIX + c) for c in TYPING_COLUMNS])
    exams_by_name = exam_set(sheet, contigs, results, make_reads({r[0]: 20 for r in rows}), "sp1", 42, FIRST)
    sizes = {name: exam.answers.count() for name, exam in exams_by_name.items()}
    assert sizes == {"typing_practice": 5, "assembly_practice": 5, "typing_real": 20, "assembly_real": 20}
    errors_seen = Counter(r.error for r in exams_by_name["assembly_real"].answers.collect())
    assert errors_seen == {"NONE": 15, "CONTAMINATED": 2, "DEGRADED": 1, "TRUNCATED": 1, "LOW_COVERAGE": 1}
    exams_by_name["typing_practice"].write(str(tmp_path / "t"))
    assert spark.read.format("fasta").load(str(tmp_path / "t" / "contigs")).count() == 5
    fastas = {r.fasta for r in exams_by_name["typing_practice"].blank.collect()}
    assert fastas == {p.name for p in (tmp_path / "t" / "contigs").glob("S*")}
