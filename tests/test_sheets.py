import pytest
from pyspark.sql import functions as F

from seqlab.operators import joins, reports, sheet, validate
from seqlab.plans import exams, simulate
from seqlab.sources import malformed_reports, read_first_row, read_hits, read_reports, read_sheet, write_sheet

CATALOGUE = (
    "SAMPLE_NAME,SHORT_READS,ASSEMBLY,SPECIES,ST,AMR,USE_ORIGINAL_READS\n"
    "s1,ERR1,GCA_1,sp1,ST14,\"a, b\",FALSE\n"
    "s2,,GCA_2.1,sp1,ST11,,TRUE\n"
    "s3,ERR3,,sp2,ST11,,FALSE\n"
)


@pytest.fixture
def catalogue(spark, tmp_path):
    path = tmp_path / "list.csv"
    path.write_text("﻿" + CATALOGUE, encoding="utf-8")
    return read_sheet(spark, str(path))


def test_sheet_is_text_with_quotes_and_bom(catalogue):
    assert catalogue.columns == list(validate.REQUIRED_COLUMNS)
    assert set(dict(catalogue.dtypes).values()) == {"string"}
    rows = {r.SAMPLE_NAME: r for r in catalogue.collect()}
    assert rows["s1"].AMR == "a, b" and rows["s2"].SHORT_READS is None


def test_missing_columns_are_named_in_order(catalogue):
    assert validate.validate_sheet(catalogue) is catalogue
    with pytest.raises(ValueError, match="^Input file is missing required columns: AMR, ST$"):
        validate.validate_sheet(catalogue.drop("ST", "AMR"))


def test_rows_need_an_input(spark, catalogue):
    bad = catalogue.withColumn("SHORT_READS", F.lit(""))
    assert [tuple(r) for r in validate.sheet_violations(bad, "SAMPLE_NAME").collect()] == [("s3", "assembly or reads")]
    with pytest.raises(ValueError, match="Sample s3 does not have an assembly or read record."):
        validate.validate_sheet(bad)


def test_format_rules(spark):
    rows = [("ok", "GCA_902155925.1", "sp", "ST11", "TRUE"), ("bad", "XGCA_1", None, "11", "true"), ("null", None, "sp", None, None)]
    df = spark.createDataFrame(rows, "sample_name string, assembly string, species string, st string, use_original_reads string")
    got = {(r.sample_name, r.rule) for r in validate.sheet_violations(df, "sample_name", validate.format_rules()).collect()}
    assert got == {("bad", r) for r in ("assembly", "species", "st", "use_original_reads")} | {("null", r) for r in ("assembly", "st", "use_original_reads")}


def test_original_reads_rule(catalogue):
    with pytest.raises(ValueError, match="Sample s2 does not have a read record."):
        validate.check_original_reads(validate.lower_case_columns(catalogue))


def test_dataset_sheet(spark, catalogue):
    fixed = catalogue.withColumn("SHORT_READS", F.coalesce("SHORT_READS", F.lit("ERR")))
    out = simulate.dataset_sheet(fixed, "sp1", 5)
    rows = out.collect()
    assert len(rows) == 5 and len({r.r1 for r in rows}) == 5
    own, made = simulate.split_by_reads(out)
    assert all(r.coverage == -1 and r.platform == "Unknown" for r in own.collect())
    assert all(40 <= r.coverage <= 60 and r.read_length == 150 for r in made.collect())


def test_blank_sheet_golden_text(spark, tmp_path):
    rows = [(f"sample0{i}", f"sample0{i}_R1.fastq.gz", f"sample0{i}_R2.fastq.gz", f"species{i}") for i in (1, 2)]
    df = spark.createDataFrame(rows, "public_name string, r1 string, r2 string, species string")
    path = str(tmp_path / "sheet")
    write_sheet(sheet.blank_sheet(df), path, order_by="ID")
    lines = []
    for part in sorted((tmp_path / "sheet").glob("part-*.csv")):
        head, *body = part.read_text().splitlines()
        assert head == "ID,R1,R2,SPECIES,QC,ERROR,ST,AMR,Notes"
        lines += body
    assert lines == [
        "sample01,sample01_R1.fastq.gz,sample01_R2.fastq.gz,species1,Unknown,Unknown,Unknown,Unknown,",
        "sample02,sample02_R1.fastq.gz,sample02_R2.fastq.gz,species2,Unknown,Unknown,Unknown,Unknown,",
    ]
    assert read_sheet(spark, path).count() == 2


def test_other_blank_layouts(spark):
    df = spark.createDataFrame([("s", "pub", "sp", "d/a_R1.gz", "d/a_R2.gz", "x/y.fasta")], "sample_name string, public_name string, species string, r1 string, r2 string, assembly_file string")
    assert tuple(sheet.blank_sheet(df, "basic").first()) == ("pub", "sp", "a_R1.gz", "a_R2.gz", "", "", "", "", "pub.fasta")
    assert sheet.blank_sheet(df, "basic", public=False).first().fasta == "y.fasta"
    assert sheet.blank_sheet(df, "typing").columns == "sample st k_locus capsule_type wzi o_locus o_type bla_carb fasta".split()
    with pytest.raises(ValueError):
        sheet.blank_sheet(df, "none")


def test_tidy_sheet(spark):
    df = spark.createDataFrame([("i", "r", "a", "K. p sensu stricto", "ST11~")], "ID string, SHORT_READS string, ASSEMBLY string, Species string, ST string")
    row = sheet.tidy_sheet(df, "ID", "SHORT_READS", "ASSEMBLY", "Species", "ST").first()
    assert tuple(row) == ("i", "r", "a", "K. p", "ST11", "Unknown", "FALSE")


def test_typing_results_first_row(spark, tmp_path):
    names = [sheet.TYPING_PREFIX + c for c in sheet.TYPING_COLUMNS]
    for i in (1, 2):
        body = "\n".join("\t".join([f"f{i}r{row}"] + [f"v{row}{j}" for j in range(7)]) for row in (1, 2, 3))
        (tmp_path / f"t{i}.txt").write_text("\t".join(["strain", *names]) + "\n" + body + "\n")
    rows = read_first_row(spark, str(tmp_path / "*.txt"))
    assert sorted(r.strain for r in rows.collect()) == ["f1r1", "f2r1"]
    short = sheet.typing_results(rows, "strain").first()
    assert short.asDict().keys() == {"strain", *sheet.TYPING_COLUMNS.values()} and short.kleborate_st == "v10"


def test_hits_are_typed(spark, tmp_path):
    (tmp_path / "h.tsv").write_text("al_1\tc1\t99.5\t100\t1\t0\t1\t100\t200\t101\t1e-50\t180.5\n")
    row = read_hits(spark, str(tmp_path / "h.tsv")).first()
    assert (row.allele, row.sstart, row.send, row.evalue, row.score) == ("al_1", 200, 101, 1e-50, 180.5)


def test_reports(spark, tmp_path):
    (tmp_path / "r.jsonl").write_text(
        '{"accession":"GCA_1","assemblyInfo":{"biosample":{"accession":"SAMN1","strain":""}},"annotationInfo":{"pipeline":"P",'
        '"stats":{"geneCounts":{"nonCoding":0,"total":538}}},"assemblyStats":{"gcPercent":31.5},'
        '"checkmInfo":{"checkmSpeciesTaxId":2097,"completeness":0.0},"organism":{"taxId":5},"other":{"a":1}}\n'
        '{"accession":"GCA_2","checkmInfo":{"species":"sp","checkmSpeciesTaxId":1}}\n'
    )
    flat = reports.flatten_report(read_reports(spark, str(tmp_path / "r.jsonl")))
    assert flat.columns[:5] == ["accession", "assemblyInfo_accession", "assemblyInfo_strain", "annotationinfo_pipeline", "annotationinfo_softwareversion"]
    assert len(flat.columns) == 26
    one, two = flat.orderBy("accession").collect()
    assert (one.assemblyInfo_accession, one.assemblyInfo_strain, one.annotationInfo_nonCoding, one.annotationInfo_total) == ("SAMN1", None, None, "538")
    assert (one.assemblystats_gcpercent, one.checkminfo_species, one.checkminfo_completeness, one.organism_taxid) == ("31.5", "2097", None, "5")
    assert (two.checkminfo_species, two.annotationInfo_total) == ("sp", None)


def test_contaminants_need_another_species_and_an_assembly(spark):
    listed = spark.createDataFrame([("a", "x", "A1"), ("b", "y", ""), ("c", "y", None), ("d", "z", "A4")], "sample_name string, species string, assembly string")
    used = spark.createDataFrame([("x",), ("x",)], "species string")
    assert [r.sample_name for r in joins.contaminant_pool(listed, used).collect()] == ["d"]


def test_enrich_lets_the_right_side_win(spark):
    left = spark.createDataFrame([("a", 1, 2), ("b", 3, 4)], "k string, x int, y int")
    right = spark.createDataFrame([("a", None, 9)], "k string, y int, z int")
    assert sorted(tuple(r) for r in joins.enrich_sheet(left, right, "k").collect()) == [("a", 1, None, 9), ("b", 3, 4, None)]


def test_prefix_lookup_against_brute_force(spark):
    prefixes = ["GCA_1", "GCA_12", "GCA_9", "GCF_7"]
    paths = ["GCA_1.1_x", "GCA_12.1", "GCA_123", "GCF_7", "other"]
    got = joins.prefix_lookup(spark.createDataFrame([(p,) for p in prefixes], "p string"), spark.createDataFrame([(p,) for p in paths], "f string"), "p", "f")
    want = {}
    for p in prefixes:
        found = sorted(f for f in paths if f.startswith(p))
        want[p] = (found[0] if found else None, len(found))
    assert {r.prefix: (r.first_path, r.n_paths) for r in got.collect()} == want


def test_outbreak_names(spark):
    schema = "Sample string, Cluster string, Host string, Location string, `Collection Date` string, Phenotype string, SPECIES string"
    meta = spark.createDataFrame([(s, "1", "Human", "L", "2024-02-15", "A", "sp") for s in ("t1", "t2", "t3")], schema)
    digests = spark.createDataFrame([("t1", "abcdef0123"), ("t2", "abcdef0199"), ("t3", "1234567890")], "Sample string, digest string")
    answers, blank = exams.outbreak_sheets(meta, digests)
    names = {r.Sample: r.public_name for r in answers.collect()}
    assert names["t3"] == "Sample_1234567812"
    assert {names["t1"], names["t2"]} == {"Sample_abcdef0112", "Sample_abcdef0112_2"} or names["t2"] == "Sample_abcdef0199"[:15] + "12"
    assert blank.columns == list(sheet.OUTBREAK_COLUMNS) and {r.Cluster for r in blank.collect()} == {""}
    with pytest.raises(ValueError, match="No public name for sample t3"):
        exams.outbreak_sheets(meta, digests.where("Sample <> 't3'"))


def test_exam_notes(spark):
    label = F.element_at(F.array(*[F.lit(x) for x in sheet.EXAM_ANSWERS]), (F.col("id") + 1).cast("int"))
    out = spark.range(6).select(label.alias("label"), F.lit(17).alias("p"), F.lit("d/c_R1.gz").alias("a"), F.lit("d/c_R2.gz").alias("b"))
    rows = {r.label: r for r in out.withColumns(sheet.exam_answer(F.col("label"), F.col("p"), F.col("a"), F.col("b"))).collect()}
    assert rows["CONTAMINATED"].notes == "Contamined sample with 17% using c_R1.gz and c_R2.gz"
    assert (rows["NORMAL"].qc, rows["NORMAL"].error, rows["NORMAL"].notes) == ("PASSED", "NONE", "None")
    assert rows["POOR_QUALITY"].error == "DEGRADED" and rows["LOW_COVERAGE"].notes == "Low coverage sample with 17%"


def test_reports_as_variants(spark, tmp_path):
    good = [
        '{"accession":"GCA_1","assemblyInfo":{"biosample":{"accession":"SAMN1","strain":""}},"assemblyStats":{"gcPercent":31.5,"contigN50":0},"checkmInfo":{"checkmSpeciesTaxId":2097}}',
        '{"accession":"GCA_2","checkmInfo":{"species":"sp","checkmSpeciesTaxId":1},"organism":{"taxId":false},"annotationInfo":{"stats":{"geneCounts":{"total":12345678901}}}}',
    ]
    bad = {2: '{"accession": "GCA_3"', 4: "no json", 7: "[1, 2]"}
    lines = [good[0], bad[2], "", bad[4], "  ", good[1], bad[7]]
    (tmp_path / "a.jsonl").write_text("\n".join(lines) + "\n")
    (tmp_path / "b.jsonl").write_text("\n".join([good[0]] * 3000 + ["{broken"] + [good[1]] * 3000))
    text = spark.createDataFrame([(x,) for x in good], "json string")
    want = sorted(map(repr, reports.flatten_report(reports.parse_reports(text, "json"), root="report").collect()))
    assert sorted(map(repr, reports.flatten_variant(reports.variant_reports(text, "json")).collect())) == want
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        found = malformed_reports(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {(r["path"].rsplit("/", 1)[1], r["line_number"]): r["line"] for r in found} == {("a.jsonl", n): x for n, x in bad.items()} | {("b.jsonl", 3001): "{broken"}
