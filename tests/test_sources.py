import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from seqlab.operators.stats import count_reads, count_reads_from_lines
from seqlab.sources import complete_pairs, corrupt_files, file_digest, write_fasta, write_fastq, write_read_files
from seqlab.sources.files import corrupted_bytes


def fastq(path, records):
    text = "".join(f"{h}\n{s}\n+\n{q}\n" for h, s, q in records)
    with gzip.open(path, "wt") if str(path).endswith(".gz") else open(path, "w") as f:
        f.write(text)


def test_paired_fastq(spark, tmp_path):
    fastq(tmp_path / "a_R1.fastq.gz", [("@1", "ACTG", "@III"), ("@2", "GG", "II"), ("@3", "", "")])
    fastq(tmp_path / "a_R2.fastq.gz", [("@1", "GTCA", "KKKK"), ("@2", "CC", "KK")])
    fastq(tmp_path / "b.x_1.fq", [("@z", "NNac", "!!!!")])
    reads = spark.read.format("fastq").load(str(tmp_path))
    rows = sorted(tuple(r)[:6] for r in reads.collect())
    assert rows == [
        ("a", 0, 1, "@1", "ACTG", "+"),
        ("a", 0, 2, "@1", "GTCA", "+"),
        ("a", 1, 1, "@2", "GG", "+"),
        ("a", 1, 2, "@2", "CC", "+"),
        ("a", 2, 1, "@3", "", "+"),
        ("b.x", 0, 1, "@z", "NNac", "+"),
    ]
    assert reads.where("sequence = 'ACTG'").first().quality == "@III"
    assert sorted((r.pair_id, r.mate) for r in complete_pairs(reads).collect()) == [(0, 1), (0, 2), (1, 1), (1, 2)]
    counts = {(r.sample_id, r.mate): r.n_reads for r in count_reads(reads, "sample_id", "mate").collect()}
    assert counts == {("a", 1): 3, ("a", 2): 2, ("b.x", 1): 1}


def test_fastq_stops_at_an_empty_header_and_strips_lines(spark, tmp_path):
    (tmp_path / "s.fastq").write_text("@1 \r\n AC\t\r\n+\r\nII\r\n\n@2\nAC\n+\nII\n")
    row, = spark.read.format("fastq").load(str(tmp_path / "s.fastq")).collect()
    assert (row.header, row.sequence, row.quality) == ("@1", "AC", "II")


def test_fastq_truncated_last_record(spark, tmp_path):
    (tmp_path / "s.fastq").write_text("@1\nAC\n+\nII\n@2\nGG\n")
    rows = spark.read.format("fastq").load(str(tmp_path / "s.*")).orderBy("pair_id").collect()
    assert [(r.header, r.sequence, r.plus, r.quality) for r in rows] == [("@1", "AC", "+", "II"), ("@2", "GG", "", "")]
    lines = spark.read.text(str(tmp_path / "s.fastq"))
    assert count_reads_from_lines(lines).first().n_reads == 1


def test_fastq_of_several_blocks_and_members(spark, tmp_path):
    body = "".join(f"@{i}\n{'ACGT' * 40}\n+\n{'I' * 160}\n" for i in range(30000))
    with open(tmp_path / "big_1.fastq.gz", "wb") as f:
        f.write(gzip.compress(body.encode()))
        f.write(gzip.compress(b"@last\nA\n+\nI\n"))
    reads = spark.read.format("fastq").load(str(tmp_path))
    got = reads.agg(F.count("*"), F.max("pair_id"), F.count_distinct("header"), F.max_by("header", "pair_id")).first()
    assert tuple(got) == (30001, 30000, 30001, "@last")


def test_files_share_tasks_by_size(spark, tmp_path):
    for i in range(6):
        fastq(tmp_path / f"s{i}_R1.fastq", [("@1", "A" * 500, "I" * 500)])
    read = spark.read.format("fastq")

    def tasks(size):
        return read.option("partitionBytes", size).load(str(tmp_path)).select(F.spark_partition_id().alias("p")).distinct().count()

    assert (tasks(1), tasks(1 << 20)) == (6, 1)
    with pytest.raises(Exception, match="nothing_here"):
        read.load(str(tmp_path / "nothing_here")).count()


def test_fastq_round_trip_in_chunks(spark, tmp_path, make_reads):
    reads = make_reads({"a": 25, "b c": 3}, partitions=5)
    out = str(tmp_path / "out")
    write_fastq(reads, out, chunk_pairs=10)
    assert len(list((tmp_path / "out" / "sample_id=a" / "mate=1").glob("chunk=*"))) == 3
    back = spark.read.format("fastq").load(out)
    columns = ["sample_id", "mate", "header", "sequence", "plus", "quality"]
    assert sorted(map(tuple, back.select(*columns).collect())) == sorted(map(tuple, reads.select(*columns).collect()))
    pairs = back.groupBy("sample_id", "pair_id").agg(F.count_distinct(F.split("header", "/")[0]).alias("names"), F.count("*").alias("n"))
    assert pairs.where("names <> 1 OR n <> 2").count() == 0 and pairs.count() == 28
    assert complete_pairs(back).count() == 56


def test_contaminant_is_written_first(spark, tmp_path, make_reads):
    mixed = make_reads({"a": 8}).withColumn("origin", F.when(F.col("pair_id") % 2 == 0, "host").otherwise("contaminant"))
    write_fastq(mixed, str(tmp_path / "m"), chunk_pairs=4)
    files = sorted((tmp_path / "m" / "sample_id=a" / "mate=2").rglob("*.gz"))
    headers = [line for f in files for line in gzip.open(f, "rt").read().split("\n")[::4] if line]
    assert headers == [f"@a.{i}/2" for i in (1, 3, 5, 7, 0, 2, 4, 6)]
    back = spark.read.format("fastq").load(str(tmp_path / "m"))
    assert back.select("pair_id").distinct().count() == 8 and complete_pairs(back).count() == 16


def test_fasta_round_trip(spark, tmp_path):
    (tmp_path / "g.fasta").write_text(">c1 first\nACGT\nAC\n>empty\n>c2\nNNnn\n\nA\n")
    contigs = spark.read.format("fasta").load(str(tmp_path / "g.fasta"))
    assert [tuple(r) for r in contigs.orderBy("contig_index").collect()] == [("g", 1, "c1 first", "ACGTAC"), ("g", 2, "c2", "NNnnA")]
    write_fasta(contigs.withColumn("contig_name", F.concat(F.lit("x"), "contig_index")), str(tmp_path / "o"))
    back = spark.read.format("fasta").load(str(tmp_path / "o")).orderBy("contig_name").collect()
    assert [(r.sample_id, r.contig_name, r.sequence) for r in back] == [("g", "x1", "ACGTAC"), ("g", "x2", "NNnnA")]


def test_file_digest_small_and_large(spark, tmp_path):
    data = {"a.bin": b"abc", "b.bin": bytes(range(256)) * 300}
    for name, content in data.items():
        (tmp_path / name).write_bytes(content)
    rows = file_digest(spark, str(tmp_path)).collect()
    assert {r.path.rsplit("/", 1)[1]: r.md5 for r in rows} == {n: hashlib.md5(c).hexdigest() for n, c in data.items()}


@pytest.mark.parametrize("ensure", [False, True])
def test_corrupt_files_change_one_byte(spark, tmp_path, ensure):
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    for i in range(8):
        (source / f"f{i}.gz").write_bytes(bytes([i % 2]) * 1000)
    plan = {r.path.rsplit("/", 1)[1]: r for r in corrupt_files(spark, str(source), str(out), 42, ensure).collect()}
    for i in range(8):
        old, new = (d / f"f{i}.gz" for d in (source, out))
        changed = [p for p, (a, b) in enumerate(zip(old.read_bytes(), new.read_bytes())) if a != b]
        assert len(new.read_bytes()) == 1000
        assert changed == ([plan[f"f{i}.gz"].position] if ensure or i % 2 else [])
    assert len({r.position for r in plan.values()}) > 4


def test_corrupt_files_keep_folders(spark, tmp_path, make_reads):
    write_fastq(make_reads({f"s{i}": 4 for i in range(12)}), str(tmp_path / "in"))
    files = sorted((tmp_path / "in").rglob("*.gz"))
    plan = corrupt_files(spark, str(tmp_path / "in"), str(tmp_path / "out"), 42, True)
    copies = sorted((tmp_path / "out").rglob("*.gz"))
    assert len(files) == len(copies) == plan.count() == 24
    assert [f.relative_to(tmp_path / "in") for f in files] == [c.relative_to(tmp_path / "out") for c in copies]
    for old, new in zip(files, copies):
        assert sum(a != b for a, b in zip(old.read_bytes(), new.read_bytes())) == 1
    (tmp_path / "x").mkdir()
    (tmp_path / "y").mkdir()
    for d in "xy":
        (tmp_path / d / "same.gz").write_bytes(b"abc")
    with pytest.raises(ValueError, match="same.gz"):
        corrupt_files(spark, str(tmp_path / "[xy]"), str(tmp_path / "z"))


def test_read_files(spark, tmp_path, make_reads):
    reads = make_reads({"a": 25, "b c": 3}).withColumn("origin", F.when(F.col("pair_id") % 5 == 0, "contaminant").otherwise("host"))
    write_read_files(reads, str(tmp_path / "plain"), chunk_pairs=4)
    corrupt = spark.createDataFrame([("a", 2)], "sample_id string, mate int")
    write_read_files(reads, str(tmp_path / "bad"), corrupt, chunk_pairs=4)
    names = ["a_R1.fastq.gz", "a_R2.fastq.gz", "b c_R1.fastq.gz", "b c_R2.fastq.gz"]
    for folder in ("plain", "bad"):
        assert sorted(p.name for p in (tmp_path / folder).glob("*.gz")) == names
    headers = [gzip.open(tmp_path / "plain" / f"a_R{m}.fastq.gz", "rt").read().split("\n")[:-1:4] for m in (1, 2)]
    order = [*range(0, 25, 5), *(i for i in range(25) if i % 5)]
    assert headers == [[f"@a.{i}/{m}" for i in order] for m in (1, 2)]
    for name in names:
        one, two = ((tmp_path / f / name).read_bytes() for f in ("plain", "bad"))
        assert len(one) == len(two) and sum(a != b for a, b in zip(one, two)) == (name == "a_R2.fastq.gz")


def test_many_contigs_keep_their_keys(spark, tmp_path):
    contigs = spark.range(1, 9001).selectExpr("'s' AS sample_id", "id AS contig_index", "concat('c', id) AS contig_name", "'ACGT' AS sequence")
    write_fasta(contigs, str(tmp_path / "o"))
    back = spark.read.format("fasta").load(str(tmp_path / "o"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, contigs.collect()))


def test_names_are_not_merged(spark, tmp_path):
    for version in (1, 2):
        (tmp_path / f"GCA_000742755.{version}.fna").write_text(">c\nAC\n")
    fastq(tmp_path / "r_R1.fastq", [("@1", "AC", "II")])
    read = spark.read
    assert {r.sample_id for r in read.format("fasta").load(str(tmp_path)).collect()} == {"GCA_000742755.1", "GCA_000742755.2"}
    assert [r.sample_id for r in read.format("fastq").load(str(tmp_path)).collect()] == ["r"]
    (tmp_path / "other").mkdir()
    fastq(tmp_path / "other" / "r_R1.fastq", [("@1", "AC", "II")])
    with pytest.raises(Exception, match="both files of sample r"):
        read.format("fastq").load(str(tmp_path)).count()
    with pytest.raises(Exception, match="No sequence files"):
        read.format("fasta").load(str(tmp_path / "other")).count()


def test_written_and_read_again_and_again(spark, tmp_path, make_reads):
    reads = make_reads({"a": 12})
    for i in range(5):
        write_fastq(reads, str(tmp_path / str(i)), chunk_pairs=5)
        reads = spark.read.format("fastq").load(str(tmp_path / str(i)))
    assert reads.agg(F.max("pair_id")).first()[0] < 4 << 32 and reads.count() == 24


def test_corrupted_bytes_expression(spark):
    df = spark.createDataFrame([(bytearray(b"\x01\x00\x03"),)], "c binary")
    row = df.select(corrupted_bytes(F.col("c"), F.lit(3)).alias("a"), corrupted_bytes(F.col("c"), F.lit(2), True).alias("b")).first()
    assert bytes(row.a) == b"\x01\x00\x00" and bytes(row.b) == b"\x01\xff\x03"


def test_files_are_renamed_at_commit_alone(spark, tmp_path):
    rows = spark.range(400).selectExpr("concat('f', id % 4, '.gz') AS file", "concat('line ', id) AS value", "CAST(NULL AS DOUBLE) AS corrupt_at", "id")
    ordered = rows.repartition(4, "file").sortWithinPartitions("file", "id").drop("id")
    ordered.write.format("record_files").option("memberBytes", 100).mode("append").save(str(tmp_path / "good"))
    for i in range(4):
        data = (tmp_path / "good" / f"f{i}.gz").read_bytes()
        assert gzip.decompress(data).decode().split("\n")[:-1] == [f"line {k}" for k in range(i, 400, 4)] and data.count(b"\x1f\x8b\x08") > 5
    assert len(list((tmp_path / "good").iterdir())) == 4
    broken = ordered.withColumn("value", F.when(F.col("value") == "line 399", F.raise_error(F.lit("broken row"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="broken row"):
        broken.write.format("record_files").mode("append").save(str(tmp_path / "bad"))
    assert not (tmp_path / "bad").exists() or not list((tmp_path / "bad").iterdir())


@pytest.mark.parametrize("segmented", [False, True])
def test_large_samples_are_written_by_many_tasks(spark, tmp_path, make_reads, segmented):
    reads = make_reads({"hot": 90, "a": 5})
    corrupt = spark.createDataFrame([("hot", 1), ("a", 2)], "sample_id string, mate int")
    files = {r["target"]: r for r in write_read_files(reads, str(tmp_path / "o"), corrupt, 42, 10, segmented).collect()}
    names = [f"hot_R{m}_{i:03}.fastq.gz" for m in (1, 2) for i in range(1, 10)] if segmented else ["hot_R1.fastq.gz", "hot_R2.fastq.gz"]
    assert sorted(p.name for p in (tmp_path / "o").iterdir()) == sorted(files) == sorted([*names, "a_R1.fastq.gz", "a_R2.fastq.gz"])
    assert {t for t, r in files.items() if r["position"] is not None} == {"a_R2.fastq.gz", names[0]}
    assert all((tmp_path / "o" / t).stat().st_size == r["length"] for t, r in files.items())
    assert all((r["own"], r["foreign"]) == (5 if t.startswith("a") else 10 if segmented else 90, 0) for t, r in files.items())
    write_read_files(reads, str(tmp_path / "p"), None, 42, 10, segmented)
    back = spark.read.format("fastq").load(str(tmp_path / "p"))
    columns = ["sample_id", "mate", "header", "sequence", "plus", "quality"]
    assert sorted(map(tuple, back.select(*columns).collect())) == sorted(map(tuple, reads.select(*columns).collect()))
    assert complete_pairs(back).count() == 190
