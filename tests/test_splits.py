import gzip
import io
import random

import pytest

from seqlab.sources import read_fasta, read_fastq
from seqlab.sources.sequences import fasta_blocks, fastq_blocks
from seqlab.sources.splits import FASTA, FASTQ, Cut


def fastq_text(n, seed=1, end="\n"):
    """Records whose quality lines may start with @ or +."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        size = rng.randint(1, 9)
        out.append(f"@r{i}{end}{''.join(rng.choices('ACGTN', k=size))}{end}+{end}{rng.choice('@+I')}{''.join(rng.choices('@+I!', k=size - 1))}{end}")
    return "".join(out)


def fasta_text(n, seed=1):
    rng = random.Random(seed)
    return "".join(f">c{i}\n" + "".join("".join(rng.choices("ACGT", k=rng.randint(1, 6))) + "\n" for _ in range(rng.randint(0, 4))) for i in range(n))


def pieces_of(path, kind, cuts):
    """The rows that ranges between ``cuts`` give, one list each, and all rows that one scan gives."""
    file = Cut(str(path))
    places = [file.first_record(a, b, kind) for a, b in zip(cuts, [*cuts[1:], file.size])]
    places = [p for p in places if p is not None]
    out = []
    for place, end in zip(places, [*places[1:], None]):
        out.append([row for columns in kind.blocks(str(path), Cut(str(path)).lines(place, end)) for row in zip(*columns[2 if kind is FASTA else 3 :])])
    return out


def scanned(text, kind, path):
    blocks = fastq_blocks if kind is FASTQ else fasta_blocks
    return [row for columns in blocks(str(path), io.StringIO(text, newline=None)) for row in zip(*columns[2 if kind is FASTA else 3 :])]


@pytest.mark.parametrize("kind, text, name", [(FASTQ, fastq_text(25), "s_R1.fastq"), (FASTQ, fastq_text(12, 2, "\r\n"), "s_R1.fastq"), (FASTQ, fastq_text(7)[:-9], "s_R1.fastq"), (FASTA, fasta_text(20), "s.fasta")])
def test_every_cut_of_a_plain_file(tmp_path, kind, text, name):
    path = tmp_path / name
    path.write_bytes(text.encode())
    want = scanned(text, kind, path)
    for cut in range(1, len(text)):
        assert sum(pieces_of(path, kind, [0, cut]), []) == want, cut
    for step in (1, 2, 3, 7, 16, 50):
        assert sum(pieces_of(path, kind, list(range(0, len(text), step))), []) == want, step


@pytest.mark.parametrize("kind, text, name", [(FASTQ, fastq_text(60), "s_R1.fastq.gz"), (FASTA, fasta_text(50), "s.fasta.gz")])
@pytest.mark.parametrize("member", [1, 13, 64, 300, 10_000])
def test_every_cut_of_members(tmp_path, kind, text, name, member):
    path = tmp_path / name
    data = text.encode()
    members = [gzip.compress(data[i : i + member]) for i in range(0, len(data), member)][:400] if member > 1 else [gzip.compress(data), gzip.compress(b"")]
    path.write_bytes(b"".join(members) + b"\0" * 20)
    want = scanned(gzip.decompress(b"".join(members)).decode(), kind, path)
    size = path.stat().st_size
    for cut in range(1, size, max(1, size // 300)):
        assert sum(pieces_of(path, kind, [0, cut]), []) == want, cut
    for step in (20, 111, 1000):
        found = pieces_of(path, kind, list(range(0, size, step)))
        assert sum(found, []) == want, step
        assert len(found) > 3 or member > 100 or member == 1 or step == 1000


def test_a_member_within_a_member_is_none(tmp_path):
    inner = gzip.compress(b"@fake\nA\n+\nI\n" * 50)
    body = fastq_text(30).encode()
    path = tmp_path / "s_R1.fastq.gz"
    path.write_bytes(gzip.compress(body) + gzip.compress(body, 0))
    assert inner[:3] == b"\x1f\x8b\x08"
    want = scanned((body * 2).decode(), FASTQ, path)
    for cut in range(1, path.stat().st_size, 5):
        assert sum(pieces_of(path, FASTQ, [0, cut]), []) == want


@pytest.mark.parametrize("range_bytes", [40, 333, 1 << 20])
def test_the_rows_of_one_task(spark, tmp_path, range_bytes):
    texts = {"a_R1.fastq": fastq_text(200), "a_R2.fastq": fastq_text(190, 5), "e_R1.fastq": "", "f_R1.fastq": fastq_text(9) + "\n" + fastq_text(9)}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    body = fastq_text(150, 7).encode()
    (tmp_path / "g_R1.fastq.gz").write_bytes(b"".join(gzip.compress(body[i : i + 100]) for i in range(0, len(body), 100)))
    (tmp_path / "h_R1.fq.gz").write_bytes(gzip.compress(body))
    (tmp_path / "c.fasta").write_text(fasta_text(80))
    for name, read in (("fastq", read_fastq), ("fasta", read_fasta)):
        want = sorted(map(tuple, spark.read.format(name).load(str(tmp_path)).collect()))
        assert sorted(map(tuple, read(spark, str(tmp_path), range_bytes).collect())) == want and want
    with pytest.raises(FileNotFoundError):
        read_fastq(spark, str(tmp_path / "nothing"))


def test_many_tasks_read_one_file(spark, tmp_path):
    (tmp_path / "a_R1.fastq").write_text(fastq_text(3000))
    reads = read_fastq(spark, str(tmp_path / "a_R1.fastq"), 8000)
    from pyspark.sql import functions as F

    by_task = reads.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(by_task) >= 5 and max(r["count"] for r in by_task) < 1500
    assert reads.agg(F.max("pair_id"), F.count_distinct("pair_id")).first() == (2999, 3000)
