import hashlib
import random
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from seqlab.operators import hits, screen, stats
from seqlab.operators.joins import cluster_reads, mate_pairs
from seqlab.operators.screen import kmer_containment


def brute_n50(lengths):
    total, upto = sum(lengths), 0
    for n in sorted(lengths, reverse=True):
        upto += n
        if upto >= total / 2:
            return n
    return None


@pytest.mark.parametrize("lengths", [[7], [5, 5], [1, 2, 3, 4], [10, 5, 5], [3, 3, 3, 9], list(range(1, 60))])
def test_n50(spark, lengths):
    df = spark.createDataFrame([("s", n) for n in lengths], "s string, n bigint").repartition(4)
    assert stats.n50_from_lengths(df, ["s"], "n").first().n50 == brute_n50(lengths)


def test_assembly_stats_against_brute_force(spark):
    rng = random.Random(1)
    contigs = [(f"s{i % 4}", "".join(rng.choices("ACGTacgtN", k=rng.randint(0, 40)))) for i in range(200)]
    df = spark.createDataFrame(contigs, "sample_id string, sequence string").repartition(7)
    for row in stats.assembly_stats(df, "sample_id").collect():
        mine = [s for name, s in contigs if name == row.sample_id and s]
        total = sum(map(len, mine))
        assert (row.total_bases, row.number_of_contigs, row.n50) == (total, len(mine), brute_n50([len(s) for s in mine]))
        assert row.gc_content == round(sum(c in "GCgc" for s in mine for c in s) / total * 100, 2)
    assert stats.assembly_stats(df.where("false"), "sample_id").count() == 0


def test_genome_length_and_gc(spark):
    df = spark.createDataFrame([("s", "ATCGatcgN"), ("s", "A" * 1_000_000)], "s string, sequence string")
    assert tuple(stats.genome_length(df, "s").first()) == ("s", 1_000_004, 20000)
    assert stats.genome_length(df.where("length(sequence) < 100"), "s").first().variable_sites == 10000
    row = spark.range(1).select(stats.gc_percent(F.lit("GCgcA")).alias("a"), stats.gc_percent(F.lit("")).alias("b")).first()
    assert tuple(row) == (80.0, 0.0)


def test_assembler_report(spark):
    sheet = spark.createDataFrame([("a", 1), ("b", 2)], "accession string, x int")
    made = spark.createDataFrame([("a", "spades", "GGCC"), ("a", "flye", "AT"), ("a", "flye", "ATG")], "accession string, tool string, sequence string")
    rows = {r.accession: r for r in stats.assembler_report(sheet, made, "accession", "tool", ["spades", "flye"]).collect()}
    assert (rows["a"].spades_gc_content, rows["a"].flye_n50, rows["a"].flye_number_of_contigs) == (100.0, 3, 2)
    assert rows["b"].spades_n50 is None and rows["a"].spades_assembly == "a_scaffolds.fasta"


HITS = "allele string, contig string, identity double, aln_length int, mismatch int, gap int, qstart int, qend int, sstart int, send int, evalue double, score double"


def test_annotation(spark):
    rows = [
        ("l1", "c1", 99.0, 10, 0, 0, 1, 10, 500, 491, 0.0, 20.0),
        ("l1", "c2", 99.0, 10, 0, 0, 1, 10, 1, 10, 0.0, 19.0),
        ("l2", "c1", 99.0, 10, 0, 0, 1, 10, 5, 14, 0.0, 7.0),
        ("l3", "c1", 99.0, 10, 0, 0, 1, 10, 90000, 90009, 0.0, 7.0),
    ]
    contigs = spark.createDataFrame([("c1",), ("c2",)], "contig string")
    got = hits.annotate(contigs, spark.createDataFrame(rows, HITS)).orderBy("contig", "feature_number").collect()
    assert [(r.contig, r.locus, r.feat_start, r.feat_end, r.strand, r.feature_number) for r in got] == [
        ("c1", "l2", 4, 14, 1, 1),
        ("c1", "l1", 490, 500, -1, 2),
        ("c1", "l3", 89999, 90009, 1, 3),
        ("c2", None, None, None, None, None),
    ]


def test_mate_pairs_need_both_mates(spark, make_reads):
    reads = make_reads({"a": 3}).where("NOT (pair_id = 1 AND mate = 2)")
    pairs = mate_pairs(reads, "sample_id", "pair_id", "mate", ["header"]).orderBy("pair_id").collect()
    assert [(r.pair_id, r.header_1, r.header_2) for r in pairs] == [(0, "@a.0/1", "@a.0/2"), (2, "@a.2/1", "@a.2/2")]


def test_clustered_reads_pair_without_an_exchange(spark, make_reads, tmp_path):
    reads = make_reads({"a": 40, "b": 3}).where("NOT (pair_id = 1 AND mate = 2)")
    table = cluster_reads(reads, "clustered_reads", 4, path=str(tmp_path / "clustered"))
    pairs = mate_pairs(table, "sample_id", "pair_id", "mate", ["header"])
    assert "Exchange" not in pairs._jdf.queryExecution().executedPlan().toString()
    assert sorted(pairs.collect()) == sorted(mate_pairs(reads, "sample_id", "pair_id", "mate", ["header"]).collect())
    joined = table.hint("merge").join(table.select("sample_id", "pair_id", F.col("header").alias("other")), ["sample_id", "pair_id"])
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    spark.sql("DROP TABLE clustered_reads")


def test_containment_against_brute_force(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choices("ACGT", k=n)) for n in (300, 25_000, 5, 40)]
    texts[3] = texts[1][9_990:10_060]
    k = 9
    samples = spark.createDataFrame([("s0", texts[0]), ("s1", texts[1]), ("s2", texts[2])], "s string, t string")
    refs = spark.createDataFrame([("r0", texts[3]), ("r0", texts[0][:50]), ("r1", texts[0])], "r string, t string")

    def bag(*parts):
        return {p[i : i + k] for p in parts for i in range(len(p) - k + 1)}

    own = {"s0": bag(texts[0]), "s1": bag(texts[1])}
    known = {"r0": bag(texts[3], texts[0][:50]), "r1": bag(texts[0])}
    want = {(s, r): (len(a & b), len(a)) for s, a in own.items() for r, b in known.items() if a & b}
    got = {(x.s, x.r): (x.n_shared, x.n_kmers) for x in kmer_containment(samples, refs, "s", "t", "r", "t", k).collect()}
    assert got == want
    sketch = kmer_containment(samples, refs, "s", "t", "r", "t", k, scale=4).where("s = 's0' AND r = 'r1'").first()
    assert sketch.containment == 1.0 and sketch.n_kmers < want[("s0", "r1")][1] / 2


def test_sketches(spark):
    rng = random.Random(7)
    base = "".join(rng.choices("ACGT", k=12_000))
    mutated = "".join(c if rng.random() > 0.01 else rng.choice("ACGT") for c in base)
    texts = [("a", base), ("b", mutated), ("c", "".join(rng.choices("ACGT", k=3000))), ("d", "short"), ("e", None)]
    k, size = 15, 800
    df = spark.createDataFrame(texts, "s string, t string").repartition(3)
    made = {r["s"]: r["sketch"] for r in screen.sketches(df, "t", k, size, "s").collect()}
    bags = {s: {t[i : i + k] for i in range(len(t) - k + 1)} for s, t in texts if t}
    number = lambda w: int(hashlib.md5(w.encode()).hexdigest()[:15], 16)
    assert made == {s: sorted(map(number, words))[:size] for s, words in bags.items() if words}
    # Sketches of halves merge into the sketch of the whole.
    halves = spark.createDataFrame([("a", base[: 6000 + k - 1]), ("a", base[6000:])], "s string, t string")
    parts = screen.sketches(halves.where("length(t) > 6000"), "t", k, size, "s").union(screen.sketches(halves.where("length(t) <= 6000"), "t", k, size, "s"))
    assert screen.merged_sketches(parts, "s", size).first()["sketch"] == made["a"]
    sketched = screen.sketches(df, "t", k, size, "s")
    pairs = {(r["x"], r["y"]): r for r in screen.sketch_distances(sketched.withColumnRenamed("s", "x"), sketched.withColumnRenamed("s", "y"), "x", "y", size, k).collect()}
    true = len(bags["a"] & bags["b"]) / len(bags["a"] | bags["b"])
    assert abs(pairs["a", "b"]["similarity"] - true) < 3 * (true * (1 - true) / size) ** 0.5
    assert abs(pairs["a", "b"]["distance"] - 0.0075) < 0.002 and pairs["a", "a"]["distance"] == 0
    assert ("a", "d") not in pairs and pairs["a", "b"]["n_compared"] == size


def test_equal_kmers_have_equal_minimizers():
    rng = random.Random(3)
    for n in (0, 5, 8, 9, 40, 700):
        text = "".join(rng.choices("abcd日𝔘\ud800", k=n))
        for k in (1, 4, 9):
            letters, starts, least = screen.runs(text, k, min(8, k))
            assert len(letters) == n and (n < k) == (not len(starts))
            found, ends = {}, [*starts[1:].tolist(), n - k + 1]
            for start, end, minimizer in zip(starts.tolist(), ends, least.tolist()):
                assert all(found.setdefault(text[i : i + k], minimizer) == minimizer for i in range(start, end))
            assert found.keys() == {text[i : i + k] for i in range(n - k + 1)}


def test_kmers_as_text(spark):
    texts = [("a", "abcabcabcx𝔘yz"), ("a", "abcabc"), ("b", "日本語日本語"), ("b", None), ("c", "ab"), (None, "abcd")]
    found = screen.kmers(spark.createDataFrame(texts, "s string, t string"), "t", 3, "s").collect()
    assert len(found) == len(set(map(tuple, found)))
    assert {tuple(r) for r in found} == {(s, t[i : i + 3]) for s, t in texts if t for i in range(len(t) - 2)}


def test_distinct_kmers_need_one_shuffle_by_minimizer(spark):
    df = spark.createDataFrame([("s", "ACGTACGTTTGACCA" * 9)], "s string, t string")
    plan = screen.numbered_kmers(screen.pieces_of(df, "t", 9, "s"), 9, ["s"], 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 1 and "Exchange hashpartitioning(minimizer" in plan


def test_sketches_shuffle_hashes_of_sketches_alone(spark, monkeypatch):
    rng = random.Random(11)
    texts = [(rng.choice("ab"), rng.choice(["x", None]), "".join(rng.choices("acgtéß日𝔘 ", k=rng.randint(0, 9000)))) for _ in range(60)]
    df = spark.createDataFrame([*texts, (None, "x", "acgtacgtacgtacgt"), ("a", "x", None)], "s string, l string, t string").repartition(3)
    k, size = 9, 50
    plan = screen.sketches(df, "t", k, size, "s")._jdf.queryExecution().executedPlan().toString()
    assert "minimizer" not in plan and "kmer" not in plan
    hashed = screen.distinct_numbers(screen.pieces_of(df, "t", k, "s"), ["s"], "hash", lambda data, bounds: screen.hashes_of(data, bounds, k), size)
    assert hashed.count() <= 3 * size * hashed.rdd.getNumPartitions()
    want = {}
    for s, l, t in [*texts, (None, "x", "acgtacgtacgtacgt")]:
        want.setdefault((s, l), set()).update(int(hashlib.md5(t[i : i + k].encode()).hexdigest()[:15], 16) for i in range(len(t) - k + 1))
    want = {key: sorted(hashes)[:size] for key, hashes in want.items() if hashes}
    # Also if a task lets go of what it holds.
    for held in (screen.HELD, 70):
        monkeypatch.setattr(screen, "HELD", held)
        parts = screen.sketches(df, "t", k, size, "s", "l")
        assert {(r["s"], r["l"]): r["sketch"] for r in parts.collect()} == want
    merged = {r["s"]: r["sketch"] for r in screen.merged_sketches(parts, "s", size).collect()}
    assert merged == {s: sorted(set().union(*(h for key, h in want.items() if key[0] == s)))[:size] for s in ("a", "b", None)}


@pytest.mark.parametrize("n", [0, 1, 3, 4, 11, 12, 13, 54, 55, 56, 130])
def test_md5_heads(n):
    data = random.Random(n).randbytes(300)
    starts = screen.np.arange(300 - n + 1)
    want = [int(hashlib.md5(data[i : i + n]).hexdigest()[:15], 16) for i in starts]
    assert screen.md5_heads(screen.np.frombuffer(data, screen.np.uint8), starts, n).tolist() == want


def test_runs_take_memory_of_a_slice_not_of_a_batch(spark):
    rng = random.Random(12)
    pieces = ["".join(rng.choices("acgt", k=10_000)) for _ in range(60)] * 10 + ["".join(rng.choices("acgt", k=10_000)) for _ in range(300)]

    class Pieces:
        schema = spark.createDataFrame([], "s string, piece string").schema

        def mapInArrow(self, run, types):
            self.run = run
            return self

        def repartition(self, *columns):
            return self

    def numbers(dealt, texts):
        batch = pa.RecordBatch.from_pydict({"s": [f"s{i % 2}" for i in range(len(texts))], "piece": texts})
        tracemalloc.start()
        rows = found = 0
        for out in dealt.run(iter([batch])):
            rows, found = rows + len(out), found + len(out.column("run").flatten())
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return rows, found, most

    dealt = screen.dealt_runs(Pieces(), 20, ["s"], screen.FACTORS[1])
    rows, found, most = numbers(dealt, pieces)
    assert most < 200e6
    # A piece that another slice had is not sent again.
    assert found < 1.01 * 360 * 9981
    assert numbers(dealt, pieces * 4)[2] < 200e6


def test_long_runs_of_one_minimizer_are_told_apart(spark):
    # One word, which every k-mer holds, is the minimizer throughout; the middle alone differs.
    rng = random.Random(13)
    texts = []
    while any(len(screen.runs(t, 20, 8)[1]) != 1 for t in texts) or not texts:
        word, between = "".join(rng.choices("acgt", k=8)), "".join(rng.choices("acgt", k=4))
        texts = [f"{word}{between}" * 3 + f"{word}{x}" + f"{word}{between}" * 3 for x in ("cgat", "ctag", "cacc", "gatt")]
    pieces = spark.createDataFrame([("s", t) for t in texts], "s string, piece string").coalesce(1)
    want = len({t[i : i + 20] for t in texts for i in range(len(t) - 19)})
    assert screen.numbered_kmers(pieces, 20, ["s"], screen.FACTORS[1]).count() == want


def shuffled_bytes(spark):
    """Bytes that all stages of the session have written to shuffles."""
    jvm = spark.sparkContext._jvm
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_containment_shuffles_text_not_numbers(spark):
    rng = random.Random(14)
    words = ["".join(rng.choices("aeinrst", k=rng.randint(2, 6))) for _ in range(200)]
    texts = [(f"s{i % 3}", " ".join(rng.choices(words, k=4000))) for i in range(60)]
    samples = spark.createDataFrame(texts, "s string, t string").repartition(8)
    refs = spark.createDataFrame([("r", texts[0][1][:500])], "r string, t string")
    before = shuffled_bytes(spark)
    assert kmer_containment(samples, refs, "s", "t", "r", "t").count() >= 1
    # The texts are dealt out once here; the numbers of their k-mers alone are 8 bytes a letter.
    assert shuffled_bytes(spark) - before < 4 * sum(len(t) for _, t in texts)


@pytest.mark.parametrize("k", [1, 2, 5, 20])
@pytest.mark.parametrize("small", [False, True])
def test_containment_in_buckets(spark, monkeypatch, k, small):
    # Small limits: many rows for a bucket, repeats taken out often, and k-mers compared by ranges of their numbers.
    if small:
        for name, value in (("SLICE", 3000), ("GATHERED", 5000), ("COPIED", 500), ("REPEATS", 60), ("DIFFERENT", 25)):
            monkeypatch.setattr(screen, name, value)
    rng = random.Random(15)
    texts = ["".join(rng.choices("acgté日𝔘", k=rng.choice([0, 3, 19, 20, 21, 400]))) for _ in range(25)] + [None, "x" * 9000, "ab" * 300]
    texts += [texts[i][5:] + texts[i + 1] for i in range(5)]
    samples = [(rng.choice([1, 2, 3, None]), t) for t in texts]
    refs = [(rng.choice(["p", "q", None]), t[:150]) for t in texts[10:] if t] + [("q", None), ("only", "§" * 40)]
    bags = [{} for _ in range(2)]
    for bag, rows in zip(bags, (samples, refs), strict=True):
        for key, t in rows:
            bag.setdefault(key, set()).update(t[i : i + k] for i in range(len(t or "") - k + 1))
    want = {(s, r, len(a & b), len(a)) for s, a in bags[0].items() for r, b in bags[1].items() if s is not None and a & b}
    found = kmer_containment(
        spark.createDataFrame(samples, "s int, t string").repartition(3), spark.createDataFrame(refs, "r string, t string"), "s", "t", "r", "t", k
    )
    assert found.columns == ["s", "r", "n_kmers", "n_shared", "containment"]
    rows = [tuple(r) for r in found.collect()]
    assert {(s, r, shared, n) for s, r, n, shared, _ in rows} == want and len(rows) == len(want)


def test_containment_of_empty_tables(spark):
    some, none = (spark.createDataFrame(rows, "s string, t string") for rows in ([("a", "acgtacgtacgt")], []))
    assert kmer_containment(none, some.withColumnRenamed("s", "r"), "s", "t", "r", "t", 4).count() == 0
    assert kmer_containment(some, none.withColumnRenamed("s", "r"), "s", "t", "r", "t", 4).count() == 0
