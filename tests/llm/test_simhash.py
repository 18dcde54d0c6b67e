import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from seqlab.llm.simhash import cell_edges, drop_near_duplicates, fingerprint, fingerprints, grid, near_duplicates, simhash_components


def plain_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in lowered).split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values):
    """Label of each value: the smallest index that can be reached."""
    label = list(range(len(values)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= 3:
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(values))]


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def test_fingerprint(odd_texts):
    for text in [t or "" for t in odd_texts] + ["One two THREE four five one two three"]:
        assert fingerprint(text) == signed(plain_fingerprint(text))


@pytest.mark.parametrize("cell", [3, 4096])
def test_components_of_close_fingerprints(spark, cell):
    rng = random.Random(3)
    bases = [rng.getrandbits(64) for _ in range(12)]
    values = sorted({b ^ sum(1 << k for k in rng.sample(range(64), rng.choice([0, 1, 2, 3, 4, 6]))) for b in bases for _ in range(60)})
    rng.shuffle(values)
    rows = spark.createDataFrame([(i, signed(v)) for i, v in enumerate(values)], "doc_id long, fp long").repartition(5)
    found = {r["fp"]: r["component_id"] for r in near_duplicates(rows, cell).collect()}
    assert [found[signed(v)] for v in values] == plain_components(values)


@pytest.mark.parametrize("records", [1, 2, 3])
def test_cells_cut_between_batches(spark, records):
    rng = random.Random(11)
    near = lambda v: v ^ sum(1 << k for k in (*rng.sample(range(32), 1), *rng.sample(range(32, 64), 2)))
    values = sorted({x for v in (rng.getrandbits(64) for _ in range(60)) for x in (v, near(v))})
    rows = spark.createDataFrame([(i, signed(v)) for i, v in enumerate(values)], "doc_id long, fp long").repartition(5)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)
    try:
        found = {r["fp"]: r["component_id"] for r in near_duplicates(rows).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert [found[signed(v)] for v in values] == plain_components(values)


def test_large_cell_gives_a_forest():
    rng = np.random.default_rng(1)
    flips = np.array([1 << k for k in range(64)], np.uint64)
    homes = np.unique(np.uint64(12345) ^ flips[rng.integers(0, 64, 200)] ^ flips[rng.integers(0, 64, 200)])
    fp = np.concatenate([homes, homes])
    new = np.zeros(len(fp), bool)
    new[0] = True
    u, v = cell_edges(new, np.repeat([False, True], len(homes)), fp)
    assert len(u) < 3 * len(homes)
    assert (np.bitwise_count(u ^ v) <= 6).all()


def test_neighbours_meet_in_a_cell(spark):
    rng = random.Random(9)
    pairs = [(v, v ^ sum(1 << k for k in rng.sample(range(64), n))) for n in (1, 2, 3) for v in (rng.getrandbits(64) for _ in range(60))]
    nodes = spark.createDataFrame([(signed(x),) for p in pairs for x in p], "fp long").distinct()
    rows = grid(nodes)
    cells = {}
    for r in rows.collect():
        cells.setdefault((r["half"], r["cell"]), {True: set(), False: set()})[r["probe"]].add(r["fp"])
    met = {frozenset((p, h)) for c in cells.values() for p in c[True] for h in c[False]}
    assert all(frozenset(map(signed, p)) in met for p in pairs)


def test_documents(spark, documents, odd_texts):
    rows = [(100 - i, t) for i, t in enumerate(odd_texts)] + [(7, "same text twice"), (7, "same text twice"), (None, "alone by itself here"), (None, "same text twice")]
    found = simhash_components(documents(rows)).collect()
    assert len(found) == len(rows)
    values = [plain_fingerprint(t or "") for _, t in rows]
    label = plain_components(values)
    least = {}
    for (i, _), g in zip(rows, label, strict=True):
        least[g] = min((x for x in (least.get(g), i) if x is not None), default=None)
    want = sorted(((i, f"{v:016x}", least[g]) for (i, _), v, g in zip(rows, values, label, strict=True)), key=repr)
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in found), key=repr) == want


def test_one_of_each_group_stays(documents, odd_texts):
    docs = documents([(i, t) for i, t in enumerate(odd_texts)] + [(3, "\n"), (None, "unique words here today")])
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    groups = {r["component_id"] for r in simhash_components(docs).collect()}
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted(groups, key=repr)


def test_empty(documents):
    assert simhash_components(documents([])).count() == 0
    assert drop_near_duplicates(documents([])).count() == 0


def test_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = sorted(docs.select("doc_id", "text").collect())
    label = plain_components([plain_fingerprint(r["text"]) for r in rows])
    found = {r["doc_id"]: r["component_id"] for r in simhash_components(docs).collect()}
    assert [found[r["doc_id"]] for r in rows] == [rows[g]["doc_id"] for g in label]
    assert fingerprints(docs, ["doc_id"]).where(F.col("fp").isNull()).count() == 0


def test_columns_that_the_stage_would_name_itself(spark):
    rows = [(1, "a b c d", "p"), (2, "a b c d", "q"), (3, "e f g h", "r"), (None, "e f g h", "s")]
    names = ["text_hash", "FP", "root", "kept_id", "kept_hash", "component_id", "first_id"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Text_Hash string").repartition(2)
    docs = docs.selectExpr("*", *(f"1 AS {n}" for n in names[1:]))
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted((r["doc_id"], r["Text_Hash"]) for r in kept.collect()) == [(1, "p"), (3, "r")]
