import numpy as np
import pytest

from seqlab.llm import multi_index
from seqlab.llm.multi_index import Index, learn, search

VECTORS = "vec_id long, embedding array<float>, label int, score double, block int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 0.5, 1) for i, v in rows], VECTORS).repartition(3)


def brute(rows, asked, k):
    out = {}
    for q, v in asked:
        scored = sorted((-sum(float(np.float32(a)) * float(np.float32(b)) for a, b in zip(v, w, strict=True)), i) for i, w in rows if i != q)
        out[q] = scored[:k]
    return out


def test_within_finds_every_code():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 1 << 63, 20, dtype=np.uint64)
    codes = np.concatenate([base ^ np.uint64(rng.integers(0, 1 << 12)) for _ in range(30)])
    index = Index(codes)
    for radius in (0, 3, 7, 20, 64):
        for code in codes[:15]:
            assert index.within(code, radius).tolist() == np.flatnonzero(np.bitwise_count(codes ^ code) <= radius).tolist()


def test_recall(spark, folder):
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    want = brute(rows, [r for r in rows if r[0] % 20 == 0], 20)
    found = {}
    for r in search(vectors, vectors.where("vec_id % 20 = 0"), 20, block=100, query_block=10).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert found.keys() == want.keys()
    hits = 0
    for q, best in want.items():
        assert sorted(found[q]) == list(range(1, 21))
        hits += len({i for _, i in best} & {i for i, _ in found[q].values()})
        listed = [(-s, i) for _, (i, s) in sorted(found[q].items())]
        assert listed == sorted(listed)
    assert hits >= 0.9 * 20 * len(want)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i % 5), 1.0, -2.0]) for i in range(30)]
    bad = [(100, None), (101, []), (102, [0.0, 0.0, 0.0]), (103, [1.0, None, 1.0]), (104, [nan, 1.0, 1.0]), (105, [inf, 1.0, 1.0]), (106, [9.0, 9.0]), (None, [9.0, 9.0, 9.0])]
    rows = frame(spark, good + bad)
    found = search(rows, rows, k=50, block=7, query_block=11).collect()
    by = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        by.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
    assert by == brute(good, good, 50)  # all candidates, ties to the smaller id
    assert search(frame(spark, bad[:3]), rows, 5).count() == 0
    assert search(rows, rows.limit(0), 5).count() == 0
    assert search(frame(spark, good[:1]), frame(spark, good[:1]), 5).count() == 0


def test_repeated_rows(spark):
    rows = frame(spark, [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [0.1, 0.2])])
    found = search(rows, rows.where("vec_id = 3"), 3).collect()
    assert [(r["vec_id"]) for r in sorted(found, key=lambda r: r["rank"])] == [2, 2, 1]


@pytest.mark.parametrize("dims", [2, 40, 200])
def test_codes_of_any_dimension(dims):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(300, dims))
    codes = learn(vectors, float(np.sqrt((vectors**2).sum(1).max())), 5, 300)
    assert codes.directions.shape == (dims + 1, multi_index.BITS) and 0 <= codes.radius <= 64


def clustered(n, seed=3, dims=24, centres=60):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dims))
    return [(i, [float(x) for x in np.float32(middle[i % centres] + 0.1 * rng.normal(size=dims))]) for i in range(n)]


@pytest.mark.parametrize("partitions, adaptive", [(8, "false"), (200, "false"), (8, "true")])
@pytest.mark.parametrize("block", [250, 100_000])
def test_all_groups_meet(spark, monkeypatch, partitions, adaptive, block):
    rows = clustered(4000)
    if block == 250:
        monkeypatch.setattr(multi_index, "cell_bits", lambda *a: 3)
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        vectors = frame(spark, rows)
        found = {}
        for r in search(vectors, vectors.where("vec_id % 20 = 0"), 20, block, 50).collect():
            found.setdefault(r["query_id"], set()).add(r["vec_id"])
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    data = np.array([v for _, v in rows])
    scores = data[::20] @ data.T
    assert len(found) == 200 and all(len(x) == 20 for x in found.values())
    hits = 0
    for at, q in enumerate(range(0, 4000, 20)):
        scores[at, q] = -np.inf
        hits += len(found[q] & set(np.argsort(-scores[at])[:20].tolist()))
    assert hits >= 0.95 * 20 * 200


def test_cells_give_every_code_in_the_radius_once():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 1 << 63, 3, dtype=np.uint64).repeat(200) ^ (np.uint64(1) << rng.integers(0, 64, 600).astype(np.uint64))
    for radius in (2, 9, 21):
        for code in codes[:4]:
            got = [r for p in range(multi_index.PARTS) for r in Index(codes, range(p, p + 1)).within(code, radius)]
            assert sorted(got) == np.flatnonzero(np.bitwise_count(codes ^ code) <= radius).tolist()


def test_cells_follow_the_radius():
    assert multi_index.cell_bits(51_300, 2565, 28, 8192, 4096) == 0
    assert multi_index.cell_bits(10**9, 5 * 10**7, 8, 8192, 4096) > 8
    assert multi_index.cell_bits(100, 5, 3, 8192, 4096) == 0


def test_queries_with_few_rows_in_the_radius(spark, monkeypatch):
    learn_codes = multi_index.learn
    monkeypatch.setattr(multi_index, "learn", lambda *a: multi_index.Codes(learn_codes(*a).directions, a[1], 0))
    rows = clustered(200, dims=5)
    vectors = frame(spark, rows)
    want = brute(rows, rows[:40], 30)
    found = {}
    for r in search(vectors, vectors.where("vec_id < 40"), 30, 64, 16).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    assert {q: [i for _, i in best] for q, best in want.items()} == {q: [x[n] for n in sorted(x)] for q, x in found.items()}
