from collections import Counter

import pytest
from pyspark.sql import functions as F

from seqlab.operators import mixing, sampling, selection
from seqlab.operators.positions import ordered_position, rank_by_bucket, rank_by_range, shuffled_position

FIRST = "mate = 1"


def ids(df):
    return sorted((r.sample_id, r.pair_id, r.mate) for r in df.collect())


def quotas(spark, wanted):
    return spark.createDataFrame([(g, "all", q) for g, q in wanted.items()], "grp string, slot string, quota bigint")


def test_fraction_keeps_pairs_together(spark, make_reads):
    kept = sampling.subsample_fraction(make_reads({"a": 2000}), "pair_id", 0.3)
    mates = Counter(r.pair_id for r in kept.collect())
    assert set(mates.values()) == {2} and 500 < len(mates) < 700
    with pytest.raises(ValueError):
        sampling.subsample_fraction(kept, "pair_id", 0)


def test_quota_is_exact_and_independent_of_partitioning(spark, make_reads):
    wanted = quotas(spark, {"a": 7, "b": 0, "c": 500, "d": 1})
    sizes = {"a": 40, "b": 10, "c": 12, "d": 1}
    results = [
        ids(sampling.subsample_quota(make_reads(sizes, p), "sample_id", "pair_id", wanted, 42, first))
        for p, first in ((1, FIRST), (17, FIRST), (5, None))
    ]
    assert results[0] == results[1] == results[2]
    got = Counter(s for s, _, mate in results[0] if mate == 1)
    assert got == {"a": 7, "c": 12, "d": 1}
    assert Counter(s for s, _, mate in results[0] if mate == 2) == got
    other = ids(sampling.subsample_quota(make_reads(sizes), "sample_id", "pair_id", wanted, 43, FIRST))
    assert other != results[0]


def test_quota_matches_plain_ranking(spark):
    df = spark.range(30000).select((F.col("id") % 3).cast("string").alias("g"), "id")
    wanted = quotas(spark, {"0": 1234, "1": 1, "2": 9999})
    kept = sampling.subsample_quota(df, "g", "id", wanted, 5, "true")
    rows = df.withColumn("h", sampling.draw_hash(5, "count", "g", "id")).collect()
    for g, n in (("0", 1234), ("1", 1), ("2", 9999)):
        best = {r.id for r in sorted((r.h, r.id, r) for r in rows if r.g == g)[:n] for r in [r[2]]}
        assert {r.id for r in kept.where(F.col("g") == g).collect()} == best


def test_samples_of_growing_size_are_nested(spark, make_reads):
    reads = make_reads({"a": 100})
    small, large = (set(ids(sampling.subsample_count(reads, "pair_id", n, 42, FIRST))) for n in (10, 60))
    assert small < large and len(small) == 20


def test_low_coverage_counts(spark, make_reads):
    percent = spark.createDataFrame([("a", 10), ("b", 50)], "grp string, percent int")
    kept = sampling.low_coverage(make_reads({"a": 95, "b": 7}), "sample_id", "pair_id", percent, 42, FIRST)
    assert Counter(r.sample_id for r in kept.where("mate = 1").collect()) == {"a": 9, "b": 3}


def test_mixing_counts_and_audit(spark, make_reads):
    plan = spark.createDataFrame([("a", "x", 25), ("b", "x", 100), ("c", "y", 50)], "sample_id string, contaminant_id string, pct int")
    host, foreign = make_reads({"a": 101, "b": 10, "c": 8, "unplanned": 5}), make_reads({"x": 60, "y": 2})
    mixed, mixture = mixing.mix_contaminant(host, foreign, plan, 42, FIRST)
    audit = {r.sample_id: r for r in mixing.mixing_audit(mixed, mixture.sized, FIRST).collect()}
    assert (audit["a"].n_own, audit["a"].got_own, audit["a"].got_foreign) == (76, 76, 25)
    assert (audit["b"].got_own, audit["b"].got_foreign) == (0, 10)
    assert (audit["c"].n_foreign, audit["c"].got_own, audit["c"].got_foreign) == (4, 4, 2)
    assert mixed.where("sample_id = 'unplanned'").isEmpty()
    headers = {r.header[1] for r in mixed.where("sample_id = 'a' AND origin = 'contaminant'").collect()}
    assert headers == {"x"}


def test_series_is_nested_and_ends_fully_foreign(spark, make_reads):
    series = mixing.contamination_series(make_reads({"h": 40}), make_reads({"f": 40}), 4, 42, FIRST).where("mate = 1").collect()
    counts = Counter((r.step, r.origin) for r in series)
    assert counts == {(1, "contaminant"): 10, (1, "host"): 30, (2, "contaminant"): 20, (2, "host"): 20, (3, "contaminant"): 30, (3, "host"): 10, (4, "contaminant"): 40}
    foreign = {s: {r.pair_id for r in series if r.step == s and r.origin == "contaminant"} for s in range(1, 5)}
    assert foreign[1] < foreign[2] < foreign[3] < foreign[4]


def test_positions(spark):
    df = spark.range(9000).select(F.concat(F.lit("k"), F.col("id")).alias("key"))
    ordered = {r.key: r.p for r in ordered_position(df, "key", "p").collect()}
    assert ordered == {k: i + 1 for i, k in enumerate(sorted(ordered))} and len(ordered) == 9000
    shuffled = [r.p for r in sorted(shuffled_position(df, "key", 1, "x", "p").collect(), key=lambda r: r.key)]
    assert sorted(shuffled) == list(range(1, 9001)) and shuffled != sorted(shuffled)
    hot = spark.range(5000).select(F.when(F.col("id") < 4500, "hot").otherwise("cold").alias("g"), "id")
    ranked = rank_by_bucket(hot, ["g"], F.shiftright("id", 6), [F.col("id")], "p").collect()
    assert all(r.p == (r.id + 1 if r.g == "hot" else r.id - 4499) for r in ranked)


def test_topup(spark):
    rows = spark.range(5).select(F.concat(F.lit("s"), F.col("id")).alias("name"))
    more = selection.sample_with_topup(rows, 12, "name").collect()
    assert len(more) == 12 and sorted(r.name for r in more if r.replicate == 0) == ["s0", "s1", "s2", "s3", "s4"]
    assert sorted(r.replicate for r in more if r.replicate) == list(range(1, 8))
    assert selection.sample_with_topup(rows, 3, "name").count() == 3
    assert selection.sample_with_topup(rows, 5, "name").count() == 5


def test_groups_and_choice(spark):
    rows = spark.range(100).select("id", (F.col("id") % 9).alias("g"))
    groups = selection.sample_groups(rows, "g", "id", 4).collect()
    assert len({r.g for r in groups}) == 4 and all(r.id % 9 == r.g for r in groups)
    assert selection.choose_one(rows, "id").count() == 1
    assert selection.choose_one(rows.where("id < 0"), "id").count() == 0


def test_error_weights(spark):
    rows = spark.range(20000).withColumn("e", selection.error_label(42, "id"))
    share = {r.e: r.n / 20000 for r in rows.groupBy("e").agg(F.count("*").alias("n")).collect()}
    expected = {"CONTAMINATED": 0.496, "LOW_COVERAGE": 0.216, "TRUNCATED": 0.096, "CORRUPT": 0.096, "POOR_QUALITY": 0.096}
    assert share.keys() == expected.keys() and all(abs(share[e] - p) < 0.015 for e, p in expected.items())


def test_assign_errors_takes_the_floor(spark):
    out = selection.assign_errors(spark.range(11), "id", 0.6).collect()
    assert sum(r.qc == "FAILED" for r in out) == 6
    assert all((r.error == "NONE") == (r.qc == "PASSED") for r in out)


def test_proportion_and_fixed_size(spark):
    kept = {p: {r.id for r in sampling.sample_proportion(spark.range(0, 101, 1, p), 0.6, "id").collect()} for p in (1, 9)}
    assert kept[1] == kept[9] and len(kept[1]) == 60
    assert {r.id for r in sampling.sample_n(spark.range(101), 25, "id").collect()} < kept[1]


def test_labels_and_pool(spark):
    labels = Counter(r.label for r in selection.deal_labels(spark.range(20), "id", {"A": 2, "B": 1}).collect())
    assert labels == {"A": 2, "B": 1, "NORMAL": 17}
    pool = spark.createDataFrame([("x",), ("y",), ("z",)], "c string")
    dealt = Counter(r.c for r in selection.deal_pool(spark.range(7), "id", pool, "c").collect())
    assert sorted(dealt.values()) == [2, 2, 3]
    with pytest.raises(ValueError):
        selection.deal_pool(spark.range(7), "id", pool.where("c = 'no'"), "c")


def test_large_parameter_tables_are_not_broadcast(spark, make_reads):
    """With the size limit at zero the same result comes from shuffled joins."""
    wanted = quotas(spark, {"a": 7, "b": 3})
    reads = make_reads({"a": 40, "b": 10})
    usual = ids(sampling.subsample_quota(reads, "sample_id", "pair_id", wanted, 42, FIRST))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert ids(sampling.subsample_quota(reads, "sample_id", "pair_id", wanted, 42, FIRST)) == usual
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


@pytest.mark.parametrize("plain", [0, 40, 10**6])
def test_positions_of_large_and_small_groups(spark, plain):
    rows = [("hot", i % 7, i) for i in range(300)] + [(None, i, i) for i in range(50)] + [(g, 1, i) for g in "abc" for i in range(3)]
    df = spark.createDataFrame(rows, "g string, a long, b long").repartition(4)
    found = sorted(map(repr, map(tuple, rank_by_range(df, ["g"], ["a", "b"], "p", plain).collect())))
    want = []
    for g in ("hot", None, "a", "b", "c"):
        want += [(g, a, b, i + 1) for i, (a, b) in enumerate(sorted((a, b) for x, a, b in rows if x == g))]
    assert found == sorted(map(repr, want))
    whole = rank_by_range(df.where("g = 'hot'"), [], ["a", "b"], "p", plain).orderBy("p").collect()
    assert [(r["a"], r["b"]) for r in whole] == sorted((a, b) for g, a, b in rows if g == "hot") and [r["p"] for r in whole] == list(range(1, 301))
