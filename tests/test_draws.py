import hashlib

from pyspark.sql import functions as F

from seqlab.functions import draw_hash, draw_int, draw_uniform, percent_2dp, strip, zfill


def py_hash(seed, purpose, key):
    return int(hashlib.md5(f"{seed}:{purpose}:{key}".encode()).hexdigest()[:8], 16)


def test_hash_is_md5_of_seed_purpose_key(spark):
    rows = spark.range(200).select("id", draw_hash(7, "x", "id").alias("h"), draw_hash(7, "x", "id", F.lit("b")).alias("h2")).collect()
    assert all(r.h == py_hash(7, "x", r.id) and r.h2 == py_hash(7, "x", f"{r.id}|b") for r in rows)


def test_draws_do_not_depend_on_partitioning(spark):
    df = spark.range(500).withColumn("d", draw_int(5, 9, 1, "p", "id"))
    assert df.repartition(1).collect().sort() == df.repartition(17).collect().sort()
    assert {r.d for r in df.collect()} == {5, 6, 7, 8, 9}


def test_uniform_is_spread_and_seeded(spark):
    mean = spark.range(20000).agg(F.avg(draw_uniform(3, "u", "id")).alias("m")).first().m
    assert abs(mean - 0.5) < 0.01
    differs = spark.range(100).where(draw_uniform(3, "u", "id") != draw_uniform(4, "u", "id")).count()
    assert differs > 95


def test_text_helpers(spark):
    row = spark.range(1).select(
        zfill(F.lit(7), 2).alias("a"),
        zfill(F.lit(123), 2).alias("b"),
        strip(F.lit("\t x y\r\n")).alias("c"),
        percent_2dp(F.lit(1), F.lit(3)).alias("d"),
        percent_2dp(F.lit(1), F.lit(0)).alias("e"),
        percent_2dp(F.lit(1), F.lit(800)).alias("f"),
        percent_2dp(F.lit(3), F.lit(800)).alias("g"),
    ).first()
    assert tuple(row) == ("07", "123", "x y", 33.33, 0.0, 0.12, 0.38)
