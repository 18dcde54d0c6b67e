import pytest
from pyspark.sql import functions as F

from seqlab.operators.reads import corrupt_text, decrement_quality, degrade_quality, truncate_reads


def one(spark, sequence, quality):
    schema = "sample_id string, pair_id bigint, mate int, header string, sequence string, plus string, quality string"
    return spark.createDataFrame([("s", 0, 1, "@SEQ_ID_1", sequence, "+", quality)], schema)


@pytest.mark.parametrize("n,sequence,quality", [(5, "ACTGA", "IIIII"), (20, "ACTGACTGACTG", "IIIIIIIIIIII")])
def test_truncation(spark, n, sequence, quality):
    row = truncate_reads(one(spark, "ACTGACTGACTG", "IIIIIIIIIIII"), n).first()
    assert (row.header, row.sequence, row.plus, row.quality) == ("@SEQ_ID_1", sequence, "+", quality)


def test_truncation_of_one_mate(spark, make_reads):
    rows = truncate_reads(make_reads({"a": 5}), 3, mates=(2,)).collect()
    assert all(len(r.sequence) == (12 if r.mate == 1 else 3) for r in rows)


def test_degraded_quality_stays_in_the_falling_range(spark):
    reads = spark.range(400).select(
        F.lit("s").alias("sample_id"), F.col("id").alias("pair_id"), F.lit(1).alias("mate"), F.repeat(F.lit("A"), 100).alias("sequence"), F.lit("").alias("quality")
    )
    rows = degrade_quality(reads, 5, 30).collect()
    assert all(len(r.quality) == 100 for r in rows)
    for i in range(100):
        scores = {ord(r.quality[i]) - 33 for r in rows}
        top = 30 - int(i / 100 * 25)
        assert min(scores) == 5 and max(scores) == top
    assert len({r.quality for r in rows}) == 400


def test_degrade_of_empty_reads_and_bad_range(spark):
    assert degrade_quality(one(spark, "", ""), 5, 30).first().quality == ""
    with pytest.raises(ValueError, match="0-93"):
        degrade_quality(one(spark, "A", "I"), 31, 30)


def test_degrade_handles_reads_longer_than_a_block(spark):
    row = degrade_quality(one(spark, "A" * 3_000_000, ""), 5, 30).first()
    assert len(row.quality) == 3_000_000 and ord(max(row.quality[-50_000:])) - 33 == 6


def test_decrement_has_a_floor(spark):
    row = decrement_quality(one(spark, "ACGTA", "!+5I~"), 20).first()
    assert row.quality == "!!!5j"
    assert decrement_quality(one(spark, "A", "~"), 94).first().quality == "!"


def test_corruption_changes_exactly_one_character(spark):
    df = spark.range(300).select("id", F.repeat(F.lit("A"), 20).alias("t"))
    rows = corrupt_text(df, "t", "id", marker="x").collect()
    assert all(r.t.count("x") == 1 and len(r.t) == 20 for r in rows)
    assert {r.t.index("x") for r in rows} == set(range(20))
    empty = corrupt_text(spark.createDataFrame([(1, "")], "id int, t string"), "t", "id").first()
    assert empty.t == ""
