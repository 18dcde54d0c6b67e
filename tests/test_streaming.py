import pytest

from seqlab.operators.sampling import subsample_quota
from seqlab.streaming.sampling import KEPT, sample_stream, streamed_sample, versions

QUOTAS = [("hot", "all", 40), ("a", "all", 5), ("few", "all", 50), ("none", "all", 0)]


def write_part(reads, path, condition):
    reads.where(condition).coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("first", ["mate = 1", None])
def test_the_stream_keeps_the_sample_of_the_batch(spark, tmp_path, make_reads, first):
    reads = make_reads({"hot": 300, "a": 30, "few": 20, "none": 9, "other": 9})
    quotas = spark.createDataFrame(QUOTAS, "grp string, slot string, quota bigint")
    source, folder, checkpoint = (str(tmp_path / x) for x in ("in", "kept", "log"))

    def run():
        stream = spark.readStream.schema(reads.schema).option("maxFilesPerTrigger", 1).parquet(source)
        sample_stream(stream, "sample_id", "pair_id", quotas, folder, checkpoint, 7, first).awaitTermination()

    def sampled(rows):
        return sorted(map(tuple, rows.select("sample_id", "pair_id", "mate").collect()))

    mates = "mate = 1 or pair_id % 2 = 0"  # the other second mates come later
    for part in (f"pair_id % 3 = 0 and ({mates})", f"pair_id % 3 = 1 and ({mates})"):
        write_part(reads, source, part)
    run()
    so_far = reads.where(f"pair_id % 3 < 2 and ({mates})")
    assert sampled(streamed_sample(so_far, "sample_id", "pair_id", quotas, folder, 7)) == sampled(subsample_quota(so_far, "sample_id", "pair_id", quotas, 7, first))
    # A restart goes on with the kept keys.
    write_part(reads, source, f"pair_id % 3 = 2 and ({mates})")
    write_part(reads, source, f"not ({mates})")
    run()
    want = sampled(subsample_quota(reads, "sample_id", "pair_id", quotas, 7, first))
    assert sampled(streamed_sample(reads, "sample_id", "pair_id", quotas, folder, 7)) == want and len(want) == 2 * (40 + 5 + 20)
    assert len(versions(spark, folder)) == 2
    # A batch that is repeated after it wrote its keys writes the same again.
    last = versions(spark, folder)[-1]
    before = sorted(map(tuple, spark.read.parquet(f"{folder}/{KEPT}{last}").collect()))
    for name in (str(last), f".{last}.crc"):
        (tmp_path / "log" / "commits" / name).rename(tmp_path / f"lost{name}")
    run()
    assert versions(spark, folder)[-1] == last and sorted(map(tuple, spark.read.parquet(f"{folder}/{KEPT}{last}").collect())) == before


def test_no_rows(spark, tmp_path, make_reads):
    reads = make_reads({"a": 2})
    quotas = spark.createDataFrame(QUOTAS, "grp string, slot string, quota bigint")
    assert streamed_sample(reads, "sample_id", "pair_id", quotas, str(tmp_path / "nothing")).count() == 0
