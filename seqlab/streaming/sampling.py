"""Exact samples of reads that arrive as a stream: the first n pairs in hash order of each sample, whatever the batches are.

The first n pairs of all that came are among the first n of what was kept and of what is new, so the kept keys are all the
state. Each micro-batch writes them as a version of its own, made from the version before it: a batch that is repeated
after a failure writes the same version again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from seqlab.functions import draw_hash
from seqlab.operators.sampling import pair_keys, within_cut

KEPT = "kept-"


def versions(spark: SparkSession, folder: str) -> list[int]:
    """The numbers of the micro-batches whose kept keys are complete in ``folder``, ascending."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    done = (s.getPath() for s in fs.listStatus(path) if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")))
    return sorted(int(p.getName().removeprefix(KEPT)) for p in done if p.getName().startswith(KEPT))


def forget(spark: SparkSession, folder: str, version: int) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{KEPT}{version}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def sample_stream(
    reads: DataFrame, group: str, key: str, quotas: DataFrame, folder: str, checkpoint: str, seed: int = 42, first: str | None = None
) -> StreamingQuery:
    """Keep in ``folder`` the keys of the sample of ``quota`` pairs of each group, over all available rows of the stream ``reads``.

    ``quotas`` (grp, slot, quota) and ``first`` are those of ``subsample_quota``, whose sample it is. The mates of a pair may come in
    different batches. A group needs no task of its own before its rows are cut down to the quota; once that is reached, rows
    beyond the last kept key are dropped where they are read.
    """

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        done = [v for v in versions(spark, folder) if v < number]
        most = quotas.agg(F.max("quota")).first()[0] or 0
        keys = pair_keys(batch, F.col(group), key, first)
        fresh = keys.select("grp", "key", draw_hash(seed, "count", "grp", "key").alias("h")).join(quotas.select("grp", "quota"), "grp")
        if done:
            kept = spark.read.parquet(f"{folder}/{KEPT}{done[-1]}").join(quotas.select("grp", "quota"), "grp").select("grp", "key", "h", "quota")
            full = closing_keys(kept).where(F.col("taken") >= F.col("quota")).select("grp", "cut_h", "cut_key")
            open_rows = F.col("cut_h").isNull() | within_cut(F.col("h"), F.col("key"))
            fresh = fresh.join(full, "grp", "left").where(open_rows).select(*kept.columns).unionByName(kept)
        place = F.row_number().over(Window.partitionBy("grp").orderBy("h", "key"))
        ranked = fresh.distinct().withColumn("place", place).where(F.col("place") <= most)  # a constant: cut before the shuffle
        ranked.where(F.col("place") <= F.col("quota")).select("grp", "key", "h").write.mode("overwrite").parquet(f"{folder}/{KEPT}{number}")
        for old in done[:-1]:
            forget(spark, folder, old)

    return reads.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def closing_keys(kept: DataFrame) -> DataFrame:
    """(grp, quota, taken, cut_h, cut_key) of kept keys (grp, key, h, quota): how many there are and the last in hash order."""
    last = F.max(F.struct("h", "key")).alias("last")
    found = kept.groupBy("grp", "quota").agg(F.count(F.lit(1)).alias("taken"), last)
    return found.select("grp", "quota", "taken", F.col("last.h").alias("cut_h"), F.col("last.key").alias("cut_key"))


def streamed_sample(reads: DataFrame, group: str, key: str, quotas: DataFrame, folder: str, seed: int = 42) -> DataFrame:
    """The rows of ``reads``, all that the stream has had, that are in the sample that ``sample_stream`` keeps in ``folder``.

    A filter by the last kept key of each group, as in the batch; the reads are not shuffled.
    """
    spark = reads.sparkSession
    found = versions(spark, folder)
    if not found:
        return reads.limit(0)
    kept = spark.read.parquet(f"{folder}/{KEPT}{found[-1]}").join(quotas.select("grp", "quota"), "grp")
    cuts = closing_keys(kept).select(F.col("grp").alias(group), "cut_h", "cut_key")
    return reads.join(cuts, group).where(within_cut(draw_hash(seed, "count", group, key), F.col(key))).select(*reads.columns)
