"""Session settings, and the shared folder for landed intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_scratch: dict[str, str] = {}


def build_session(app: str = "seqlab", cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark; on a cluster use the session that is given."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SEQLAB_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a fresh scratch folder if that is unset and all threads are in this process.

    A folder that is named is taken to be shared, whatever its scheme: a mounted one has none. Any master but ``local`` and
    ``local[...]``, an unknown one too, needs the setting.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise ValueError("Set spark.checkpoint.dir to a folder that all executors share.")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return _local_scratch[app]


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Used for per-sample parameter tables. It cuts the lineage, outlives lost executors, and gives the
    optimizer the true size of the table: a join with it is broadcast only below
    ``spark.sql.autoBroadcastJoinThreshold`` and is a shuffled, skew-split join above it.
    """
    spark = df.sparkSession
    path = f"{landing_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def landing_folder(spark: SparkSession) -> str:
    """Where this application lands its tables."""
    return f"{shared_folder(spark)}/seqlab/{spark.conf.get('spark.app.id', 'local')}"


def release(spark: SparkSession) -> None:
    """Delete all that this application has landed; results that still depend on it can no longer be computed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(landing_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
