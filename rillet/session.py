"""Session builder and cluster-wide settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators assume; all of them are plain Spark configuration.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Top-n per key: keep a partial limit on the map side before the shuffle.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "rillet", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with UTC time, AQE and skew-join handling on.

    The master and the number of shuffle partitions are set only when asked for, so
    spark-submit's and the cluster's values hold. ANSI mode stays at the Spark 4 default
    (on); operators use ``try_*`` functions wherever the source allows bad values.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder that ``spark.checkpoint.dir`` names.

    Where it is unset, a session on this one machine (tests) gets a fresh local folder;
    on a cluster that would be a different disk for every executor, so it is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not current:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="rillet-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def materialized(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write a frame once under the shared folder and read it back: several consumers
    share it, lineage ends here, and no executor memory or disk holds it. ``codec`` is
    Parquet's, else the session's; ``zstd`` packs whole texts and doubles more tightly."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/rillet/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cluster_conf(input_bytes: int, total_cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Sizing for a cluster run: input splits and shuffle partitions of about
    ``partition_bytes`` each (a multiple of the core count, at least two waves),
    AQE coalescing towards half of that, and skew splitting above four times
    the median. For 100 TB on 8000 cores this gives 376 000 shuffle partitions
    of about 256 MB that AQE merges where the data turns out smaller."""
    waves = max(2, -(-input_bytes // (partition_bytes * total_cores)))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(waves * total_cores),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes * 2),
    }
