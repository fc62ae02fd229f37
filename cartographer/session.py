"""Session construction and lineage cutting.

The builder only sets what the library relies on (UTC session time zone, AQE
with skew-join handling, Arrow transfer); everything else is left to the
cluster's own defaults so a production deployment can size shuffles itself.
"""

from __future__ import annotations

import gc
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # aggregate-side skew: AQE splits oversized shuffle partitions of rebalances
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoints no plan refers to any more are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "cartographer", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is. Only when it is unset (local tests) a scratch folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not (sc.master or "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store) on a cluster")
    local = tempfile.mkdtemp(prefix="cartographer-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return local


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the reliable checkpoint folder.

    Used before iterative model fits so that a lost executor re-reads the
    checkpoint instead of replaying the whole feature lineage.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Has shuffle files removed that no plan refers to any more.

    Spark removes them when the driver happens to collect its garbage: on a quiet
    driver those of finished steps stay beside those of the next.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
