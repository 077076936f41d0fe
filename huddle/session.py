"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Defaults that matter at scale: AQE re-plans joins from runtime sizes
# (its broadcast decision is size-checked against
# spark.sql.autoBroadcastJoinThreshold), coalesces small shuffle partitions
# and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Recording the Python call site of every column function costs several
    # driver round trips per call; plans with many expressions spend more
    # time on that than on analysis.  Errors still carry the plan context.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "huddle",
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    The folder comes from the session (``spark.checkpoint.dir`` or one set
    on the SparkContext).  Only a local session without one gets a fresh
    temporary folder; on a cluster a machine-local folder would not survive
    the loss of an executor, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage "
            "(HDFS/S3/ABFS) so checkpoints survive executor loss"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="huddle-ckpt-"))
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path below the checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts])


def table_path(root: str, name: str) -> str:
    return os.path.join(root, f"{name}.parquet")


def materialize(df, name: str = "table"):
    """Write ``df`` once as Parquet below the shared checkpoint folder and
    return a DataFrame reading it back.

    This cuts the lineage like ``checkpoint()`` but computes the input once
    (a reliable checkpoint of an unpersisted frame computes it twice) and
    keeps a columnar copy, so each consumer reads only the columns it
    needs.  The written files live on the shared storage the cluster names,
    so they survive the loss of any executor.
    """
    import uuid

    spark = df.sparkSession
    path = shared_path(spark, "huddle-tables", f"{name}-{uuid.uuid4().hex}")
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path)
