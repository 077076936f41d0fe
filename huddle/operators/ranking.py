"""Global positions in a sorted order, without a single-partition window.

``Window.orderBy(...)`` with no ``partitionBy`` moves every row into one
task.  Here the data is range-partitioned on the sort key (sampled bounds,
so one hot value is split across tasks), sorted inside each partition, and
scanned once per partition; one row per partition of counts gives the
offsets that turn local positions into global ones.  The scanned frame is
written once to the session's shared checkpoint folder so both uses of it
(the counts and the final rows) see the same partitioning, also after an
executor is lost and tasks are recomputed.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from huddle.session import ensure_checkpoint_dir, materialize


def _local_scan(flag_col: str):
    def scan(batches):
        idx = 0
        before = 0
        for pdf in batches:
            flags = pdf[flag_col].to_numpy(dtype=np.int64)
            n = len(flags)
            pdf["_local_idx"] = np.arange(idx, idx + n, dtype=np.int64)
            pdf["_local_before"] = before + np.cumsum(flags) - flags
            idx += n
            before += int(flags.sum())
            yield pdf

    return scan


def global_positions(
    df: DataFrame,
    order: Sequence[str],
    flag: str,
    num_partitions: int | None = None,
    position_col: str = "position",
    before_col: str = "flag_before",
) -> DataFrame:
    """Add ``position`` (0-based rank in ``order``) and ``flag_before``
    (number of earlier rows whose integer ``flag`` is 1).  ``order`` must be
    a total order (end it with a unique key)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    ordered = ordered.withColumn("_pid", F.spark_partition_id())
    schema = T.StructType(
        ordered.schema.fields
        + [T.StructField("_local_idx", T.LongType()), T.StructField("_local_before", T.LongType())]
    )
    scanned = materialize(ordered.mapInPandas(_local_scan(flag), schema), "positions")
    # one row per partition: a window over it is bounded by the partition count
    totals = scanned.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.sum(flag).alias("_nf"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_pid",
        F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"),
        F.coalesce(F.sum("_nf").over(w), F.lit(0)).alias("_off_f"),
    )
    out = scanned.join(F.broadcast(offsets), "_pid")
    return out.select(
        *df.columns,
        (F.col("_off") + F.col("_local_idx")).alias(position_col),
        (F.col("_off_f") + F.col("_local_before")).alias(before_col),
    )
