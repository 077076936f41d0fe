"""Spark helpers of this subpackage."""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import DataFrame, Window

from huddle.session import materialize

#: Rows of a one- or two-column side that may be broadcast (about 16 MB of ids).
BROADCAST_ROWS = 500_000


def written(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the cluster's shared folder and read it back."""
    return materialize(df, f"llm-{name}")


def side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A written, narrow join side: broadcast when its counted rows are few,
    else left to the optimizer's shuffle join."""
    return F.broadcast(df) if df.count() <= limit else df


def small_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """The frame, with the session's Arrow and Parquet batches held to ``rows`` rows: texts are long, and a
    task's Python and JVM each hold whole batches."""
    conf = df.sparkSession.conf
    for name in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize"):
        if int(conf.get(name)) > rows:
            conf.set(name, str(rows))
    return df


def has_rows(df: DataFrame) -> bool:
    return bool(df.take(1))


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The frame with its columns called c0, c1, ..., so that none clashes with an operator's own,
    and the new name of each old one."""
    names = {c: f"c{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def positions(df: DataFrame, order: list, name: str, group: str | None = None) -> DataFrame:
    """The frame with ``position`` (from 0) and ``total``, of all rows or of those that share the
    non-null column ``group``, which ``order`` then begins with.  ``order`` must be a total order.

    No window sees all rows: they are range-partitioned, sorted and written with their place in
    their partition; one row per partition (and group in it) then holds how many came before."""
    here = F.monotonically_increasing_id()
    placed = written(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", here), name)
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    placed = placed.select("*", part.alias("_part"), place.alias("_place")).drop("_at")
    keys = ["_part"] + ([group] if group else [])
    counts = placed.groupBy(*keys).agg(F.count("*").alias("_rows"), F.min("_place").alias("_first"))
    whole = Window.partitionBy(*([group] if group else [F.lit(0)]))  # one row per partition: bounded by their number
    before = F.sum("_rows").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(*keys, (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_rows").over(whole).alias("total"))
    placed = placed.join(side(written(counts, f"{name}-counts")), keys)
    return placed.select(*df.columns, (F.col("_place") + F.col("_shift")).alias("position"), "total")
