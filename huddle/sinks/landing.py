"""Incremental landing: add only what is not there yet, whatever was interrupted.

``land`` takes whole partitions, ``land_files`` source files, of which a season
may have several that arrive at different times.  Both write first and enter
what they wrote in a log beside the data (folders that readers of the target
skip) afterwards.  What the log does not list is written again to the same
folders and replaces what an interrupted run left there, so no row is lost or
repeated.  The log, not the data, is read to learn what is there.  A target is
filled by one of the two, not by both.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from huddle.session import materialize


def new_partitions(incoming: DataFrame, landed_keys: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``incoming`` whose partition key is not among ``landed_keys``;
    a NULL key equals a NULL key."""
    landed = landed_keys.select(*[F.col(k).alias(f"_landed_{i}") for i, k in enumerate(keys)]).distinct()
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_landed_{i}")) for i, k in enumerate(keys)])
    return incoming.join(landed, same, "left_anti")


def landed_keys(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame | None:
    """The keys that the target holds, or None where there is no target yet."""
    try:
        landed = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return landed.select(*keys).distinct()


def land_files(batch: DataFrame, path: str, keys: Sequence[str] = ("season",), file_col: str = "_file") -> None:
    """Append the rows of source files that ``path`` has not had yet.

    The unit is the source file, named by ``file_col``: its rows go to
    ``<keys>/landing=<id>``, the id following from the file's name alone, and
    replace that folder.  Then the batch's files are entered in the log
    (``<path>/_landed_files``).  A file whose rows were written but not entered is
    written again to the same place, in whatever batch it comes next."""
    spark, log = batch.sparkSession, f"{path}/_landed_files"
    done = landed_keys(spark, log, [file_col])
    todo = batch if done is None else new_partitions(batch, done, [file_col])
    named = todo.withColumn("landing", F.concat(F.lit("f"), F.substring(F.sha2(F.col(file_col), 256), 1, 32)))
    files = materialize(named.select(file_col, "landing").distinct(), "landing-files")
    if not files.take(1):
        return
    by = [*keys, "landing"]
    _replace(named.drop(file_col), path, by)
    files.coalesce(1).write.mode("append").parquet(log)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the source files that the log lists, without those of an interrupted run."""
    listed = spark.read.parquet(f"{path}/_landed_files").select("landing").distinct()  # one row per source file
    return spark.read.parquet(path).join(listed, "landing", "left_semi").drop("landing")


def _replace(rows: DataFrame, path: str, by: Sequence[str]) -> None:
    """Write rows partitioned by ``by``; partitions that have rows are replaced, the others stay."""
    rows.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def land(spark: SparkSession, incoming: DataFrame, path: str, keys: Sequence[str] = ("season",)) -> None:
    """Append the partitions of ``incoming`` that ``path`` does not hold yet.

    The keys landed are in the log (``<path>/_landed_keys``, one row per partition).  A
    target that was filled before it had a log has its keys entered first."""
    log = f"{path}/_landed_keys"
    done = landed_keys(spark, log, keys)
    if done is None:
        present = landed_keys(spark, path, keys)
        first = incoming.select(*keys).limit(0) if present is None else present
        first.coalesce(1).write.mode("append").parquet(log)
        done = landed_keys(spark, log, keys)
    # a snapshot: the comparison must not change while the log grows
    todo = new_partitions(incoming, materialize(done, "landing-keys"), keys)
    fresh = materialize(todo.select(*keys).distinct(), "landing-keys")
    if not fresh.take(1):
        return
    _replace(todo, path, keys)
    fresh.coalesce(1).write.mode("append").parquet(log)
