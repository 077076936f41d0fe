"""File sources.

Every reader declares its schema; NaN becomes NULL once, here, so no
operator downstream has to care (in Spark NaN is an ordinary value:
``NaN > 0`` is true and ``sum`` over it is NaN).
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from huddle import schemas
from huddle.functions.columns import nan_to_null


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One of the driver's tables (``<root>/<name>.parquet``), listed anew on
    every call, so rows appended since an earlier call are seen."""
    return spark.read.parquet(os.path.join(root, f"{name}.parquet"))


def nans_to_nulls(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Replace NaN by NULL in every floating column (or the given ones)."""
    floating = {
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    targets = floating if columns is None else floating & set(columns)
    return df.select(*[nan_to_null(c).alias(c) if c in targets else F.col(c) for c in df.columns])


def conform(df: DataFrame, schema: T.StructType, optional: Iterable[str] = schemas.OPTIONAL) -> DataFrame:
    """Project ``df`` onto ``schema``: cast present columns, add absent
    ``optional`` ones as NULL, drop the rest, then map NaN to NULL.  Any other
    absent column is an error: its sums would silently be 0."""
    present = set(df.columns)
    _require(present, schema, optional)
    cols = [
        (F.col(f.name).cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ]
    return nans_to_nulls(df.select(*cols))


def _require(present: set[str], schema: T.StructType, optional: Iterable[str]) -> None:
    absent = [f.name for f in schema.fields if f.name not in present and f.name not in set(optional)]
    if absent:
        raise ValueError(f"input lacks the declared column(s) {', '.join(absent)}")


def read_plays(
    spark: SparkSession,
    path: str,
    seasons: Sequence[int] | None = None,
    schema: T.StructType = schemas.PLAYS,
) -> DataFrame:
    """Play-by-play stored as one Parquet dataset partitioned by ``season``.

    Only the declared columns are read (the files may hold hundreds); a
    season list becomes a partition filter, so other seasons are never
    opened.  Replaces a per-season loop over files.  Seasons whose files hold
    a column in different types (``epa`` once as integers) are read as they
    are and widened to the declared types.
    """
    def wanted(df: DataFrame) -> DataFrame:
        return conform(df if seasons is None else df.filter(F.col("season").isin(list(seasons))), schema)

    try:  # the footers of all files, merged by a job
        return wanted(spark.read.option("mergeSchema", "true").parquet(path))
    except (PySparkException, Py4JJavaError) as e:
        if "CANNOT_MERGE" not in str(e) and "Failed to merge" not in str(e):
            raise
    return reduce(DataFrame.unionByName, [wanted(df) for df in _by_types(spark, path, [f.name for f in schema.fields])])


def _by_types(spark: SparkSession, path: str, names: Sequence[str]) -> list[DataFrame]:
    """One scan for each combination of types that the folders of a dataset hold ``names`` in."""
    folders = sorted({os.path.dirname(f) for f in spark.read.option("mergeSchema", "false").parquet(path).inputFiles()})
    base, found = path.rstrip("/"), {}

    def types(folder: str) -> T.StructType:
        return spark.read.option("mergeSchema", "true").parquet(folder).schema

    with ThreadPoolExecutor(8) as pool:  # one footer job per folder
        for folder, kinds in zip(folders, pool.map(types, folders), strict=True):
            held = tuple((f.name, f.dataType) for f in kinds.fields if f.name in names)
            found.setdefault(held, []).append(folder)
    return [
        spark.read.option("basePath", base).schema(T.StructType([T.StructField(n, t) for n, t in held])).parquet(*group)
        for held, group in found.items()
    ]


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    optional: Iterable[str] = schemas.OPTIONAL,
    missing: Sequence[str] = ("NA",),
) -> DataFrame:
    """CSV with a header row: the declared columns, found by name.

    The file may hold more columns, in any order.  A declared column that the
    header lacks is an error unless it is ``optional`` (then NULL).  Empty
    fields and the ``missing`` marks are NULL; any other value that its
    declared type cannot hold is an error when the column is read.  Files of
    one folder must share one header."""
    raw = spark.read.option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)
    _require(set(raw.columns), schema, optional)
    cols = [
        (_parsed(f, missing) if f.name in raw.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ]
    return nans_to_nulls(raw.select(*cols))


def _parsed(field: T.StructField, missing: Sequence[str]) -> Column:
    text = F.col(f"`{field.name}`")
    text = F.when(~text.isin(*missing), text) if missing else text
    if isinstance(field.dataType, T.StringType):
        return text
    value = text.try_cast(field.dataType)
    if isinstance(field.dataType, T.IntegralType):
        # "3.0", as written for an integer column with missing values
        number = text.try_cast("double")
        value = F.coalesce(value, F.when(number == F.floor(number), number.try_cast(field.dataType)))
    fault = F.raise_error(F.concat(F.lit(f"column {field.name}: not a {field.dataType.simpleString()}: "), text))
    return F.coalesce(value, F.when(text.isNotNull(), fault.cast(field.dataType)))


def read_weekly_player_stats(
    spark: SparkSession, path: str, positions: Sequence[str] | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Weekly player statistics, optionally limited to positions (pushed down)."""
    if fmt == "csv":
        df = read_csv(spark, path, schemas.WEEKLY_PLAYER_STATS)
    else:
        df = conform(spark.read.parquet(path), schemas.WEEKLY_PLAYER_STATS)
    if positions is not None:
        df = df.filter(F.col("position").isin(list(positions)))
    return df


def read_snap_counts(
    spark: SparkSession,
    path: str,
    seasons: Iterable[int] | None = None,
    schema: T.StructType = schemas.SNAP_COUNTS,
    fmt: str = "parquet",
) -> DataFrame:
    """Weekly snap counts, optionally limited to seasons (pushed down).  Files
    with other columns are read by the caller's own ``schema``."""
    df = read_csv(spark, path, schema) if fmt == "csv" else conform(spark.read.parquet(path), schema)
    if seasons is not None:
        df = df.filter(F.col("season").isin([int(s) for s in seasons]))
    return df
