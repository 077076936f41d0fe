"""Column catalogue of a dataset, with per-column counts from one scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SQL_NAMES = {
    T.LongType: "BIGINT", T.IntegerType: "INTEGER", T.ShortType: "SMALLINT", T.ByteType: "TINYINT",
    T.DoubleType: "DOUBLE", T.FloatType: "FLOAT", T.StringType: "VARCHAR", T.BooleanType: "BOOLEAN",
    T.DateType: "DATE", T.TimestampNTZType: "TIMESTAMP", T.TimestampType: "TIMESTAMP WITH TIME ZONE",
    T.BinaryType: "BLOB",
}


def sql_type_name(dt: T.DataType) -> str:
    for cls, name in _SQL_NAMES.items():
        if isinstance(dt, cls):
            return name
    if isinstance(dt, T.DecimalType):
        return f"DECIMAL({dt.precision},{dt.scale})"
    return dt.simpleString().upper()


def column_names(df: DataFrame) -> DataFrame:
    """(ordinal, name, type) -- the schema as a table (no data read)."""
    rows = [(i + 1, f.name, sql_type_name(f.dataType)) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "ordinal int, name string, type string")


def column_profile(df: DataFrame) -> DataFrame:
    """(ordinal, name, type, non_null, nulls): one aggregate over the data
    computes every column's count, then the single row is unpivoted."""
    fields = df.schema.fields
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f.name)).alias(f"_c{i}") for i, f in enumerate(fields)])
    entries = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("ordinal"), F.lit(f.name).alias("name"),
                F.lit(sql_type_name(f.dataType)).alias("type"), F.col(f"_c{i}").alias("non_null"),
            )
            for i, f in enumerate(fields)
        ]
    )
    return counts.select("_rows", F.inline(entries)).select(
        "ordinal", "name", "type", "non_null", (F.col("_rows") - F.col("non_null")).alias("nulls")
    )


def write_column_catalogue(df: DataFrame, path: str) -> None:
    """One column name per line, in schema order, as a single text file."""
    column_names(df).orderBy("ordinal").select("name").coalesce(1).write.mode("overwrite").text(path)
