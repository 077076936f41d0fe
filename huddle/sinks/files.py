"""File sinks.  Every writer replaces or appends whole partitions through
Spark's committer, so a job that loses executors mid-write is retried
without leaving partial files behind."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from huddle.functions.columns import fixed_width_line, pad_right


def write_partitioned_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("season",),
    mode: str = "append",
    max_records_per_file: int | None = None,
) -> None:
    """Parquet dataset partitioned by ``partition_by``.

    Rows are clustered by the partition columns with a ``rebalance`` hint,
    not ``repartition(cols)``: a hash repartition would send each season
    (or a season holding a third of the data) to a single task, while
    rebalancing lets AQE split large partitions into advisory-sized tasks
    and still write few files per partition directory.
    """
    writer = df.hint("rebalance", *partition_by).write.mode(mode).partitionBy(*partition_by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False) -> None:
    """CSV with a header row.  ``single_file`` is for small reports only
    (it funnels the rows through one task)."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).csv(path)


def report_lines(
    table: DataFrame,
    label: str,
    value: str,
    order: str,
    header: tuple[str, str] = ("Regressor", "MSE"),
    width: int = 20,
    decimals: int = 5,
    rule_width: int = 60,
) -> DataFrame:
    """(line_no, line) of a fixed-width text report: header, a rule of '=',
    then one line per row ordered by ``order``."""
    head = F.concat(pad_right(F.lit(header[0]), width), F.lit(" "), pad_right(F.lit(header[1]), width))
    spark = table.sparkSession
    top = spark.range(1).select(
        F.inline(F.array(
            F.struct(F.lit(0).alias("line_no"), head.alias("line")),
            F.struct(F.lit(1).alias("line_no"), F.lit("=" * rule_width).alias("line")),
        ))
    )
    body = table.select(
        (F.col(order) + 2).cast("int").alias("line_no"),
        fixed_width_line(F.col(label), F.col(value), width, decimals).alias("line"),
    )
    return top.unionByName(body)


def write_text_lines(lines: DataFrame, path: str, order: str = "line_no") -> None:
    """Write a small ordered report as one text file."""
    lines.orderBy(order).select("line").coalesce(1).write.mode("overwrite").text(path)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows (a limit: Spark stops reading once it has them)."""
    return df.limit(n)
