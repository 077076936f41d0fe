"""Database tables over JDBC (read in parallel ranges, replaced as a whole)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from huddle.sources.files import nans_to_nulls

# How databases rename a table inside a transaction; others by the ``rename`` argument.
RENAME = {"derby": "RENAME TABLE {old} TO {new}", "postgresql": "ALTER TABLE {old} RENAME TO {new}"}


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """A whole table; with ``partition_column`` the read is split into
    ``num_partitions`` (8) range queries run by separate tasks: equal ranges
    between the bounds, or without bounds ranges that hold about equally many
    rows, by the quantiles of the numeric column, which is read once before.
    Filters and projections applied afterwards are pushed into the SQL sent to
    the database.  NaN becomes NULL, as in the file sources."""
    properties, parts = properties or {}, num_partitions or 8
    if partition_column is None:
        found = spark.read.jdbc(url, table, properties=properties)
    elif lower_bound is None or upper_bound is None:
        found = spark.read.jdbc(url, table, predicates=_ranges(spark, url, table, properties, partition_column, parts), properties=properties)
    else:
        found = spark.read.jdbc(url, table, partition_column, lower_bound, upper_bound, parts, properties=properties)
    return nans_to_nulls(found)


def _ranges(spark: SparkSession, url: str, table: str, properties: dict, column: str, parts: int) -> list[str]:
    """Conditions that no two rows share and each row meets one of: between quantiles, the first with the nulls."""
    shares = [i / parts for i in range(1, parts)]
    whole = spark.read.jdbc(url, table, properties=properties)
    values = whole.select(F.percentile_approx(column, F.array(*map(F.lit, shares))) if shares else F.array())
    cuts = sorted(set(values.first()[0] or []))
    if not cuts:
        return ["1 = 1"]
    mark = "`" if url.startswith("jdbc:mysql") else '"'
    column = mark + next((c for c in whole.columns if c.lower() == column.lower()), column) + mark  # as the database spells it
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]


def write_table(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict | None = None,
    mode: str = "overwrite",
    batch_size: int = 1000,
    rename: str | None = None,
) -> None:
    """Replace (or append to) a table, inserting ``batch_size`` rows per batch
    from every partition in parallel.

    A table is replaced in two steps: all rows go to a new table beside it,
    which then takes its name in one transaction.  Until then readers see the
    old rows, and a failing write leaves them.  ``rename`` is the database's
    statement for {old} and {new}; for a database that is neither in RENAME
    nor given one it is an error."""
    if mode != "overwrite":
        df.write.option("batchsize", batch_size).jdbc(url, table, mode, properties or {})
        return
    rename = rename or RENAME.get(url.split(":")[1])
    if rename is None:
        raise ValueError(f"how does {url.split(':')[1]} rename a table? give rename='... {{old}} ... {{new}}'")
    staging = f"{table}_{uuid.uuid4().hex[:12]}"
    try:
        df.write.option("batchsize", batch_size).jdbc(url, staging, "error", properties or {})
        known = _known(df.sparkSession, url, table, properties or {})
        _run(df.sparkSession, url, properties or {}, [f"DROP TABLE {table}"] * known + [rename.format(old=staging, new=table.split(".")[-1])])
    except Exception:
        if _known(df.sparkSession, url, staging, properties or {}):
            _run(df.sparkSession, url, properties or {}, [f"DROP TABLE {staging}"])
        raise


def _connection(spark: SparkSession, url: str, properties: dict):
    jvm = spark._jvm
    own = jvm.java.util.Properties()
    for k, v in properties.items():
        own.setProperty(k, str(v))
    if "driver" not in properties:
        return jvm.java.sql.DriverManager.getConnection(url, own)
    # a driver from the session's own jars is unknown to the driver manager
    loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
    return loader.loadClass(properties["driver"]).newInstance().connect(url, own)


def _run(spark: SparkSession, url: str, properties: dict, statements: list[str]) -> None:
    """The statements in one transaction."""
    connection = _connection(spark, url, properties)
    try:
        connection.setAutoCommit(False)
        for sql in statements:
            connection.createStatement().execute(sql)
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def _known(spark: SparkSession, url: str, table: str, properties: dict) -> bool:
    try:
        _run(spark, url, properties, [f"SELECT 1 FROM {table} WHERE 1 = 0"])
    except Exception:  # noqa: BLE001 (the driver's own error for an unknown table)
        return False
    return True
