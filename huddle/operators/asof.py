"""The nearest grid values on both sides of a point, without pairs.

Points and grid rows are sorted together: range-partitioned (sampled bounds,
so no group has to fit a task), sorted inside each partition, and filled from
the last grid row before and the first one behind.  What lies beyond a
partition's edge comes from one row per partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from huddle.session import materialize


def grid_neighbours(points: DataFrame, grid: DataFrame, x: str, value: str, group: str | None = None) -> DataFrame:
    """Each point (its ``x`` and ``group``) with ``below`` and ``above``: structs (x, value) of the largest
    grid x of at most the point's, and of the smallest beyond it; null where there is none in the group.

    A null x or group meets nothing.  Points should be distinct: every one is returned."""
    key = F.col(group) if group else F.lit(0)
    none = F.lit(None)
    cell = F.struct(key.alias("g"), F.col(x).cast("double").alias("x"), F.col(value).cast("double").alias("value"))
    have = grid.where(F.col(x).isNotNull()).select(key.alias("g"), F.col(x).cast("double").alias("x"), F.lit(0).alias("kind"), cell.alias("cell"))
    want = points.select(key.alias("g"), F.col(x).cast("double").alias("x"), F.lit(1).alias("kind"), none.cast(have.schema["cell"].dataType).alias("cell"))
    order = ["g", "x", "kind"]  # a grid row at the point itself comes before it
    mixed = have.unionByName(want).repartitionByRange(*order).sortWithinPartitions(*order)
    mixed = materialize(mixed.withColumn("at", F.monotonically_increasing_id()), "asof")
    part = F.shiftright("at", 33)
    mixed = mixed.withColumn("part", part)
    edges = mixed.groupBy("part").agg(F.max_by("cell", F.when(F.col("cell").isNotNull(), F.col("at"))).alias("last"), F.min_by("cell", F.when(F.col("cell").isNotNull(), F.col("at"))).alias("first"))
    beside = Window.partitionBy(F.lit(0)).orderBy("part")  # one row per partition
    edges = edges.select(
        "part",
        F.last("last", ignorenulls=True).over(beside.rowsBetween(Window.unboundedPreceding, -1)).alias("before"),
        F.first("first", ignorenulls=True).over(beside.rowsBetween(1, Window.unboundedFollowing)).alias("behind"),
    )
    inside = Window.partitionBy("part").orderBy("at")  # a range partition each
    filled = mixed.withColumn("below", F.last("cell", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    filled = filled.withColumn("above", F.first("cell", ignorenulls=True).over(inside.rowsBetween(0, Window.unboundedFollowing)))
    filled = filled.where(F.col("kind") == 1).join(F.broadcast(edges), "part")

    def own(near, far):
        found = F.coalesce(near, far)
        return F.when(found["g"] == F.col("g"), F.struct(found["x"].alias("x"), found["value"].alias("value")))

    named = [F.col("g").alias(group)] if group else []
    return filled.select(*named, F.col("x").alias(x), own(F.col("below"), F.col("before")).alias("below"), own(F.col("above"), F.col("behind")).alias("above"))
