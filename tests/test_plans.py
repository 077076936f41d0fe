"""Plan-shape checks: properties that matter at scale, asserted on the
physical plans Spark chooses."""

import re

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

ML = {"gbt_predictions", "cv_scores", "feature_importance", "tree_regressor_mse", "bayesian_ridge_fit"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - ML))
def test_no_cross_products(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_flagship_single_scan_single_aggregation_exchange(spark):
    plan = plan_of(entry.entry(spark))
    assert len(re.findall(r"lineitem\.parquet", plan)) == 1
    agg_exchanges = re.findall(r"Exchange hashpartitioning\(season#\d+, week#\d+, team#\d+", plan)
    assert len(agg_exchanges) == 1


def test_chunked_lag_reuses_the_raw_shuffle(spark):
    df = entry.queries()["lag_one"](spark, SF_SMALL)
    df.collect()
    final = plan_of(df).split("== Initial Plan ==")[0]
    assert "Reused" in final
    assert len(re.findall(r"events\.parquet", final)) == 1


def test_partitioned_write_rebalances(spark, tmp_path):
    from pyspark.sql import functions as F

    from huddle.sinks.files import write_partitioned_parquet

    df = spark.range(100).withColumn("season", (F.col("id") % 3).cast("int"))
    captured = []
    original = df.hint

    def spy(*args):
        out = original(*args)
        captured.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    df.hint = spy
    write_partitioned_parquet(df, str(tmp_path / "out"), ["season"])
    assert "REBALANCE_PARTITIONS_BY_COL" in captured[0]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 100
