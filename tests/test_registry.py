"""Every registered query against its SQL oracle (DuckDB) on the smallest
scale factor: same columns, same rows, values equal to 1e-9 relative."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from huddle.plans.oracle import ORACLE
from huddle.plans.queries import REGISTRY
from tests.conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "pages"]
# model training has no SQL equivalent; these are checked for shape only
ROWS_ONLY = {"gbt_predictions", "cv_scores", "feature_importance", "tree_regressor_mse", "regressor_comparison", "regressor_report"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return con


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        return float(v)
    return str(v)


def canon(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(norm(x) for x in rec) for rec in pdf[cols].itertuples(index=False)), key=repr)


def test_every_query_has_an_oracle_or_is_rows_only():
    assert set(REGISTRY) - set(ORACLE) == ROWS_ONLY
    assert set(REGISTRY) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "turnover_margin" in df.columns


@pytest.mark.parametrize("name", sorted(set(ORACLE) & set(REGISTRY)))
def test_query_matches_oracle(spark, duck, name):
    got = entry.queries()[name](spark, SF_SMALL).toPandas()
    want = duck.execute(entry.oracle_sql()[name]).df()
    c1, r1 = canon(got)
    c2, r2 = canon(want)
    assert c1 == c2
    assert len(r1) == len(r2)
    for a, b in zip(r1, r2):
        for x, y in zip(a, b):
            if isinstance(x, float) and isinstance(y, float):
                assert abs(x - y) <= 1e-9 * max(1.0, abs(x)), (name, a, b)
            else:
                assert x == y, (name, a, b)
