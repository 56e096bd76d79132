"""Every registered query with an oracle equals DuckDB on sf0.001."""

import math
import subprocess
import sys

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from conftest import SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents"]
MODELS = {"x4_evaluated_rows", "x5_predicted_rows", "x7_score_outcomes", "x8_stream_outcomes",
          "s13_same_predictions", "x4_signal_learned"}  # fit 2 x 100 trees: tests/test_ml.py, tools/check_oracles.py
OTHERS = {n for n in E.oracle_sql() if n.startswith("op") or n == "pipeline"}


LIMITED = """
import os, sys, duckdb
con = duckdb.connect()
for name in sorted(os.listdir(sys.argv[2])):
    if name.endswith(".parquet"):
        con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{sys.argv[2]}/{name}'")
con.execute(f"SELECT * FROM ({sys.argv[1]}) LIMIT 1").fetchall()
"""


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if hasattr(v, "item") and getattr(v, "ndim", None) == 0:
        v = v.item()
    if isinstance(v, float):
        if math.isnan(v):
            return None
        v = round(v, 6)
        return int(v) if v.is_integer() else v
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().isoformat()
    if hasattr(v, "isoformat"):
        s = v.isoformat()
        return s if "T" in s else s + "T00:00:00"
    return v


def _rows(df):
    cols = sorted(df.columns)
    return sorted(repr(tuple(_norm(x) for x in r)) for r in df[cols].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(n for n in E.oracle_sql() if n not in MODELS | OTHERS))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SMALL).toPandas()
    want = con.execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_oracle_ends_under_a_limit(name):
    """Whoever looks at the first row only must not wait for a worse plan."""
    child = subprocess.run([sys.executable, "-c", LIMITED, E.oracle_sql()[name], SMALL],
                           timeout=120, capture_output=True, text=True)
    assert child.returncode == 0, child.stderr


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert len(df.columns) == 48 and df.count() > 1000
