"""Every registered query runs; those with oracle SQL equal DuckDB's result (sf0.001).

The same comparison at sf0.01 is ``python tools/oracle_check.py``.
"""

from __future__ import annotations

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

from .conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "float": "FLOAT",
         "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _canon(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["y", "m", "q", "n"]
    assert df.count() > 0


def test_every_query_has_a_callable_and_sql_keys_match():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    duck_types = {d[0]: str(d[1]).upper() for d in res.description}
    for col, t in df.dtypes:
        assert _DUCK.get(t, t.upper()) == duck_types[col], (col, t, duck_types[col])
    assert _canon(df.columns, got) == _canon(cols, res.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_query_without_oracle_runs(spark, name):
    df = queries()[name](spark, SF_SMALL)
    assert df.count() > 0


def test_cli_lists_every_query():
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-m", "kestrel", "--list"], cwd=root, capture_output=True, text=True,
                         timeout=120, check=True).stdout.split()
    from kestrel.plans import QUERIES

    assert sorted(out) == sorted(QUERIES)
    assert set(QUERIES) <= set(queries())


def test_cli_runs_a_query_as_a_job(tmp_path):
    import os
    import subprocess
    import sys

    import pyarrow.parquet as pq

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = str(tmp_path / "routes")
    subprocess.run([sys.executable, "-m", "kestrel", "graph_top_routes", SF_SMALL, out], cwd=root,
                   capture_output=True, text=True, timeout=300, check=True)
    result = pq.read_table(out)
    assert result.num_rows == 10 and result.column_names == ["src", "dst", "n", "route"]
