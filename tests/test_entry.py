"""Driver contract: entry runs, every query has a DuckDB twin with the same columns."""

import duckdb
import pytest

import __spark_entry__ as E
from sluice.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"offset", "schemaURI", "status", "reason", "errors"}


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


FAST = ["q01_record_to_envelope", "q03_semver_parse", "q05_registry_requests", "q06_validate_status",
        "q09_enum_status", "q19_write_outcome", "q22_upsert_latest", "q30_minimum_ref"]


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle_at_smallest_scale(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sdf = E.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    s_rows = sorted(tuple(str(r[c]) for c in cols) for r in sdf.collect())
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    d_rows = sorted(tuple(str(r[i]) for i in idx) for r in rel.fetchall())
    assert s_rows == d_rows


def test_entry_runs_where_executors_cannot_import_the_package(tmp_path):
    """Another working directory, default settings, the package on the driver's path only."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (f"import sys; sys.path.insert(0, {root!r}); import __spark_entry__ as e\n"
            "from pyspark.sql import SparkSession\n"
            "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
            "print('rows', e.entry(s).count())")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 1500" in out.stdout, out.stderr[-2000:]
