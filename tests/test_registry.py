import os
import subprocess
import sys

import pytest

import __spark_entry__ as contract
from registry.oracle import oracle
from registry.queries import QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "lineitem", "orders", "events"]
SOME = [
    "s7_json_decode", "p1_parse_timestamp", "p9_json_encode", "n4_passengers", "v5_all_errors",
    "r12_process_valid", "r12_process_rejected", "d1_keep_first", "o5_partition_lag",
    "o7_latency", "o8_size_histogram", "o8_duration_histogram",
]


def test_imports_without_a_session():
    root = os.path.dirname(os.path.abspath(contract.__file__))
    code = "import __spark_entry__ as e; e.queries(); e.oracle_sql(); import tripline.streaming.jobs"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)


def test_every_oracle_has_its_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) == set(oracle())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
@pytest.mark.parametrize("name", SOME)
def test_same_rows_as_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    found = contract.queries()[name](spark, DATA)
    columns = sorted(found.columns)
    cursor = con.execute(contract.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    expected = [tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall()]
    rows = [tuple(r[c] for c in columns) for r in found.collect()]
    assert rows and sorted(rows, key=str) == sorted(expected, key=str)
