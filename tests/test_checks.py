"""A sample of the registered queries against DuckDB; TIDEMARK_ALL=1 runs all of them."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from checks import all_checks
from checks.fixtures import BASE_TABLES
from run_checks import rows_of

FOLDER = "/root/testdata/sf0.001"
SAMPLE = [
    "ver04_next_version", "dt01_day_in_name", "str01_keywords", "tpl01_fill_names", "cat01_filtered_files",
    "cat02_newest_version", "cat13_full_paths", "cat16_is_newest", "join01_file_traceback", "join03_code_of_day",
    "join04_interval_overlap", "cov02_parents_of_missing", "cov04_coverage_matrix", "lin03_ancestors",
    "lin07_purged_rows", "plan11_versions_to_write", "audit01_rule_violations", "audit04_wrong_newest_flag",
    "audit12_compare_files", "queue04_clean", "edit01_after_flag", "log07_range_report", "ing01_quarantine",
    "derive02_concatenate",
]
NAMES = list(all_checks.QUERIES) if os.environ.get("TIDEMARK_ALL") else SAMPLE


@pytest.fixture(scope="module")
def db():
    if not os.path.isdir(FOLDER):
        pytest.skip("the given tables are not here")
    connection = duckdb.connect()
    for table in BASE_TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, db, name):
    df = entry_module.queries()[name](spark, FOLDER)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = db.execute(entry_module.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == rows_of(columns, cursor.fetchall())


def test_every_query_has_a_counterpart():
    assert set(all_checks.QUERIES) == set(all_checks.ORACLES)


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["product_id", "day"] and df.count() > 0
