"""Every registered query against its SQL, on the given tables."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as spark_entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_every_query_but_the_optional_ones_has_sql():
    assert set(spark_entry.ORACLE) <= set(spark_entry.oracle_sql()) <= set(spark_entry.queries())
    without = set(spark_entry.queries()) - set(spark_entry.oracle_sql())
    assert all(name == "pipeline" or name.startswith("op") for name in without)


@pytest.mark.parametrize("name", sorted(spark_entry.oracle_sql()))
def test_query(spark, duck, name):
    df = spark_entry.queries()[name](spark, SF_DIR)
    result = duck.execute(spark_entry.oracle_sql()[name])
    names = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(names)
    expected = rows_of(names, result.fetchall())
    assert expected
    actual = rows_of(df.columns, [tuple(row) for row in df.collect()])
    assert len(actual) == len(expected)
    assert actual == expected


def test_entry(spark):
    assert spark_entry.entry(spark).count() == 20


IMPORT_WITHOUT = """
import sys
for name in sys.argv[1:]:
    sys.modules[name] = None
import __spark_entry__ as entry
assert set(entry.queries()) >= set(entry.ORACLE) and len(entry.ORACLE) > 50
print(sum(name.startswith("op") or name == "pipeline" for name in entry.queries()))
"""


@pytest.mark.parametrize("missing", ["tokenizers", "xxhash", "corpus_pipeline", "repotide.llm"])
def test_the_rest_stays_if_the_optional_part_cannot_be_imported(missing):
    root = os.path.dirname(os.path.abspath(spark_entry.__file__))
    run = subprocess.run([sys.executable, "-c", IMPORT_WITHOUT, missing], cwd=root, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    assert run.stdout.strip() == "0"
