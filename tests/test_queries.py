"""Every registered query against its SQL twin in DuckDB, on whole tables."""
import datetime
import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(file)[:-8]} AS SELECT * FROM '{file}'")
    return con


def shown(value):
    if isinstance(value, float):
        return repr(round(value, 6))
    return value.isoformat() if isinstance(value, datetime.datetime) else str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(shown(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    got = table(df.columns, df.collect())
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == table(columns, cursor.fetchall())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_inventory_has_empty_and_missing_texts_and_odd_paths(spark, tmp_path):
    rows = [(1, "", "a"), (2, None, "a"), (3, "x\r\n가", "a"), (4, "y", ".b"), (5, "y", "_c"), (6, "y", "d/e"), (7, "", "d/e"), (8, "y", ""), (9, "y", None),
            (10, "y", ".."), (11, "y", "f" * 300), (12, "y", "g h%20"), (13, "", "i.gz")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    df = QUERIES["file_inventory"](spark, str(tmp_path))
    other = duckdb.connect()
    other.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    cursor = other.execute(ORACLES["file_inventory"])
    assert table(df.columns, df.collect()) == table([d[0] for d in cursor.description], cursor.fetchall())
