"""Holds a registered query against its SQL."""

import duckdb

import __spark_entry__ as entry

TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def same_as_sql(spark, name, sf_dir):
    db = duckdb.connect()
    for table in TABLES:
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    expected = db.sql(entry.oracle_sql()[name])
    columns = sorted(expected.columns)
    found = entry.queries()[name](spark, sf_dir)
    assert sorted(found.columns) == columns
    rows = [tuple(r) for r in found.select(columns).collect()]
    wanted = expected.project(", ".join(columns)).fetchall()
    assert len(rows) == len(wanted)
    assert sorted(map(str, rows)) == sorted(map(str, wanted))
