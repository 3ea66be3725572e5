"""A few registered queries against their SQL; the driver compares all of them."""

import dataclasses
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks import catalogue, daily_queries
from ohlcraft.operators.indicators import families
from tests.conftest import SF_DIR

SOME = ["patterns_slice", "ti_dmi", "ti_bollinger", "indicators_range_anchor", "load_stats",
        "upsert_market_cap", "charts_by_date", "insert_ignore_indicators", "ti_projection_bands", "ti_cci",
        *daily_queries.QUERIES]


def test_every_query_has_its_sql():
    assert all(query.sql for query in catalogue.QUERIES.values())
    assert len(catalogue.QUERIES) > 120
    assert catalogue.QUERIES.keys() <= entry.queries().keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()


def _comparable(rows):
    return sorted((tuple(None if v is None else str(v) for v in row) for row in rows),
                  key=lambda row: tuple(v or "" for v in row))


@pytest.mark.parametrize("name", SOME)
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for table in ("orders", "customer", "nation"):
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    found = entry.queries()[name](spark, SF_DIR)
    columns = sorted(found.columns)
    expected = db.sql(entry.oracle_sql()[name])
    assert sorted(expected.columns) == columns
    quoted = ", ".join(f'"{c}"' for c in columns)
    rows = [tuple(r) for r in found.select(*(f"`{c}`" for c in columns)).collect()]
    assert _comparable(rows) == _comparable(expected.project(quoted).fetchall())


def _raise(run, *arrays):
    raise ArithmeticError("no lines")


def _raise_on_low(run, close):
    if (close < 2300).any():
        raise ArithmeticError("a low close")
    return [close]


@pytest.mark.parametrize("name, broken", [
    ("MACD", {"slice_lines": _raise}),
    ("A/D Line", {"slice_lines": _raise}),
    ("McCellan Oscillator", {"inputs": lambda t: 1 / 0}),
    ("이동평균(라인3개)", {"inputs": lambda t: 1 / 0}),
    ("DEMA", {"slice_lines": _raise_on_low}),  # in some batches
])
def test_a_summary_of_lines_fails_with_a_family(spark, tmp_path, monkeypatch, name, broken):
    spark.range(1, 140).select(
        F.col("id").alias("o_orderkey"), (F.col("id") * 37.5 + 900).alias("o_totalprice"),
    ).write.parquet(str(tmp_path / "orders.parquet"))
    run = catalogue.QUERIES["indicators_all"].run
    assert run(spark, str(tmp_path)).count() == 87
    monkeypatch.setitem(families.FAMILIES, name, dataclasses.replace(families.FAMILIES[name], **broken))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        with pytest.raises(Exception, match=re.escape(f"indicator family {name!r} failed")):
            run(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
