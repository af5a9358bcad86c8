"""Registered queries against their DuckDB oracle on the smoke tables."""

import datetime
import decimal
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from smoke import SMOKE_DIR
from tidemark.plans import registry

NAMES = [
    "transit_time", "order_sla", "ship_mode_delays", "priority_speed", "monthly_delay", "delay_alerts",
    "pk_duplicates", "fk_lineitem_partsupp", "empty_orders", "date_sequence", "quality_report",
    "quarantine_lineitem", "copy_difference", "lossless_events", "unexpected_values", "category_share",
    "order_status_check", "copy_delta", "copy_verification", "all_marts", "temporal_audit",
]


def _canon(v):
    if v is None:
        return ("null",)
    if isinstance(v, (float, int, decimal.Decimal)) and not isinstance(v, bool):
        f = float(v)
        return ("nan",) if math.isnan(f) else ("num", repr(f))
    if isinstance(v, (datetime.date, datetime.datetime)):
        return ("t", v.isoformat())
    return ("s", str(v))


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_canon(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(SMOKE_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_registry_is_complete():
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert set(registry.queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    assert len(registry.queries()) >= 49


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["table_name", "rule_name", "invalid_rows", "status"]
    assert df.count() == 38


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SMOKE_DIR)
    res = duck.execute(entry.oracle_sql()[name])
    d_cols = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert _rows(df.columns, df.collect()) == _rows(d_cols, res.fetchall())
