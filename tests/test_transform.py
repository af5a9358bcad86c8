from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.contract import TPCH_CONTRACT, Column, Table
from tidemark.operators.transform import transform_table, validate_lossless_casts


SAMPLES = {"DATE": date(2031, 5, 17), "BIGINT": 4_000_000_000, "INT": 17, "STRING": "ä b"}


def test_every_table_of_the_contract_takes_its_own_types(spark):
    for table in TPCH_CONTRACT.tables:
        row = [SAMPLES.get(c.dtype, Decimal("8.75")) for c in table.columns]
        raw = spark.createDataFrame([row], ", ".join(f"`{c.source}` {c.dtype}" for c in table.columns))
        typed = transform_table(raw, table)
        assert [(f.name, f.dataType) for f in typed.schema] == [(c.name, c.spark_type) for c in table.columns]
        assert list(typed.first()) == row
        assert validate_lossless_casts(raw, table).isEmpty()


@pytest.mark.parametrize(
    ("price", "stock", "lost"),
    [("7.500", 3, []), ("7.501", 3, ["supply_cost"]), ("7.5", 3_000_000_000, ["avail_quantity"]), ("99999999999999999", 3, ["supply_cost"])],
)
def test_values_that_do_not_fit_are_reported_and_become_null_or_rounded(spark, price, stock, lost):
    table = TPCH_CONTRACT.table("partsupp")
    raw = spark.createDataFrame(
        [(11, 22, stock, Decimal(price), None)],
        "ps_partkey LONG, ps_suppkey LONG, ps_availqty LONG, ps_supplycost DECIMAL(24,4), ps_comment STRING",
    )
    found = [tag for r in validate_lossless_casts(raw, table).collect() for tag in r._quality_errors]
    assert found == [f"lossy_cast:{c}" for c in lost]
    typed = transform_table(raw, table).first()
    assert (typed.avail_quantity is None) == ("avail_quantity" in lost)
    assert (typed.supply_cost is None) == (len(price) > 10)


@pytest.mark.parametrize("check", [transform_table, validate_lossless_casts])
def test_a_source_must_have_every_column_of_the_contract(spark, check):
    supplier = TPCH_CONTRACT.table("supplier")
    kept = [c for c in supplier.columns if c.name not in ("phone", "nation_key")]
    raw = spark.createDataFrame([], ", ".join(f"{c.source} {c.dtype}" for c in kept) + ", extra INT")
    with pytest.raises(ValueError, match=r"supplier: .*\['s_nationkey', 's_phone'\]"):
        check(raw, supplier)


def test_round_trip_is_type_aware(spark):
    t = Table(
        "x",
        (
            Column("s", "s", "DECIMAL(18,2)", True),
            Column("i", "i", "INT", True),
            Column("ts", "d", "DATE", True),
            Column("f", "n", "BIGINT", True),
        ),
        ("s",),
    )
    rows = [
        ("12.340", " 7 ", datetime(2026, 1, 1, 0, 0), 2.0),  # string decimal re-renders, padded int
        ("12.34", "7", datetime(2026, 1, 1, 5, 0), 1.5),  # time of day lost, fraction lost
        (None, None, None, None),  # nulls are never cast violations
    ]
    df = spark.createDataFrame(rows, "s STRING, i STRING, ts TIMESTAMP, f DOUBLE")
    out = {tuple(r._quality_errors) for r in validate_lossless_casts(df, t).collect()}
    assert out == {("lossy_cast:s", "lossy_cast:i"), ("lossy_cast:d", "lossy_cast:n")}


@settings(max_examples=10, deadline=None)
@given(st.lists(st.decimals(min_value=-10**6, max_value=10**6, places=3, allow_nan=False), min_size=1, max_size=20))
def test_lossless_property(spark, values):
    """A DECIMAL(22,3) value is lossless in DECIMAL(18,2) iff its third
    decimal is zero."""
    t = Table("x", (Column("v", "v", "DECIMAL(18,2)", False),), ("v",))
    df = spark.createDataFrame([(v,) for v in values], "v DECIMAL(22,3)")
    flagged = sorted(r.v for r in validate_lossless_casts(df, t).collect())
    expected = sorted(v for v in values if v != v.quantize(Decimal("0.01")))
    assert flagged == expected
