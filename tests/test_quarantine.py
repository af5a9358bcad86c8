"""The one-pass quarantine against the rule-by-rule frames."""

import random
from collections import Counter
from datetime import date, timedelta

import pytest

from tidemark.contract import TPCH_CONTRACT
from tidemark.plans import quarantine, registry
from tidemark.plans.oracle import DRIVER_CONTRACT
from tidemark.plans.quarantine import broken_rows, one_pass_quarantine
from tidemark.plans.silver import quarantine_frames, rule_frames, run_silver_transformations

from smoke import SMOKE_DIR
from test_suite import _minimal_bronze

START = date(2026, 3, 1)


def _rows(df, columns):
    return Counter(str(r) for r in df.select(*columns).collect())


def _assert_same(tr, tables):
    frames = rule_frames(tr, TPCH_CONTRACT, registry.RULES)
    by_rule = quarantine_frames(frames)
    found = one_pass_quarantine(tr, TPCH_CONTRACT, [f[:2] for f in frames], registry.RULES)
    assert set(found) == set(by_rule)
    for name in tables:
        assert set(found[name].columns) == set(by_rule[name].columns)
        assert _rows(found[name], by_rule[name].columns) == _rows(by_rule[name], by_rule[name].columns)
    return found


def _changed(spark, frame, changes):
    """Copies of the frame's first row, each with other values."""
    first = frame.first().asDict()
    return spark.createDataFrame([tuple((first | c)[n] for n in frame.columns) for c in changes], frame.schema)


def test_random_lines_and_orders(spark):
    """Null and repeated keys on both sides, null dates, unknown categories."""
    pick = random.Random(5)
    day = lambda: pick.choice([None, *(START + timedelta(days=i) for i in range(5))])
    key = lambda: pick.choice([None, 1, 2, 3, 4, 5])
    bronze = _minimal_bronze(spark)
    bronze["lineitem"] = _changed(spark, bronze["lineitem"], [
        dict(l_orderkey=key(), l_linenumber=pick.randint(1, 3), l_partkey=key(), l_suppkey=key(), l_shipdate=day(),
             l_receiptdate=day(), l_shipmode=pick.choice(["RAIL", "CART", None]))
        for _ in range(60)
    ])
    bronze["orders"] = _changed(spark, bronze["orders"], [
        dict(o_orderkey=key(), o_custkey=key(), o_orderdate=day(), o_orderstatus=pick.choice(["F", "?", None])) for _ in range(12)
    ])
    found = _assert_same(run_silver_transformations(bronze, TPCH_CONTRACT), ["lineitem", "orders", "partsupp", "lineitem_casts"])
    rules = {r._validation_rule for n in ("lineitem", "orders") for r in found[n].select("_validation_rule").distinct().collect()}
    assert {"date_sequence", "primary_key", "fk_orders_order_key", "categories", "order_status", "nonempty_order", "required_values"} <= rules


def test_one_order_holds_a_third_of_all_lines_and_many_orders(spark, monkeypatch):
    """A line is written for each order of its key, in blocks of copies."""
    monkeypatch.setattr(quarantine, "COPIES", 4)
    bronze = _minimal_bronze(spark)
    early, late = START, START + timedelta(days=90)
    bronze["orders"] = _changed(spark, bronze["orders"], [dict(o_orderkey=1, o_orderdate=late)] * 9 + [dict(o_orderkey=1, o_orderdate=early)] * 2)
    bronze["lineitem"] = _changed(spark, bronze["lineitem"], [
        dict(l_orderkey=1 if i % 3 == 0 else 50 + i, l_linenumber=i, l_shipdate=START + timedelta(days=3), l_receiptdate=late) for i in range(90)
    ])
    found = _assert_same(run_silver_transformations(bronze, TPCH_CONTRACT), ["lineitem", "orders"])
    dates = found["lineitem"].filter("_validation_rule = 'date_sequence'")
    assert dates.filter("order_key = 1").count() == 30 * 9
    assert dates.filter("order_key <> 1").count() == 60


def test_empty_tables_and_unknown_rules(spark):
    bronze = {name: rows.limit(0) for name, rows in _minimal_bronze(spark).items()}
    tr = run_silver_transformations(bronze, TPCH_CONTRACT)
    assert broken_rows(tr.tables, TPCH_CONTRACT, "lineitem", ["primary_key", "date_sequence"], registry.RULES).isEmpty()
    with pytest.raises(ValueError, match="no such rules"):
        broken_rows(tr.tables, TPCH_CONTRACT, "orders", ["categories"], registry.RULES)


def test_lines_are_scanned_twice_and_no_job_runs(spark):
    """Besides the derived partsupp: the rows, and the keys that repeat."""
    tr = registry.driver_silver(spark, SMOKE_DIR)
    rules = [f[1] for f in rule_frames(tr, DRIVER_CONTRACT, registry.RULES) if f[0] == "lineitem" and f[1] != "lossless_casts"]
    assert len(rules) == 8
    without = [r for r in rules if "partsupp" not in r]
    plan = broken_rows(tr.tables, DRIVER_CONTRACT, "lineitem", without, registry.RULES)._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    scans = [leaves.apply(i).toString() for i in range(leaves.size())]
    assert sum("l_orderkey" in s for s in scans) == 2


def test_no_join_moves_the_dates_of_another(spark):
    """The histograms of dates meet the rows in the last join."""
    tr = registry.driver_silver(spark, SMOKE_DIR)
    rules = [f[1] for f in rule_frames(tr, DRIVER_CONTRACT, registry.RULES) if f[0] == "lineitem" and f[1] != "lossless_casts"]
    nodes = [broken_rows(tr.tables, DRIVER_CONTRACT, "lineitem", rules, registry.RULES)._jdf.queryExecution().optimizedPlan()]
    dated = 0
    while nodes:
        node = nodes.pop()
        nodes += [node.children().apply(i) for i in range(node.children().size())]
        dated += node.nodeName() == "Join" and any("__days" in node.children().apply(i).output().toString() for i in range(2))
    assert dated == 1
