from datetime import date
from decimal import Decimal

import pytest

from tidemark.contract import TPCH_CONTRACT
from tidemark.plans import registry
from tidemark.plans.oracle import DRIVER_CONTRACT
from tidemark.plans.tagged import tagged_report
from tidemark.plans.silver import (
    fused_report,
    per_rule_report,
    rule_frames,
    run_silver_transformations,
    validate_silver_tables,
)

from smoke import SMOKE_DIR


#: Columns of the smallest warehouse that passes every rule; any other column
#: is null where it may be, else the sample of its type.
PASSING = {"ship_mode": "AIR", "return_flag": "N", "line_status": "O", "order_status": "O"}
TYPE_SAMPLES = {"DATE": date(2026, 1, 1), "BIGINT": 1, "INT": 1, "STRING": "some text"}


def _minimal_bronze(spark):
    """Raw tables of one order with one line; a second customer has none."""

    def cell(column):
        if column.nullable:
            return None
        return PASSING.get(column.name, TYPE_SAMPLES.get(column.dtype, Decimal("3.00")))

    tables = {}
    for table in TPCH_CONTRACT.tables:
        raw = spark.createDataFrame([[cell(c) for c in table.columns]], ", ".join(f"{c.source} {c.dtype}" for c in table.columns))
        tables[table.name] = raw
    customer = tables["customer"]
    tables["customer"] = customer.union(customer.withColumn("c_custkey", customer["c_custkey"] + 1))
    return tables


def _report(df):
    return {(r.table_name, r.rule_name): (r.invalid_rows, r.status) for r in df.collect()}


def test_full_validation_passes_and_keeps_parents(spark):
    tr = run_silver_transformations(_minimal_bronze(spark), TPCH_CONTRACT)
    v = validate_silver_tables(tr, TPCH_CONTRACT)
    report = _report(v.report)
    assert len(report) == 38
    assert all(n == 0 and s == "PASSED" for n, s in report.values())
    v.assert_valid()
    assert tr.tables["customer"].count() == 2


def test_empty_lineitem_fails_nonempty_order(spark):
    bronze = _minimal_bronze(spark)
    bronze["lineitem"] = bronze["lineitem"].limit(0)
    tr = run_silver_transformations(bronze, TPCH_CONTRACT)
    for fused in (True, False):
        v = validate_silver_tables(tr, TPCH_CONTRACT, fused=fused)
        with pytest.raises(ValueError, match="nonempty_order"):
            v.assert_valid()
        assert v.quarantine["orders"].first()._validation_rule == "nonempty_order"
        assert _report(v.report)[("orders", "nonempty_order")] == (1, "FAILED")


def test_fused_equals_per_rule_on_faulty_data(spark):
    bronze = _minimal_bronze(spark)
    li = bronze["lineitem"]
    first = li.first()
    bad = list(first)
    bad[1] = 7  # unknown part and pair
    bad[9] = "X"  # line status outside the whitelist
    bad[10] = date(2025, 12, 1)  # ship before order
    bronze["lineitem"] = li.union(spark.createDataFrame([tuple(bad), tuple(first)], li.schema))
    tr = run_silver_transformations(bronze, TPCH_CONTRACT)
    fused = _report(fused_report(tr, TPCH_CONTRACT))
    assert fused == _report(tagged_report(tr.bronze, TPCH_CONTRACT, registry.RULES))
    plain = _report(per_rule_report(rule_frames(tr, TPCH_CONTRACT)))
    assert fused == plain
    assert fused[("lineitem", "primary_key")] == (3, "FAILED")
    assert fused[("lineitem", "fk_part_part_key")] == (1, "FAILED")
    assert fused[("lineitem", "categories")] == (1, "FAILED")
    assert fused[("lineitem", "date_sequence")] == (1, "FAILED")


def test_fused_equals_per_rule_on_driver_data(spark):
    tr = registry.driver_silver(spark, SMOKE_DIR)
    fused = _report(fused_report(tr, DRIVER_CONTRACT, registry.RULES))
    plain = _report(per_rule_report(rule_frames(tr, DRIVER_CONTRACT, registry.RULES)))
    assert fused == plain
    assert len(fused) == 38
    assert fused[("lineitem", "date_sequence")][0] > 0


def test_quarantine_routes_casts_separately(spark):
    bronze = _minimal_bronze(spark)
    ps = bronze["partsupp"]
    row = list(ps.first())
    row[3] = Decimal("1.005")
    bronze["partsupp"] = spark.createDataFrame([tuple(row)], "ps_partkey BIGINT, ps_suppkey BIGINT, ps_availqty INT, ps_supplycost DECIMAL(18,3), ps_comment STRING")
    tr = run_silver_transformations(bronze, TPCH_CONTRACT)
    v = validate_silver_tables(tr, TPCH_CONTRACT)
    assert _report(v.report)[("partsupp", "lossless_casts")] == (1, "FAILED")
    q = v.quarantine["partsupp_casts"].collect()
    assert q[0]._quality_errors == ["lossy_cast:supply_cost"] and q[0]._validation_rule == "lossless_casts"


def test_fused_report_with_brace_and_quote_in_whitelist(spark):
    bronze = _minimal_bronze(spark)
    tr = run_silver_transformations(bronze, TPCH_CONTRACT)
    rules = {"ship_mode": ["AIR", "{odd}", "it's"], "return_flag": ["N"], "line_status": ["O"]}
    report = _report(fused_report(tr, TPCH_CONTRACT, rules))
    assert report[("lineitem", "categories")] == (0, "PASSED")
    assert report == _report(tagged_report(tr.bronze, TPCH_CONTRACT, rules))
    rules["ship_mode"] = ["{odd}", "it's"]
    assert _report(fused_report(tr, TPCH_CONTRACT, rules))[("lineitem", "categories")] == (1, "FAILED")


def _widen(keys, template, key):
    """Give every key the template row's other column values."""
    from pyspark.sql import functions as F

    first = template.first()
    return keys.select(key, *[F.lit(first[c]).cast(template.schema[c].dataType).alias(c) for c in template.columns if c != key]).select(*template.columns)


def test_hot_key_a_third_of_all_rows(spark):
    """One order key carries a third of all lines (and repeats line
    numbers): the fused counts equal the per-rule counts."""
    from pyspark.sql import functions as F

    ids = spark.range(3000)
    hot = F.col("id") % 3 == 0
    lines = ids.select(
        F.when(hot, F.lit(7)).otherwise(F.col("id") + 100).alias("l_orderkey"),
        (F.col("id") % 50).alias("l_partkey"),
        (F.col("id") % 10).alias("l_suppkey"),
        F.when(hot, (F.col("id") % 400).cast("int")).otherwise(F.lit(1)).alias("l_linenumber"),
        F.lit(1.0).alias("l_quantity"), F.lit(2.5).alias("l_extendedprice"), F.lit(0.05).alias("l_discount"),
        F.lit(0.0).alias("l_tax"), F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
        F.date_add(F.lit("2026-01-05").cast("date"), (F.col("id") % 5).cast("int")).alias("l_shipdate"),
        F.lit("2026-01-20").cast("date").alias("l_commitdate"),
        F.date_add(F.lit("2026-01-15").cast("date"), (F.col("id") % 9).cast("int")).alias("l_receiptdate"),
        F.lit(None).cast("string").alias("l_shipinstruct"), F.lit("AIR").alias("l_shipmode"),
        F.lit(None).cast("string").alias("l_comment"),
    )
    bronze = _minimal_bronze(spark)
    bronze["lineitem"] = lines
    order_keys = ids.filter("id % 3 != 0 AND id % 7 != 0").select((F.col("id") + 100).alias("o_orderkey"))
    order_keys = order_keys.union(spark.createDataFrame([(7,)], "o_orderkey LONG"))
    bronze["orders"] = _widen(order_keys, bronze["orders"], "o_orderkey")
    bronze["part"] = _widen(spark.range(50).select(F.col("id").alias("p_partkey")), bronze["part"], "p_partkey")
    tr = run_silver_transformations(bronze, TPCH_CONTRACT)
    fused = _report(fused_report(tr, TPCH_CONTRACT))
    assert fused == _report(tagged_report(tr.bronze, TPCH_CONTRACT, registry.RULES))
    plain = _report(per_rule_report(rule_frames(tr, TPCH_CONTRACT)))
    assert fused == plain
    # the hot order repeats line numbers 0..399 (1000 rows); other orders are unique
    assert fused[("lineitem", "primary_key")][0] == 1000
    # non-hot lines whose order (id % 7 == 0) was left out of orders are orphans
    orphans = sum(1 for i in range(3000) if i % 3 != 0 and i % 7 == 0)
    assert fused[("lineitem", "fk_orders_order_key")] == (orphans, "FAILED")


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_keys = st.one_of(st.none(), st.integers(1, 4))
_days = st.one_of(st.none(), st.integers(0, 6))
_line = st.tuples(_keys, st.integers(1, 3), _keys, _keys, _days, _days, _days, st.sampled_from(["AIR", "SHIP", "BAD", None]))
_order = st.tuples(_keys, _days, st.sampled_from(["O", "F", "X", None]))


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(_line, max_size=12), st.lists(_order, max_size=6))
def test_fused_equals_per_rule_property(spark, lines, orders):
    """Random small warehouses with null keys, duplicated orders, null dates
    and bad categories: both report forms agree on every rule."""
    from datetime import date, timedelta

    base = date(2026, 1, 1)
    d = lambda n: None if n is None else base + timedelta(days=n)
    bronze = _minimal_bronze(spark)
    li = bronze["lineitem"]
    tmpl = li.first().asDict()
    rows = []
    for ok, ln, pk, sk, ship, commit, receipt, mode in lines:
        r = dict(tmpl)
        r.update(l_orderkey=ok, l_linenumber=ln, l_partkey=pk, l_suppkey=sk, l_shipdate=d(ship),
                 l_commitdate=d(commit), l_receiptdate=d(receipt), l_shipmode=mode)
        rows.append(tuple(r[c] for c in li.columns))
    bronze["lineitem"] = spark.createDataFrame(rows, li.schema)
    o = bronze["orders"]
    otmpl = o.first().asDict()
    orows = []
    for ok, od, status in orders:
        r = dict(otmpl)
        r.update(o_orderkey=ok, o_orderdate=d(od), o_orderstatus=status)
        orows.append(tuple(r[c] for c in o.columns))
    bronze["orders"] = spark.createDataFrame(orows, o.schema)
    tr = run_silver_transformations(bronze, TPCH_CONTRACT)
    plain = _report(per_rule_report(rule_frames(tr, TPCH_CONTRACT)))
    assert _report(fused_report(tr, TPCH_CONTRACT)) == plain == _report(tagged_report(tr.bronze, TPCH_CONTRACT, registry.RULES))


def test_fk_join_forms_agree(spark):
    tr = registry.driver_silver(spark, SMOKE_DIR)
    anti = _report(fused_report(tr, DRIVER_CONTRACT, registry.RULES, fk_join="anti"))
    outer = _report(fused_report(tr, DRIVER_CONTRACT, registry.RULES, fk_join="outer"))
    assert anti == outer
    assert _report(tagged_report(tr.bronze, DRIVER_CONTRACT, registry.RULES)) == anti


@pytest.mark.parametrize(("only", "scans"), [(None, 2), (["lineitem"], 2), (["orders"], 1)])
def test_tagged_report_scans_the_lines_once_for_all_keys(spark, only, scans):
    """One scan for all keys and row-local rules, one for the date order (the
    driver's partsupp is derived from the lines by a scan of its own)."""
    bronze = registry.driver_silver(spark, SMOKE_DIR).bronze
    plan = tagged_report(bronze, DRIVER_CONTRACT, registry.RULES, only=only)._jdf.queryExecution().optimizedPlan().toString()
    derived = plan.count("% 10) = 0")
    assert len([line for line in plan.splitlines() if "Relation" in line and "l_orderkey" in line]) == scans + derived
    assert plan.count("Join") == scans - 1 and "Expand" in plan


@pytest.mark.parametrize("only", [["lineitem"], ["region", "partsupp"]])
def test_parts_of_the_tagged_report_equal_the_whole(spark, only):
    bronze = registry.driver_silver(spark, SMOKE_DIR).bronze
    whole = _report(tagged_report(bronze, DRIVER_CONTRACT, registry.RULES))
    assert _report(tagged_report(bronze, DRIVER_CONTRACT, registry.RULES, only=only)) == {k: v for k, v in whole.items() if k[0] in only}


def test_keys_of_text_and_nulls_meet_as_the_rules_say(spark):
    """Text keys, null keys on both sides, repeated parents, an empty child."""
    from tidemark.contract import Column, Contract, ForeignKey, Table

    parent = Table("p", (Column("a", "a", "STRING", False), Column("b", "b", "INT", True)), ("a", "b"))
    child = Table("c", (Column("id", "id", "BIGINT", False), Column("a", "a", "STRING", True), Column("b", "b", "INT", True)), ("id",))
    other = Table("d", (Column("id", "id", "BIGINT", False), Column("a", "a", "STRING", True), Column("b", "b", "INT", True)), ("id",))
    contract = Contract((parent, child, other), (ForeignKey("c", ("a", "b"), "p"), ForeignKey("d", ("a", "b"), "p")))
    rows = {
        "p": spark.createDataFrame([("x", 1), ("x", 1), ("y", None), ("y", None), ("z", 2)], "a STRING, b INT"),
        "c": spark.createDataFrame([(1, "x", 1), (2, "y", None), (2, None, 1), (None, "z", 3), (None, "0", 0)], "id LONG, a STRING, b INT"),
        "d": spark.createDataFrame([], "id LONG, a STRING, b INT"),
    }
    tr = run_silver_transformations(rows, contract)
    report = {k: n for k, (n, _) in _report(tagged_report(rows, contract, registry.RULES)).items()}
    assert report == {k: n for k, (n, _) in _report(per_rule_report(rule_frames(tr, contract))).items()}
    assert report[("p", "primary_key")] == 4 and report[("c", "fk_p_a_b")] == 4 and report[("d", "fk_p_a_b")] == 0


def test_no_scan_task_holds_the_keys_of_a_whole_file(spark):
    """The lines' keys are dealt to the tasks below every histogram, those of
    the derived partsupp too; a file with one row group is one scan task."""
    plan = registry.q_lineitem_report(spark, SMOKE_DIR)._jdf.queryExecution().optimizedPlan()
    nodes, by_key = [plan], []
    while nodes:
        node = nodes.pop()
        nodes += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "Aggregate" and not node.groupingExpressions().isEmpty() and "l_orderkey" in node.toString():
            by_key.append(node.toString())
    assert len(by_key) >= 4
    assert all("RepartitionByExpression" in part for part in by_key)


def test_a_third_of_all_lines_share_one_key(spark):
    """Dealt rows of a hot key are counted as the plain rules count them."""
    bronze = _minimal_bronze(spark)
    first = bronze["lineitem"].first().asDict()
    changes = [dict(l_orderkey=1 if i % 3 else 100 + i, l_linenumber=None if i % 5 == 0 else i % 4, l_partkey=i % 7 or None) for i in range(60)]
    bronze["lineitem"] = spark.createDataFrame([tuple((first | c)[n] for n in bronze["lineitem"].columns) for c in changes], bronze["lineitem"].schema)
    tr = run_silver_transformations(bronze, TPCH_CONTRACT)
    plain = _report(per_rule_report(rule_frames(tr, TPCH_CONTRACT, registry.RULES)))
    assert plain[("lineitem", "primary_key")][0] > 30
    for how in ("anti", "outer"):
        fused = _report(fused_report(tr, TPCH_CONTRACT, registry.RULES, only=["lineitem"], fk_join=how))
        assert fused == {rule: n for rule, n in plain.items() if rule[0] == "lineitem"}
