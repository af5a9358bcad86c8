import uuid

import pytest

from tidemark.config import LakeConfig
from tidemark.plans.lake import run_bronze, run_gold, run_monitoring, run_silver
from tidemark.plans.oracle import DRIVER_CONTRACT
from tidemark.plans.registry import RULES
from tidemark.sources.adapter import bronze_sources

from smoke import SMOKE_DIR
from test_suite import _minimal_bronze


def test_end_to_end_on_a_valid_warehouse(spark):
    cfg = LakeConfig(prefix="e" + uuid.uuid4().hex[:8])
    results = run_bronze(spark, _minimal_bronze(spark), cfg, verify_contents=True)
    assert len(results) == 8 and all(r["status"] == "PASS" for r in results)
    validation, counts = run_silver(spark, cfg, run_id="r1")
    assert counts["customer"] == 2
    from tidemark.plans.publish import publish_summary

    summary = publish_summary(spark, "r1", counts).collect()
    assert [r.table_name for r in summary] == sorted(counts) and summary[0].run_id == "r1"
    marts = run_gold(spark, cfg)
    assert spark.table(f"{cfg.gold}.order_fulfillment_sla").count() == 1
    monitor = run_monitoring(spark, cfg, raise_alerts=False)
    assert monitor["metrics"].count() == 1


def test_driver_data_is_rejected_with_evidence(spark):
    """The driver tables break several rules (ship before order, duplicated
    line keys, empty orders): the run records the evidence and publishes
    nothing."""
    cfg = LakeConfig(prefix="d" + uuid.uuid4().hex[:8])
    run_bronze(spark, bronze_sources(spark, SMOKE_DIR), cfg)
    with pytest.raises(ValueError, match="date_sequence"):
        run_silver(spark, cfg, DRIVER_CONTRACT, RULES, run_id="r1")
    failed = {r.rule_name for r in spark.table(f"{cfg.silver}.quality_validation_results").filter("status = 'FAILED'").collect()}
    assert {"date_sequence", "primary_key", "nonempty_order"} <= failed
    assert spark.table(f"{cfg.silver}.quarantine_lineitem").count() > 0
    assert not spark.catalog.tableExists(f"{cfg.silver}.lineitem")


def test_bucketed_silver_removes_order_key_shuffles(spark):
    """Published lineitem/orders bucketed on order_key: the per-order
    aggregate and the join with orders plan without an exchange."""
    from tidemark.operators.marts import build_order_fulfillment_sla_mart

    cfg = LakeConfig(prefix="b" + uuid.uuid4().hex[:8], buckets=4)
    run_bronze(spark, _minimal_bronze(spark), cfg)
    run_silver(spark, cfg, run_id="r1")
    lines = spark.table(f"{cfg.silver}.lineitem")
    orders = spark.table(f"{cfg.silver}.orders")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = build_order_fulfillment_sla_mart(orders, lines)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "SortMergeJoin" in plan
    assert "hashpartitioning(order_key" not in plan
    assert build_order_fulfillment_sla_mart(orders, lines).first().total_orders == 1
