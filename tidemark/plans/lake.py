"""The whole medallion run as plain function calls (the notebook flow).

    bronze  = run_bronze(spark, sources, config)
    silver  = run_silver(spark, config, contract)        # raises if a rule fails
    marts   = run_gold(spark, config)
    monitor = run_monitoring(spark, config)               # optionally raises on alerts

Each step reads what the previous one published, so steps can run as
separate jobs. Nothing is collected to the driver except bounded summaries
(one row per table, per rule or per month).
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.config import LakeConfig
from tidemark.contract import TPCH_CONTRACT, Contract
from tidemark.plans.bronze import ingest_raw_tables
from tidemark.plans.gold import run_gold_marts
from tidemark.plans.monitoring import raise_on_alerts, run_delay_monitoring
from tidemark.plans.publish import publish_gold_marts, publish_silver_tables, record_validation_results
from tidemark.plans.silver import ValidationResult, run_silver_transformations, validate_silver_tables
from tidemark.sources.catalog import require_source_format
from tidemark.sources.tables import quote


def run_bronze(
    spark: SparkSession,
    sources: Mapping[str, DataFrame] | str,
    config: LakeConfig = LakeConfig(),
    tables: Sequence[str] | None = None,
    verify_contents: bool = False,
) -> list[dict]:
    names = tuple(tables) if tables is not None else (TPCH_CONTRACT.table_names if isinstance(sources, str) else tuple(sources))
    return ingest_raw_tables(spark, sources, config, names, verify_contents)


def run_silver(
    spark: SparkSession,
    config: LakeConfig = LakeConfig(),
    contract: Contract = TPCH_CONTRACT,
    rules: Mapping[str, Sequence[str]] | None = None,
    run_id: str | None = None,
) -> tuple[ValidationResult, dict[str, int]]:
    """Transform Bronze, validate, record the audit (always), then gate and
    publish. A failed rule raises after the evidence is recorded."""
    run_id = run_id or str(uuid.uuid4())
    for t in contract.table_names:
        require_source_format(spark, f"{config.bronze}.{t}", config.fmt)
    bronze = {t: spark.table(quote(f"{config.bronze}.{t}")) for t in contract.table_names}
    transformed = run_silver_transformations(bronze, contract)
    validation = validate_silver_tables(transformed, contract, rules)
    record_validation_results(spark, validation, run_id, config.silver, config.fmt)
    validation.assert_valid()
    counts = publish_silver_tables(spark, transformed, validation, contract, config.silver, config.fmt, config.buckets)
    return validation, counts


def run_gold(spark: SparkSession, config: LakeConfig = LakeConfig(), method: str = "exact") -> dict[str, DataFrame]:
    marts = run_gold_marts(spark, config, method)
    publish_gold_marts(spark, marts, config)
    return marts


def run_monitoring(
    spark: SparkSession,
    config: LakeConfig = LakeConfig(),
    absolute_threshold_pct: float = 65.0,
    mom_spike_threshold: float = 5.0,
    raise_alerts: bool = False,
) -> dict[str, DataFrame]:
    result = run_delay_monitoring(spark, absolute_threshold_pct, mom_spike_threshold, config)
    if raise_alerts:
        raise_on_alerts(result["alerts"], absolute_threshold_pct, mom_spike_threshold)
    return result
