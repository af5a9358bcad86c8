"""Delay monitoring job and its alert gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.config import LakeConfig
from tidemark.operators.monitor import (
    ABSOLUTE_THRESHOLD_PCT,
    MOM_SPIKE_THRESHOLD,
    check_delay_alert_threshold,
    compute_monthly_delay_rate,
)
from tidemark.sources.tables import quote


def delay_monitoring(
    lineitem: DataFrame,
    absolute_threshold_pct: float = ABSOLUTE_THRESHOLD_PCT,
    mom_spike_threshold: float = MOM_SPIKE_THRESHOLD,
) -> dict[str, DataFrame]:
    metrics = compute_monthly_delay_rate(lineitem)
    return {"metrics": metrics, "alerts": check_delay_alert_threshold(metrics, absolute_threshold_pct, mom_spike_threshold)}


def run_delay_monitoring(
    spark: SparkSession,
    absolute_threshold_pct: float = ABSOLUTE_THRESHOLD_PCT,
    mom_spike_threshold: float = MOM_SPIKE_THRESHOLD,
    config: LakeConfig = LakeConfig(),
) -> dict[str, DataFrame]:
    lineitem = spark.table(quote(f"{config.silver}.lineitem"))
    return delay_monitoring(lineitem, absolute_threshold_pct, mom_spike_threshold)


def raise_on_alerts(alerts: DataFrame, absolute_threshold_pct: float = ABSOLUTE_THRESHOLD_PCT, mom_spike_threshold: float = MOM_SPIKE_THRESHOLD) -> None:
    """Alert gate: raise listing every breached month. The alert frame has
    at most one row per month, so collecting it is bounded."""
    rows = alerts.orderBy("receipt_month").collect()
    if not rows:
        return
    periods = [
        f"{r.receipt_month.strftime('%Y-%m') if r.receipt_month else 'unknown month'} "
        f"(Rate: {r.delay_rate_pct}%, ΔMoM: {r.rate_change_pct_points} pp)"
        for r in rows
    ]
    raise AssertionError(
        f"ALERT: {len(rows)} period(s) breach delivery SLA thresholds "
        f"(rate > {absolute_threshold_pct}% or month-over-month rise > {mom_spike_threshold} pp):\n - "
        + "\n - ".join(periods)
    )
