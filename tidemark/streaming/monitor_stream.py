"""Incremental delay monitoring with Structured Streaming.

New line-item files arrive in a folder; the query keeps per-receipt-month
counts in its state store (complete mode: one state row per month, bounded
by the calendar span, not by the data) and, for every micro-batch, turns the
complete month table into rates, month-over-month change and alerts in
``foreachBatch`` — the same functions as the batch job, on a small frame.
The sink tables are overwritten per batch, so a replayed batch after a
failure rewrites the same result (idempotent); a long-lived reader session
calls ``spark.catalog.refreshTable`` before re-reading them. The checkpoint
lives under the cluster's shared ``spark.checkpoint.dir``; a restarted query
resumes from it and reads only files it has not seen.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.operators.monitor import (
    ABSOLUTE_THRESHOLD_PCT,
    MOM_SPIKE_THRESHOLD,
    check_delay_alert_threshold,
    monthly_delay_counts,
    with_rate_and_change,
)
from tidemark.session import checkpoint_dir
from tidemark.sources.tables import quote


def start_delay_monitor(
    spark: SparkSession,
    source_path: str,
    source_schema: StructType,
    to_lines: Callable[[DataFrame], DataFrame],
    metrics_table: str,
    alerts_table: str,
    checkpoint_location: str | None = None,
    absolute_threshold_pct: float = ABSOLUTE_THRESHOLD_PCT,
    mom_spike_threshold: float = MOM_SPIKE_THRESHOLD,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the monitor. ``to_lines`` maps raw source rows to typed lines
    (e.g. the delivery adapter + contract projection); it must be row-local."""
    reader = spark.readStream.schema(source_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = to_lines(reader.parquet(source_path))
    counts = monthly_delay_counts(lines)

    def publish(batch: DataFrame, epoch_id: int) -> None:
        # ``batch`` is the complete month table: at most one row per month.
        months = batch.persist()
        try:
            metrics = with_rate_and_change(months)
            metrics.write.mode("overwrite").saveAsTable(quote(metrics_table))
            alerts = check_delay_alert_threshold(metrics, absolute_threshold_pct, mom_spike_threshold)
            alerts.write.mode("overwrite").saveAsTable(quote(alerts_table))
        finally:
            months.unpersist()

    location = checkpoint_location or f"{checkpoint_dir(spark).rstrip('/')}/delay_monitor"
    writer = (
        counts.writeStream.outputMode("complete")
        .foreachBatch(publish)
        .option("checkpointLocation", location)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
