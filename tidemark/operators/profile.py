"""Profiling and audit aggregates: each is one aggregate over one scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows (a display preview; the limit is the feature)."""
    return df.limit(n)


def row_count(df: DataFrame, alias: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: for every column, the number of nulls (single scan)."""
    cols = list(columns or df.columns)
    return df.select(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])


def category_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def category_share(df: DataFrame, column: str) -> DataFrame:
    """Frequency and percentage of the total, most frequent first. The total
    is a subquery over the same per-category aggregate (one scan, one
    exchange), so categories are never gathered in one task."""
    counts = category_counts(df, column)
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("share_pct", F.col("count") / total * 100).orderBy(F.desc("count"))


def min_max(df: DataFrame, columns: Sequence[str], extra: Sequence = ()) -> DataFrame:
    """min_<c> / max_<c> for each column (plus ``extra`` aggregates), one scan."""
    aggs = []
    for c in columns:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.agg(*aggs, *extra)


def measure_summary(df: DataFrame, column: str, prefix: str | None = None) -> DataFrame:
    """min / max / avg of a numeric measure."""
    p = prefix or column
    return df.agg(F.min(column).alias(f"min_{p}"), F.max(column).alias(f"max_{p}"), F.avg(column).alias(f"avg_{p}"))


def items_per_order(lineitem: DataFrame, key: str = "order_key", digits: int = 6) -> DataFrame:
    """count / mean / stddev / min / max of lines per order, as numbers
    (``describe`` would return strings). Mean and stddev are rounded to
    ``digits`` so that engines with different summation orders agree."""
    per_order = lineitem.groupBy(key).agg(F.count(F.lit(1)).alias("items_cnt"))
    return per_order.agg(
        F.count(F.lit(1)).alias("orders"),
        F.round(F.avg("items_cnt"), digits).alias("mean_items"),
        F.round(F.stddev_samp("items_cnt"), digits).alias("stddev_items"),
        F.min("items_cnt").alias("min_items"),
        F.max("items_cnt").alias("max_items"),
    )


def overall_delay_rate(lineitem: DataFrame) -> DataFrame:
    delayed = F.when(F.col("receipt_date") > F.col("commit_date"), 1).otherwise(0)
    return lineitem.agg(
        F.count(F.lit(1)).alias("total_items"),
        F.sum(delayed).alias("delayed_items"),
        F.round(F.avg(delayed) * 100, 2).alias("delay_rate_pct"),
    )


def unexpected_values(df: DataFrame, allowed: Mapping[str, Sequence[str]]) -> DataFrame:
    """(column_name, value) for every distinct value outside the whitelist;
    null is reported as unexpected. One scan: each row gives its unexpected
    (column, value) pairs, and only distinct pairs are shuffled."""
    pairs = [
        F.when(F.col(c).isNull() | ~F.col(c).isin(*values), F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")))
        for c, values in allowed.items()
    ]
    found = df.select(F.explode(F.filter(F.array(*pairs), lambda p: p.isNotNull())).alias("p"))
    return found.select("p.column_name", "p.value").distinct()


def profile_summary(lineitem: DataFrame) -> DataFrame:
    """Every scalar profiling figure of typed lines in ONE aggregate (one
    scan): row count, nulls per column, date ranges, transit-day min / max /
    average, delayed count and overall delay rate."""
    transit = F.datediff("receipt_date", "ship_date")
    delayed = F.when(F.col("receipt_date") > F.col("commit_date"), 1).otherwise(0)
    aggs = [F.count(F.lit(1)).alias("row_count")]
    aggs += [F.count(F.when(F.col(c).isNull(), 1)).alias(f"nulls_{c}") for c in lineitem.columns]
    for c in ("ship_date", "commit_date", "receipt_date"):
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    aggs += [
        F.min(transit).alias("min_transit_days"),
        F.max(transit).alias("max_transit_days"),
        F.avg(transit).alias("avg_transit_days"),
        F.sum(delayed).alias("delayed_items"),
        F.round(F.avg(delayed) * 100, 2).alias("delay_rate_pct"),
    ]
    return lineitem.agg(*aggs)
