"""Discrete percentiles per group.

``exact`` (default) — the lower discrete percentile: the smallest value whose
cumulative share of the group's non-null values reaches p (what
``percentile_disc`` and, when it is exact, ``percentile_approx`` return).
It is computed from a value histogram: ``groupBy(group, value).count()``
aggregates map-side, so the shuffle carries at most one row per distinct
(group, value) per map task, however many rows or however skewed the groups
are. A window over that small histogram accumulates counts. This is exact
and cheap whenever the value domain is bounded — day counts are bounded by
the calendar span of the data, not by the row count.

``approx`` — ``percentile_approx`` (a mergeable sketch; rank error up to
n/accuracy). Use it for continuous, unbounded value domains.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def group_percentiles(
    df: DataFrame,
    group_cols: Sequence[str],
    value_col: str,
    percentiles: Mapping[str, float],
    count_alias: str | None = None,
    mean_alias: str | None = None,
    method: str = "exact",
    accuracy: int = 10000,
    weight_col: str | None = None,
) -> DataFrame:
    """One row per group: each alias → percentile of ``value_col`` (nulls
    ignored; null when the group has no non-null value); ``count_alias``
    (optional) → count of all rows, nulls included; ``mean_alias``
    (optional) → average of the non-null values (DOUBLE). ``weight_col``:
    the input is already a histogram and this column holds each row's
    multiplicity (exact method only)."""
    if method == "approx" and weight_col is None:
        aggs = [F.percentile_approx(value_col, p, accuracy).alias(a) for a, p in percentiles.items()]
        if mean_alias:
            aggs.append(F.avg(value_col).alias(mean_alias))
        if count_alias:
            aggs.append(F.count(F.lit(1)).alias(count_alias))
        return df.groupBy(*group_cols).agg(*aggs)
    if method != "exact":
        raise ValueError(f"unknown percentile method: {method}")

    value = "__value"
    weight = F.sum(weight_col) if weight_col else F.count(F.lit(1))
    hist = df.groupBy(*group_cols, F.col(value_col).alias(value)).agg(weight.alias("__n"))
    present = F.when(F.col(value).isNotNull(), F.col("__n")).otherwise(0)
    by_group = Window.partitionBy(*group_cols)
    running = by_group.orderBy(F.col(value).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = hist.select(
        *group_cols,
        value,
        "__n",
        F.sum(present).over(running).alias("__cum"),
        F.sum(present).over(by_group).alias("__total"),
    )
    aggs = [
        F.min(
            F.when(
                F.col(value).isNotNull() & (F.try_divide(F.col("__cum"), F.col("__total")) >= F.lit(p)),
                F.col(value),
            )
        ).alias(a)
        for a, p in percentiles.items()
    ]
    if mean_alias:
        # sum(value * n) / sum(n) over non-null values equals avg(value).
        weighted = F.sum(F.col(value).cast("double") * F.col("__n"))
        aggs.append(F.try_divide(weighted, F.sum(F.when(F.col(value).isNotNull(), F.col("__n")))).alias(mean_alias))
    if count_alias:
        aggs.append(F.sum("__n").alias(count_alias))
    return ranked.groupBy(*group_cols).agg(*aggs)
