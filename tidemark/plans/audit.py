"""Post-publish audit (zero-violation checks on published Silver) and the
profiling suite. The audit returns one row per check instead of raising, and
``assert_audit_clean`` is the gate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import profile
from tidemark.sources.rules import check_rules, load_logistics_rules


def _rows(counts: DataFrame) -> DataFrame:
    """A row of counts as rows (check_name, violations)."""
    pairs = ", ".join(f"'{c}', `{c}`" for c in counts.columns)
    return counts.selectExpr(f"stack({len(counts.columns)}, {pairs}) AS (check_name, violations)")


def _count(when: Column, name: str) -> Column:
    return F.count(F.when(when, 1)).alias(name)


def post_publish_audit(
    lineitem: DataFrame, orders: DataFrame, rules: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """(check_name, violations): category, temporal and referential checks.

    Two aggregates: one over the lines alone (categories, receipt before
    shipment), one over a full outer join of three narrow columns on the order
    key (shipment before order, orphan lines, orders without lines)."""
    allowed = check_rules(load_logistics_rules() if rules is None else rules)
    alone = [_count(F.col(c).isNull() | ~F.col(c).isin(*values), f"unexpected_{c}") for c, values in allowed.items()]
    alone.append(_count(F.col("receipt_date") < F.col("ship_date"), "receipt_before_ship"))
    lines = lineitem.select("order_key", "ship_date", F.lit(True).alias("is_line"))
    dates = orders.select("order_key", "order_date", F.lit(True).alias("is_order"))
    both = lines.join(dates, "order_key", "full_outer").agg(
        _count(F.col("ship_date") < F.col("order_date"), "ship_before_order"),
        _count(F.col("is_order").isNull(), "orphan_lineitems"),
        _count(F.col("is_line").isNull(), "orders_without_items"),
    )
    return _rows(lineitem.agg(*alone)).unionByName(_rows(both))


def assert_audit_clean(audit: DataFrame) -> None:
    bad = audit.filter(F.col("violations") > 0).collect()
    if bad:
        raise AssertionError("; ".join(f"{r.check_name}: {r.violations}" for r in bad))


def profile_lineitem(lineitem: DataFrame) -> dict[str, DataFrame]:
    """The profiling suite over typed lines: nulls, categories, date ranges,
    items per order and the overall delay rate."""
    transit = lineitem.withColumn("transit_days", F.datediff("receipt_date", "ship_date"))
    return {
        "row_count": profile.row_count(lineitem),
        "null_counts": profile.null_counts(lineitem),
        "ship_mode_share": profile.category_share(lineitem, "ship_mode"),
        "line_status_counts": profile.category_counts(lineitem, "line_status"),
        "return_flag_counts": profile.category_counts(lineitem, "return_flag"),
        "date_ranges": profile.min_max(lineitem, ["ship_date", "commit_date", "receipt_date"]),
        "transit_summary": profile.measure_summary(transit, "transit_days"),
        "items_per_order": profile.items_per_order(lineitem),
        "delay_rate": profile.overall_delay_rate(lineitem),
    }
