"""Row-returning data-quality checks on typed Silver frames.

Each check returns the offending rows (the quarantine view of the rule). The
count-only form used by the report lives in ``tidemark.plans.silver``; it
aggregates on keys before any shuffle and never moves whole rows.

Scale notes
* Primary key: duplicates are found by a key aggregate (partial aggregation
  map-side, so a key holding a third of all rows collapses to one row per map
  task) and the rows are then selected with a null-safe semi join, which AQE
  can split when one duplicated key is hot. A window over the key would put a
  hot key's rows into a single task.
* Foreign key: ``left_anti`` on the whole key; Spark's size statistics and AQE
  choose broadcast (small parent) or sort-merge (large parent) at run time.
* Every check is one lazy plan: building it starts no job, and the same plan
  runs at every size. AQE turns a join into a broadcast join only from the
  measured bytes of a finished exchange.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.contract import ORDER_STATUSES, Table
from tidemark.functions.errors import Rule, any_rule, category_tags, error_array, required_tags, tag_when
from tidemark.sources.rules import check_rules, load_logistics_rules


def invalid_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows breaking at least one rule; ``_quality_errors`` lists the broken
    rules' tags in rule order."""
    return df.filter(any_rule(rules)).withColumn("_quality_errors", error_array(rules))


def validate_required_values(df: DataFrame, table: Table) -> DataFrame:
    """Rows with a null in any non-nullable contract column (failed casts
    included, since try_cast turned them into nulls)."""
    return invalid_rows(df, required_tags([c for c in table.required if c in df.columns]))


def null_safe_key_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join on ``keys`` where null matches null (``<=>``); the right
    side's key columns are renamed so the result keeps the left schema."""
    renamed = right.select(*[F.col(k).alias(f"__key_{i}") for i, k in enumerate(keys)])
    return left.join(renamed, [left[k].eqNullSafe(renamed[f"__key_{i}"]) for i, k in enumerate(keys)], how)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values (nulls grouped together) that occur more than once, with
    their multiplicity ``_key_count``."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_key_count"))
        .filter(F.col("_key_count") > 1)
    )


def validate_primary_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row of every duplicated key (simple or composite; null keys
    group together, as in GROUP BY)."""
    return null_safe_key_join(df, duplicate_keys(df, keys), keys, "left_semi")


def validate_foreign_key(child: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Child rows without a parent on the whole (possibly composite) key.
    A null child key never matches, so it is a violation (unlike a SQL
    FOREIGN KEY constraint)."""
    return child.join(parent.select(*keys), list(keys), "left_anti")


def date_rules(order_date) -> list[Rule]:
    """Tags of a line whose order has that date."""
    return [
        tag_when(order_date.isNull(), "missing_order_date"),
        tag_when(F.col("ship_date").isNull(), "missing_ship_date"),
        tag_when(F.col("receipt_date").isNull(), "missing_receipt_date"),
        tag_when(order_date > F.col("ship_date"), "ship_before_order"),
        tag_when(F.col("ship_date") > F.col("receipt_date"), "receipt_before_ship"),
    ]


def _order_dates(orders: DataFrame) -> DataFrame:
    return orders.select(F.col("order_key").alias("__order_key"), F.col("order_date").alias("__order_date"))


def validate_date_sequence(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines breaking order_date <= ship_date <= receipt_date.

    A missing order or any missing date is an error; commit dates are not
    checked. Plain left-join semantics: a duplicated order key yields one
    output row per matching order, as the rule's definition requires.
    Output: the line's columns in their original order plus
    ``_quality_errors``."""
    dates = _order_dates(orders)
    joined = lineitem.join(dates, lineitem["order_key"] == dates["__order_key"], "left")
    return invalid_rows(joined, date_rules(F.col("__order_date"))).select(*lineitem.columns, "_quality_errors")


def validate_allowed_values(df: DataFrame, allowed: Mapping[str, Sequence[str]]) -> DataFrame:
    """Exact whitelist match per column; null counts as an invalid category."""
    return invalid_rows(df, category_tags(allowed))


def validate_categorical_values(lineitem: DataFrame, rules: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """ship_mode / return_flag / line_status against the JSON whitelists."""
    allowed = check_rules(load_logistics_rules() if rules is None else rules)
    return validate_allowed_values(lineitem, allowed)


def validate_order_status(orders: DataFrame, statuses: Sequence[str] = ORDER_STATUSES) -> DataFrame:
    return validate_allowed_values(orders, {"order_status": list(statuses)})


def empty_orders(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders without any line (every order needs at least one)."""
    return validate_foreign_key(orders, lineitem, ["order_key"])


def validate_referential_integrity(lineitem: DataFrame, orders: DataFrame) -> dict[str, DataFrame]:
    """Orphan lines and empty orders, side by side; nothing is deleted."""
    return {
        "orphan_lineitems": validate_foreign_key(lineitem, orders, ["order_key"]),
        "empty_orders": empty_orders(lineitem, orders),
    }
