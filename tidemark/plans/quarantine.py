"""Quarantine in one pass: a table's rows are read once for all of its rules.

Rules that need one row only are conditions on it. Key rules are flags from
left joins with narrow tables of keys: the repeated primary keys (the one
other scan of the table), the distinct keys of each parent, the distinct
children of an order. Date order needs the parent's dates: a histogram of
(date, orders) per order key, at most one entry per calendar day, so that an
order key held by any number of orders is one row of the join; it also serves
the foreign key to orders. A row that breaks rules is then written once per
broken rule. AQE splits a hot key on the side of the rows, which is the
preserved side of every join, and the other side has it once.

The rows are those of ``silver.rule_frames`` (tested against them): a line
appears for date order as often as its order key occurs in orders with a date
that breaks the order, for any other rule once per row.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contract import ORDER_STATUSES, Contract
from tidemark.functions.errors import Rule, any_rule, category_tags, error_array, required_tags
from tidemark.operators import checks

#: A line's copies are produced in blocks of so many, so that no array of one
#: row grows with the number of orders of a key.
COPIES = 1 << 16
BROKEN = "struct<rule:string,errors:array<string>,copies:bigint>"


class RuleFlags:
    """The rows of a table with the columns that its rules need, beside each
    rule's condition and broken entries."""

    def __init__(self, rows: DataFrame):
        self.columns = rows.columns
        self.rows = rows
        self.conditions: list[Column] = []
        self.entries: list[Column] = []

    def add(self, rule: str, condition: Column, errors: Column | None = None) -> None:
        errors = F.array(F.lit(rule)) if errors is None else errors
        entry = F.struct(F.lit(rule).alias("rule"), errors.alias("errors"), F.lit(1).cast("long").alias("copies"))
        self.conditions.append(condition)
        self.entries.append(F.when(condition, F.array(entry.cast(BROKEN))).otherwise(F.array().cast(f"array<{BROKEN}>")))

    def add_tags(self, rule: str, tags: Sequence[Rule]) -> None:
        self.add(rule, any_rule(tags), error_array(tags))

    def mark(self, keys_of: DataFrame, keys: Sequence[str], null_matches: bool = False) -> Column:
        """Whether a row's key is among ``keys_of``, whose keys are distinct."""
        name = f"__mark{len(self.rows.columns)}"
        side = keys_of.select(*[F.col(k).alias(f"{name}_{i}") for i, k in enumerate(keys)], F.lit(True).alias(name))
        pairs = [(F.col(k), F.col(f"{name}_{i}")) for i, k in enumerate(keys)]
        self.rows = self.rows.join(side, reduce(and_, [a.eqNullSafe(b) if null_matches else a == b for a, b in pairs]), "left")
        return F.col(name).isNotNull()

    def add_dates(self, orders: DataFrame) -> Column:
        """The rule of date order; whether a line's order exists."""
        day = orders.groupBy("order_key", "order_date").agg(F.count(F.lit(1)).alias("copies"))
        days = day.groupBy("order_key").agg(F.collect_list(F.struct("order_date", "copies")).alias("__days"))
        self.rows = self.rows.join(days.withColumnRenamed("order_key", "__order_key"), F.col("order_key") == F.col("__order_key"), "left")
        found = F.col("__days").isNotNull()
        no_order = F.array(F.struct(F.lit(None).cast("date").alias("order_date"), F.lit(1).cast("long").alias("copies")))
        dates = F.coalesce("__days", no_order)

        def entry(d: Column) -> Column:
            errors = error_array(checks.date_rules(d["order_date"]))
            return F.struct(F.lit("date_sequence").alias("rule"), errors.alias("errors"), d["copies"].alias("copies")).cast(BROKEN)

        self.conditions.append(F.exists(dates, lambda d: any_rule(checks.date_rules(d["order_date"]))))
        self.entries.append(F.filter(F.transform(dates, entry), lambda e: F.size(e["errors"]) > 0))
        return found

    def broken(self) -> DataFrame:
        rows = self.rows.filter(reduce(or_, self.conditions))
        rows = rows.select(*self.columns, F.explode(F.concat(*self.entries)).alias("__e"))
        last = ((F.col("__e.copies") - 1) / COPIES).cast("long")
        rows = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("__block"))
        left = F.least(F.col("__e.copies") - F.col("__block") * COPIES, F.lit(COPIES).cast("long"))
        rows = rows.select("*", F.explode(F.sequence(F.lit(1).cast("long"), left)).alias("__copy"))
        return rows.select(*self.columns, F.col("__e.errors").alias("_quality_errors"), F.col("__e.rule").alias("_validation_rule"))


def broken_rows(
    tables: Mapping[str, DataFrame],
    contract: Contract,
    table: str,
    rules: Collection[str],
    allowed: Mapping[str, Sequence[str]],
    order_statuses: Sequence[str] = ORDER_STATUSES,
) -> DataFrame:
    """The rows of ``table`` that break some of ``rules`` (those on typed
    rows), once per broken rule: its columns, ``_quality_errors`` and
    ``_validation_rule``. Lazy; tables of rules not asked for are not read."""
    spec = contract.table(table)
    flags = RuleFlags(tables[table])
    if "required_values" in rules:
        flags.add_tags("required_values", required_tags([c for c in spec.required if c in flags.columns]))
    if table == "lineitem" and "categories" in rules:
        flags.add_tags("categories", category_tags(allowed))
    if table == "orders" and "order_status" in rules:
        flags.add_tags("order_status", category_tags({"order_status": list(order_statuses)}))
    if "primary_key" in rules:
        flags.add("primary_key", flags.mark(checks.duplicate_keys(tables[table], spec.primary_key), spec.primary_key, null_matches=True))
    parents = {fk.rule_name: (fk.parent, tuple(fk.keys)) for fk in contract.foreign_keys_of(table)}
    if table == "orders":
        parents["nonempty_order"] = ("lineitem", ("order_key",))
    dated = table == "lineitem" and "date_sequence" in rules
    of_dates = [rule for rule, parent in parents.items() if dated and rule in rules and parent == ("orders", ("order_key",))]
    for rule, (parent, keys) in parents.items():
        if rule in rules and rule not in of_dates:
            flags.add(rule, ~flags.mark(tables[parent].select(*keys).distinct(), keys))
    if dated:  # the last join, so that no other shuffles its histograms
        order_exists = flags.add_dates(tables["orders"])
        for rule in of_dates:
            flags.add(rule, ~order_exists)
    absent = set(rules) - {"required_values", "categories", "order_status", "primary_key", "date_sequence", *parents}
    if absent or not flags.entries:
        raise ValueError(f"{table}: no such rules: {sorted(absent)}")
    return flags.broken()


def one_pass_quarantine(
    transformed,
    contract: Contract,
    rules: Collection[tuple[str, str]],
    allowed: Mapping[str, Sequence[str]],
    order_statuses: Sequence[str] = ORDER_STATUSES,
) -> dict[str, DataFrame]:
    """The offending rows of the (table, rule) pairs by quarantine table. Raw
    rows of failed casts have another schema and go to ``<table>_casts``."""
    out = {}
    for table in sorted({t for t, _ in rules}):
        mine = {r for t, r in rules if t == table}
        if "lossless_casts" in mine:
            out[f"{table}_casts"] = transformed.cast_violations[table].withColumn("_validation_rule", F.lit("lossless_casts"))
        if typed := mine - {"lossless_casts"}:
            out[table] = broken_rows(transformed.tables, contract, table, typed, allowed, order_statuses)
    return out
