"""Registered queries: every operator of the build as a (spark, sf_dir) →
DataFrame callable over the whole driver tables, and its DuckDB oracle SQL.

Output conventions: every computed column is aliased identically in both
forms; month buckets are returned as DATE; error arrays are returned as a
comma-joined string (``quality_errors``) so both engines hash them alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contract import Column, Table
from tidemark.functions.errors import category_tags, required_tags, tag_when
from tidemark.operators import checks, copy, marts, monitor, profile
from tidemark.operators.transform import transform_table, validate_lossless_casts
from tidemark.plans.audit import post_publish_audit
from tidemark.plans.oracle import (
    DRIVER_CONTRACT,
    _in_list,
    lineitem_cols,
    orders_cols,
    quality_report_sql,
    with_silver,
)
from tidemark.plans.quarantine import broken_rows
from tidemark.plans.silver import TransformationResult, fused_report, run_silver_transformations
from tidemark.plans.tagged import tagged_report
from tidemark.sources.adapter import bronze_sources
from tidemark.sources.rules import load_logistics_rules
from tidemark.sources.tables import read_table

# Fixed values for the registry's restricted rule set: a narrower carrier and
# returns policy, used to exercise the whitelist rules on data that passes
# the default whitelists.
RESTRICTED_RULES = {
    "ship_mode": ["AIR", "RAIL", "TRUCK"],
    "return_flag": ["N", "R"],
    "line_status": ["O", "F"],
}

# A policy without the partly filled status, for the same reason.
RESTRICTED_STATUSES = ["O", "F"]

# Contracts used to exercise the lossless-cast and required-value rules on
# real data: whole-currency prices, and events at daily grain with integer
# property codes.
PRICE_CONTRACT = Table(
    "lineitem_price",
    (
        Column("l_orderkey", "order_key", "BIGINT", False),
        Column("l_linenumber", "line_number", "INT", False),
        Column("l_extendedprice", "extended_price", "BIGINT", False),
    ),
    ("order_key", "line_number"),
)
EVENTS_CONTRACT = Table(
    "events",
    (
        Column("event_id", "event_id", "BIGINT", False),
        Column("ts", "event_date", "DATE", False),
        Column("user_id", "user_id", "BIGINT", False),
        Column("event_type", "event_type", "STRING", False),
        Column("value", "value", "DECIMAL(18,2)", False),
        Column("props", "props_code", "INT", False),
    ),
    ("event_id",),
)

RULES = load_logistics_rules()


def driver_silver(spark: SparkSession, sf_dir: str) -> TransformationResult:
    sources = bronze_sources(spark, sf_dir)
    return run_silver_transformations(sources, DRIVER_CONTRACT)


def _lines(spark, d):
    return driver_silver(spark, d).tables["lineitem"]


def _lines_orders(spark, d):
    t = driver_silver(spark, d).tables
    return t["lineitem"], t["orders"]


def _joined_errors(df: DataFrame, column: str = "_quality_errors") -> DataFrame:
    return df.withColumn("quality_errors", F.array_join(column, ",")).drop(column)


def _as_date(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.col(column).cast("date"))


# --------------------------------------------------------------------------- marts
def q_transit_time(spark, d):
    return marts.build_transit_time_mart(_lines(spark, d))


def q_order_sla(spark, d):
    lines, orders = _lines_orders(spark, d)
    return _as_date(marts.build_order_fulfillment_sla_mart(orders, lines), "order_month")


def q_ship_mode_delays(spark, d):
    return marts.build_ship_mode_delay_mart(_lines(spark, d))


def q_priority_speed(spark, d):
    lines, orders = _lines_orders(spark, d)
    return marts.build_priority_fulfillment_mart(orders, lines)


def q_monthly_delay(spark, d):
    return _as_date(monitor.compute_monthly_delay_rate(_lines(spark, d)), "receipt_month")


def q_monthly_delay_counts(spark, d):
    return _as_date(monitor.monthly_delay_counts(_lines(spark, d)), "receipt_month")


def q_delay_alerts(spark, d):
    metrics = monitor.compute_monthly_delay_rate(_lines(spark, d))
    return _as_date(monitor.check_delay_alert_threshold(metrics), "receipt_month")


_DAYS = "datediff('day', {a}, {b})"
_ON_TIME = "CASE WHEN receipt_date <= commit_date THEN 1 ELSE 0 END"
_DELAYED = "CASE WHEN receipt_date > commit_date THEN 1 ELSE 0 END"

SQL_TRANSIT_TIME = with_silver(f"""
SELECT ship_mode,
       CAST(quantile_disc(t, 0.5) AS INTEGER) AS median_transit_days,
       CAST(quantile_disc(t, 0.9) AS INTEGER) AS p90_transit_days,
       COUNT(*) AS total_shipments
FROM (SELECT ship_mode, {_DAYS.format(a='ship_date', b='receipt_date')} AS t FROM s_lineitem)
GROUP BY ship_mode""")

SQL_ORDER_SLA = with_silver(f"""
SELECT CAST(date_trunc('month', o.order_date) AS DATE) AS order_month,
       COUNT(*) AS total_orders,
       CAST(SUM(CASE WHEN total_lines = on_time_lines THEN 1 ELSE 0 END) AS BIGINT) AS fully_on_time_orders,
       CAST(SUM(total_lines) AS BIGINT) AS total_line_items,
       CAST(SUM(on_time_lines) AS BIGINT) AS on_time_line_items,
       ROUND(SUM(CASE WHEN total_lines = on_time_lines THEN 1 ELSE 0 END) / COUNT(*) * 100, 2) AS order_fully_on_time_rate,
       ROUND(SUM(on_time_lines) / SUM(total_lines) * 100, 2) AS lineitem_on_time_rate
FROM (SELECT order_key, COUNT(*) AS total_lines, SUM({_ON_TIME}) AS on_time_lines
      FROM s_lineitem GROUP BY order_key) p
JOIN s_orders o ON o.order_key = p.order_key
GROUP BY 1""")

SQL_SHIP_MODE_DELAYS = with_silver(f"""
SELECT ship_mode, COUNT(*) AS total_items_shipped,
       CAST(SUM({_DELAYED}) AS BIGINT) AS delayed_items_count,
       ROUND(SUM({_DELAYED}) / COUNT(*) * 100, 2) AS delay_rate_pct
FROM s_lineitem GROUP BY ship_mode ORDER BY delay_rate_pct DESC""")

SQL_PRIORITY_SPEED = with_silver(f"""
SELECT order_priority, ROUND(AVG(d), 2) AS avg_fulfillment_days,
       CAST(quantile_disc(d, 0.5) AS INTEGER) AS median_fulfillment_days,
       COUNT(*) AS total_orders
FROM (SELECT o.order_priority, {_DAYS.format(a='o.order_date', b='f.final_receipt')} AS d
      FROM (SELECT order_key, MAX(receipt_date) AS final_receipt FROM s_lineitem GROUP BY order_key) f
      JOIN s_orders o ON o.order_key = f.order_key)
GROUP BY order_priority ORDER BY order_priority""")

_MONTHLY = f"""
SELECT CAST(m AS DATE) AS receipt_month, total_receipts, delayed_items, delay_rate_pct,
       LAG(delay_rate_pct) OVER (ORDER BY m NULLS FIRST) AS prev_month_rate,
       ROUND(delay_rate_pct - LAG(delay_rate_pct) OVER (ORDER BY m NULLS FIRST), 2) AS rate_change_pct_points
FROM (SELECT date_trunc('month', receipt_date) AS m, COUNT(*) AS total_receipts,
             CAST(SUM({_DELAYED}) AS BIGINT) AS delayed_items,
             ROUND(SUM({_DELAYED}) / COUNT(*) * 100, 2) AS delay_rate_pct
      FROM s_lineitem GROUP BY 1)"""

SQL_MONTHLY_DELAY = with_silver(_MONTHLY + " ORDER BY receipt_month NULLS FIRST")
SQL_MONTHLY_DELAY_COUNTS = with_silver(f"""
SELECT CAST(date_trunc('month', receipt_date) AS DATE) AS receipt_month, COUNT(*) AS total_receipts,
       CAST(SUM({_DELAYED}) AS BIGINT) AS delayed_items
FROM s_lineitem GROUP BY 1""")
SQL_DELAY_ALERTS = with_silver(
    f"SELECT * FROM ({_MONTHLY}) WHERE delay_rate_pct > 65.0 OR rate_change_pct_points > 5.0 ORDER BY receipt_month"
)


def q_order_facts(spark, d):
    lines, orders = _lines_orders(spark, d)
    return marts.order_facts(orders, lines)


def q_ship_mode_histogram(spark, d):
    return marts.ship_mode_histogram(_lines(spark, d))


SQL_ORDER_FACTS = with_silver(f"""
SELECT p.order_key, p.total_lines, p.on_time_lines, p.final_receipt_date, o.order_date, o.order_priority
FROM (SELECT order_key, COUNT(*) AS total_lines, CAST(SUM({_ON_TIME}) AS BIGINT) AS on_time_lines,
             MAX(receipt_date) AS final_receipt_date
      FROM s_lineitem GROUP BY order_key) p
JOIN s_orders o ON o.order_key = p.order_key""")

SQL_ALL_MARTS = with_silver(f"""
SELECT 'transit_time_performance' AS mart, ship_mode AS key,
       CAST(quantile_disc({_DAYS.format(a='ship_date', b='receipt_date')}, 0.5) AS BIGINT) AS total FROM s_lineitem GROUP BY ship_mode
UNION ALL SELECT 'ship_mode_delays', ship_mode, CAST(SUM({_DELAYED}) AS BIGINT) FROM s_lineitem GROUP BY ship_mode
UNION ALL SELECT 'order_fulfillment_sla', strftime(date_trunc('month', o.order_date), '%Y-%m-%d %H:%M:%S'),
                 CAST(SUM(CASE WHEN n = ok THEN 1 ELSE 0 END) AS BIGINT)
  FROM (SELECT order_key, COUNT(*) AS n, SUM({_ON_TIME}) AS ok FROM s_lineitem GROUP BY order_key) p
  JOIN s_orders o ON o.order_key = p.order_key GROUP BY 2
UNION ALL SELECT 'priority_fulfillment_speed', o.order_priority,
                 CAST(quantile_disc({_DAYS.format(a='o.order_date', b='r')}, 0.5) AS BIGINT)
  FROM (SELECT order_key, MAX(receipt_date) AS r FROM s_lineitem GROUP BY order_key) f
  JOIN s_orders o ON o.order_key = f.order_key GROUP BY 2""")

SQL_SHIP_MODE_HISTOGRAM = with_silver(f"""
SELECT ship_mode, CAST({_DAYS.format(a='ship_date', b='receipt_date')} AS INTEGER) AS transit_days,
       COUNT(*) AS shipments, CAST(SUM({_DELAYED}) AS BIGINT) AS delayed
FROM s_lineitem GROUP BY 1, 2""")


# --------------------------------------------------------------------------- key checks
def q_pk_duplicates(spark, d):
    t = DRIVER_CONTRACT.table("lineitem")
    return checks.validate_primary_key(_lines(spark, d), t.primary_key)


SQL_PK_DUPLICATES = with_silver(f"""
SELECT {lineitem_cols()} FROM (
  SELECT *, COUNT(*) OVER (PARTITION BY order_key, line_number) AS k FROM s_lineitem) WHERE k > 1""")


def _fk_query(child: str, parent: str, keys: tuple[str, ...]) -> Callable:
    def run(spark, d):
        t = driver_silver(spark, d).tables
        return checks.validate_foreign_key(t[child], t[parent], keys)

    return run


def _fk_sql(child: str, parent: str, keys: tuple[str, ...]) -> str:
    cols = ", ".join("c." + n for n in DRIVER_CONTRACT.table(child).names)
    cond = " AND ".join(f"p.{k} = c.{k}" for k in keys)
    return with_silver(f"SELECT {cols} FROM s_{child} c WHERE NOT EXISTS (SELECT 1 FROM s_{parent} p WHERE {cond})")


FK_QUERIES = {
    f"fk_{fk.child}_{fk.parent}": (fk.child, fk.parent, fk.keys) for fk in DRIVER_CONTRACT.foreign_keys
}


def q_empty_orders(spark, d):
    lines, orders = _lines_orders(spark, d)
    return checks.empty_orders(lines, orders)


SQL_EMPTY_ORDERS = with_silver(f"""
SELECT {orders_cols('o.')} FROM s_orders o
WHERE NOT EXISTS (SELECT 1 FROM s_lineitem l WHERE l.order_key = o.order_key)""")


def q_date_sequence(spark, d):
    lines, orders = _lines_orders(spark, d)
    return _joined_errors(checks.validate_date_sequence(lines, orders))


_SEQ_TAGS = """concat_ws(',',
    CASE WHEN o.order_date IS NULL THEN 'missing_order_date' END,
    CASE WHEN l.ship_date IS NULL THEN 'missing_ship_date' END,
    CASE WHEN l.receipt_date IS NULL THEN 'missing_receipt_date' END,
    CASE WHEN o.order_date > l.ship_date THEN 'ship_before_order' END,
    CASE WHEN l.ship_date > l.receipt_date THEN 'receipt_before_ship' END)"""

SQL_DATE_SEQUENCE = with_silver(f"""
SELECT * FROM (
  SELECT {lineitem_cols('l.')}, {_SEQ_TAGS} AS quality_errors
  FROM s_lineitem l LEFT JOIN s_orders o ON l.order_key = o.order_key)
WHERE quality_errors <> ''""")


# --------------------------------------------------------------------------- row rules
def _category_sql(rules) -> str:
    tags = ", ".join(
        f"CASE WHEN {c} IS NULL OR {c} NOT IN ({_in_list(v)}) THEN 'category:{c}' END" for c, v in rules.items()
    )
    return with_silver(f"""
SELECT * FROM (SELECT {lineitem_cols()}, concat_ws(',', {tags}) AS quality_errors FROM s_lineitem)
WHERE quality_errors <> ''""")


def q_invalid_categories(spark, d):
    return _joined_errors(checks.validate_categorical_values(_lines(spark, d), RULES))


def q_invalid_categories_restricted(spark, d):
    return _joined_errors(checks.validate_categorical_values(_lines(spark, d), RESTRICTED_RULES))


def q_order_status(spark, d):
    return _joined_errors(checks.validate_order_status(_lines_orders(spark, d)[1], RESTRICTED_STATUSES))


SQL_ORDER_STATUS = with_silver(f"""
SELECT {orders_cols()}, 'category:order_status' AS quality_errors FROM s_orders
WHERE order_status IS NULL OR order_status NOT IN ('O', 'F')""")


def q_required_values(spark, d):
    return _joined_errors(checks.validate_required_values(_lines(spark, d), DRIVER_CONTRACT.table("lineitem")))


_REQ_TAGS = ", ".join(
    f"CASE WHEN {c} IS NULL THEN 'required:{c}' END" for c in DRIVER_CONTRACT.table("lineitem").required
)
SQL_REQUIRED_VALUES = with_silver(f"""
SELECT * FROM (SELECT {lineitem_cols()}, concat_ws(',', {_REQ_TAGS}) AS quality_errors FROM s_lineitem)
WHERE quality_errors <> ''""")


def q_required_values_events(spark, d):
    events = transform_table(read_table(spark, d, "events"), EVENTS_CONTRACT)
    return _joined_errors(checks.validate_required_values(events, EVENTS_CONTRACT))


SQL_REQUIRED_VALUES_EVENTS = """
SELECT * FROM (
  SELECT event_id, event_date, user_id, event_type, value, props_code,
         concat_ws(',', CASE WHEN event_id IS NULL THEN 'required:event_id' END,
                        CASE WHEN event_date IS NULL THEN 'required:event_date' END,
                        CASE WHEN user_id IS NULL THEN 'required:user_id' END,
                        CASE WHEN event_type IS NULL THEN 'required:event_type' END,
                        CASE WHEN value IS NULL THEN 'required:value' END,
                        CASE WHEN props_code IS NULL THEN 'required:props_code' END) AS quality_errors
  FROM (SELECT TRY_CAST(event_id AS BIGINT) AS event_id, TRY_CAST(ts AS DATE) AS event_date,
               TRY_CAST(user_id AS BIGINT) AS user_id, event_type,
               TRY_CAST(value AS DECIMAL(18,2)) AS value, TRY_CAST(props AS INTEGER) AS props_code
        FROM events))
WHERE quality_errors <> ''"""


def q_line_errors(spark, d):
    """Multi-rule row filter: required values, restricted whitelists and
    receipt-before-ship tagged together on each line."""
    lines = _lines(spark, d)
    tags = (
        required_tags(DRIVER_CONTRACT.table("lineitem").required)
        + category_tags(RESTRICTED_RULES)
        + [tag_when(F.col("ship_date") > F.col("receipt_date"), "receipt_before_ship")]
    )
    return _joined_errors(checks.invalid_rows(lines, tags))


_LINE_ERR_TAGS = (
    _REQ_TAGS
    + ", "
    + ", ".join(
        f"CASE WHEN {c} IS NULL OR {c} NOT IN ({_in_list(v)}) THEN 'category:{c}' END"
        for c, v in RESTRICTED_RULES.items()
    )
    + ", CASE WHEN ship_date > receipt_date THEN 'receipt_before_ship' END"
)
SQL_LINE_ERRORS = with_silver(f"""
SELECT * FROM (SELECT {lineitem_cols()}, concat_ws(',', {_LINE_ERR_TAGS}) AS quality_errors FROM s_lineitem)
WHERE quality_errors <> ''""")


# --------------------------------------------------------------------------- casts / copies
def q_contract_projection(spark, d):
    return _lines(spark, d)


SQL_CONTRACT_PROJECTION = with_silver("SELECT * FROM s_lineitem")


def q_lossless_price(spark, d):
    return _joined_errors(validate_lossless_casts(read_table(spark, d, "lineitem"), PRICE_CONTRACT))


SQL_LOSSLESS_PRICE = """
SELECT *, 'lossy_cast:extended_price' AS quality_errors FROM lineitem
WHERE l_extendedprice IS NOT NULL AND l_extendedprice <> trunc(l_extendedprice)"""


def q_lossless_events(spark, d):
    return _joined_errors(validate_lossless_casts(read_table(spark, d, "events"), EVENTS_CONTRACT))


SQL_LOSSLESS_EVENTS = """
SELECT * FROM (
  SELECT *, concat_ws(',',
      CASE WHEN ts IS NOT NULL AND ts <> date_trunc('day', ts) THEN 'lossy_cast:event_date' END,
      CASE WHEN value IS NOT NULL AND CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) <> value THEN 'lossy_cast:value' END,
      CASE WHEN props IS NOT NULL AND (TRY_CAST(props AS INTEGER) IS NULL
                OR CAST(TRY_CAST(props AS INTEGER) AS VARCHAR) <> props) THEN 'lossy_cast:props_code' END
    ) AS quality_errors
  FROM events)
WHERE quality_errors <> ''"""


def _price_copy(spark, d):
    raw = read_table(spark, d, "lineitem")
    return raw, raw.withColumn("l_extendedprice", F.col("l_extendedprice").try_cast("bigint").cast("double"))


def q_copy_difference(spark, d):
    return copy.multiset_difference(*_price_copy(spark, d))


_PRICE_SRC = "SELECT * FROM lineitem"
_PRICE_COPY = "SELECT * REPLACE (CAST(trunc(l_extendedprice) AS DOUBLE) AS l_extendedprice) FROM lineitem"
SQL_COPY_DIFFERENCE = f"""
SELECT *, 'source_only' AS _side FROM ({_PRICE_SRC} EXCEPT ALL {_PRICE_COPY})
UNION ALL
SELECT *, 'copy_only' AS _side FROM ({_PRICE_COPY} EXCEPT ALL {_PRICE_SRC})"""


def q_copy_delta(spark, d):
    return copy.multiset_delta(*_price_copy(spark, d))


SQL_COPY_DELTA = f"""
SELECT * EXCLUDE (s, c), CAST(SUM(s) AS BIGINT) AS source_count, CAST(SUM(c) AS BIGINT) AS copy_count
FROM (SELECT *, 1 AS s, 0 AS c FROM ({_PRICE_SRC}) UNION ALL SELECT *, 0 AS s, 1 AS c FROM ({_PRICE_COPY}))
GROUP BY ALL
HAVING SUM(s) <> SUM(c)"""


def q_copy_verification(spark, d):
    return copy.verification_summary(*_price_copy(spark, d))


SQL_COPY_VERIFICATION = f"""
SELECT COUNT(*) AS source_rows, (SELECT COUNT(*) FROM ({_PRICE_COPY})) AS copy_rows,
       (SELECT COUNT(*) FROM ({SQL_COPY_DELTA})) AS differing_rows,
       (SELECT COUNT(*) FROM ({SQL_COPY_DELTA})) = 0 AS equal
FROM lineitem"""


def q_all_marts(spark, d):
    """All four marts from the shared intermediates, as (mart, row) rows."""
    lines, orders = _lines_orders(spark, d)
    parts = marts.marts_from_shared(marts.ship_mode_histogram(lines), marts.order_facts(orders, lines))
    rows = [
        df.select(F.lit(name).alias("mart"), df[df.columns[0]].cast("string").alias("key"), F.col(COUNTED[name]).cast("bigint").alias("total"))
        for name, df in parts.items()
    ]
    return rows[0].unionAll(rows[1]).unionAll(rows[2]).unionAll(rows[3])


COUNTED = {
    "transit_time_performance": "median_transit_days",
    "order_fulfillment_sla": "fully_on_time_orders",
    "ship_mode_delays": "delayed_items_count",
    "priority_fulfillment_speed": "median_fulfillment_days",
}


# --------------------------------------------------------------------------- suite
def q_quality_report(spark, d):
    return tagged_report(driver_silver(spark, d).bronze, DRIVER_CONTRACT, RULES)


def q_lineitem_report(spark, d):
    """The line-item rules alone (required values, primary key, lossless
    casts, whitelists, four foreign keys, date order) as one fused plan."""
    return fused_report(driver_silver(spark, d), DRIVER_CONTRACT, RULES, only=["lineitem"])


def q_quarantine_lineitem(spark, d):
    names = ["required_values", "primary_key", "date_sequence", "categories", *(fk.rule_name for fk in DRIVER_CONTRACT.foreign_keys_of("lineitem"))]
    q = broken_rows(driver_silver(spark, d).tables, DRIVER_CONTRACT, "lineitem", names, RULES)
    return _joined_errors(q).withColumnRenamed("_validation_rule", "validation_rule")


def _quarantine_sql() -> str:
    cols = lineitem_cols()
    lc = lineitem_cols("c.")
    parts = [
        f"SELECT {cols}, 'required_values' AS validation_rule, concat_ws(',', {_REQ_TAGS}) AS quality_errors "
        f"FROM s_lineitem WHERE {' OR '.join(c + ' IS NULL' for c in DRIVER_CONTRACT.table('lineitem').required)}",
        f"SELECT {cols}, 'primary_key', 'primary_key' FROM "
        "(SELECT *, COUNT(*) OVER (PARTITION BY order_key, line_number) AS k FROM s_lineitem) WHERE k > 1",
    ]
    for fk in DRIVER_CONTRACT.foreign_keys_of("lineitem"):
        cond = " AND ".join(f"p.{k} = c.{k}" for k in fk.keys)
        parts.append(
            f"SELECT {lc}, '{fk.rule_name}', '{fk.rule_name}' FROM s_lineitem c "
            f"WHERE NOT EXISTS (SELECT 1 FROM s_{fk.parent} p WHERE {cond})"
        )
    parts.append(
        f"SELECT * FROM (SELECT {lineitem_cols('l.')}, 'date_sequence', {_SEQ_TAGS} AS e "
        "FROM s_lineitem l LEFT JOIN s_orders o ON l.order_key = o.order_key) WHERE e <> ''"
    )
    cat_tags = ", ".join(
        f"CASE WHEN {c} IS NULL OR {c} NOT IN ({_in_list(v)}) THEN 'category:{c}' END" for c, v in RULES.items()
    )
    parts.append(
        f"SELECT * FROM (SELECT {cols}, 'categories', concat_ws(',', {cat_tags}) AS e FROM s_lineitem) WHERE e <> ''"
    )
    return with_silver("\nUNION ALL ".join(parts))


# --------------------------------------------------------------------------- profiling / audit
def q_null_profile(spark, d):
    return profile.null_counts(read_table(spark, d, "lineitem"))


def _null_profile_sql(columns) -> str:
    return "SELECT " + ", ".join(f"COUNT(CASE WHEN {c} IS NULL THEN 1 END) AS {c}" for c in columns) + " FROM lineitem"


_RAW_LINEITEM = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


def q_category_share(spark, d):
    return profile.category_share(_lines(spark, d), "ship_mode")


SQL_CATEGORY_SHARE = with_silver("""
SELECT ship_mode, COUNT(*) AS "count", COUNT(*) / SUM(COUNT(*)) OVER () * 100 AS share_pct
FROM s_lineitem GROUP BY ship_mode ORDER BY "count" DESC""")


def _category_count_query(column: str) -> Callable:
    return lambda spark, d: profile.category_counts(_lines(spark, d), column)


def _category_count_sql(column: str) -> str:
    return with_silver(f'SELECT {column}, COUNT(*) AS "count" FROM s_lineitem GROUP BY {column}')


def q_items_per_order(spark, d):
    return profile.items_per_order(_lines(spark, d))


SQL_ITEMS_PER_ORDER = with_silver("""
SELECT COUNT(*) AS orders, ROUND(AVG(n), 6) AS mean_items, ROUND(STDDEV_SAMP(n), 6) AS stddev_items,
       MIN(n) AS min_items, MAX(n) AS max_items
FROM (SELECT order_key, COUNT(*) AS n FROM s_lineitem GROUP BY order_key)""")


def q_date_ranges(spark, d):
    lines = _lines(spark, d).withColumn("transit_days", F.datediff("receipt_date", "ship_date"))
    return profile.min_max(
        lines,
        ["ship_date", "commit_date", "receipt_date", "transit_days"],
        extra=[F.avg("transit_days").alias("avg_transit_days")],
    )


SQL_DATE_RANGES = with_silver(f"""
SELECT MIN(ship_date) AS min_ship_date, MAX(ship_date) AS max_ship_date,
       MIN(commit_date) AS min_commit_date, MAX(commit_date) AS max_commit_date,
       MIN(receipt_date) AS min_receipt_date, MAX(receipt_date) AS max_receipt_date,
       CAST(MIN(t) AS INTEGER) AS min_transit_days, CAST(MAX(t) AS INTEGER) AS max_transit_days,
       AVG(t) AS avg_transit_days
FROM (SELECT *, {_DAYS.format(a='ship_date', b='receipt_date')} AS t FROM s_lineitem)""")


def q_delay_rate(spark, d):
    return profile.overall_delay_rate(_lines(spark, d))


SQL_DELAY_RATE = with_silver(f"""
SELECT COUNT(*) AS total_items, CAST(SUM({_DELAYED}) AS BIGINT) AS delayed_items,
       ROUND(AVG({_DELAYED}) * 100, 2) AS delay_rate_pct FROM s_lineitem""")


def q_unexpected_values(spark, d):
    return profile.unexpected_values(_lines(spark, d), RESTRICTED_RULES)


SQL_UNEXPECTED_VALUES = with_silver(
    "\nUNION ALL ".join(
        f"SELECT DISTINCT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM s_lineitem "
        f"WHERE {c} IS NULL OR {c} NOT IN ({_in_list(v)})"
        for c, v in RESTRICTED_RULES.items()
    )
)


def q_lineitem_profile(spark, d):
    return profile.profile_summary(_lines(spark, d))


def _lineitem_profile_sql() -> str:
    names = DRIVER_CONTRACT.table("lineitem").names
    parts = ["COUNT(*) AS row_count"]
    parts += [f"COUNT(CASE WHEN {c} IS NULL THEN 1 END) AS nulls_{c}" for c in names]
    for c in ("ship_date", "commit_date", "receipt_date"):
        parts += [f"MIN({c}) AS min_{c}", f"MAX({c}) AS max_{c}"]
    t = _DAYS.format(a="ship_date", b="receipt_date")
    parts += [
        f"CAST(MIN({t}) AS INTEGER) AS min_transit_days",
        f"CAST(MAX({t}) AS INTEGER) AS max_transit_days",
        f"AVG({t}) AS avg_transit_days",
        f"CAST(SUM({_DELAYED}) AS BIGINT) AS delayed_items",
        f"ROUND(AVG({_DELAYED}) * 100, 2) AS delay_rate_pct",
    ]
    return with_silver("SELECT " + ", ".join(parts) + " FROM s_lineitem")


def q_row_counts(spark, d):
    sources = bronze_sources(spark, d)
    parts = [profile.row_count(df).select(F.lit(n).alias("table_name"), "row_count") for n, df in sources.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


SQL_ROW_COUNTS = with_silver(
    "\nUNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM b_{t}" for t in DRIVER_CONTRACT.table_names)
)


def q_temporal_audit(spark, d):
    lines, orders = _lines_orders(spark, d)
    return post_publish_audit(lines, orders, RESTRICTED_RULES)


SQL_TEMPORAL_AUDIT = with_silver("""
SELECT 'ship_before_order' AS check_name, COUNT(*) AS violations
  FROM s_lineitem l JOIN s_orders o ON l.order_key = o.order_key WHERE l.ship_date < o.order_date
UNION ALL SELECT 'unexpected_' || c, COUNT(*) FILTER (bad) FROM (
  SELECT unnest(['ship_mode', 'return_flag', 'line_status']) AS c, unnest([{0}]) AS bad FROM s_lineitem) GROUP BY c
UNION ALL SELECT 'receipt_before_ship', COUNT(*) FROM s_lineitem WHERE receipt_date < ship_date
UNION ALL SELECT 'orphan_lineitems', COUNT(*) FROM s_lineitem l
  WHERE NOT EXISTS (SELECT 1 FROM s_orders o WHERE o.order_key = l.order_key)
UNION ALL SELECT 'orders_without_items', COUNT(*) FROM s_orders o
  WHERE NOT EXISTS (SELECT 1 FROM s_lineitem l WHERE l.order_key = o.order_key)""".format(
    ", ".join(f"{c} IS NULL OR {c} NOT IN ({_in_list(v)})" for c, v in RESTRICTED_RULES.items())
))


# --------------------------------------------------------------------------- registry
def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable] = {
        "transit_time": q_transit_time,
        "order_sla": q_order_sla,
        "ship_mode_delays": q_ship_mode_delays,
        "priority_speed": q_priority_speed,
        "monthly_delay": q_monthly_delay,
        "monthly_delay_counts": q_monthly_delay_counts,
        "delay_alerts": q_delay_alerts,
        "order_facts": q_order_facts,
        "ship_mode_histogram": q_ship_mode_histogram,
        "pk_duplicates": q_pk_duplicates,
        "empty_orders": q_empty_orders,
        "date_sequence": q_date_sequence,
        "invalid_categories": q_invalid_categories,
        "invalid_categories_restricted": q_invalid_categories_restricted,
        "order_status_check": q_order_status,
        "required_values": q_required_values,
        "required_values_events": q_required_values_events,
        "line_errors": q_line_errors,
        "contract_projection": q_contract_projection,
        "lossless_price": q_lossless_price,
        "lossless_events": q_lossless_events,
        "copy_difference": q_copy_difference,
        "copy_delta": q_copy_delta,
        "copy_verification": q_copy_verification,
        "all_marts": q_all_marts,
        "quality_report": q_quality_report,
        "lineitem_report": q_lineitem_report,
        "quarantine_lineitem": q_quarantine_lineitem,
        "null_profile": q_null_profile,
        "category_share": q_category_share,
        "line_status_counts": _category_count_query("line_status"),
        "return_flag_counts": _category_count_query("return_flag"),
        "items_per_order": q_items_per_order,
        "date_ranges": q_date_ranges,
        "delay_rate": q_delay_rate,
        "unexpected_values": q_unexpected_values,
        "row_counts": q_row_counts,
        "lineitem_profile": q_lineitem_profile,
        "temporal_audit": q_temporal_audit,
    }
    for name, args in FK_QUERIES.items():
        out[name] = _fk_query(*args)
    return out


def oracle_sql() -> dict[str, str]:
    out = {
        "transit_time": SQL_TRANSIT_TIME,
        "order_sla": SQL_ORDER_SLA,
        "ship_mode_delays": SQL_SHIP_MODE_DELAYS,
        "priority_speed": SQL_PRIORITY_SPEED,
        "monthly_delay": SQL_MONTHLY_DELAY,
        "monthly_delay_counts": SQL_MONTHLY_DELAY_COUNTS,
        "delay_alerts": SQL_DELAY_ALERTS,
        "order_facts": SQL_ORDER_FACTS,
        "ship_mode_histogram": SQL_SHIP_MODE_HISTOGRAM,
        "pk_duplicates": SQL_PK_DUPLICATES,
        "empty_orders": SQL_EMPTY_ORDERS,
        "date_sequence": SQL_DATE_SEQUENCE,
        "invalid_categories": _category_sql(RULES),
        "invalid_categories_restricted": _category_sql(RESTRICTED_RULES),
        "order_status_check": SQL_ORDER_STATUS,
        "required_values": SQL_REQUIRED_VALUES,
        "required_values_events": SQL_REQUIRED_VALUES_EVENTS,
        "line_errors": SQL_LINE_ERRORS,
        "contract_projection": SQL_CONTRACT_PROJECTION,
        "lossless_price": SQL_LOSSLESS_PRICE,
        "lossless_events": SQL_LOSSLESS_EVENTS,
        "copy_difference": SQL_COPY_DIFFERENCE,
        "copy_delta": SQL_COPY_DELTA,
        "copy_verification": SQL_COPY_VERIFICATION,
        "all_marts": SQL_ALL_MARTS,
        "quality_report": quality_report_sql(RULES),
        "lineitem_report": quality_report_sql(RULES, only=["lineitem"]),
        "quarantine_lineitem": _quarantine_sql(),
        "null_profile": _null_profile_sql(_RAW_LINEITEM),
        "category_share": SQL_CATEGORY_SHARE,
        "line_status_counts": _category_count_sql("line_status"),
        "return_flag_counts": _category_count_sql("return_flag"),
        "items_per_order": SQL_ITEMS_PER_ORDER,
        "date_ranges": SQL_DATE_RANGES,
        "delay_rate": SQL_DELAY_RATE,
        "unexpected_values": SQL_UNEXPECTED_VALUES,
        "row_counts": SQL_ROW_COUNTS,
        "lineitem_profile": _lineitem_profile_sql(),
        "temporal_audit": SQL_TEMPORAL_AUDIT,
    }
    for name, args in FK_QUERIES.items():
        out[name] = _fk_sql(*args)
    return out
