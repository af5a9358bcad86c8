"""Independent ANSI-SQL formulations (DuckDB dialect) of the registered
queries, over the raw driver views. Used as the correctness oracle: the SQL
is written the plain way (NOT EXISTS, window counts, quantile_disc, UNION
ALL of per-rule counts), not as a transcript of the Spark plans."""

from __future__ import annotations

from tidemark.contract import ORDER_STATUSES, TPCH_CONTRACT, Contract
from tidemark.sources.adapter import SHIP_MODES

# Driver tables: the source columns each raw view provides.
DRIVER_COLUMNS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "partsupp": ["ps_partkey", "ps_suppkey", "ps_availqty", "ps_supplycost"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
        "l_commitdate", "l_receiptdate", "l_shipmode",
    ],
}
DRIVER_CONTRACT: Contract = TPCH_CONTRACT.restricted_to(DRIVER_COLUMNS)

_DUCK_TYPES = {"BIGINT": "BIGINT", "INT": "INTEGER", "STRING": "VARCHAR", "DATE": "DATE", "DECIMAL(18,2)": "DECIMAL(18,2)"}

_MODE_CASE = " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(SHIP_MODES))

BRONZE_CTES = f"""
b_lineitem AS (
  SELECT *,
    CAST(l_shipdate AS DATE) + CAST((l_partkey*31 + l_suppkey*17 + l_linenumber*7) % 91 - 42 AS INTEGER) AS l_commitdate,
    CAST(l_shipdate AS DATE) + CAST((l_orderkey*13 + l_partkey*5 + l_linenumber*11) % 30 + 1 AS INTEGER) AS l_receiptdate,
    CASE CAST((l_orderkey + l_partkey*3 + l_linenumber) % 7 AS INTEGER) {_MODE_CASE} END AS l_shipmode
  FROM lineitem),
b_partsupp AS (
  SELECT l_partkey AS ps_partkey, l_suppkey AS ps_suppkey,
         CAST(SUM(l_quantity) AS BIGINT) AS ps_availqty, MIN(l_extendedprice) AS ps_supplycost
  FROM lineitem WHERE (l_partkey + l_suppkey) % 10 <> 0
  GROUP BY l_partkey, l_suppkey),
b_region AS (SELECT * FROM region), b_nation AS (SELECT * FROM nation),
b_supplier AS (SELECT * FROM supplier), b_customer AS (SELECT * FROM customer),
b_part AS (SELECT * FROM part), b_orders AS (SELECT * FROM orders)"""


def _silver_cte(contract: Contract, table: str) -> str:
    t = contract.table(table)
    cols = ", ".join(f"TRY_CAST({c.source} AS {_DUCK_TYPES[c.dtype]}) AS {c.name}" for c in t.columns)
    return f"s_{table} AS (SELECT {cols} FROM b_{table})"


def with_silver(body: str, contract: Contract = DRIVER_CONTRACT) -> str:
    """Prefix a query over s_<table> views with the Bronze + Silver CTEs."""
    ctes = ",\n".join([BRONZE_CTES.strip()] + [_silver_cte(contract, t) for t in contract.table_names])
    return f"WITH {ctes}\n{body}"


def lineitem_cols(prefix: str = "") -> str:
    return ", ".join(prefix + n for n in DRIVER_CONTRACT.table("lineitem").names)


def orders_cols(prefix: str = "") -> str:
    return ", ".join(prefix + n for n in DRIVER_CONTRACT.table("orders").names)


def _in_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def quality_report_sql(rules: dict, contract: Contract = DRIVER_CONTRACT, statuses=ORDER_STATUSES, only=None) -> str:
    """38 per-rule counts as a UNION ALL, each in its plainest SQL form
    (``only``: keep the rules of these tables)."""
    parts: list[tuple[str, str, str]] = []  # (table, rule, FROM ... WHERE ...)
    for t in contract.tables:
        s = f"s_{t.name}"
        req = " OR ".join(f"{c} IS NULL" for c in t.required) or "FALSE"
        parts.append((t.name, "required_values", f"FROM {s} WHERE {req}"))
        keys = ", ".join(t.primary_key)
        parts.append((t.name, "primary_key", f"FROM (SELECT COUNT(*) OVER (PARTITION BY {keys}) AS k FROM {s}) WHERE k > 1"))
        lossy = " OR ".join(
            f"({c.source} IS NOT NULL AND (TRY_CAST({c.source} AS {_DUCK_TYPES[c.dtype]}) IS NULL"
            f" OR TRY_CAST({c.source} AS {_DUCK_TYPES[c.dtype]}) <> {c.source}))"
            for c in t.columns
        )
        parts.append((t.name, "lossless_casts", f"FROM b_{t.name} WHERE {lossy}"))
    for fk in contract.foreign_keys:
        cond = " AND ".join(f"p.{k} = c.{k}" for k in fk.keys)
        parts.append((fk.child, fk.rule_name, f"FROM s_{fk.child} c WHERE NOT EXISTS (SELECT 1 FROM s_{fk.parent} p WHERE {cond})"))
    cats = " OR ".join(f"{c} IS NULL OR {c} NOT IN ({_in_list(v)})" for c, v in rules.items())
    parts += [
        ("lineitem", "date_sequence",
         "FROM s_lineitem l LEFT JOIN s_orders o ON l.order_key = o.order_key "
         "WHERE o.order_date IS NULL OR l.ship_date IS NULL OR l.receipt_date IS NULL "
         "OR o.order_date > l.ship_date OR l.ship_date > l.receipt_date"),
        ("lineitem", "categories", f"FROM s_lineitem WHERE {cats}"),
        ("orders", "order_status", f"FROM s_orders WHERE order_status IS NULL OR order_status NOT IN ({_in_list(statuses)})"),
        ("orders", "nonempty_order", "FROM s_orders o WHERE NOT EXISTS (SELECT 1 FROM s_lineitem l WHERE l.order_key = o.order_key)"),
    ]
    keep = set(only) if only is not None else {t for t, _, _ in parts}
    union = "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{r}' AS rule_name, COUNT(*) AS invalid_rows {tail}" for t, r, tail in parts if t in keep
    )
    body = (
        "SELECT table_name, rule_name, CAST(invalid_rows AS BIGINT) AS invalid_rows, "
        "CASE WHEN invalid_rows > 0 THEN 'FAILED' ELSE 'PASSED' END AS status FROM (\n" + union + "\n)"
    )
    return with_silver(body, contract)
