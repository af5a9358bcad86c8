"""Tagged multi-key aggregate: all key rules of a contract from one exchange.

Every table is scanned once. ``UNPIVOT`` (Spark's expand) turns a row into one
row per key that it carries: its own primary key, tagged with its table, and
each foreign key, tagged with the parent's table. Counters say who sent the
key: ``n0`` the table itself, ``n1``, ``n2``, ... its children in contract
order. Grouping by (tag, key) brings a parent and all its children together:

* own rows of a group with ``n0 > 1`` break the primary key;
* rows of child i with ``n0 = 0``, or with a null in the key, are orphans;
* own rows with ``n_i = 0``, or with a null in the key, have no child i.

Row-local rules travel as one more tagged row, whose counters are their flags
and whose key is constant, so that each task adds them up before the exchange.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame

from tidemark.contract import ORDER_STATUSES, Contract, Table
from tidemark.functions.casts import _q, cast_is_null_sql, lossy_cast_sql, not_allowed_sql

INTEGERS = ("BIGINT", "INT")


class TaggedKeys:
    """The tagged rows that the rules of the ``wanted`` tables need."""

    def __init__(self, contract: Contract, wanted: Collection[str]):
        self.contract = contract
        self.wanted = [t for t in contract.table_names if t in wanted]
        self.children = {t: [fk for fk in contract.foreign_keys if fk.parent == t] for t in contract.table_names}
        key_types = {t.column(k).dtype for t in contract.tables for k in t.primary_key}
        self.key_type = "BIGINT" if key_types <= set(INTEGERS) else "STRING"
        self.width = max(len(t.primary_key) for t in contract.tables)
        self.tag = {t: i for i, t in enumerate(contract.table_names)}
        self.local_tag = {t: len(self.tag) + i for i, t in enumerate(contract.table_names)}

    def foreign_keys(self) -> list[tuple[int, object]]:
        """(counter, foreign key) of the rules asked for, child rows or empty parents."""
        pairs = [(i, fk) for t in self.contract.table_names for i, fk in enumerate(self.children[t], 1)]
        return [(i, fk) for i, fk in pairs if fk.child in self.wanted or (self.counts_empty(fk) and fk.parent in self.wanted)]

    @staticmethod
    def counts_empty(fk) -> bool:
        """Every order needs a line."""
        return (fk.child, fk.parent) == ("lineitem", "orders")

    def _branches(self, t: Table, local: Mapping[str, str], counters: int) -> list[tuple[str, list[str], list[str]]]:
        """(tag column, key columns, counter columns) of each tagged row."""
        zero, one = "__zero", "__one"
        out = []
        parents = {fk.parent for _, fk in self.foreign_keys()}

        def key(names) -> list[str]:
            return [f"__k_{n}" for n in names] + ["__key0"] * (self.width - len(names))

        if t.name in self.wanted or t.name in parents:
            out.append((f"__t{self.tag[t.name]}", key(t.primary_key), [one] + [zero] * (counters - 1)))
        for i, fk in self.foreign_keys():
            if fk.child == t.name:
                out.append((f"__t{self.tag[fk.parent]}", key(fk.keys), [one if j == i else zero for j in range(counters)]))
        if local:
            flags = [f"__f_{r}" for r in local]
            out.append((f"__t{self.local_tag[t.name]}", ["__key0"] * self.width, flags + [zero] * (counters - len(flags))))
        return out

    def tagged(self, t: Table, view: str, local: Mapping[str, str], counters: int) -> str | None:
        """``SELECT`` of the tagged rows of one table, from one scan."""
        branches = self._branches(t, local, counters)
        if not branches:
            return None
        keys = sorted({k for _, some, _ in branches for k in some if k.startswith("__k_")})
        col = {c.name: c for c in t.columns}
        cast = lambda c: f"CAST(try_cast({_q(c.source)} AS {c.dtype}) AS {self.key_type})"
        columns = [f"{cast(col[k[4:]])} AS {_q(k)}" for k in keys]
        columns += [f"CAST(0 AS {self.key_type}) AS __key0", "0L AS __zero", "1L AS __one"]
        columns += [f"CAST(COALESCE({cond}, false) AS BIGINT) AS {_q('__f_' + r)}" for r, cond in local.items()]
        columns += [f"{tag[3:]} AS {tag}" for tag in sorted({b[0] for b in branches})]
        shape = ", ".join(["g", *(f"k{i}" for i in range(self.width)), *(f"n{i}" for i in range(counters))])
        rows = ", ".join(f"({', '.join(map(_q, [tag, *some, *n]))}) AS r{i}" for i, (tag, some, n) in enumerate(branches))
        return f"SELECT {shape} FROM (SELECT {', '.join(columns)} FROM {view}) UNPIVOT INCLUDE NULLS (({shape}) FOR __row IN ({rows}))"

    def by_key(self, views: Mapping[str, str], local: Mapping[str, Mapping[str, str]]) -> tuple[str, int]:
        """``SELECT g, k0.., n0..`` with a row per tag and key, and the number of counters."""
        counters = max([1 + len(c) for c in self.children.values()] + [len(r) for r in local.values()])
        parts = [s for t in self.contract.tables if (s := self.tagged(t, views[t.name], local.get(t.name, {}), counters))]
        shape = [*(f"k{i}" for i in range(self.width))]
        # a row without counts for every tag, so that none is missing when its table is empty
        tags = [self.tag[t] for t in self.contract.table_names] + [self.local_tag[t] for t in local]
        blank = ", ".join([*(f"CAST(0 AS {self.key_type})" for _ in shape), *("0L" for _ in range(counters))])
        parts.append(f"SELECT explode(array({', '.join(map(str, tags))})) AS g, {blank}")
        sums = ", ".join(f"SUM(n{i}) AS n{i}" for i in range(counters))
        return f"SELECT g, {', '.join(shape)}, {sums} FROM ({' UNION ALL '.join(parts)}) GROUP BY g, {', '.join(shape)}", counters

    def report(self, local: Mapping[str, Mapping[str, str]], views: Mapping[str, str]) -> str:
        """``SELECT table_name, rule_name, invalid_rows`` of all rules but date order."""
        by_key, counters = self.by_key(views, local)
        no_key = " OR ".join(f"k{i} IS NULL" for i in range(self.width))
        sums = ["SUM(IF(n0 > 1, n0, 0)) AS repeated"]
        sums += [f"SUM(n{i}) AS s{i}" for i in range(counters)]
        sums += [f"SUM(IF(n0 = 0 OR {no_key}, n{i}, 0)) AS orphans{i}" for i in range(1, counters)]
        sums += [f"SUM(IF(n{i} = 0 OR {no_key}, n0, 0)) AS childless{i}" for i in range(1, counters)]
        found: dict[int, list[str]] = {}

        def row(table: str, rule: str, n: str) -> str:
            return f"named_struct('table', '{table}', 'rule', '{rule}', 'n', {n})"

        for t in self.wanted:
            found.setdefault(self.tag[t], []).append(row(t, "primary_key", "repeated"))
        for i, fk in self.foreign_keys():
            mine = found.setdefault(self.tag[fk.parent], [])
            if fk.child in self.wanted:
                mine.append(row(fk.child, fk.rule_name, f"orphans{i}"))
            if self.counts_empty(fk) and fk.parent in self.wanted:
                mine.append(row(fk.parent, "nonempty_order", f"childless{i}"))
        for t, conditions in local.items():
            found[self.local_tag[t]] = [row(t, r, f"s{i}") for i, r in enumerate(conditions)]
        cases = " ".join(f"WHEN {g} THEN array({', '.join(rows)})" for g, rows in found.items())
        totals = f"SELECT g, {', '.join(sums)} FROM ({by_key}) GROUP BY g"
        return f"SELECT inline(CASE g {cases} END) AS (table_name, rule_name, invalid_rows) FROM ({totals})"


def local_conditions(contract: Contract, allowed: Mapping, order_statuses: Sequence[str], bronze: Mapping[str, DataFrame]) -> dict[str, dict[str, str]]:
    """Per table, SQL conditions on raw rows of the rules that need one row only."""
    out = {}
    for t in contract.tables:
        types = {f.name: f.dataType.simpleString() for f in bronze[t.name].schema.fields}
        absent = set(t.sources) - set(types)
        if absent:
            raise ValueError(f"{t.name}: the source lacks columns of the contract: {sorted(absent)}")
        col = {c.name: c for c in t.columns}
        mine = {
            "required_values": " OR ".join(cast_is_null_sql(col[n].source, col[n].dtype) for n in t.required) or "false",
            "lossless_casts": " OR ".join(lossy_cast_sql(c.source, types[c.source], c.dtype) for c in t.columns) or "false",
        }
        if {"lineitem", "orders"} <= set(contract.table_names):
            if t.name == "lineitem":
                mine["categories"] = " OR ".join(not_allowed_sql(col[c].source, col[c].dtype, v) for c, v in allowed.items())
            if t.name == "orders":
                mine["order_status"] = not_allowed_sql(col["order_status"].source, col["order_status"].dtype, order_statuses)
        out[t.name] = mine
    return out


def tagged_report(
    bronze: Mapping[str, DataFrame],
    contract: Contract,
    allowed: Mapping[str, Sequence[str]],
    order_statuses: Sequence[str] = ORDER_STATUSES,
    only: Collection[str] | None = None,
) -> DataFrame:
    """All rule counts from one scan a table and one exchange of keys; ``only``
    restricts the report to the rules of the named tables (of their parents
    only the keys are read). Date order is the one rule that needs line-level
    values across tables: one left join of three projected line columns with
    (order_key, order_date), counting fan-out rows as the rule defines."""
    wanted = set(contract.table_names if only is None else only)
    local = {t: rules for t, rules in local_conditions(contract, allowed, order_statuses, bronze).items() if t in wanted}
    views = {t: "{" + f"b_{t}" + "}" for t in contract.table_names}  # bound to the frames below
    masked = {t: f"\x00{t}\x00" for t in views}
    selects = [TaggedKeys(contract, wanted).report(local, masked)]
    if {"lineitem", "orders"} <= set(contract.table_names) and "lineitem" in wanted:
        typed = {t: {c.name: f"try_cast({_q(c.source)} AS {c.dtype}) AS {c.name}" for c in contract.table(t).columns} for t in ("lineitem", "orders")}
        line = ", ".join(typed["lineitem"][c] for c in ("order_key", "ship_date", "receipt_date"))
        order = ", ".join(typed["orders"][c] for c in ("order_key", "order_date"))
        selects.append(
            "SELECT 'lineitem' AS table_name, 'date_sequence' AS rule_name, COUNT_IF("
            "o.order_date IS NULL OR l.ship_date IS NULL OR l.receipt_date IS NULL "
            "OR o.order_date > l.ship_date OR l.ship_date > l.receipt_date) AS invalid_rows "
            f"FROM (SELECT {line} FROM {masked['lineitem']}) l LEFT JOIN (SELECT {order} FROM {masked['orders']}) o ON l.order_key = o.order_key"
        )
    sql = (
        "SELECT table_name, rule_name, CAST(invalid_rows AS BIGINT) AS invalid_rows, "
        f"CASE WHEN invalid_rows > 0 THEN 'FAILED' ELSE 'PASSED' END AS status FROM ({' UNION ALL '.join(selects)})"
    )
    sql = sql.replace("{", "{{").replace("}", "}}")  # literal braces, as in a whitelist value
    used = [t for t in contract.table_names if masked[t] in sql]
    for t in used:
        sql = sql.replace(masked[t], views[t])
    return next(iter(bronze.values())).sparkSession.sql(sql, **{f"b_{t}": bronze[t] for t in used})
