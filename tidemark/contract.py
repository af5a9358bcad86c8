"""Data contract: typed tables, primary keys and foreign keys.

The contract is a parameter of every check and transformation, never a module
global read implicitly. ``TPCH_CONTRACT`` is the full 61-column delivery
contract; ``Contract.restricted_to`` derives the subset that a given set of
source frames can satisfy (the driver test tables lack several columns).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

import re

from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_SIMPLE_TYPES = {"BIGINT": LongType(), "INT": IntegerType(), "STRING": StringType(), "DATE": DateType(), "TIMESTAMP": TimestampType()}


def spark_type(dtype: str) -> DataType:
    """Spark type of a contract SQL type name."""
    key = dtype.strip().upper()
    if key in _SIMPLE_TYPES:
        return _SIMPLE_TYPES[key]
    m = re.fullmatch(r"DECIMAL\(\s*(\d+)\s*,\s*(\d+)\s*\)", key)
    if m:
        return DecimalType(int(m.group(1)), int(m.group(2)))
    raise ValueError(f"unsupported contract type: {dtype}")


@dataclass(frozen=True)
class Column:
    source: str
    name: str
    dtype: str
    nullable: bool

    @property
    def spark_type(self) -> DataType:
        return spark_type(self.dtype)


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]
    primary_key: tuple[str, ...]

    def __post_init__(self) -> None:
        names = [c.name for c in self.columns]
        if len(set(names)) != len(names):
            raise ValueError(f"{self.name}: repeated target column")
        missing = set(self.primary_key) - set(names)
        if missing:
            raise ValueError(f"{self.name}: primary key not in columns: {sorted(missing)}")

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def sources(self) -> list[str]:
        return [c.source for c in self.columns]

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.columns if not c.nullable]

    def column(self, name: str) -> Column:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(f"{self.name}.{name}")

    def struct(self, with_nullability: bool = True) -> StructType:
        return StructType(
            [
                StructField(c.name, c.spark_type, c.nullable if with_nullability else True)
                for c in self.columns
            ]
        )

    def ddl(self, not_null: bool = True) -> str:
        return ", ".join(
            f"`{c.name}` {c.dtype}" + ("" if c.nullable or not not_null else " NOT NULL")
            for c in self.columns
        )


@dataclass(frozen=True)
class ForeignKey:
    child: str
    keys: tuple[str, ...]
    parent: str

    @property
    def rule_name(self) -> str:
        return f"fk_{self.parent}_{'_'.join(self.keys)}"


@dataclass(frozen=True)
class Contract:
    tables: tuple[Table, ...]
    foreign_keys: tuple[ForeignKey, ...] = field(default=())

    def __post_init__(self) -> None:
        by_name = {t.name: t for t in self.tables}
        for fk in self.foreign_keys:
            child, parent = by_name.get(fk.child), by_name.get(fk.parent)
            if child is None or parent is None:
                raise ValueError(f"{fk.rule_name}: unknown table")
            if tuple(fk.keys) != tuple(parent.primary_key):
                raise ValueError(f"{fk.child}.{fk.rule_name}: key must be the parent's whole primary key")
            for key in fk.keys:
                if child.column(key).dtype != parent.column(key).dtype:
                    raise ValueError(f"{fk.child}.{fk.rule_name}: type of {key} differs from parent")

    @property
    def table_names(self) -> list[str]:
        return [t.name for t in self.tables]

    def table(self, name: str) -> Table:
        for t in self.tables:
            if t.name == name:
                return t
        raise KeyError(name)

    def foreign_keys_of(self, child: str) -> list[ForeignKey]:
        return [fk for fk in self.foreign_keys if fk.child == child]

    @property
    def column_count(self) -> int:
        return sum(len(t.columns) for t in self.tables)

    def restricted_to(self, available: Mapping[str, Iterable[str]]) -> Contract:
        """Keep the tables in ``available`` and, within them, the columns whose
        source column is present. Keys must survive; foreign keys whose tables
        are both kept are retained."""
        tables = []
        for t in self.tables:
            if t.name not in available:
                continue
            present = set(available[t.name])
            cols = tuple(c for c in t.columns if c.source in present)
            kept = {c.name for c in cols}
            if not set(t.primary_key) <= kept:
                raise ValueError(f"{t.name}: source lacks primary key columns")
            tables.append(Table(t.name, cols, t.primary_key))
        names = {t.name for t in tables}
        fks = tuple(fk for fk in self.foreign_keys if fk.child in names and fk.parent in names)
        return Contract(tuple(tables), fks)


def _table(name: str, primary_key: Sequence[str], rows: Sequence[tuple[str, str, str, bool]]) -> Table:
    return Table(name, tuple(Column(*row) for row in rows), tuple(primary_key))


# ---------------------------------------------------------------------------
# The Silver delivery contract. Per table, in column order:
# (source column, Silver column, SQL type, nullable). These names, types,
# nullability flags, primary keys and foreign keys must stay exactly as listed.
# ---------------------------------------------------------------------------
TPCH_CONTRACT = Contract(
    tables=(
        _table("region", ["region_key"], [
            ("r_regionkey", "region_key", "BIGINT", False),
            ("r_name", "name", "STRING", False),
            ("r_comment", "comment", "STRING", True),
        ]),
        _table("nation", ["nation_key"], [
            ("n_nationkey", "nation_key", "BIGINT", False),
            ("n_name", "name", "STRING", False),
            ("n_regionkey", "region_key", "BIGINT", False),
            ("n_comment", "comment", "STRING", True),
        ]),
        _table("supplier", ["supp_key"], [
            ("s_suppkey", "supp_key", "BIGINT", False),
            ("s_name", "name", "STRING", False),
            ("s_address", "address", "STRING", False),
            ("s_nationkey", "nation_key", "BIGINT", False),
            ("s_phone", "phone", "STRING", False),
            ("s_acctbal", "acct_balance", "DECIMAL(18,2)", False),
            ("s_comment", "comment", "STRING", True),
        ]),
        _table("customer", ["cust_key"], [
            ("c_custkey", "cust_key", "BIGINT", False),
            ("c_name", "name", "STRING", False),
            ("c_address", "address", "STRING", False),
            ("c_nationkey", "nation_key", "BIGINT", False),
            ("c_phone", "phone", "STRING", False),
            ("c_acctbal", "acct_balance", "DECIMAL(18,2)", False),
            ("c_mktsegment", "market_segment", "STRING", False),
            ("c_comment", "comment", "STRING", True),
        ]),
        _table("part", ["part_key"], [
            ("p_partkey", "part_key", "BIGINT", False),
            ("p_name", "name", "STRING", False),
            ("p_mfgr", "manufacturer", "STRING", False),
            ("p_brand", "brand", "STRING", False),
            ("p_type", "type", "STRING", False),
            ("p_size", "size", "INT", False),
            ("p_container", "container", "STRING", False),
            ("p_retailprice", "retail_price", "DECIMAL(18,2)", False),
            ("p_comment", "comment", "STRING", True),
        ]),
        _table("partsupp", ["part_key", "supp_key"], [
            ("ps_partkey", "part_key", "BIGINT", False),
            ("ps_suppkey", "supp_key", "BIGINT", False),
            ("ps_availqty", "avail_quantity", "INT", False),
            ("ps_supplycost", "supply_cost", "DECIMAL(18,2)", False),
            ("ps_comment", "comment", "STRING", True),
        ]),
        _table("orders", ["order_key"], [
            ("o_orderkey", "order_key", "BIGINT", False),
            ("o_custkey", "cust_key", "BIGINT", False),
            ("o_orderstatus", "order_status", "STRING", False),
            ("o_totalprice", "total_price", "DECIMAL(18,2)", False),
            ("o_orderdate", "order_date", "DATE", False),
            ("o_orderpriority", "order_priority", "STRING", False),
            ("o_clerk", "clerk", "STRING", False),
            ("o_shippriority", "ship_priority", "INT", False),
            ("o_comment", "comment", "STRING", True),
        ]),
        _table("lineitem", ["order_key", "line_number"], [
            ("l_orderkey", "order_key", "BIGINT", False),
            ("l_partkey", "part_key", "BIGINT", False),
            ("l_suppkey", "supp_key", "BIGINT", False),
            ("l_linenumber", "line_number", "INT", False),
            ("l_quantity", "quantity", "DECIMAL(18,2)", False),
            ("l_extendedprice", "extended_price", "DECIMAL(18,2)", False),
            ("l_discount", "discount", "DECIMAL(18,2)", False),
            ("l_tax", "tax", "DECIMAL(18,2)", False),
            ("l_returnflag", "return_flag", "STRING", False),
            ("l_linestatus", "line_status", "STRING", False),
            ("l_shipdate", "ship_date", "DATE", False),
            ("l_commitdate", "commit_date", "DATE", False),
            ("l_receiptdate", "receipt_date", "DATE", False),
            ("l_shipinstruct", "ship_instruct", "STRING", True),
            ("l_shipmode", "ship_mode", "STRING", False),
            ("l_comment", "comment", "STRING", True),
        ]),
    ),
    foreign_keys=(
        ForeignKey("nation", ("region_key",), "region"),
        ForeignKey("supplier", ("nation_key",), "nation"),
        ForeignKey("customer", ("nation_key",), "nation"),
        ForeignKey("partsupp", ("part_key",), "part"),
        ForeignKey("partsupp", ("supp_key",), "supplier"),
        ForeignKey("orders", ("cust_key",), "customer"),
        ForeignKey("lineitem", ("order_key",), "orders"),
        ForeignKey("lineitem", ("part_key", "supp_key"), "partsupp"),
        ForeignKey("lineitem", ("part_key",), "part"),
        ForeignKey("lineitem", ("supp_key",), "supplier"),
    ),
)

# Fixed value: allowed order statuses (checked by the orders.order_status rule).
ORDER_STATUSES = ("O", "F", "P")

TPCH_TABLES = tuple(TPCH_CONTRACT.table_names)
