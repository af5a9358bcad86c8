"""Adapter from the driver test tables to Bronze-shaped TPC-H sources.

The driver tables lack the delivery columns the marts need (commit date,
receipt date, ship mode) and the ``partsupp`` table. They are derived here
deterministically, row-locally, with integer arithmetic that any SQL engine
reproduces exactly (the DuckDB oracle inlines the same expressions):

* ``l_commitdate``  = ship date + ((part*31 + supp*17 + line*7) % 91 - 42) days
* ``l_receiptdate`` = ship date + ((order*13 + part*5 + line*11) % 30 + 1) days
* ``l_shipmode``    = SHIP_MODES[(order + part*3 + line) % 7]
* ``partsupp``      = the (part, supplier) pairs seen in lineitem, except the
  pairs with (part + supp) % 10 = 0, which model discontinued supply contracts
  so that the pair foreign-key check has real violations to find.

Everything stays a lazy, partition-parallel plan: the line columns are a
projection over the scan (no shuffle); ``partsupp`` is one aggregation on the
pair key. Nearly every line has a pair of its own, so the lines are dealt to
the tasks before the partial aggregation: a scan task may hold a whole file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.lazy import LazyMap
from tidemark.sources.tables import SOURCE_TABLES, read_table

# Ship modes in index order for the derived l_shipmode.
SHIP_MODES = ("AIR", "FOB", "MAIL", "RAIL", "REG AIR", "SHIP", "TRUCK")


def with_delivery_columns(lineitem: DataFrame) -> DataFrame:
    """Append l_commitdate, l_receiptdate (DATE) and l_shipmode: one
    projection over the scan, written as SQL expressions (one plan call)."""
    ship = "CAST(l_shipdate AS DATE)"
    modes = ", ".join(f"'{m}'" for m in SHIP_MODES)
    return lineitem.selectExpr(
        "*",
        f"date_add({ship}, CAST((l_partkey * 31 + l_suppkey * 17 + l_linenumber * 7) % 91 - 42 AS INT)) AS l_commitdate",
        f"date_add({ship}, CAST((l_orderkey * 13 + l_partkey * 5 + l_linenumber * 11) % 30 + 1 AS INT)) AS l_receiptdate",
        f"element_at(array({modes}), CAST((l_orderkey + l_partkey * 3 + l_linenumber) % 7 AS INT) + 1) AS l_shipmode",
    )


def derive_partsupp(lineitem: DataFrame) -> DataFrame:
    dealt = lineitem.repartition("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber")
    return (
        dealt.filter((F.col("l_partkey") + F.col("l_suppkey")) % 10 != 0)
        .groupBy(F.col("l_partkey").alias("ps_partkey"), F.col("l_suppkey").alias("ps_suppkey"))
        .agg(
            F.sum("l_quantity").cast("bigint").alias("ps_availqty"),
            F.min("l_extendedprice").alias("ps_supplycost"),
        )
    )


def bronze_sources(spark: SparkSession, sf_dir: str) -> LazyMap[DataFrame]:
    """All eight TPC-H sources, Bronze-shaped, from a driver data directory.
    Frames are built on first access, so a query pays plan construction only
    for the tables it reads."""
    raw = LazyMap({name: (lambda n=name: read_table(spark, sf_dir, n)) for name in SOURCE_TABLES})
    builders = {name: (lambda n=name: raw[n]) for name in ("region", "nation", "supplier", "customer", "part", "orders")}
    builders["partsupp"] = lambda: derive_partsupp(raw["lineitem"])
    builders["lineitem"] = lambda: with_delivery_columns(raw["lineitem"])
    order = ("region", "nation", "supplier", "customer", "part", "partsupp", "orders", "lineitem")
    return LazyMap({name: builders[name] for name in order})
