"""Contract projection (Bronze → typed Silver) and the lossless-cast check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.contract import Table
from tidemark.functions.casts import _q, lossy_cast_sql
from tidemark.functions.errors import Rule, any_rule, error_array, tag_when


def _check_sources(bronze: DataFrame, table: Table) -> None:
    missing = set(table.sources) - set(bronze.columns)
    if missing:
        raise ValueError(f"{table.name}: the source lacks columns of the contract: {sorted(missing)}")


def transform_table(bronze: DataFrame, table: Table) -> DataFrame:
    """Select, rename and try_cast in contract order; extra columns drop out.

    A single projection over the scan: Catalyst prunes unused columns and
    pushes later filters below it.
    """
    _check_sources(bronze, table)
    return bronze.selectExpr(*[f"try_cast({_q(c.source)} AS {c.dtype}) AS {_q(c.name)}" for c in table.columns])


def lossy_tags(bronze: DataFrame, table: Table) -> list[Rule]:
    """One ``lossy_cast:<target>`` rule per contract column."""
    _check_sources(bronze, table)
    types = {f.name: f.dataType.simpleString() for f in bronze.schema.fields}
    return [
        tag_when(F.expr(lossy_cast_sql(c.source, types[c.source], c.dtype)), f"lossy_cast:{c.name}")
        for c in table.columns
    ]


def validate_lossless_casts(bronze: DataFrame, table: Table) -> DataFrame:
    """Raw Bronze rows whose non-null values fail or change under the cast,
    with ``_quality_errors`` listing ``lossy_cast:<column>`` per bad column.
    Null input is never a cast violation (that is the required-value rule)."""
    rules = lossy_tags(bronze, table)
    return bronze.filter(any_rule(rules)).withColumn("_quality_errors", error_array(rules))
