"""Copy verification: schema signature and exact multiset comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def schema_signature(df: DataFrame) -> list[tuple[str, str]]:
    """Ordered (name, type) pairs; nullability is ignored."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def _positional(copy: DataFrame, like: DataFrame) -> DataFrame:
    """Rename the copy's columns to the source's names, by position."""
    return copy.toDF(*like.columns)


def multiset_delta(source: DataFrame, copy: DataFrame) -> DataFrame:
    """One row per distinct row whose multiplicity differs between the two
    frames (compared by position; nulls equal, duplicates counted), with
    ``source_count`` and ``copy_count``.

    One shuffle on all columns over the union of both sides, with map-side
    partial aggregation: a row repeated a billion times is one row per map
    task in the exchange."""
    cols = source.columns
    tagged = source.select(*cols, F.lit(1).alias("__s"), F.lit(0).alias("__c")).unionAll(
        _positional(copy, source).select(*cols, F.lit(0).alias("__s"), F.lit(1).alias("__c"))
    )
    return (
        tagged.groupBy(*cols)
        .agg(F.sum("__s").alias("source_count"), F.sum("__c").alias("copy_count"))
        .filter(F.col("source_count") != F.col("copy_count"))
    )


def multiset_difference(source: DataFrame, copy: DataFrame) -> DataFrame:
    """Every surplus row of either side as often as it is surplus, tagged
    ``_side`` = 'source_only' | 'copy_only'. Rows are repeated after the one
    aggregate of :func:`multiset_delta`, where they are."""
    surplus = F.col("source_count") - F.col("copy_count")
    side = F.when(surplus > 0, "source_only").otherwise("copy_only")
    rows = multiset_delta(source, copy).withColumns({"_side": side, "__copy": F.explode(F.sequence(F.lit(1).cast("long"), F.abs(surplus)))})
    return rows.drop("source_count", "copy_count", "__copy")


def contents_equal(source: DataFrame, copy: DataFrame) -> bool:
    """Multiset equality of whole rows in one aggregate job."""
    return multiset_delta(source, copy).isEmpty()


def verification_summary(source: DataFrame, copy: DataFrame) -> DataFrame:
    """One row: rows of both sides, distinct rows whose multiplicity differs,
    and whether names, types and contents agree."""
    delta = multiset_delta(source, copy).agg(F.count(F.lit(1)).alias("n")).scalar()
    rows = source.agg(F.count(F.lit(1)).alias("source_rows"))
    same = F.lit(schema_signature(source) == schema_signature(copy))
    out = rows.withColumn("copy_rows", copy.agg(F.count(F.lit(1))).scalar()).withColumn("differing_rows", delta)
    return out.withColumn("equal", same & (F.col("differing_rows") == 0))
