"""Intermediate results in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import checkpoint_dir

#: 64-bit words of a membership filter: 128 KiB, whatever the input.
FILTER_WORDS = 1 << 14
#: The most words of one whose number of keys is told, and its bits a key.
MOST_FILTER_WORDS, FILTER_BITS = 1 << 17, 8


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under ``spark.checkpoint.dir`` and read it back: computed
    once, no lineage, survives lost executors. Spark knows the written size,
    so a later join broadcasts the table only when its files are below
    ``spark.sql.autoBroadcastJoinThreshold``."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/staged/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def maybe_among(keys: DataFrame, key: str, value: Column, count: int = 0) -> Column:
    """True for every ``value`` that occurs in ``keys[key]`` and for some
    others: a bit per hashed key in one array of ``FILTER_WORDS`` longs, or up
    to ``MOST_FILTER_WORDS`` if there are said to be ``count`` keys. For
    filtering a wide scan before an exact step; its size is bounded, so with
    very many keys it only lets more rows pass."""
    size = min(MOST_FILTER_WORDS, max(FILTER_WORDS, 1 << (count * FILTER_BITS // 64).bit_length()))
    bits = size * 64
    slots = keys.select(F.pmod(F.xxhash64(key), F.lit(bits)).alias("s")).distinct()
    words = slots.groupBy((F.col("s") / 64).cast("long").alias("id")).agg(
        F.expr("bit_or(shiftleft(1L, cast(pmod(s, 64) AS int))) AS w")
    )
    dense = keys.sparkSession.range(size).join(words, "id", "left")
    pairs = F.array_sort(F.collect_list(F.struct("id", F.coalesce("w", F.lit(0).cast("long")).alias("w"))))
    array = dense.agg(F.transform(pairs, lambda p: p["w"]).alias("words")).scalar()
    slot = F.pmod(F.xxhash64(value), F.lit(bits))
    return F.getbit(F.element_at(array, (slot / 64).cast("int") + 1), F.pmod(slot, F.lit(64)).cast("int")) == 1


def keep_rows(df: DataFrame, id_col: str, key: Column, verdict: DataFrame) -> DataFrame:
    """``df`` without the rows that lose in ``verdict``, a row ``(__id, __key,
    __kept)`` per decided id and key: rows that it does not name stay, and of
    the rows with a kept id and key exactly one. Only rows whose id may be
    named take part in the join; the others are not shuffled."""
    among = maybe_among(verdict, "__id", F.col(id_col))
    asked = df.filter(among).withColumn("__row_key", key)
    asked = asked.join(verdict, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__row_key") == F.col("__key")), "left")
    free = asked.filter("__key IS NULL").select(*df.columns)
    kept = asked.filter("__kept").dropDuplicates(["__id", "__key"]).select(*df.columns)
    return df.filter(~among).unionByName(free).unionByName(kept)
