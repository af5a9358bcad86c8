"""Exact dedup by progressive refinement, DataFrame functions only.

Rows are grouped by the length of the normalised text, then (rows whose
length occurs more than once) by a hash of its first characters, and only
rows that still share both have their whole content hashed (SHA-256).
Each round aggregates narrow keys with map-side combine and keeps rows by a
semi join with the keys that occur more than once: a group that holds a third
of all rows is one row per map task in the aggregate and the stream side of a
join that AQE can split. No window, no collected group, no text in a shuffle.

The surviving (length, prefix hash) keys reach the content scan as a filter
of fixed size (``staging.maybe_among``, 128 KiB): a row without its bit
is not read further. At any input size false hits only cost a hash; the last
grouping decides.

Defined cases: null text counts as empty; whitespace runs
``[\\x20\\x09-\\x0D]+`` count as one space; of equal texts the smallest id
stays (a null id only if all are null); repeated rows with one id are members
of one group and each returns a row; an empty table gives an empty result;
other columns are never touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.staging import keep_rows, maybe_among, read, stage

NAME = "op6_exact_dedup"
PREFIX_CHARS = 64
SPACE = r"[\x20\x09-\x0D]+"

ORACLE_SQL = """
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS sha FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY sha) AS keep_id,
       count(*) OVER (PARTITION BY sha) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY sha) AS kept,
       sha AS text_sha256
FROM t
"""


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    norm = df.select(F.col(id_col).alias("__id"), normalised(F.col(text_col)).alias("__t"))
    return norm.withColumn("__len", F.length("__t")).withColumn(
        "__pre", F.xxhash64(F.substring("__t", 1, PREFIX_CHARS))
    )


def _often(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select(*keys)


def repeated_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every member of a group of at least two equal texts, as
    ``(__id, __sha)``: the rows that survive all three rounds' keys."""
    keys = stage(_keyed(df, id_col, text_col).select("__len", "__pre"), "dedup-keys")
    by_length = keys.join(_often(keys, ["__len"]), "__len", "left_semi")
    survivors = _often(by_length, ["__len", "__pre"]).select(F.xxhash64("__len", "__pre").alias("__key"))
    survivors = stage(survivors, "dedup-survivors")
    again = _keyed(df, id_col, text_col)
    again = again.filter(maybe_among(survivors, "__key", F.xxhash64("__len", "__pre")))
    read_again = again.select("__id", F.sha2("__t", 256).alias("__sha"))
    return stage(read_again, "dedup-hashes")


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of at least two equal texts: ``(__sha, __keep, __size)``."""
    return _groups(repeated_texts(df, id_col, text_col))


def _groups(hashes: DataFrame) -> DataFrame:
    return (
        hashes.groupBy("__sha")
        .agg(F.min("__id").alias("__keep"), F.count(F.lit(1)).alias("__size"))
        .filter("__size > 1")
    )


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with one row of each text: one of those with the smallest id.
    Rows are decided by id and text hash, as an id may have several texts."""
    hashes = repeated_texts(df, id_col, text_col)
    members = hashes.join(_groups(hashes), "__sha")
    verdict = members.select("__id", F.col("__sha").alias("__key"), F.col("__id").eqNullSafe(F.col("__keep")).alias("__kept")).distinct()
    return keep_rows(df, id_col, F.sha2(normalised(F.col(text_col)), 256), stage(verdict, "dedup-verdict"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    groups = stage(exact_groups(docs), "dedup-groups")
    rows = docs.select("doc_id", F.sha2(normalised(F.col("text")), 256).alias("text_sha256"))
    return rows.join(groups, rows["text_sha256"] == groups["__sha"], "left").select(
        "doc_id",
        F.coalesce("__keep", "doc_id").alias("keep_id"),
        F.coalesce("__size", F.lit(1).cast("long")).alias("group_size"),
        F.col("doc_id").eqNullSafe(F.coalesce("__keep", "doc_id")).alias("kept"),
        "text_sha256",
    )
