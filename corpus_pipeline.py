"""From raw documents to token ids: five stages over a table of documents.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor
kept and returns a table with the columns of ``documents`` (the last one:
token ids). ``run`` writes each result as Parquet into the shared folder and
reads it back as the next stage's input, so a lost executor never costs more
than the stage it is lost in.

Defined cases are those of the operators: null and wordless texts have no
language and leave in the first stage; an empty table passes all stages. Ids
may be null or repeated: stages decide by id and a hash of the row's content.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import op1_source_mix, op2_ngram_join, op3_byte_bpe, op5_language_spans, op6_exact_dedup
from tidemark.llm.staging import keep_rows, maybe_among, read, stage

#: Small sources are repeated at most so many times as often as large ones.
MAX_REPETITION = 2.0
#: Bytes of an Arrow batch unless the session sets its own limit: executors
#: and Python workers hold a few batches a task, of rows of any length.
ARROW_BYTES = 4 << 20
ARROW_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
TOKENIZER = "byte_bpe_multi_50k.tiktoken"

#: No stage's model, groups or merges have an SQL form as a whole; tests/llm
#: holds every stage against a brute-force version.
ORACLE_SQL = None


def _bounded(spark: SparkSession) -> None:
    if ARROW_LIMIT not in spark.conf.getAll:
        spark.conf.set(ARROW_LIMIT, str(ARROW_BYTES))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without evidence of a learned language."""
    _bounded(spark)
    return op5_language_spans.keep_known(docs, op5_language_spans.fit(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document with the smallest id stays."""
    return op6_exact_dedup.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies one document with the smallest id
    stays (one without an id only if none has one)."""
    _bounded(spark)
    key = F.md5(F.coalesce("text", F.lit("")))
    members = op2_ngram_join.ngram_components(docs.withColumn("__key", key), key_col="__key")
    row = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "key")
    members = stage(members.filter("root IS NOT NULL").select("root", row.alias("row")), "pipeline-near-members")
    best = members.groupBy("root").agg(F.min("row").alias("best"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    verdict = members.join(best, "root").select(F.col("row.doc_id").alias("__id"), F.col("row.key").alias("__key"), F.expr("row <=> best").alias("__kept"))
    return keep_rows(docs, "doc_id", key, stage(verdict.distinct(), "pipeline-near"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, small sources again up to the limit, in
    the order of the mixture's blocks. Rows are met again by a hash of all
    their columns; equal rows are one row, placed as often as they occur."""
    row = F.sha2(F.to_json(F.struct(*docs.columns)), 256)
    placed = op1_source_mix.source_mix(docs, None, MAX_REPETITION, carried=(row.alias("__placed"),))
    placed = stage(placed.select("__placed", "pass", F.col("block").alias("__block"), F.col("order_key").alias("__key")), "pipeline-mix")
    often = placed.filter("pass = 0").groupBy("__placed").count().filter("count > 1").select("__placed")
    repeated = maybe_among(stage(often, "pipeline-often"), "__placed", F.col("__row"))
    keyed = docs.withColumn("__row", row)
    keyed = keyed.filter(~repeated).unionByName(keyed.filter(repeated).dropDuplicates(["__row"]))
    mixed = keyed.join(placed.drop("pass"), F.col("__row") == F.col("__placed"))
    mixed = mixed.repartitionByRange("__block", "__key").sortWithinPartitions("__block", "__key")
    return mixed.select(*docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, ids)`` of every row."""
    _bounded(spark)
    encoded = op3_byte_bpe.encode(docs, public_tokenizers.path(TOKENIZER))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("byte_bpe", byte_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
