"""Toxicity by compression distance.

Two zstandard dictionaries are made from labelled text: an ordinary one
trained on windows of ordinary texts, and a toxic one that holds the same
bytes and, nearest to the window, the words that toxic texts have far more
often than ordinary ones (by the share of texts, per word beginning). Texts
are cut into overlapping windows; a window's distance is what the toxic
dictionary saves over the ordinary one. A logistic model over a text's
distances (largest, mean, shares and counts above each byte) is fitted on a
third of the labelled rows, whose words the dictionaries have not seen, and
shifted so that the threshold that separates them best lies at ``THRESHOLD``.

Training reads at most about ``TOXIC_ROWS`` and ``ORDINARY_ROWS`` labelled
rows, chosen by a hash of the id (whole texts); word counts are taken in
Spark, and only ``TOXIC_WORDS`` words, ``WINDOW_SAMPLES`` windows and one
short row of numbers per training text reach the driver.

Defined cases: null or empty text is one empty window; without labels of both
kinds every score is 0; repeated labels count as their largest; repeated rows
get repeated scores; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.op5_language_spans import held_out
from tidemark.llm.staging import maybe_among, read, stage

NAME = "op9_toxicity"
ORACLE_SQL = None
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
TOXIC_ROWS, ORDINARY_ROWS = 3000, 9000
WINDOW, STRIDE, LEVEL = 64, 32, 9
BASE_BYTES, WINDOW_SAMPLES, SAMPLE_BYTES = 24_000, 8000, 256
TOXIC_WORDS, BEGINNING, LEAST_TEXTS, LEAST_RATIO = 100, 4, 3, 30.0
STEPS = 5
BLANK = re.compile(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]+")
BLANK_SQL = r"[\x00-\x40\x5b-\x60\x7b-\x7f]+"
N_FEATURES = 4 + 2 * STEPS


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    centre: tuple
    scale: tuple
    weights: tuple  # the last is the intercept; empty: no model


def windows(text: str | None) -> list[bytes]:
    data = b" " + BLANK.sub(b" ", (text or "").lower().encode()) + b" "
    return [data[i : i + WINDOW] for i in range(0, max(1, len(data) - STRIDE), STRIDE)]


@cache
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    known = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    how = zstandard.ZstdCompressionParameters.from_level(LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False, min_match=3)
    return zstandard.ZstdCompressor(dict_data=known, compression_params=how)


def distances(text: str | None, ordinary: bytes, toxic: bytes) -> np.ndarray:
    """Bytes that the toxic dictionary saves, by window."""
    a, b = _compressor(ordinary).compress, _compressor(toxic).compress
    return np.array([len(a(w)) - len(b(w)) for w in windows(text)])


def features(d: np.ndarray) -> list[float]:
    top = np.sort(d)[::-1]
    over = [int((d >= k).sum()) for k in range(1, STEPS + 1)]
    return [float(top[0]), float(top[:3].mean()), float(d.mean()), *(n / len(d) for n in over), *np.log1p(over).tolist(), float(np.log(len(d)))]


def _measured(rows: DataFrame, ordinary: bytes, toxic: bytes, keep: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(distances(t.as_py(), ordinary, toxic)) for t in batch.column("text")]
            yield pa.record_batch([batch.column(keep), pa.array(x, pa.list_(pa.float64()))], [keep, "x"])

    return rows.select(keep, "text").mapInArrow(run, f"{keep} long, x array<double>")


def _toxic_words(rows: DataFrame, n_toxic: int, n_ordinary: int) -> list[str]:
    """The most frequent words of toxic texts whose beginning is rare in others."""
    plain = F.trim(F.regexp_replace(F.lower("text"), BLANK_SQL, " "))
    each = rows.select("toxic", F.explode(F.array_distinct(F.split(plain, " "))).alias("word")).filter("word != ''")
    counts = each.groupBy("word").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("o"))
    counts = stage(counts.filter("t > 0 OR o > 0").withColumn("start", F.substring("word", 1, BEGINNING)), "toxic-words")
    starts = counts.groupBy("start").agg(F.sum("t").alias("st"), F.sum("o").alias("so"))
    ratio = (F.col("st") / n_toxic) / ((F.col("so") + 0.5) / n_ordinary)
    telling = starts.filter((F.col("st") >= LEAST_TEXTS) & (ratio >= LEAST_RATIO)).select("start")
    best = counts.join(telling, "start").filter("t > 0").orderBy(F.desc("t"), "word").limit(TOXIC_WORDS)
    return [r["word"] for r in best.collect()]


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    centre, scale = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([(x - centre) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        curve = (z * (weight * p * (1 - p))[:, None]).T @ z + np.eye(len(w))
        w += np.linalg.solve(curve, z.T @ (weight * (y - p)) - w)
    value = z @ w
    order = np.argsort(-value, kind="stable")
    hit, seen = np.cumsum(weight[order] * y[order]), np.cumsum(weight[order])
    f1 = 2 * hit / (seen + (weight * y).sum())
    k = int(f1.argmax())
    cut = (value[order[k]] + value[order[min(k + 1, len(order) - 1)]]) / 2
    w[-1] += np.log(THRESHOLD / (1 - THRESHOLD)) - cut
    return centre, scale, w


def _sizes(labels: DataFrame) -> dict[int, int]:
    return {r["toxic"]: r["n"] for r in labels.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows


def choose(labels: DataFrame) -> tuple[DataFrame, dict[int, float]]:
    """About ``TOXIC_ROWS`` and ``ORDINARY_ROWS`` of the labels (id, toxic),
    and the share of each kind that was taken."""
    sizes = _sizes(labels)
    share = {k: min(1.0, most / max(1, sizes.get(k, 0))) for k, most in ((1, TOXIC_ROWS), (0, ORDINARY_ROWS))}
    chance = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    some = labels.filter(chance < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]))
    return stage(some.select("id", "toxic"), "toxic-labels"), share


def train(some: DataFrame, share: dict[int, float] | None = None) -> Model:
    """``some`` is (id, text, toxic 0/1), the rows to learn from; ``share``
    says which part of each kind they are."""
    none = Model(b"", b"", (), (), ())
    share = share or {0: 1.0, 1: 1.0}
    some = stage(some.select("id", "text", "toxic"), "toxic-sample")
    part = F.pmod(F.xxhash64("id", F.lit("part")), F.lit(3))
    own, other = some.filter(part != 0), some.filter(part == 0)
    n, m = _sizes(own), _sizes(other)
    if not min(n.get(0, 0), n.get(1, 0), m.get(0, 0), m.get(1, 0)):  # too few to tell them apart
        own = other = some
        n = _sizes(some)
    if not n.get(0) or not n.get(1):
        return none
    place = F.pmod(F.xxhash64("id"), F.greatest(F.length("text") - SAMPLE_BYTES, F.lit(1))).cast("int") + 1
    pieces = own.filter("toxic = 0 AND text != ''").orderBy(F.xxhash64("id")).limit(WINDOW_SAMPLES)
    pieces = pieces.select(F.substring("text", place, F.lit(SAMPLE_BYTES)).alias("s")).collect()
    samples = [BLANK.sub(b" ", r["s"].lower().encode()) for r in pieces]
    try:
        ordinary = zstandard.train_dictionary(BASE_BYTES + 8192, samples).as_bytes()[-BASE_BYTES:]
    except zstandard.ZstdError:  # too few samples: the samples themselves
        ordinary = b" ".join(samples)[-BASE_BYTES:] or b" "
    words = _toxic_words(own, n[1], n[0])
    toxic = b"".join(b" " + w.encode() + b" " for w in reversed(words)) + ordinary
    got = _measured(other.select(F.col("toxic").cast("long").alias("toxic"), "text"), ordinary, toxic, "toxic").toPandas()
    x, y = np.array(got["x"].tolist()), got["toxic"].to_numpy(float)
    centre, scale, w = _fit(x, y, np.where(y == 1, 1 / share[1], 1 / share[0]))
    return Model(ordinary, toxic, tuple(centre), tuple(scale), tuple(w))


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score, predicted, worst)``; ``worst`` is the largest distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            p, worst = np.zeros(n), np.zeros(n, np.int64)
            if model.weights and n:
                x = np.array([features(distances(t.as_py(), model.ordinary, model.toxic)) for t in batch.column("text")])
                worst = x[:, 0].astype(np.int64)
                z = (x - np.array(model.centre)) / np.array(model.scale)
                p = 1 / (1 + np.exp(-np.clip(z @ np.array(model.weights[:-1]) + model.weights[-1], -30, 30)))
            yield pa.record_batch([batch.column("doc_id"), pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32)), pa.array(worst)], ["doc_id", "score", "predicted", "worst"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, predicted int, worst long")


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the labelled rows of ``documents`` that are not held out."""
    known = labels.filter("toxic IS NOT NULL").groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").cast("int").alias("toxic"))
    some, share = choose(known.filter(~held_out(F.col("id"), FOLDS, HELD_OUT)))
    texts = docs.select(F.col("doc_id").alias("id"), "text").filter(maybe_among(some, "id", F.col("id")))
    return train(texts.join(some, "id"), share)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, read(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"), "score", "predicted", "worst")
