"""Language of texts and of the spans in them.

Words are runs of letters. A word's script (ranges of code points) narrows its
candidate languages to those that use the script; its score for each is the
sum of log-probabilities of its byte 2- to 4-grams. A Viterbi pass per text,
with a penalty for every change of language, labels the words; runs of one
label are the spans, and the label with most bytes is the text's language.

``train`` counts hashed n-grams per language with Spark over at most about
``TRAIN_ROWS`` labelled rows of each (chosen by a hash of the id, whole
texts). The model is a table of ``BUCKETS`` x languages. ``predict`` reads
whole texts in batches of bounded bytes; all texts of a batch advance through
the Viterbi recursion together.

Defined cases: null or letterless text is ``und`` with score 0 and no spans;
without any labelled row every text is ``und``; ties go to the language first
in order; repeated rows get repeated results; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import textops
from tidemark.llm.staging import read

NAME = "op5_language_spans"
ORACLE_SQL = None
FOLDS = 5
TRAIN_ROWS = 3000
BUCKETS = 1 << 16
SWITCH_PENALTY = 12.0
SCRIPT_SHARE = 0.01
SLICE_BYTES = 1 << 18
BATCH_BYTES, KEEP_BYTES = 12 << 20, 4 << 20
#: First code points of ranges and the script each one begins (fixed values).
SCRIPTS = [
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"),
    (0x0780, "other"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "other"), (0x0B80, "Tamil"), (0x0C00, "other"),
    (0x0E00, "Thai"), (0x0E80, "other"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "other"),
    (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "other"), (0x3040, "Kana"), (0x3100, "other"), (0x3400, "Han"),
    (0xA000, "other"), (0xAC00, "Hangul"), (0xD7B0, "other"), (0xF900, "Han"), (0xFB00, "other"), (0x20000, "Han"), (0x32000, "other"),
]
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})


def _mapped() -> np.ndarray:
    """Letters folded to lower case (ASCII); separators are blanks."""
    table = np.full(256, 0x20, np.uint32)
    for b in range(256):
        if chr(b).isascii() and chr(b).isalpha():
            table[b] = ord(chr(b).lower())
        elif b >= 0x80:
            table[b] = b
    return table


MAPPED = _mapped()


@dataclass
class Words:
    """Words of a batch: begins, ends (bytes), the text of each, n-gram
    buckets by word (``grams`` from ``first``) and scripts."""

    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    grams: np.ndarray
    first: np.ndarray
    script: np.ndarray


def _hash(value: np.ndarray, order: int) -> np.ndarray:
    mixed = (value + np.uint32(order * 0x1000193)) * np.uint32(0x9E3779B1)
    return ((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x85EBCA77)) >> np.uint32(32 - (BUCKETS - 1).bit_length())


def read_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    blank = MAPPED[data] == 0x20
    folded = MAPPED[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    inside = ~blank
    begins = inside.copy()
    begins[1:] &= blank[:-1] | edge[1:-1]
    finish = inside.copy()
    finish[:-1] &= blank[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finish) + 1
    size = ends - starts
    first = np.concatenate([[0], np.cumsum(size + 1)])
    word = np.repeat(np.arange(len(starts)), size + 1)
    d = np.arange(first[-1]) - first[word]
    at = starts[word] + d
    pad = np.concatenate([np.full(3, 0x20, np.uint32), folded, np.full(1, 0x20, np.uint32)])
    b0 = np.where(d == size[word], np.uint32(0x20), pad[at + 3])
    b1 = np.where(d == 0, np.uint32(0x20), pad[at + 2])
    b2 = np.where(d <= 1, np.uint32(0x20), pad[at + 1])
    b3 = np.where(d <= 2, np.uint32(0x20), pad[at])
    two = b1 << np.uint32(8) | b0
    three = b2 << np.uint32(16) | two
    four = b3 << np.uint32(24) | three
    none = np.uint32(BUCKETS)  # a bucket that scores nothing
    grams = np.stack([_hash(two, 2), np.where(d >= 1, _hash(three, 3), none), np.where(d >= 2, _hash(four, 4), none)], 1)
    text = np.searchsorted(offsets, starts, "right") - 1
    return Words(starts, ends, text, grams, first, _script(data, starts))


def _script(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Script number of each word's first character."""
    script = np.full(len(starts), SCRIPT_NAMES.index("Latin"), np.uint8)
    high = np.flatnonzero(data[starts] >= 0xC0)
    if len(high):
        pad = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int64)
        at = starts[high]
        b, c1, c2, c3 = pad[at], *(pad[at + k] & 0x3F for k in (1, 2, 3))
        cp = np.where(b < 0xE0, (b & 0x1F) << 6 | c1, np.where(b < 0xF0, (b & 0x0F) << 12 | c1 << 6 | c2, (b & 0x07) << 18 | c1 << 12 | c2 << 6 | c3))
        number = np.array([SCRIPT_NAMES.index(name) for _, name in SCRIPTS], np.uint8)
        script[high] = number[np.searchsorted([c for c, _ in SCRIPTS], cp, "right") - 1]
    return script


# ---- model -----------------------------------------------------------------------


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # log-probability by bucket and language; the last row is 0
    allowed: np.ndarray  # by script and language

    def word_scores(self, words: Words) -> np.ndarray:
        each = self.table[words.grams[:, 0]] + self.table[words.grams[:, 1]] + self.table[words.grams[:, 2]]
        total = np.add.reduceat(each, words.first[:-1], axis=0) if len(words.starts) else each[:0]
        return np.where(self.allowed[words.script], total, np.float32(-1e9))


def held_out(id_col: Column, folds: int, remainder: int) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % folds == remainder


def train(rows: DataFrame, max_rows: int = TRAIN_ROWS) -> Model:
    """``rows`` is (id, text, lang), labelled. About ``max_rows`` rows of each
    language, chosen by a hash of the id."""
    rows = rows.filter("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per language
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((BUCKETS + 1, 0), np.float32), np.zeros((len(SCRIPT_NAMES), 0), bool))
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, max_rows / sizes[k]))])
    chance = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.filter(F.coalesce(chance < F.element_at(share, F.col("lang")), F.lit(True))).select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), BUCKETS + len(SCRIPT_NAMES)), np.int64)
        number = {name: i for i, name in enumerate(languages)}
        for batch in textops.slices(batches, "text", SLICE_BYTES):
            words = read_words(*textops.buffers(batch.column("text")))
            lang = np.array([number[x] for x in batch.column("lang").to_pylist()])
            of = lang[words.text]
            for i in np.unique(of):
                mine = words.grams[np.repeat(of == i, np.diff(words.first))].reshape(-1)
                total[i, :BUCKETS] += np.bincount(mine, minlength=BUCKETS + 1)[:BUCKETS]
                total[i, BUCKETS:] += np.bincount(words.script[of == i], minlength=len(SCRIPT_NAMES))
        i, bucket = np.nonzero(total)
        yield pa.record_batch([pa.array(i, pa.int32()), pa.array(bucket, pa.int32()), pa.array(total[i, bucket])], ["i", "b", "n"])

    counted = sample.mapInArrow(textops.freed(count), "i int, b int, n long").groupBy("i", "b").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros((len(languages), BUCKETS + len(SCRIPT_NAMES)))
    total[counted["i"], counted["b"]] = counted["n"]
    grams, scripts = total[:, :BUCKETS] + 0.1, total[:, BUCKETS:]
    table = np.log(grams / grams.sum(1, keepdims=True)).T
    used = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(1, keepdims=True), 1)
    allowed = used.T.copy()
    allowed[~allowed.any(1)] = True  # a script that no language uses says nothing
    return Model(languages, np.vstack([table, np.zeros((1, len(languages)))]).astype(np.float32), allowed)


def viterbi(scores: np.ndarray, sizes: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """The best label of every word; ``sizes`` words belong to each text.
    All texts take step t together."""
    n, k = scores.shape
    kind = np.min_scalar_type(max(k - 1, 0))
    labels = np.zeros(n, kind)
    if k < 2 or not n:
        return labels
    by_size = np.argsort(-sizes, kind="stable")
    first = (np.cumsum(sizes) - sizes)[by_size]
    sizes = sizes[by_size]
    longest = int(sizes[0])
    live = np.searchsorted(-sizes, -np.arange(longest), "left")  # texts with more than t words
    begin = np.concatenate([[0], np.cumsum(live)])
    order = np.empty(n, np.int64)  # words by step, then by text
    for t in range(longest):
        order[begin[t] : begin[t + 1]] = first[: live[t]] + t
    stepwise = scores[order]
    stay = np.ones((n, k), bool)
    source = np.zeros(n, kind)
    best = stepwise[: live[0]].copy()
    for t in range(1, longest):
        a, m = begin[t], live[t]
        now = best[:m]
        top = now.argmax(1)
        jump = now[np.arange(m), top] - np.float32(penalty)
        source[a : a + m] = top
        np.greater_equal(now, jump[:, None], out=stay[a : a + m])
        np.maximum(now, jump[:, None], out=now)
        now += stepwise[a : a + m]
    state = best.argmax(1).astype(kind)  # of each text's last word
    out = np.empty(n, kind)
    for t in range(longest - 1, -1, -1):
        a, m = begin[t], live[t]
        out[a : a + m] = state[:m]
        if t:
            keep = stay[a : a + m][np.arange(m), state[:m]]
            state[:m] = np.where(keep, state[:m], source[a : a + m])
    labels[order] = out
    return labels


OUT = "doc_id long, lang_pred string, score double, spans array<struct<lang:string,first_word:int,end_word:int>>"
SPANS = pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int32()), ("end_word", pa.int32())]))


def label(model: Model, batch: list[tuple[np.ndarray, np.ndarray]]) -> tuple[list[str], list[float], list[list[dict]], np.ndarray]:
    """Languages, scores and spans of the texts of some slices, and whether a
    text's words of some label are likelier in that language than n-grams
    drawn evenly from all buckets."""
    scores, sizes, weights, letters = [], [], [], []
    for data, offsets in batch:
        words = read_words(data, offsets)
        scores.append(model.word_scores(words))
        sizes.append(np.bincount(words.text, minlength=len(offsets) - 1))
        weights.append(words.ends - words.starts)
        kind, _ = textops.classes(data)
        seen = np.concatenate([[0], np.cumsum(kind == textops.LETTER)])
        letters.append(seen[offsets[1:]] > seen[offsets[:-1]])
    sizes, weights, letters = np.concatenate(sizes), np.concatenate(weights), np.concatenate(letters)
    k = len(model.languages)
    scores = np.concatenate(scores)
    labels = viterbi(scores, sizes)
    text = np.repeat(np.arange(len(sizes)), sizes)
    evident = np.zeros(len(sizes), bool)
    if k:
        above = scores[np.arange(len(labels)), labels] + 3 * weights * np.log(BUCKETS)  # a word of n bytes has 3 n n-grams
        evident = letters & (np.bincount(text * k + labels, above, minlength=len(sizes) * k).reshape(-1, k) > 0).any(1)
    share = np.bincount(text * max(k, 1) + labels, weights, minlength=len(sizes) * max(k, 1)).reshape(len(sizes), -1)
    best = share.argmax(1)
    score = share[np.arange(len(sizes)), best] / np.maximum(share.sum(1), 1)
    first = np.cumsum(sizes) - sizes
    turn = np.ones(len(labels), bool)
    turn[1:] = (labels[1:] != labels[:-1]) | (text[1:] != text[:-1])
    begins = np.flatnonzero(turn)
    ends = np.append(begins[1:], len(labels))
    spans: list[list[dict]] = [[] for _ in sizes]
    if k:
        for a, b in zip(begins.tolist(), ends.tolist()):
            i = int(text[a])
            if letters[i]:
                spans[i].append({"lang": model.languages[labels[a]], "first_word": a - int(first[i]), "end_word": b - int(first[i])})
    known = letters & (k > 0)
    return [model.languages[b] if ok else "und" for b, ok in zip(best, known)], np.where(known, score, 0.0).tolist(), spans, evident


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score, spans)``; spans number the text's words."""
    sent = df.sparkSession.sparkContext.broadcast(model)  # buckets x languages, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, size = [], [], 0

        def flush():
            langs, scores, spans, _ = label(sent.value, held)
            return pa.record_batch(
                [pa.array(ids, pa.int64()), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(spans, SPANS)],
                ["doc_id", "lang_pred", "score", "spans"],
            )

        for batch in textops.slices(batches, "text", SLICE_BYTES):
            held.append(textops.buffers(batch.column("text")))
            ids += batch.column("doc_id").to_pylist()
            size += len(held[-1][0])
            if size >= BATCH_BYTES:
                yield flush()
                ids, held, size = [], [], 0
        if held:
            yield flush()

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(textops.freed(run), OUT)


def keep_known(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` with evidence of a learned language, however many
    they mix; all columns as they are. Rows go that have no letter, or whose
    words fit every label given to them worse than evenly drawn n-grams."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textops.slices(batches, text_col, KEEP_BYTES):
            parts = [textops.buffers(b.column(text_col)) for b in textops.slices(iter([batch]), text_col, SLICE_BYTES)]
            yield batch.filter(pa.array(label(sent.value, parts)[3], pa.bool_()))

    return df.mapInArrow(textops.freed(run), df.schema)


def fit(docs: DataFrame) -> Model:
    """A model from the rows of ``documents`` that are not held out."""
    rows = docs.filter(~held_out(F.col("doc_id"), FOLDS, 0))
    return train(rows.select(F.col("doc_id").alias("id"), "text", "lang"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return predict(docs, fit(docs)).select(
        "doc_id", held_out(F.col("doc_id"), FOLDS, 0).alias("held_out"), "lang_pred", "score", F.size("spans").cast("long").alias("n_spans")
    )
