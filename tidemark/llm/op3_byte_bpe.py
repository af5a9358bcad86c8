"""Byte-level BPE: ranked merges folded by Spark, pieces joined to decode.

Words common to many texts are folded once for the whole table
(``common_words``: at most ``COMMON_WORDS`` of them, found in a bounded sample
of texts); they are a cache alone, any other word is folded where it is met.
The rest of ``encode`` runs in one narrow stage, with no shuffle and no state
beyond a batch of texts and about ``TASK_WORDS`` words of the task:

1. an Arrow step splits whole texts by the public pattern into words and
   emits each batch's words that are neither common nor known from the task's
   batches before, then its documents as word numbers;
2. Spark's higher-order functions fold the ranked merges over each distinct
   word: the state is the word's array of token ids and the array of the
   merged id of every neighbouring pair; each step replaces the leftmost pair
   with the smallest merged id (its rank) until no pair has one. The rank map
   is a constant of the plan (bounded by the vocabulary), laid out so that one
   lookup is two array reads;
3. an Arrow step puts the words' ids, common ones too, back into document
   order.

Words longer than ``FOLD_BYTES`` bytes, whose fold would be quadratic, are
merged by the same rule with a heap in step 3 (``merge_long``).

``decode`` concatenates the binary pieces of ids.

Defined cases: null text is empty and gives no ids; repeated rows and ids give
repeated results; an empty table gives an empty result; ids without a piece
fail; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import cache
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import textops
from tidemark.llm.staging import read

NAME = "op3_byte_bpe"
ORACLE_SQL = None
FOLD_BYTES = 48
SLICE_BYTES = 1 << 20
BATCH_BYTES = 8 << 20
WORD_ROWS = 1024
#: Distinct words after which a task begins to count them anew.
TASK_WORDS = 1 << 17
#: Words of documents that are put together at a time.
GATHER_WORDS = 1 << 16
#: Sampled texts, characters read of each, and the most words kept of them.
SAMPLE_ROWS, SAMPLE_CHARS, COMMON_WORDS = 1 << 15, 1 << 12, 1 << 19


@cache
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def pair_ids(path: str) -> np.ndarray:
    """(left id, right id, merged id) of all pairs of pieces that make a piece."""
    known = ranks(path)
    rows = (
        number
        for piece, rank in known.items()
        for k in range(1, len(piece))
        if piece[:k] in known and piece[k:] in known
        for number in (known[piece[:k]], known[piece[k:]], rank)
    )
    return np.fromiter(rows, np.int64).reshape(-1, 3)


def _id_bits(base: int) -> int:
    return base.bit_length()


@cache
def _lookup(path: str) -> tuple[np.ndarray, np.ndarray, int, int]:
    """The rank map without collisions: entry key mod p + shift[key mod r]
    of ``table`` is key shifted by the bits of an id, plus the merged
    id, where key = left * base + right; an unused entry is that of a key that
    cannot be. Returns (shift, table, p, base)."""
    pairs = pair_ids(path)
    base = max(ranks(path).values()) + 1
    keys = pairs[:, 0] * base + pairs[:, 1]
    n = max(1, len(keys))
    r, p = n // 3 | 1, int(n * 1.4) | 1
    while True:  # keys of one bucket must differ modulo p
        at = keys % p
        order = np.lexsort((at, keys % r))
        b = (keys % r)[order]
        if not ((b[1:] == b[:-1]) & (at[order][1:] == at[order][:-1])).any():
            break
        p += 2
    bucket = keys % r
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    groups = np.split(order, edges[1:]) if len(keys) else []
    groups.sort(key=len, reverse=True)
    bits = _id_bits(base)
    table = [0] * p
    shift = [0] * r
    slot0 = at.tolist()
    value = ((keys << bits) + pairs[:, 2]).tolist()
    number = bucket.tolist()
    for g in map(np.ndarray.tolist, groups):
        slots = [slot0[i] for i in g]
        d = 0
        while any(s + d < len(table) and table[s + d] for s in slots):
            d += 1
        table += [0] * (max(slots) + d + 1 - len(table))
        shift[number[g[0]]] = d
        for i, s in zip(g, slots):
            table[s + d] = value[i]
    table += [0] * (p + max(shift) - len(table))
    table = [v or base * base << bits for v in table]
    return np.array(shift, np.int64), np.array(table, np.int64), p, base


def _constant(spark: SparkSession, values: np.ndarray) -> Column:
    """An array as a constant of the plan: a one-row subquery, read once. It
    is a local relation, as the driver writes a plan's literals out in every
    description of the plan, and keeps those."""
    at = pa.array([0, len(values)], pa.int32())
    return spark.createDataFrame(pa.table({"v": pa.ListArray.from_arrays(at, pa.array(values))})).scalar()


def with_rank_map(df: DataFrame, path: str, where: Column) -> DataFrame:
    """``df`` with the rank map in the columns that ``fold`` reads, on the
    rows it is needed for."""
    shift, table, _, _ = _lookup(path)
    return df.withColumns({n: F.when(where, _constant(df.sparkSession, v)) for n, v in (("__shift", shift), ("__table", table))})


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def fold(symbols: Column, path: str) -> Column:
    """Ids of one word, given the ids of its bytes, beside the rank map.

    The state has one number per piece: (merged id with the next piece, first
    byte, id), so that the smallest is the leftmost pair of the lowest rank.
    """
    shift, table, p, base = _lookup(path)
    r, bits = len(shift), _id_bits(base)
    none, place, ids = 1 << bits, FOLD_BYTES.bit_length(), (1 << bits) - 1
    up = 1 << (bits + place)

    def merged(k: Column) -> Column:
        """Merged id of the pair of key left * base + right; ``none`` without one."""
        slot = k % p + F.get(F.col("__shift"), (k % r).cast("int"))
        return F.least(F.get(F.col("__table"), slot.cast("int")).bitwiseXOR(k * (1 << bits)), F.lit(none).cast("long"))

    keys = F.zip_with(symbols, F.slice(symbols, 2, FOLD_BYTES), lambda x, y: x.cast("long") * base + y)
    start = F.zip_with(symbols, F.transform(keys, merged), lambda x, n: n * up + x)
    start = F.transform(start, lambda c, i: c + i.cast("long") * (1 << bits))

    def merge(cells: Column, best: Column, at: Column) -> Column:
        left, right, new = F.get(cells, at - 2), F.get(cells, at + 1), F.shiftright(best, bits + place)
        pair = F.transform(F.array(left.bitwiseAND(ids) * base + new, new * base + right.bitwiseAND(ids)), merged)
        changed = _let(
            pair,
            lambda n: F.array(
                left.bitwiseAND(up - 1) + F.get(n, 0) * up,
                F.get(n, 1) * up + best.bitwiseAND(up - 1 - ids) + new,
            ),
        )
        return F.concat(
            F.slice(cells, 1, F.greatest(at - 2, F.lit(0))),
            F.slice(changed, F.when(at > 1, 1).otherwise(2), 2),
            F.slice(cells, at + 2, FOLD_BYTES),
        )

    def step(cells: Column, _: Column) -> Column:
        return _let(
            F.array_min(cells),
            lambda best: F.when(best >= none * up, cells).otherwise(
                _let(F.array_position(cells, best).cast("int"), lambda at: merge(cells, best, at))
            ),
        )

    steps = F.sequence(F.lit(1), F.greatest(F.size(symbols) - 1, F.lit(1)))
    return F.aggregate(steps, start, step, lambda cells: F.transform(cells, lambda c: c.bitwiseAND(ids).cast("int")))


def merge_long(word: bytes, known: dict[bytes, int]) -> list[int]:
    """The same merges with a heap: leftmost pair of the smallest rank first."""
    n = len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap = []

    def offer(a: int) -> None:
        b = end[a]
        if b < n:
            rank = known.get(word[a : end[b]])
            if rank is not None:
                heapq.heappush(heap, (rank, a, end[b]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, a, to = heapq.heappop(heap)
        if not alive[a] or end[a] >= n or end[end[a]] != to:
            continue
        b = end[a]
        alive[b] = False
        end[a] = to
        if to < n:
            before[to] = a
        offer(a)
        if before[a] >= 0:
            offer(before[a])
    ids, at = [], 0
    while at < n:
        ids.append(known[word[at : end[at]]])
        at = end[at]
    return ids


SPLIT_SCHEMA = "doc_id long, words array<array<int>>, long_words array<binary>, index binary"


def _symbols(words: list[bytes], byte_id: np.ndarray) -> pa.Array:
    """One row: the ids of each word's bytes."""
    flat = byte_id[np.frombuffer(b"".join(words), np.uint8)]
    at = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pa.ListArray.from_arrays(pa.array(at), pa.array(flat)))


def _byte_ids(path: str) -> np.ndarray:
    return np.array([ranks(path)[bytes([b])] for b in range(256)], np.int32)


def _folded(words: DataFrame, path: str) -> DataFrame:
    """``words``, arrays of symbols, with ``ids`` of each in their place."""
    words = with_rank_map(words, path, F.col("words").isNotNull())
    ids = F.transform("words", lambda w: F.when(F.size(w) < 2, w).otherwise(fold(w, path)))
    return words.withColumn("ids", ids).drop("words", "__shift", "__table")


def common_words(df: DataFrame, path: str, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> tuple[pa.Array, tuple]:
    """Words met more than once in a sample of texts, and (their ids end to
    end, how many each has). Empty for tables of few rows, where a task's own
    words are as good."""
    rows = df.count()
    if rows <= 2 * sample_rows:
        return pa.array([], pa.binary()), (np.zeros(0, np.int32), np.zeros(0, np.int32))
    byte_id = _byte_ids(path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textops.slices(batches, "text", SLICE_BYTES):
            data, offsets = textops.buffers(batch.column("text"))
            starts = textops.split_byte_bpe(data, offsets)
            index, distinct = textops.dictionary(data, starts, np.append(starts[1:], len(data)))
            yield pa.record_batch([distinct.cast(pa.binary()), pa.array(np.bincount(index, minlength=len(distinct)))], ["word", "n"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, WORD_ROWS):
                some = batch.column("word").slice(at, WORD_ROWS).to_pylist()
                yield pa.record_batch([pa.array([some], pa.list_(pa.binary())), _symbols(some, byte_id)], ["known", "words"])

    sample = df.select(F.substring(text_col, 1, SAMPLE_CHARS).alias("text")).sample(sample_rows / rows, seed=0)
    words = sample.mapInArrow(textops.freed(count), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    words = words.filter((F.col("n") > 1) & (F.octet_length("word") <= FOLD_BYTES)).orderBy(F.desc("n"), "word").limit(COMMON_WORDS)
    packed = words.select("word").repartition("word").mapInArrow(textops.freed(pack), "known array<binary>, words array<array<int>>")
    found = _folded(packed, path).toArrow()  # at most COMMON_WORDS
    of_word = pc.list_flatten(found.column("ids")).combine_chunks()
    known = pc.list_flatten(found.column("known")).combine_chunks()
    return known, (of_word.flatten().to_numpy().astype(np.int32), np.array(pc.list_value_length(of_word), np.int32))


def _split(path: str, common):
    byte_id = _byte_ids(path)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("words", pa.list_(pa.list_(pa.int32()))), ("long_words", pa.list_(pa.binary())), ("index", pa.binary())]
    )

    def word_rows(values: list[bytes], anew: bool) -> Iterator[pa.RecordBatch]:
        """Rows of words in order; the first says whether numbers begin anew."""
        for i in range(0, max(1, len(values)), WORD_ROWS):
            some = values[i : i + WORD_ROWS]
            row = _symbols([w if len(w) <= FOLD_BYTES else b"" for w in some], byte_id)
            rest = pa.array([[w for w in some if len(w) > FOLD_BYTES]], pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays([pa.array([int(anew and not i)], pa.int64()), row, rest, pa.nulls(1, pa.binary())], schema=schema)

    def document_rows(docs: list, streams: list, number: np.ndarray) -> Iterator[pa.RecordBatch]:
        n = len(docs)
        for i in range(0, n, 1000):
            some = slice(i, min(i + 1000, n))
            rows = pa.array([number[s].tobytes() for s in streams[some]], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs[some], pa.int64()), pa.nulls(len(rows), schema.field(1).type), pa.nulls(len(rows), schema.field(2).type), rows], schema=schema
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = common.value
        docs, streams, held = [], [], 0
        words: dict[bytes, int] = {}
        fresh: list[bytes] = []  # words not emitted yet
        number, own = np.zeros(0, np.int32), 0  # numbers of the others, common words first; how many are not common

        def emit() -> Iterator[pa.RecordBatch]:
            nonlocal number, own
            found = np.array(pc.fill_null(pc.index_in(pa.array(fresh, pa.binary()), value_set=known), -1), np.int32)
            new = np.flatnonzero(found < 0)
            found[new] = len(known) + own + np.arange(len(new))
            yield from word_rows([fresh[i] for i in new], not len(number))
            number, own = np.concatenate([number, found]), own + len(new)
            yield from document_rows(docs, streams, number)
            docs.clear(), streams.clear(), fresh.clear()
            if len(words) > TASK_WORDS:
                words.clear()
                number, own = np.zeros(0, np.int32), 0

        for batch in textops.slices(batches, "text", SLICE_BYTES):
            data, offsets = textops.buffers(batch.column("text"))
            if held and held + len(data) > BATCH_BYTES:
                yield from emit()
                held = 0
            starts = textops.split_byte_bpe(data, offsets)
            index, distinct = textops.dictionary(data, starts, np.append(starts[1:], len(data)))
            before = len(words)
            of = np.fromiter((words.setdefault(w, len(words)) for w in distinct.to_pylist()), np.int32, len(distinct))
            fresh += list(islice(words, before, None))
            index = of[index] if len(index) else of
            at = np.searchsorted(starts, offsets)
            docs += batch.column("doc_id").to_pylist()
            streams += [index[a:b].copy() for a, b in zip(at[:-1], at[1:])]
            held += len(data)
        if docs:
            yield from emit()

    return run


def _gathered(values: np.ndarray, at: np.ndarray, parts: list[np.ndarray]) -> list[np.ndarray]:
    """For each part its ranges ``values[at[i]:at[i+1]]``, concatenated."""
    flat, ends = textops.gather(values, at, np.concatenate(parts))
    cuts = ends[np.cumsum([0, *map(len, parts)])].tolist()
    return [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def _assemble(path: str, finish, common):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = ranks(path)
        flat, sizes, done = [], [], True
        values = at = None
        for batch in batches:
            docs, rows, some, size = [], [], [], 0
            for doc, ids, rest, index in zip(
                batch.column("doc_id").to_pylist(), batch.column("ids"), batch.column("long_words"), batch.column("index")
            ):
                if index.is_valid:
                    if not done:
                        values, counts, done = np.concatenate(flat), np.concatenate(sizes), True
                        flat, sizes = [values], [counts]
                        at = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
                    of = np.frombuffer(index.as_buffer(), np.int32)
                    docs.append(doc)
                    some.append(of)
                    size += len(of)
                    if size >= GATHER_WORDS:
                        rows += _gathered(values, at, some)
                        some, size = [], 0
                else:
                    if some:
                        rows += _gathered(values, at, some)
                        some, size = [], 0
                    done = False
                    if doc:
                        flat, sizes = ([x] for x in common.value)
                    one = np.diff(ids.values.offsets.to_numpy())
                    many = ids.values.flatten().to_numpy().astype(np.int32)
                    longs = iter(rest.as_py())
                    holes = np.flatnonzero(one == 0)
                    if len(holes):
                        parts, last = [], 0
                        ends = np.cumsum(one)
                        for h in holes:
                            merged = np.array(merge_long(next(longs), known), np.int32)
                            parts += [many[last : ends[h]], merged]
                            last, one[h] = ends[h], len(merged)
                        many = np.concatenate([*parts, many[last:]])
                    flat.append(many)
                    sizes.append(one)
            if some:
                rows += _gathered(values, at, some)
            if docs:
                yield finish(docs, rows)

    return run


def _words_to_ids(df: DataFrame, path: str, id_col: str, text_col: str, known) -> DataFrame:
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return _folded(rows.mapInArrow(textops.freed(_split(path, known)), SPLIT_SCHEMA), path).select("doc_id", "ids", "long_words", "index")


def _encoded(df: DataFrame, path: str, id_col: str, text_col: str, finish, schema: str, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    known, ids = map(df.sparkSession.sparkContext.broadcast, common_words(df, path, text_col, sample_rows))
    return _words_to_ids(df, path, id_col, text_col, known).mapInArrow(textops.freed(_assemble(path, finish, ids)), schema)


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``(doc_id, ids array<int>)`` of whole texts."""

    def finish(docs, rows):
        return pa.record_batch([pa.array(docs, pa.int64()), pa.array(rows, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return _encoded(df, path, id_col, text_col, finish, "doc_id long, ids array<int>", sample_rows)


class Decoder:
    """Bytes of arrays of ids: their pieces, concatenated."""

    def __init__(self, path: str):
        known = sorted(ranks(path).items(), key=lambda x: x[1])
        sizes = np.zeros(known[-1][1] + 1, np.int64)
        sizes[[rank for _, rank in known]] = [len(piece) for piece, _ in known]
        self.known = sizes > 0
        self.bytes = np.frombuffer(b"".join(piece for piece, _ in known), np.uint8)
        self.at = np.concatenate([[0], np.cumsum(sizes)])

    def __call__(self, ids: np.ndarray) -> bytes:
        return next(self.rows([ids]))

    def rows(self, rows: list[np.ndarray]) -> Iterator[bytes]:
        """The bytes of each row; about ``GATHER_WORDS`` ids at a time."""
        sizes = np.cumsum([len(r) for r in rows])
        at = 0
        while at < len(rows):
            before = sizes[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(sizes, before + GATHER_WORDS, "right")))
            some = rows[at:to]
            ids = np.concatenate(some)
            if len(ids) and not (ids.min() >= 0 and ids.max() < len(self.known) and self.known[ids].all()):
                raise ValueError("an id has no piece")
            for part in _gathered(self.bytes, self.at, some):
                yield part.tobytes()
            at = to


@cache
def _decoder(path: str) -> Decoder:
    return Decoder(path)


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(doc_id, bytes binary)``: the text of each row's ids in UTF-8."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(path)
        for batch in batches:
            rows = list(decoder.rows([np.array(x if x is not None else [], np.int64) for x in batch.column("ids").to_pylist()]))
            yield pa.record_batch([batch.column("doc_id"), pa.array(rows, pa.binary())], ["doc_id", "bytes"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(textops.freed(run), "doc_id long, bytes binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_digests(read(spark, sf_dir, "documents"), path)


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document (doc_id, n_tokens, ids_sha256, decoded_sha256): ids are
    decoded again where they are, so that no ids leave the task."""

    def finish(docs, rows):
        decoder = _decoder(path)
        return pa.record_batch(
            [
                pa.array(docs, pa.int64()),
                pa.array([len(r) for r in rows], pa.int64()),
                pa.array([hashlib.sha256(r.astype("<u4").tobytes()).hexdigest() for r in rows], pa.string()),
                pa.array([hashlib.sha256(b).hexdigest() for b in decoder.rows(rows)], pa.string()),
            ],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _encoded(docs, path, "doc_id", "text", finish, schema)
