"""Token ids in a compact file format: canonical, length-limited Huffman.

``encode_ids`` runs a word-level BPE tokenizer of the ``tokenizers`` library
over whole texts (each distinct word of a batch once), ``write_ids`` counts
every id of the corpus, derives one length-limited code and writes blocks in
ascending id order, ``read_ids`` decodes them with one lookup table.

File format (two Parquet folders under one path, so any store that Spark
writes to will do):

* ``codebook``: (id, bits) of every id that occurs. Codes are canonical:
  ascending by (bits, id), most significant bit first.
* ``blocks``: whole documents, at least ``BLOCK_IDS`` ids where there are as
  many: part, block, part_start (ids of the part before the block), doc_ids,
  doc_counts, payload, checkpoints (the bit offset of every
  ``CHECKPOINT_IDS``-th id, from which decoding can start). Blocks are
  independent of each other; parts are ranges of the document id.

A block is decoded by all its checkpoints at once: step i decodes the i-th id
after each of them. Counts and the code book are bounded by the vocabulary,
part totals by the number of parts; nothing else reaches the driver.

Defined cases: the string of an added token in a text is that token, as the
library's ``encode(text, add_special_tokens=False)`` has it; null text is empty; an empty document has only the end id;
null ids sort first; rows with the same document id follow each other by
their content's hash; an empty table writes and reads no rows; other columns
are not read.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import textops
from tidemark.llm.staging import read, stage
from tidemark.session import checkpoint_dir

NAME = "op4_huffman_ids"
ORACLE_SQL = None
END_ID = 1
WORD_END = "</w>"
MAX_BITS = 16
BLOCK_IDS = 1 << 16
CHECKPOINT_IDS = 256
SLICE_BYTES = 6 << 20
WORDS_PER_CALL = 2000
CACHED_WORDS, CACHED_BYTES = 1 << 19, 16 << 20
COUNT_BYTES = 1 << 20
BLOCK_SCHEMA = (
    "part int, block int, part_start long, doc_ids array<long>, doc_counts array<long>, payload binary, checkpoints array<long>"
)


# ---- texts to ids ----------------------------------------------------------------


@cache
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    vocabulary = tok.get_vocab()
    ends = np.zeros(max(vocabulary.values()) + 1, bool)
    ends[[i for piece, i in vocabulary.items() if piece.endswith(WORD_END)]] = True
    added = [re.escape(t.content.encode()) for t in tok.get_added_tokens_decoder().values() if t.content]
    return tok, ends, re.compile(b"|".join(added), re.IGNORECASE) if added else None


class WordEncoder:
    """Ids of distinct words, kept between batches: about ``CACHED_WORDS`` and
    ``CACHED_BYTES``, of which words met again stay when there are more."""

    def __init__(self, path: str):
        self.tok, self.ends, self.added = _tokenizer(path)
        self.clear()

    def clear(self) -> None:
        self._keep(pa.array([], pa.large_binary()), np.zeros(0, np.uint32), np.zeros(1, np.int64))

    def _keep(self, words: pa.Array, flat: np.ndarray, at: np.ndarray) -> None:
        self.words, self.flat, self.at = words, flat, at
        self.met = np.ones(len(words), np.int32)  # batches
        self.size = pc.sum(pc.binary_length(words)).as_py() or 0

    @property
    def known(self) -> list[bytes]:
        return self.words.to_pylist()

    def forget(self) -> None:
        """Words met in the fewest batches go, until half the room is free."""
        sizes, often = pc.binary_length(self.words).to_numpy(), 2
        while (stay := self.met >= often).sum() > CACHED_WORDS // 2 or sizes[stay].sum() > CACHED_BYTES // 2:
            often *= 2
        flat, at = textops.gather(self.flat, self.at, np.flatnonzero(stay))
        self._keep(self.words.filter(pa.array(stay)), flat, at)

    def rows(self, words: pa.Array) -> np.ndarray:
        """The number of each of a batch's distinct words."""
        if len(self.words) > CACHED_WORDS or self.size > CACHED_BYTES:
            self.forget()
        number = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy().astype(np.int64)
        fresh = number < 0
        self.met[number[~fresh]] += 1
        number[fresh] = len(self.words) + np.arange(fresh.sum())
        new = words.filter(pa.array(fresh))
        flat, sizes = [self.flat], [np.diff(self.at)]
        for i in range(0, len(new), WORDS_PER_CALL):
            some = new.slice(i, WORDS_PER_CALL).to_pylist()
            (got,) = self.tok.encode_batch_fast([b" ".join(some).decode()], add_special_tokens=False)
            ids = np.array(got.ids, np.uint32)
            last = np.flatnonzero(self.ends[ids]) + 1  # each word's last id is a word end
            if len(last) != len(some):
                raise AssertionError("a word was split by the tokenizer's own pattern")
            flat.append(ids)
            sizes.append(np.diff(last, prepend=0))
        self.words = pa.concat_arrays([self.words, new])
        self.size += pc.sum(pc.binary_length(new)).as_py() or 0
        self.met = np.concatenate([self.met, np.ones(len(new), np.int32)])
        self.flat = np.concatenate(flat)
        self.at = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int64)
        return number

    def texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets by text). Texts that Unicode
        normalisation could change across word borders, or that hold the
        string of an added token in any case, go whole."""
        data, offsets = textops.buffers(column)
        odd = np.union1d(_odd(data, offsets), self._with_added(data, offsets))
        if len(odd):
            return self._mixed(data, offsets, odd)
        starts, ends = textops.split_word_bpe(data, offsets)
        index, distinct = textops.dictionary(data, starts, ends)
        rows = self.rows(distinct)[index] if len(index) else np.zeros(0, np.int64)
        ids, at = textops.gather(self.flat, self.at, rows)
        return ids, at[np.searchsorted(starts, offsets)]

    def _with_added(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.added is None:
            return np.zeros(0, np.int64)
        starts = [m.start() for m in self.added.finditer(np.ascontiguousarray(data))]
        return np.unique(np.searchsorted(offsets, starts, "right") - 1).astype(np.int64)

    def _mixed(self, data: np.ndarray, offsets: np.ndarray, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = [data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
        whole = {int(i): np.array(self.tok.encode(raw[i].decode(), add_special_tokens=False).ids, np.uint32) for i in odd}
        ids, at = self.texts(pa.array([b"" if i in whole else x for i, x in enumerate(raw)], pa.large_binary()))
        parts = [whole.get(i, ids[at[i] : at[i + 1]]) for i in range(len(raw))]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


@cache
def _encoder(path: str) -> WordEncoder:
    """One for all tasks of a Python worker: most words of a task were seen before."""
    return WordEncoder(path)


def _odd(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts that are not in normal form C, or hold the one letter whose
    lower case is two characters. Code points below U+0300 never compose."""
    found = []
    high = np.flatnonzero((data >= 0xCC) | (data == 0xC4))
    for i in np.flatnonzero(np.diff(np.searchsorted(high, offsets))):
        text = data[offsets[i] : offsets[i + 1]].tobytes().decode()
        if "İ" in text or not unicodedata.is_normalized("NFC", text):
            found.append(i)
    return np.array(found, np.int64)


def id_type(path: str) -> str:
    """The narrowest little-endian unsigned type for the tokenizer's ids."""
    return "<u2" if len(_tokenizer(path)[1]) <= 1 << 16 else "<u4"


def encode_ids(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int | None = END_ID) -> DataFrame:
    """``(doc_id, ids)``: the ids of each text as an array of ``id_type``."""
    kind = id_type(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        tail = np.array([] if end_id is None else [end_id], np.uint32)
        for batch in textops.slices(batches, "text", SLICE_BYTES):
            ids, at = encoder.texts(batch.column("text"))
            rows = [np.concatenate([ids[a:b], tail]).astype(kind).tobytes() for a, b in zip(at[:-1], at[1:])]
            yield pa.record_batch([batch.column("doc_id"), pa.array(rows, pa.binary())], ["doc_id", "ids"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary")


# ---- the code --------------------------------------------------------------------


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` (package-merge); 0 for
    ids that don't occur. The limit is raised if it is too small for them."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n < 2:
        lengths[used] = 1
        return lengths
    max_bits = max(max_bits, int(np.ceil(np.log2(n))))
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    level, leaf_at = leaves, []
    is_leaf = np.ones(n, bool)
    leaf_at.append(is_leaf)
    for _ in range(max_bits - 1):
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([leaves, pairs])
        by = np.argsort(both, kind="stable")
        level = both[by]
        leaf_at.append(by < n)
    take = 2 * n - 2
    size = np.zeros(n, np.uint8)
    for is_leaf in reversed(leaf_at):
        k = int(is_leaf[:take].sum())
        size[:k] += 1
        take = 2 * (take - k)
    lengths[order] = size
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    codes = np.zeros(len(lengths), np.uint32)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    size = lengths[order].astype(np.int64)
    top = int(size[-1]) if len(size) else 0
    width = np.left_shift(1, top - size)
    at = np.concatenate([[0], np.cumsum(width)[:-1]]) if len(size) else width
    codes[order] = at >> (top - size)
    return codes


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """(bits of the ids' codes, bit offset of every checkpoint)."""
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    at = ends - size
    room = codes[ids].astype(np.int64) << (40 - size - (at & 7))
    first = at >> 3
    total = (int(ends[-1]) + 7 >> 3) if len(ids) else 0
    out = np.zeros(total + 5)
    for k in range(5):
        out += np.bincount(first + k, weights=(room >> (32 - 8 * k)) & 0xFF, minlength=total + 5)
    return out[:total].astype(np.uint8).tobytes(), at[::CHECKPOINT_IDS]


class Decoder:
    """One table lookup per id: the next ``top`` bits give id and length."""

    def __init__(self, lengths: np.ndarray):
        used = np.flatnonzero(lengths)
        order = used[np.lexsort((used, lengths[used]))]
        size = lengths[order].astype(np.int64)
        self.top = int(size[-1]) if len(size) else 1
        width = np.left_shift(1, self.top - size)
        self.ids = np.zeros(1 << self.top, np.uint32)
        self.size = np.ones(1 << self.top, np.uint8)
        self.ids[: width.sum()] = np.repeat(order, width)
        self.size[: width.sum()] = np.repeat(size, width)

    def blocks(self, payloads: list[bytes], checkpoints: list[np.ndarray], counts: list[int]) -> list[np.ndarray]:
        """The ids of each block; all checkpoints of all blocks advance together."""
        begin = np.concatenate([[0], np.cumsum([len(p) for p in payloads])]).astype(np.int64)
        raw = np.frombuffer(b"".join(payloads) + bytes(8), np.uint8).astype(np.uint64)
        n = int(begin[-1])
        window = raw[:n] << np.uint64(32) | raw[1 : n + 1] << np.uint64(24) | raw[2 : n + 2] << np.uint64(16) | raw[3 : n + 3] << np.uint64(8) | raw[4 : n + 4]
        lanes = [np.asarray(c, np.int64) + 8 * b for c, b in zip(checkpoints, begin[:-1])]
        at = np.concatenate(lanes) if lanes else np.zeros(0, np.int64)
        todo = [np.minimum(CHECKPOINT_IDS, m - CHECKPOINT_IDS * np.arange(len(c))) for m, c in zip(counts, checkpoints)]
        todo = np.concatenate(todo) if todo else np.zeros(0, np.int64)
        out = np.zeros((CHECKPOINT_IDS, len(at)), np.uint32)
        by = np.argsort(-todo, kind="stable")
        at, live = at[by], todo[by]
        mask = np.uint64((1 << self.top) - 1)
        for step in range(CHECKPOINT_IDS):
            k = int(np.searchsorted(-live, -step, "left"))
            if not k:
                break
            now = at[:k]
            bits = window[now >> 3] >> (40 - self.top - (now & 7)).astype(np.uint64) & mask
            out[step, by[:k]] = self.ids[bits]
            now += self.size[bits]
        flat = np.ascontiguousarray(out.T)
        ids, lane = [], 0
        for m, c in zip(counts, checkpoints):
            ids.append(flat[lane : lane + len(c)].reshape(-1)[:m])
            lane += len(c)
        return ids


# ---- files -----------------------------------------------------------------------


def added_counts(total: np.ndarray, values: pa.Array, kind: str) -> np.ndarray:
    """``total`` and the ids of documents, about ``COUNT_BYTES`` counted at a time."""
    at = 0
    while at < len(values):
        some, size = [], 0
        while at < len(values) and size < COUNT_BYTES:
            some.append(np.frombuffer(values[at].as_buffer(), kind))
            at, size = at + 1, size + some[-1].nbytes
        one = np.bincount(np.concatenate(some), minlength=len(total))
        one[: len(total)] += total
        total = one
    return total


def count_ids(ids: DataFrame, kind: str) -> np.ndarray:
    """How often each id occurs; as many rows as the vocabulary reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            total = added_counts(total, batch.column("ids"), kind)
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "n"])

    found = ids.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(int(found["id"].max()) + 1 if len(found) else 0, np.int64)
    counts[found["id"].to_numpy(np.int64)] = found["n"]
    return counts


def write_ids(ids: DataFrame, path: str, kind: str = "<u4", max_bits: int = MAX_BITS) -> None:
    """Write ``(doc_id, ids)``, ids of type ``kind``, in ascending doc_id order."""
    spark = ids.sparkSession
    lengths = code_lengths(count_ids(ids, kind), max_bits)
    codes = canonical_codes(lengths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, block, start = TaskContext.get().partitionId(), 0, 0
        docs: list = []
        some: list[np.ndarray] = []
        size = 0

        def flush():
            nonlocal block, start, size
            payload, marks = pack(np.concatenate(some), codes, lengths)
            row = {
                "part": part, "block": block, "part_start": start, "doc_ids": docs[:], "doc_counts": [len(x) for x in some],
                "payload": payload, "checkpoints": marks.tolist(),
            }
            block, start, size = block + 1, start + size, 0
            docs.clear()
            some.clear()
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for doc, value in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                docs.append(doc)
                some.append(np.frombuffer(value.as_buffer(), kind).astype(np.uint32))
                size += len(some[-1])
                if size >= BLOCK_IDS:
                    yield flush()
        if docs:
            yield flush()

    schema = pa.schema(
        [("part", pa.int32()), ("block", pa.int32()), ("part_start", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
         ("doc_counts", pa.list_(pa.int64())), ("payload", pa.binary()), ("checkpoints", pa.list_(pa.int64()))]
    )
    used = np.flatnonzero(lengths)
    book = spark.createDataFrame([(int(i), int(lengths[i])) for i in used], "id long, bits int")
    book.coalesce(1).write.parquet(f"{path}/codebook")
    ordered = ids.withColumn("__h", F.xxhash64("ids"))
    ordered = ordered.repartitionByRange("doc_id", "__h").sortWithinPartitions("doc_id", "__h").drop("__h")
    ordered.mapInArrow(run, BLOCK_SCHEMA).write.option("compression", "none").parquet(f"{path}/blocks")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, ids)`` of every document: its little-endian unsigned
    32-bit ids; ``start`` counts the ids of all documents before it."""
    book = spark.read.parquet(f"{path}/codebook").toPandas()
    lengths = np.zeros(int(book["id"].max()) + 1 if len(book) else 0, np.uint8)
    lengths[book["id"].to_numpy(np.int64)] = book["bits"]
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    sizes = blocks.select("part", F.aggregate("doc_counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    totals = sizes.groupBy("part").agg(F.sum("n").alias("n")).toPandas().sort_values("part")  # a row per part
    before = dict(zip(totals["part"].tolist(), (totals["n"].cumsum() - totals["n"]).tolist()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(lengths)
        for batch in textops.slices(batches, "payload", 2 << 20):
            doc_counts = [np.array(x, np.int64) for x in batch.column("doc_counts").to_pylist()]
            decoded = decoder.blocks(
                batch.column("payload").to_pylist(), [np.array(x, np.int64) for x in batch.column("checkpoints").to_pylist()],
                [int(n.sum()) for n in doc_counts],
            )
            docs, starts, rows = [], [], []
            for part, at, ids, counts, found in zip(
                batch.column("part").to_pylist(), batch.column("part_start").to_pylist(), batch.column("doc_ids").to_pylist(), doc_counts, decoded
            ):
                ends = np.cumsum(counts)
                docs += ids
                starts += (before[part] + at + ends - counts).tolist()
                rows += [found[b - n : b].astype("<u4").tobytes() for b, n in zip(ends, counts)]
            yield pa.record_batch([pa.array(docs, pa.int64()), pa.array(starts, pa.int64()), pa.array(rows, pa.binary())], ["doc_id", "start", "ids"])

    return blocks.mapInArrow(run, "doc_id long, start long, ids binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    ids = stage(encode_ids(docs, tokenizer), "token-ids")
    path = f"{checkpoint_dir(spark).rstrip('/')}/staged/id-files-{uuid.uuid4().hex}"
    write_ids(ids, path, id_type(tokenizer))
    return read_ids(spark, path).select(
        "doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )
