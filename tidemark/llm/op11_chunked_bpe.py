"""BPE encoding and decoding with content-defined chunk reuse.

A tokenizer of the ``tokenizers`` library whose words never cross white space
encodes whole texts; passages that documents share are encoded once:

1. a rolling hash over ``WINDOW`` bytes cuts every text into chunks. The cuts
   depend on the bytes around them only, so a passage is cut alike in every
   document. A chunk's body reaches from its first to its last white space;
2. bodies are counted by a 128-bit hash (partial counts in each task, one
   narrow shuffle). Those that occur twice are shared;
3. documents without a shared body are encoded where they lie. Of the others,
   every task emits each shared body once, Spark keeps one row a body, and
   those rows are encoded: one encoding a body, however many documents;
4. what lies between two bodies is a join, as it holds the chunk border and
   words that the border cuts. A join is repaired by encoding it again,
   together with whole words of the bodies on both sides, until both readings
   agree: the wider one must be the ids of those words around the ids of the
   narrower one. Each try takes one more word on each side; a body that has no
   more words to give is not taken from the table but encoded with its join;
5. bodies meet the documents' references by hash (frequent ones salted) and a
   document's ids are put together in its own order.

Which bodies are shared is told to the tasks by a bit per hash. Its array is
sized from their number, up to ``MOST_BITS``; with more of them, bodies that
occur once also take the way over the table, which changes no result.

``decode`` joins the pieces of ids with spaces, as the library does for a
tokenizer without a decoder.

Defined cases: null text is empty and gives no ids; repeated rows and null or
repeated ids give a row each; an empty table gives an empty result; the string
of an added token in a text is that token; ids without a piece are left out
when decoding; a text without white space is one join; other columns are not
read.
"""

from __future__ import annotations

import hashlib
import os
import struct
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import textops
from tidemark.llm.staging import read, stage

NAME = "op11_chunked_bpe"
ORACLE_SQL = None
TOKENIZER = "word_bpe_49k.json"
#: Bytes of the rolling hash (a power of two), of the least chunk, of the mean one above it, of the largest.
WINDOW, LEAST, MEAN, MOST = 32, 256, 1024, 8192
SLICE_BYTES = 1 << 20
#: A join longer than this holds an unshared stretch.
LONG_JOIN = 256
CACHED_WORDS, CACHED_JOINS, CACHED_BODIES, WORDS_PER_CALL = 1 << 19, 1 << 14, 1 << 18, 2000
WORD_END = "</w>"
#: UTF-8 of characters from U+0300 on begins with 0xCC or more; 0xC4 begins that of the letter U+0130.
ODD_BYTE = (np.arange(256) >= 0xCC) | (np.arange(256) == 0xC4)
#: Bits of the shared bodies' array: so many a body, at least and at most.
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 26
#: A body that occurs more often is met in so many salted pieces.
HOT, SALTS = 4096, 64
PARTS_SCHEMA = "row binary, doc_id long, kept array<binary>, bodies array<binary>, salts array<int>, hash binary, body binary"
ENCODED, DECODED = "doc_id long, ids binary", "doc_id long, n_tokens long, spelled string, text string"
Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


# ---- words -----------------------------------------------------------------------


@cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def id_type(path: str) -> str:
    """The narrowest little-endian unsigned type for the tokenizer's ids."""
    return "<u2" if _tokenizer(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"


class Encoder:
    """Encodes pieces of text, given as bytes. ``whole`` gives a piece to the
    library. ``pieces`` splits at the tokenizer's words and encodes distinct
    ones once a task; what stands between two ASCII white spaces and holds
    characters from U+0300 on, the letter whose lower case is two characters,
    or the first two bytes of an added token is one word of its own there, as
    the library may join or split it otherwise."""

    def __init__(self, path: str):
        self.tok, self.kind = _tokenizer(path), id_type(path)
        vocabulary = self.tok.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for piece, i in vocabulary.items() if piece.endswith(WORD_END)]] = True
        self.added = {t.content.encode()[:2] for t in self.tok.get_added_tokens_decoder().values()}
        self.clear()
        self.read: dict[bytes, list[int]] = {}

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat, self.at = np.zeros(0, self.kind), np.zeros(1, np.int64)

    def whole(self, pieces: list[bytes]) -> list[np.ndarray]:
        got = self.tok.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)
        return [np.array(g.ids, self.kind) for g in got]

    def memo(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of short pieces as lists, as many of them occur again and again."""
        new = [p for p in pieces if p not in self.read]
        if new:
            if len(self.read) > CACHED_JOINS:
                self.read.clear()
                new = pieces
            self.read.update(zip(new, (x.tolist() for x in self.whole(new))))
        return [self.read[p] for p in pieces]

    def _together(self, words: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """(ids, sizes by word) of the tokenizer's own words, many in a call."""
        flat, sizes = [], []
        for i in range(0, len(words), WORDS_PER_CALL):
            some = words[i : i + WORDS_PER_CALL]
            (ids,) = self.whole([b" ".join(some)])
            last = np.flatnonzero(self.ends[ids]) + 1
            if len(last) != len(some):
                raise AssertionError("a word was split otherwise by the library")
            flat.append(ids)
            sizes.append(np.diff(last, prepend=0))
        return flat, sizes

    def _rows(self, words: list[bytes], alone: np.ndarray | None) -> np.ndarray:
        """Places of distinct words in ``at``; those with ``alone`` go to the library one by one."""
        new = [i for i, w in enumerate(words) if w not in self.known]
        if len(self.known) + len(new) > CACHED_WORDS:
            self.clear()
            new = range(len(words))
        odd = [] if alone is None else [words[i] for i in new if alone[i]]
        plain = [words[i] for i in new] if alone is None else [words[i] for i in new if not alone[i]]
        own = self.whole(odd)
        flat, sizes = self._together(plain)
        first = len(self.known)
        self.known.update(zip([*odd, *plain], range(first, first + len(new))))
        self.flat = np.concatenate([self.flat, *own, *flat])
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(np.concatenate([np.array([len(x) for x in own], np.int64), *sizes]))])
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def _words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]:
        """(bytes, starts, ends) of the words to look up, A-Z lowered in plain
        ones, and which of them are odd (None: none)."""
        odd = ODD_BYTE[data]
        for two in self.added:
            if len(two) == 2:
                odd[:-1] |= (data[:-1] == two[0]) & (data[1:] == two[1])
        capital = (data >= 0x41) & (data <= 0x5A)
        starts, ends = textops.split_word_bpe(data, offsets)
        alone = None
        if odd.any():
            begin, end, _ = textops.words(data, offsets)
            at = np.concatenate([[0], np.cumsum(odd)])
            mine = at[end] > at[begin]
            begin, end = begin[mine], end[mine]
            inside = np.searchsorted(begin, starts, "right") - 1
            kept = (inside < 0) | (starts >= end[np.maximum(inside, 0)])
            starts, ends = np.concatenate([starts[kept], begin]), np.concatenate([ends[kept], end])
            by = np.argsort(starts, kind="stable")
            starts, ends, alone = starts[by], ends[by], by >= kept.sum()
            edge = np.zeros(len(data) + 1, np.int8)
            edge[begin], edge[end] = 1, -1
            capital &= np.cumsum(edge[:-1]) == 0
        return data + (capital * np.uint8(32)), starts, ends, alone

    def pieces(self, column: pa.Array) -> list[np.ndarray]:
        data, offsets = textops.buffers(column)
        data, starts, ends, alone = self._words(data, offsets)
        index, distinct = textops.dictionary(data, starts, ends)
        if not len(index):
            return [self.flat[:0]] * len(column)
        if alone is not None:  # a word's bytes tell whether it is odd
            by_word = np.zeros(len(distinct), bool)
            by_word[index[alone]] = True
            alone = by_word
        rows = self._rows(distinct.to_pylist(), alone)[index]
        ids, at = textops.gather(self.flat, self.at, rows)
        edge = at[np.searchsorted(starts, offsets)]
        return [ids[a:b] for a, b in zip(edge[:-1], edge[1:])]


# ---- chunks ----------------------------------------------------------------------


@cache
def _table() -> np.ndarray:
    return np.random.default_rng(20).integers(0, 1 << 32, 256, dtype=np.uint32)


def rolling(data: np.ndarray) -> np.ndarray:
    """Hash of the ``WINDOW`` bytes that end at each position (wrapping; the
    first ones lack bytes), by doubling the window."""
    h, size = _table()[data], 1
    factor = 0x9E3779B1
    while size < WINDOW:
        before = h[:-size] * np.uint32(factor)
        h[size:] += before
        size, factor = size * 2, factor * factor & 0xFFFFFFFF
    return h


def chunks(data: np.ndarray, offsets: np.ndarray) -> list[list[int]]:
    """Borders of each text's chunks, its begin and end included."""
    marks = (np.flatnonzero(rolling(data) % np.uint32(MEAN) == 0) + 1).tolist()
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        borders = [a]
        at = a
        while b - at > LEAST:
            i = bisect_left(marks, at + max(LEAST, WINDOW))
            at = min(marks[i] if i < len(marks) else b, at + MOST)
            if at >= b:
                break
            borders.append(at)
        out.append([*borders, b])
    return out


class Text:
    """The bodies of a slice's texts: white space positions and words."""

    def __init__(self, column: pa.Array):
        self.data, self.offsets = textops.buffers(column)
        self.raw = self.data.tobytes()
        self.borders = chunks(self.data, self.offsets)
        spaces = np.flatnonzero((self.data == 0x20) | ((self.data >= 0x09) & (self.data <= 0x0D)))
        starts, ends, _ = textops.words(self.data, self.offsets)
        self.starts, self.ends = starts.tolist(), ends.tolist()
        a = np.array([x for some in self.borders for x in some[:-1]], np.int64)
        b = np.array([x for some in self.borders for x in some[1:]], np.int64)
        pad = np.append(spaces, len(self.data))
        first = pad[np.searchsorted(spaces, a)]
        last = np.append(pad, -1)[np.searchsorted(spaces, b) - 1]
        held = np.searchsorted(starts, last) - np.searchsorted(starts, first)  # words between
        good = (first < b) & (first < last) & (held > 1)
        self.body = [(s, t) if g else None for s, t, g in zip(first.tolist(), last.tolist(), good.tolist())]
        self.of = np.concatenate([[0], np.cumsum([len(some) - 1 for some in self.borders])]).tolist()

    def bodies(self, i: int) -> list[tuple[int, int]]:
        return [x for x in self.body[self.of[i] : self.of[i + 1]] if x]

    def digest(self, body: tuple[int, int]) -> bytes:
        return hashlib.blake2b(self.raw[body[0] : body[1]], digest_size=16).digest()

    def last_words(self, body: tuple[int, int], n: int) -> int | None:
        """Where the last n words of a body begin; None if it has fewer."""
        i = bisect_left(self.starts, body[1]) - n
        return self.starts[i] if i >= 0 and self.starts[i] >= body[0] else None

    def first_words(self, body: tuple[int, int], n: int) -> int | None:
        i = bisect_left(self.starts, body[0]) + n - 1
        return self.ends[i] if i < len(self.ends) and self.ends[i] <= body[1] else None


def repaired(text: Text, i: int, shared: list[tuple[int, int]], encoder: Encoder) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """(bodies that stay, joins around them) of text i, whose joins agree.

    The join between two bodies is encoded alone and with words of both;
    white space at its ends makes the readings agree at once for tokenizers
    whose words end there, any other needs more words or gives up a body."""
    begin, end = int(text.offsets[i]), int(text.offsets[i + 1])
    kept = list(shared)
    k = 0
    while k <= len(kept):
        left, right = kept[k - 1] if k else None, kept[k] if k < len(kept) else None
        a, b = left[1] if left else begin, right[0] if right else end
        verdict = _agrees(text, (a, b), left, right, encoder)
        if verdict is None:
            k += 1
        else:  # the body on that side goes; the join before it is looked at again
            del kept[k - 1 if verdict == "left" else k]
            k = max(0, k - 1)
    edges = [begin, *(x for body in kept for x in body), end]
    return kept, list(zip(edges[::2], edges[1::2]))


def _agrees(text: Text, join: tuple[int, int], left: tuple | None, right: tuple | None, encoder: Encoder) -> str | None:
    """None if the join reads alike by itself and with words around it, else
    the side whose body has no more words to try."""
    a, b = join
    if b - a > LONG_JOIN:
        first, last = bisect_left(text.starts, a + 1), bisect_left(text.starts, b) - 1
        if first < last and text.starts[first] < b:  # an unshared stretch: its ends, each up to a word
            near = _agrees(text, (a, text.ends[first]), left, None, encoder) if left else None
            return near or (_agrees(text, (text.starts[last], b), None, right, encoder) if right else None)
    n = 1
    while left or right:
        begin = text.last_words(left, n) if left else a
        end = text.first_words(right, n) if right else b
        if begin is None or end is None:
            return "left" if begin is None else "right"
        before, alone, after, wide = encoder.memo([text.raw[begin:a], text.raw[a:b], text.raw[b:end], text.raw[begin:end]])
        if wide == before + alone + after:
            return None
        n += 1
    return None


# ---- shared bodies ---------------------------------------------------------------


class Bits:
    """One bit per hash: true for every hash put in and for some others."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def __call__(self, digests: list[bytes]) -> np.ndarray:
        if not len(self.words) or not digests:
            return np.zeros(len(digests), bool)
        slot = slots(digests, 64 * len(self.words))
        return (self.words[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)


def slots(digests: list[bytes], bits: int) -> np.ndarray:
    return np.frombuffer(b"".join(digests), "<u8")[::2] % np.uint64(bits)


def bits_of(hashes: DataFrame, n: int) -> Bits:
    """The bits of ``n`` hashes, put together by Spark: ``MOST_BITS`` at most."""
    if not n:
        return Bits(np.zeros(0, np.uint64))
    size = LEAST_BITS
    while size < min(BITS_EACH * n, MOST_BITS):
        size *= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = slots(batch.column("hash").to_pylist(), size)
            word, bit = (slot >> np.uint64(6)).astype(np.int64), np.uint64(1) << (slot & np.uint64(63))
            yield pa.record_batch([pa.array(word), pa.array(bit.view(np.int64))], ["word", "bit"])

    found = hashes.select("hash").mapInArrow(run, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    words = np.zeros(size // 64, np.uint64)
    words[found.column("word").to_numpy()] = found.column("bit").to_numpy().view(np.uint64)
    return Bits(words)


def shared_bodies(rows: DataFrame) -> DataFrame:
    """``(hash, n)`` of every body that occurs more than once in ``(doc_id, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textops.slices(batches, "text", SLICE_BYTES):
            text = Text(batch.column("text"))
            n = Counter(text.digest(body) for body in text.body if body)
            yield pa.record_batch([pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64())], ["hash", "n"])

    counted = rows.select("text").mapInArrow(run, "hash binary, n long")
    return stage(counted.groupBy("hash").agg(F.sum("n").alias("n")).filter("n > 1"), "bpe-shared")


# ---- documents -------------------------------------------------------------------


def _hits(text: Text, *known: Bits) -> tuple[list[bytes], list[np.ndarray]]:
    """(hash of each chunk's body or b"", for each of ``known`` whether it has it)."""
    held = np.array([body is not None for body in text.body], bool)
    digests = [text.digest(body) for body in text.body if body]
    hits = [np.zeros(len(held), bool) for _ in known]
    for hit, bits in zip(hits, known):
        hit[held] = bits(digests)
    each = iter(digests)
    return [next(each) if h else b"" for h in held], hits


def _alone(rows: DataFrame, path: str, shared: Bits, then: Step, schema: str) -> DataFrame:
    """``(doc_id, ids)`` of the documents without a shared body, through ``then``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in textops.slices(batches, "text", SLICE_BYTES):
            text = Text(batch.column("text"))
            _, (hit,) = _hits(text, shared)
            some = [i for i in range(batch.num_rows) if not hit[text.of[i] : text.of[i + 1]].any()]
            mine = batch.take(pa.array(some, pa.int64()))
            ids = [x.tobytes() for x in encoder.pieces(mine.column("text"))]
            yield pa.record_batch([mine.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return rows.mapInArrow(lambda batches: then(run(batches)), schema)


def _parted(rows: DataFrame, path: str, shared: Bits, hot: Bits) -> DataFrame:
    """The other documents: a row each with the ids of its joins and the
    hashes of its bodies, and a row for every body a task meets first. The
    row key is the task's number and a counter; it holds as the result is
    written once."""
    names = [c.split()[0] for c in PARTS_SCHEMA.split(", ")]
    types = [pa.binary(), pa.int64(), pa.list_(pa.binary()), pa.list_(pa.binary()), pa.list_(pa.int32()), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, task, n, told = Encoder(path), TaskContext.get().partitionId(), 0, set()
        for batch in textops.slices(batches, "text", SLICE_BYTES):
            text = Text(batch.column("text"))
            digests, (hit, warm) = _hits(text, shared, hot)
            docs, joins, found = [], [], {}
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                mine = [j for j in range(text.of[i], text.of[i + 1]) if hit[j]]
                if not mine:
                    continue
                number = {text.body[j]: j for j in mine}
                kept, between = repaired(text, i, list(number), encoder)
                at = [number[body] for body in kept]
                docs.append((struct.pack(">IQ", task, n), doc_id, len(between), [digests[j] for j in at], [n % SALTS if warm[j] else 0 for j in at]))
                joins += between
                found.update((digests[j], text.body[j]) for j in at)
                n += 1
            ids = [x.tobytes() for x in encoder.pieces(pa.array([text.raw[a:b] for a, b in joins], pa.large_binary()))]
            out, at = [], 0
            for row, doc_id, size, hashes, salts in docs:
                out.append((row, doc_id, ids[at : at + size], hashes, salts, None, None))
                at += size
            if len(told) > CACHED_BODIES:
                told.clear()
            out += [(None, None, None, None, None, h, text.raw[a:b]) for h, (a, b) in found.items() if h not in told]
            told.update(found)
            columns = list(zip(*out)) if out else [()] * len(names)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names)

    return stage(rows.mapInArrow(run, PARTS_SCHEMA), "bpe-parts")


def _bodies(parts: DataFrame, path: str, hot: Bits) -> DataFrame:
    """``(hash, salt, ids)``: every body encoded once, frequent ones a row for
    each salt."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in textops.slices(batches, "body", SLICE_BYTES):
            ids = [x.tobytes() for x in encoder.pieces(batch.column("body"))]
            last = np.where(hot(batch.column("hash").to_pylist()), SALTS - 1, 0).astype(np.int32)
            yield pa.record_batch([batch.column("hash"), pa.array(last), pa.array(ids, pa.binary())], ["hash", "last", "ids"])

    once = parts.filter("hash IS NOT NULL").select("hash", "body").dropDuplicates(["hash"])
    table = stage(once.mapInArrow(run, "hash binary, last int, ids binary"), "bpe-bodies")
    return table.select("hash", F.explode(F.sequence(F.lit(0), "last")).alias("salt"), "ids")


def _assembled(parts: DataFrame, bodies: DataFrame, then: Step, schema: str) -> DataFrame:
    """``(doc_id, ids)``: joins and bodies of each document in turn, through ``then``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for kept, got in zip(batch.column("kept").to_pylist(), batch.column("got").to_pylist()):
                got = [x["ids"] for x in got or ()]
                if len(got) + 1 != len(kept):
                    raise AssertionError("a shared body is missing")
                out.append(b"".join(x for pair in zip(kept, [*got, b""]) for x in pair))
            yield pa.record_batch([batch.column("doc_id"), pa.array(out, pa.binary())], ["doc_id", "ids"])

    docs = parts.filter("row IS NOT NULL")
    asked = docs.select("row", F.posexplode(F.arrays_zip("bodies", "salts")).alias("pos", "x"))
    asked = asked.select("row", "pos", F.col("x.bodies").alias("hash"), F.col("x.salts").alias("salt"))
    met = asked.join(bodies, ["hash", "salt"]).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("pos", "ids"))).alias("got"))
    return docs.select("row", "doc_id", "kept").join(met, "row", "left").select("doc_id", "kept", "got").mapInArrow(lambda batches: then(run(batches)), schema)


def _through(df: DataFrame, path: str, id_col: str, text_col: str, then: Step, schema: str) -> DataFrame:
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    twice = shared_bodies(rows)
    often = twice.filter(F.col("n") > HOT)
    shared, hot = bits_of(twice, twice.count()), bits_of(often, often.count())
    alone = _alone(rows, path, shared, then, schema)
    if not len(shared.words):
        return alone
    parts = _parted(rows, path, shared, hot)
    return alone.unionByName(_assembled(parts, _bodies(parts, path, hot), then, schema))


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids)``: the ids of every row's text, of ``id_type``."""
    return _through(df, path, id_col, text_col, lambda batches: batches, ENCODED)


def encode_and_decode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``decode(encode(...))`` without a second pass over the ids."""
    return _through(df, path, id_col, text_col, _decoder(path), DECODED)


# ---- decoding --------------------------------------------------------------------


def _spellings(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all pieces, each with a space after it; where each begins)."""
    spaced = [p + b" " if p is not None else b"" for p in pieces]
    return np.frombuffer(b"".join(spaced), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in spaced])])


@cache
def _tables(path: str) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    tok = _tokenizer(path)
    size = max(tok.get_vocab(with_added_tokens=True).values()) + 1
    pieces = [tok.id_to_token(i) for i in range(size)]
    return _spellings([None if p is None else p.encode() for p in pieces]), _spellings([str(i).encode() for i in range(size)])


def _spelled(ids: np.ndarray, at: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> pa.Array:
    """The spellings of each text's ids, a space between two."""
    data, ends = textops.gather(table[0], table[1], ids)
    edge = ends[at]
    raw = data.tobytes()
    return pa.array([raw[a : max(a, b - 1)].decode() for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())], pa.string())


def _decoder(path: str) -> Step:
    kind = np.dtype(id_type(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, numbers = _tables(path)
        for batch in textops.slices(batches, "ids", SLICE_BYTES // 4):
            data, offsets = textops.buffers(batch.column("ids"))
            ids, at = np.frombuffer(data.tobytes(), kind).astype(np.int64), offsets // kind.itemsize
            columns = [batch.column("doc_id"), pa.array(np.diff(at), pa.int64()), _spelled(ids, at, numbers), _spelled(ids, at, pieces)]
            yield pa.record_batch(columns, ["doc_id", "n_tokens", "spelled", "text"])

    return run


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``(doc_id, n_tokens, spelled, text)`` of ``(doc_id, ids)``: the ids in
    decimal and the decoded text, both with a space between two."""
    return encoded.select("doc_id", "ids").mapInArrow(_decoder(path), DECODED)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    read_back = encode_and_decode(read(spark, sf_dir, "documents"), path)
    return read_back.select("doc_id", "n_tokens", F.sha2("spelled", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))
