"""Repeated passages by column-wise suffix sorting of many documents.

A byte goes if it is covered by a string of ``LENGTH`` bytes that also starts
anywhere else, in this text or another. The steps:

1. Every window of ``LENGTH`` bytes picks the leftmost smallest hash among its
   ``GRAM``-byte strings. Equal windows pick the same string at the same
   distance, so repeated windows can only be found around picked strings
   ("anchors", about one in a hundred bytes) that occur twice. Anchors are
   counted by ranges of their hash, mixed again, in packed arrays.
2. The surroundings of each repeated anchor, LENGTH - GRAM bytes before it to
   LENGTH bytes from it, are one short document of a collection; equal
   documents of a task travel once, with a mark.
3. Each part of the collection is sorted column by column from its end: a
   round inserts one symbol of every document in front of the suffixes sorted
   so far. The order of the previous round, stably split by the new symbol, is
   the new order; the common prefix of two neighbours that got the same symbol
   is one more than the smallest between them before. (This is the collection
   Burrows-Wheeler transform, kept per column: all documents are aligned at
   their anchor, so only suffixes of one column meet, and a round costs the
   number of documents instead of the size of the transform so far.) A suffix
   whose common prefix with a neighbour reaches LENGTH starts a repeated
   window.
4. The windows' union is cut out of the texts that have any.

The sequential files between the rounds' parts are Spark's shuffle files.
Texts travel compressed, and only those with repeated anchors.

Defined cases: null text has no bytes; texts shorter than LENGTH lose none;
repeated rows are documents of their own (each makes the other's windows
repeated); rows with a null or repeated id are told apart by their content;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import textops
from tidemark.llm.rolling import LETTERS, mix, powers
from tidemark.llm.staging import maybe_among, read, stage

NAME = "op7_suffix_dedup"
ORACLE_SQL = None
LENGTH = 400
GRAM = 200
SLICE_BYTES = 1 << 18
PART_ANCHORS = 1 << 18
PART_DOCUMENTS = 1 << 14
SORT_DOCUMENTS = 1 << 11
FLUSH_BYTES = 4 << 20
END = 256  # a place behind a text's end; equals nothing


# ---- anchors ---------------------------------------------------------------------

#: Bits of a position in a batch of texts; the hash's other bits rank strings.
POSITION_BITS = 32


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of the string that each window of ``length`` bytes
    within a text picks, each once."""
    n = len(data)
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    up, down = powers(max(n, SLICE_BYTES))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(LETTERS[data] * up[:n])])
    hashes = mix((sums[gram:] - sums[: n - gram + 1]) * down[: n - gram + 1])
    low = np.uint64((1 << POSITION_BITS) - 1)  # as many for every batch, so that equal windows pick alike
    ranked = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)  # the leftmost of equal hashes
    width = length - gram + 1
    pad = -len(ranked) % width
    blocks = np.concatenate([ranked, np.full(pad, ~np.uint64(0))]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    count = n - length + 1
    best = np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])
    inside = np.zeros(n + 1, np.int8)
    sizes = np.diff(offsets)
    long = sizes >= length
    inside[offsets[:-1][long]] += 1
    inside[offsets[1:][long] - length + 1] -= 1
    picked = (best[np.cumsum(inside[:count]).astype(bool)] & low).astype(np.int64)
    picked = picked[np.diff(picked, prepend=-1) != 0]
    return picked, hashes[picked]


def text_anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``anchors`` in stretches of bounded bytes."""
    if len(data) <= 2 * SLICE_BYTES:
        return anchors(data, offsets)
    found = []
    for a in range(0, len(data), SLICE_BYTES):
        b = min(len(data), a + SLICE_BYTES + LENGTH - 1)
        inner = offsets[(offsets > a) & (offsets < b)]
        at, h = anchors(data[a:b], np.concatenate([[a], inner, [b]]) - a)
        found.append((at + a, h))
    at, h = (np.concatenate(c) for c in zip(*found))
    at, first = np.unique(at, return_index=True)
    return at, h[first]


def part_of(h: np.ndarray, bits: int) -> np.ndarray:
    """The part of each anchor. An anchor is the smallest hash of a window, so
    its own first bits are nearly always zero: they are mixed once more."""
    return (mix(h) >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)


def _anchor_rows(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textops.slices(batches, "text", 4 * SLICE_BYTES):
            data, offsets = textops.buffers(batch.column("text"))
            key = batch.column("key").to_numpy()
            at, h = text_anchors(data, offsets)
            of = np.searchsorted(offsets, at, "right") - 1
            part = part_of(h, bits)
            by = np.argsort(part, kind="stable")
            at, h, of, part = at[by] - offsets[of[by]], h[by], of[by], part[by]
            edges = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
            rows = [h[a:b].astype("<u8").tobytes() + key[of[a:b]].astype("<i8").tobytes() + at[a:b].astype("<i8").tobytes() for a, b in zip(edges[:-1], edges[1:])]
            yield pa.record_batch([pa.array(part[edges[:-1]], pa.int64()), pa.array(rows, pa.binary())], ["part", "packed"])

    return run


def _repeated_anchors(pdf: pd.DataFrame) -> pd.DataFrame:
    columns = ([], [], [])
    for packed in pdf["packed"]:
        size = len(packed) // 24
        for i, c in enumerate(columns):
            c.append(np.frombuffer(packed, "<i8", size, 8 * size * i))
    h, key, at = (np.concatenate(c) for c in columns)
    by = np.argsort(h, kind="stable")
    h, key, at = h[by], key[by], at[by]
    same = np.zeros(len(h) + 1, bool)
    same[1:-1] = h[1:] == h[:-1]
    many = same[1:] | same[:-1]
    return pd.DataFrame({"anchor": h[many], "key": key[many], "at": at[many]})


# ---- the collection --------------------------------------------------------------


def repeated_starts(group: np.ndarray, symbols: np.ndarray, length: int = LENGTH, starts: int = LENGTH - GRAM + 1) -> np.ndarray:
    """Where repeated strings of ``length`` symbols start.

    ``symbols`` is columns x documents, aligned; documents of one ``group``
    are compared. Returns booleans, ``starts`` first columns x documents.
    """
    columns, n = symbols.shape
    order = np.argsort(group, kind="stable")  # documents by suffix; empty suffixes are equal
    lcp = np.zeros(n + 1, np.int64)  # with the one before; a sentinel at the end
    found = np.zeros((starts, n), bool)
    edge = np.ones(n, bool)
    edge[1:] = group[order][1:] != group[order][:-1]
    run = np.cumsum(edge) - 1
    for column in range(columns - 1, -1, -1):
        symbol = symbols[column][order]
        rank = np.argsort(run * (END + 1) + symbol, kind="stable")  # places in the old order
        s = symbol[rank]
        equal = np.zeros(n, bool)
        equal[1:] = (s[1:] == s[:-1]) & (s[1:] != END) & ~edge[1:]
        to = np.flatnonzero(equal)
        fresh = np.zeros(n + 1, np.int64)
        if len(to):
            a, b = rank[to - 1] + 1, rank[to]
            near = a == b
            least = lcp[b].copy()
            far = np.flatnonzero(~near)
            if len(far):
                pairs = np.stack([a[far], b[far] + 1], 1).reshape(-1)
                least[far] = np.minimum.reduceat(lcp, pairs)[::2]
            whole = column == columns - 1
            fresh[to] = 1 if whole else least + 1
        order, lcp = order[rank], fresh
        if column < starts:
            best = np.maximum(lcp[:-1], lcp[1:])
            found[column, order] = best >= length
    return found


DOCUMENT_BYTES = 2 * LENGTH - GRAM


def _documents(bits: int):
    """Texts with anchors -> packed collections by part of the anchor's hash."""
    before = LENGTH - GRAM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        size = 0

        def flush():
            parts: dict[int, list] = {}
            number = part_of(np.array([anchor for anchor, _ in held], np.int64).view(np.uint64), bits).tolist()
            for n, ((anchor, body), places) in zip(number, held.items()):
                parts.setdefault(n, []).append((anchor, body, places))
            numbers, rows = [], []
            for number, some in parts.items():
                head = np.array([(a, len(p)) for a, _, p in some], "<i8").tobytes()
                places = np.array([x for _, _, p in some for x in p], "<i8").tobytes()
                lengths = np.array([len(b) for _, b, _ in some], "<i4").tobytes()
                blob = b"".join((np.array([len(some)], "<i8").tobytes(), head, lengths, b"".join(b for _, b, _ in some), places))
                numbers.append(number)
                rows.append(zstandard.compress(blob, 1))
            return pa.record_batch([pa.array(numbers, pa.int64()), pa.array(rows, pa.binary())], ["part", "packed"])

        for batch in textops.slices(batches, "text", SLICE_BYTES):
            for row in batch.to_pylist():
                text = zstandard.decompress(row["text"])
                for anchor, at in zip(row["anchors"], row["ats"]):
                    left = max(0, at - before)
                    # the missing left bytes count, so that documents stay aligned
                    body = (before - (at - left)).to_bytes(4, "little") + text[left : at + LENGTH]
                    places = held.setdefault((anchor, body), [])
                    if not places:
                        size += len(body) + 150
                    places.append((row["key"], at - before))
                    size += 32
                if size >= FLUSH_BYTES:
                    yield flush()
                    held, size = {}, 0
        if held:
            yield flush()

    return run


def _collection(parts) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """(anchor, body, count) of the distinct documents of packed collections,
    and the places of each document's copies one after another."""
    known: dict[tuple[int, bytes], int] = {}
    owners, places = [], []
    for packed in parts:
        blob = zstandard.decompress(packed)
        n = int(np.frombuffer(blob, "<i8", 1)[0])
        head = np.frombuffer(blob, "<i8", 2 * n, 8).reshape(n, 2)
        at = 8 + 20 * n
        numbers = []
        for anchor, size in zip(head[:, 0].tolist(), np.frombuffer(blob, "<i4", n, 8 + 16 * n).tolist()):
            numbers.append(known.setdefault((anchor, blob[at : at + size]), len(known)))
            at += size
        owners.append(np.repeat(np.array(numbers, np.int64), head[:, 1]))
        places.append(np.frombuffer(blob, "<i8", int(2 * head[:, 1].sum()), at).reshape(-1, 2).copy())  # not the whole blob
    owner = np.concatenate(owners)
    by = np.argsort(owner, kind="stable")
    group = np.fromiter((anchor for anchor, _ in known), np.int64, len(known))
    return group, [body for _, body in known], np.bincount(owner, minlength=len(known)), np.concatenate(places)[by]


def _intervals(pdf: pd.DataFrame) -> pd.DataFrame:
    """Repeated stretches [start, end) of each text, from one part."""
    group, bodies, counts, places = _collection(pdf["packed"])
    out = []
    before = np.cumsum(counts) - counts
    by = np.argsort(group, kind="stable")
    cuts = np.flatnonzero(np.diff(group[by], prepend=group[by[0]] - 1, append=group[by[-1]] + 1))
    at = 0
    while at < len(cuts) - 1:  # whole groups, about SORT_DOCUMENTS documents at a time
        to = max(at + 1, int(np.searchsorted(cuts, cuts[at] + SORT_DOCUMENTS, "right")) - 1)
        some = by[cuts[at] : cuts[to]]
        at = to
        symbols = np.full((DOCUMENT_BYTES, len(some)), END, np.int16)
        gaps = [int.from_bytes(bodies[j][:4], "little") for j in some]
        for i, (j, gap) in enumerate(zip(some, gaps)):
            symbols[gap : gap + len(bodies[j]) - 4, i] = np.frombuffer(bodies[j], np.uint8, offset=4)
        found = repeated_starts(group[some], symbols)
        del symbols
        for i in np.flatnonzero(counts[some] > 1):  # equal documents: all their windows
            gap, size = gaps[i], len(bodies[some[i]]) - 4
            found[gap : max(gap, min(len(found), gap + size - LENGTH + 1)), i] = True
        edge = np.diff(found.T.astype(np.int8), axis=1, prepend=0, append=0)
        i, first = np.nonzero(edge == 1)
        _, last = np.nonzero(edge == -1)
        if len(i):
            times = counts[some[i]]
            index = np.repeat(before[some[i]], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            where = places[index]
            out.append(np.column_stack([where[:, 0], where[:, 1] + np.repeat(first, times), where[:, 1] + np.repeat(last, times) + LENGTH - 1]))
    rows = np.concatenate(out) if out else np.zeros((0, 3), np.int64)
    return pd.DataFrame(rows, columns=["key", "begin", "end"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            text = zstandard.decompress(row["text"])
            spans = merge(row["spans"])
            kept, at = [], 0
            for a, b in spans:
                kept.append(text[at:a])
                at = b
            kept = b"".join([*kept, text[at:]])
            rows.append({"doc_id": row["doc_id"], "key": row["key"], "n_removed": sum(b - a for a, b in spans), "n_spans": len(spans), "kept": kept})
        yield pa.RecordBatch.from_pylist(rows, CUT)


CUT = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])


def merge(spans: list) -> list[tuple[int, int]]:
    """Maximal runs of the union of [begin, end) spans."""
    out: list[tuple[int, int]] = []
    for s in sorted((s["begin"], s["end"]) for s in spans):
        if out and s[0] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], s[1]))
        else:
            out.append(s)
    return out


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in textops.slices(batches, "text", 4 * SLICE_BYTES):
        data, offsets = textops.buffers(batch.column("text"))
        packed = [zstandard.compress(data[a:b].tobytes(), 1) for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.record_batch([batch.column("doc_id"), batch.column("key"), pa.array(packed, pa.binary())], ["doc_id", "key", "text"])


def _bits(rows: int, per_part: int) -> int:
    return max(0, int(rows / per_part).bit_length())


def keyed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, key, text): ``key`` is a hash of the id and the text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    doc = F.col(id_col).cast("long")
    return df.select(doc.alias("doc_id"), F.xxhash64(doc, text).alias("key"), text.alias("text"))


def cut_repeats(docs: DataFrame) -> DataFrame:
    """Of ``keyed`` texts those that lose bytes: ``(doc_id, key, n_removed,
    n_spans, kept)``, a row per distinct (doc_id, key)."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    found = docs.select("key", "text").mapInArrow(_anchor_rows(_bits(size * 2 // (LENGTH - GRAM), PART_ANCHORS)), "part long, packed binary")
    found = stage(found.groupBy("part").applyInPandas(_repeated_anchors, "anchor long, key long, at long"), "suffix-anchors")
    by_text = stage(found.groupBy("key").agg(F.collect_list("anchor").alias("anchors"), F.collect_list("at").alias("ats")), "suffix-places")
    texts = docs.filter(maybe_among(by_text, "key", F.col("key"))).mapInArrow(_compress, "doc_id long, key long, text binary")
    texts = stage(texts.join(by_text.select("key"), "key", "left_semi"), "suffix-texts")
    total = found.count()
    places = texts.select("key", "text").dropDuplicates(["key"]).join(by_text, "key")
    packed = places.mapInArrow(_documents(_bits(total, PART_DOCUMENTS)), "part long, packed binary")
    spans = packed.groupBy("part").applyInPandas(_intervals, "key long, begin long, end long")
    spans = stage(spans, "suffix-spans").groupBy("key").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    distinct = texts.dropDuplicates(["doc_id", "key"]).join(spans, "key")
    return distinct.mapInArrow(_cut, "doc_id long, key long, n_removed long, n_spans long, kept binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = keyed(read(spark, sf_dir, "documents"))
    cut = cut_repeats(docs).select(
        F.col("doc_id").alias("__id"), F.col("key").alias("__key"), "n_removed", "n_spans", F.sha2("kept", 256).alias("__sha")
    )
    cut = stage(cut, "suffix-cut")
    rows = docs.select("doc_id", "key", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("__whole"))
    zero = F.lit(0).cast("long")
    return rows.join(cut, (rows["key"] == cut["__key"]) & rows["doc_id"].eqNullSafe(cut["__id"]), "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("__sha", "__whole").alias("kept_sha256"),
    )
