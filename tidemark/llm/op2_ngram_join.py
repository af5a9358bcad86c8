"""N-gram Jaccard join: rare-first prefix filtering, one check per pair.

A text's set holds its distinct 5-word shingles as 64-bit hashes. Two texts
link when 100 * intersection >= 75 * union. The steps:

1. One scan gives each text's set size and a 128-bit fingerprint of its set
   (texts with equal sets are one class, linked without a check) and counts
   all shingles in ``CELLS`` hash cells. Shingles are ordered by (count of
   their cell, hash): rarest first, one order for the whole corpus. The
   counts are 8 MiB whatever the input.
2. A second scan emits the first n - ceil(0.75 n) + 1 shingles of each class.
   Two classes that link share one of them. They are grouped by ranges of the
   hash in packed arrays; only lists of at least two classes go on.
3. Length filter (0.75 n <= m) and positional filter: at the first shingle that
   two classes share, both have as many shingles left as a link needs. A list
   is dropped if no member has as many left as a link to one of its own size
   needs; lists with the same members count once, at each member's first
   position in them. Every member of a list meets the list's
   hub; then the hub leaves the list, and what is left of lists with members
   of several components elects the next hub, for ``HUB_ROUNDS`` rounds; in a
   last one every two members of different components meet. That gives the
   components, and no link between different components is lost.
4. The suffix filter bounds a pair's overlap by its shingle counts in
   ``SUFFIX_CELLS`` hash ranges; what remains is checked by the exact
   intersection of the two texts' sets.
5. ``ngram_components`` ends there. ``ngram_join`` also gives all links:
   linked classes share a list and a component. A component's classes are
   dealt by size and a salt into blocks of about ``BLOCK_CLASSES`` classes or
   ``BLOCK_SHINGLES`` shingles; every block, and every two blocks with
   neighbouring sizes that share a list of the component, are intersected pair
   by pair. That gives all links: as many rows as there are linked pairs of
   different classes, so a group of k near copies may return k * (k - 1) / 2.

A text travels compressed, and only texts of listed classes travel. The
component's id is the smallest document id in it. A document's ``n_links`` is
the number of other rows that it links with, copies included.

Defined cases: null or wordless text has an empty set, linked with nothing;
fewer than five words are one shingle; repeated rows and equal texts are one
class; rows without an id get their class's component (null if no member has
an id) but start no component of their own; a wordless text has no links, not
even with its copies; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import textops
from tidemark.llm.components import components
from tidemark.llm.rolling import LETTERS, mix, powers
from tidemark.llm.staging import maybe_among, read, stage

NAME = "op2_ngram_join"
WORDS = 5
PERCENT = 75
CELLS = 1 << 20
CELL_CHUNK = 1 << 16
SUFFIX_CELLS = 128
PART_POSTINGS = 1 << 18
#: Rounds in which the members of a list that are not yet connected meet one hub of it.
HUB_ROUNDS = 4
BLOCK_CLASSES, BLOCK_SHINGLES = 256, 1 << 16
#: Postings that a task sends at once, a batch of Arrow; classes it remembers.
FLUSH_POSTINGS, SEEN_CLASSES = 1 << 18, 1 << 16
SLICE_BYTES = 2 << 20
SPAN = 1 << 20

ORACLE_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {WORDS} THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - {WORDS - 2}), lambda i: array_to_string(w[i:i + {WORDS - 1}], ' '))) END AS s FROM w
), e AS (SELECT doc_id, len(s) AS n, md5(unnest(s)) AS g FROM s),
o AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {PERCENT} * (a.n + b.n - count(*))
), l AS (SELECT a, b FROM o UNION ALL SELECT b, a FROM o),
r(doc_id, c) AS (SELECT a, b FROM l UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.c = l.a)
SELECT s.doc_id, len(s)::BIGINT AS n_shingles, least(s.doc_id, coalesce(min(c), s.doc_id)) AS component_id
FROM s LEFT JOIN r ON s.doc_id = r.doc_id GROUP BY s.doc_id, s
"""

# ---- sets ------------------------------------------------------------------------

_STEP, _SALT = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xBF58476D1CE4E5B9)
#: Bytes' numbers with those of a-z for A-Z.
FOLDED = np.concatenate([LETTERS[:65], LETTERS[97:123], LETTERS[91:]])


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, A-Z read as a-z, in stretches of bytes."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + SPAN, "right")))
        begin, end = starts[at], ends[to - 1]
        up, down = powers(max(SPAN, int(end - begin)))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(FOLDED[data[begin:end]] * up[: end - begin])])
        a, b = starts[at:to] - begin, ends[at:to] - begin
        out[at:to] = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))
        at = to
    return out


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    starts, ends, at = textops.words(data, offsets)
    words = word_hashes(data, starts, ends)
    n = max(len(words) - WORDS + 1, 0)
    grams = words[:n].copy()
    for k in range(1, WORDS):
        grams = grams * _STEP + words[k : n + k]
    grams = mix(grams)
    sets = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= WORDS:
            sets.append(np.unique(grams[a : b - WORDS + 1]))
        elif b > a:
            whole = np.array([b - a], np.uint64)
            for k in range(a, b):
                whole = whole * _STEP + words[k : k + 1]
            sets.append(mix(whole))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def fingerprint(one: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed longs."""
    first, second = mix(one + _SALT).sum(dtype=np.uint64), mix(one ^ _STEP).sum(dtype=np.uint64)
    return int(first.astype(np.int64)), int((second + np.uint64(len(one))).astype(np.int64))


def cell(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - (CELLS - 1).bit_length())).astype(np.int64)


def needed(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The smallest overlap at which sets of n and m shingles link."""
    return -(-PERCENT * (n + m) // (100 + PERCENT))


def prefix_size(n: int) -> int:
    return n - -(-PERCENT * n // 100) + 1


# ---- scans -----------------------------------------------------------------------

SCAN_SCHEMA = "doc_id long, key string, n long, f1 long, f2 long, chunk int, counts binary"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per text; at the end of the task its counts by cell."""
    counts = np.zeros(CELLS, np.int64)
    names = [c.split()[0] for c in SCAN_SCHEMA.split(", ")]
    for batch in textops.slices(batches, "text", SLICE_BYTES):
        sets = shingle_sets(*textops.buffers(batch.column("text")))
        counts += np.bincount(cell(np.concatenate(sets)), minlength=CELLS)
        prints = [fingerprint(s) for s in sets]
        columns = [batch.column("doc_id"), batch.column("key"), *(pa.array(c, pa.int64()) for c in ([len(s) for s in sets], [a for a, _ in prints], [b for _, b in prints]))]
        yield pa.record_batch([*columns, pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())], names)
    if counts.any():
        chunks = range(CELLS // CELL_CHUNK)
        packed = [zstandard.compress(counts[i * CELL_CHUNK : (i + 1) * CELL_CHUNK].tobytes(), 1) for i in chunks]
        none = pa.nulls(len(packed), pa.int64())
        yield pa.record_batch([none, pa.nulls(len(packed), pa.string()), none, none, none, pa.array(chunks, pa.int32()), pa.array(packed, pa.binary())], names)


def _add(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(CELL_CHUNK, np.int64)
    for packed in pdf["counts"]:
        total += np.frombuffer(zstandard.decompress(packed), np.int64)
    return pd.DataFrame({"chunk": pdf["chunk"].iloc[:1], "counts": [total.tobytes()]})


def _postings(counts, part_bits: int):
    """Rows of (part, packed postings): the prefix of every set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = counts.value
        seen: set[int] = set()
        held: list[tuple] = []
        size = 0

        def flush():
            key, f1, n, pos = (np.concatenate(c) for c in zip(*held))
            key = mix(key)  # of equally rare shingles a prefix has the smallest hashes; parts must not follow them
            part = (key >> np.uint64(64 - part_bits)).astype(np.int64) if part_bits else np.zeros(len(key), np.int64)
            by = np.lexsort((key, part))
            part, key, f1, n, pos = (c[by] for c in (part, key, f1, n, pos))
            edges = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
            low = (key << np.uint64(part_bits) >> np.uint64(32)).astype("<u4")
            rows = [
                b"".join((low[a:b].tobytes(), f1[a:b].astype("<i8").tobytes(), n[a:b].astype("<u4").tobytes(), pos[a:b].astype("<u4").tobytes()))
                for a, b in zip(edges[:-1], edges[1:])
            ]
            return pa.record_batch([pa.array(part[edges[:-1]], pa.int64()), pa.array(rows, pa.binary())], ["part", "packed"])

        for batch in textops.slices(batches, "text", SLICE_BYTES):
            for one in shingle_sets(*textops.buffers(batch.column("text"))):
                f1 = fingerprint(one)[0]
                if not len(one) or f1 in seen:
                    continue
                seen.add(f1)
                k = prefix_size(len(one))
                first = one[np.lexsort((one, order[cell(one)]))[:k]]
                held.append((first, np.full(k, f1, np.int64), np.full(k, len(one), np.int64), np.arange(k)))
                size += k
            if size >= FLUSH_POSTINGS:
                yield flush()
                held, size = [], 0
                if len(seen) > SEEN_CLASSES:
                    seen = set()
        if held:
            yield flush()

    return run


LINK_SCHEMA = "a string, b string, overlap long, copies_a long, copies_b long"
LIST_SCHEMA = "list long, f1 long, n long, pos long, hub long"


def _fits(n, p, m, q) -> np.ndarray:
    """Length and positional filters for sizes n, m and positions p, q, as they
    hold at the first shingle that the two sets share."""
    can = np.minimum(n - p, m - q)
    return (100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)) & (can >= needed(n, m))


def _lists(pdf: pd.DataFrame) -> pd.DataFrame:
    """Postings of shingles that several classes share, of which two may fit; and, without a list,
    the distinct pairs of members with their list's hub that the filters let
    meet. The hub is the member of the smallest fingerprint: lists of one
    group of copies then have few different hubs."""
    columns = ([], [], [], [])
    for packed in pdf["packed"]:
        size = len(packed) // 20
        at = 0
        for c, kind in zip(columns, ("<u4", "<i8", "<u4", "<u4")):
            width = int(kind[2])
            c.append(np.frombuffer(packed, kind, size, at))
            at += size * width
    key, f1, n, pos = (np.concatenate(c).astype(np.int64) for c in columns)
    by = np.lexsort((pos, f1, key))
    key, f1, n, pos = (c[by] for c in (key, f1, n, pos))
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (f1[1:] != f1[:-1])  # copies read by several tasks
    key, f1, n, pos = (c[fresh] for c in (key, f1, n, pos))
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    head = np.flatnonzero(first)
    length = np.diff(np.append(head, len(key)))
    number = np.repeat(np.arange(len(head)), length)
    own = np.flatnonzero(~first)
    hub = head[number[own]]
    meets = _fits(n[hub], pos[hub], n[own], pos[own])
    met = np.unique(np.stack([f1[own[meets]], f1[hub[meets]]], 1), axis=0)
    early = np.maximum.reduceat((n - pos >= needed(n, n)).astype(np.int64), head)  # of two that fit, the smaller one is early
    alone = np.ones(len(head), np.int64)  # the hub and the only other member do not fit
    alone[number[own[meets]]] = 0
    many = ((length > 2) & (early > 0) | (length == 2) & (alone == 0))[number]
    shared = int(pdf["part"].iloc[0]) << 32 | key
    lists = pd.DataFrame({"list": shared, "f1": f1, "n": n, "pos": pos})[many]
    pairs = pd.DataFrame({"f1": met[:, 0], "hub": met[:, 1]})
    columns = ["list", "f1", "n", "pos", "hub"]
    return pd.concat([x.reindex(columns=columns).astype("Int64") for x in (lists, pairs)], ignore_index=True)


def _same_members(lists: DataFrame, member: str = "f1") -> DataFrame:
    """One list of each set of members: the shingles of a shared passage
    have the same members, and one of them says all about who meets whom."""
    members = lists.groupBy("list").agg(
        F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64(member)).alias("x"), F.bit_xor(F.xxhash64(member, F.lit(1))).alias("y")
    )
    if "pos" not in lists.columns:
        return lists.join(members.groupBy("size", "x", "y").agg(F.min("list").alias("list")).select("list"), "list", "left_semi")
    kind = F.struct("size", "x", "y")
    return lists.join(members, "list").groupBy(kind.alias("kind"), member, "n").agg(F.min("pos").alias("pos"), F.min("list").alias("list")).drop("kind")


def suffix_counts(one: np.ndarray) -> np.ndarray:
    """A set's shingles by hash range."""
    return np.bincount((one >> np.uint64(64 - (SUFFIX_CELLS - 1).bit_length())).astype(np.int64), minlength=SUFFIX_CELLS)


def _pack_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in textops.slices(batches, "text", SLICE_BYTES):
        data, offsets = textops.buffers(batch.column("text"))
        sets = shingle_sets(data, offsets)
        prints = [fingerprint(s) for s in sets]
        cells = [suffix_counts(s).astype("<u4" if len(s) >> 16 else "<u2").tobytes() for s in sets]
        packed = [zstandard.compress(data[a:b].tobytes(), 3) for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.record_batch(
            [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in zip(*prints)), pa.array([len(s) for s in sets], pa.int64()),
             pa.array(cells, pa.binary()), pa.array(packed, pa.binary())],
            ["doc_id", "f1", "f2", "n", "cells", "text"],
        )


def _suffix_filter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose overlap can still reach the needed one: at most the sum of
    the smaller counts in each hash range."""

    def counts(value: bytes) -> np.ndarray:
        return np.frombuffer(value, "<u2" if len(value) == 2 * SUFFIX_CELLS else "<u4")

    for batch in batches:
        rows = batch.to_pylist()
        can = [int(np.minimum(counts(r["ca"]), counts(r["cb"])).sum()) >= int(needed(r["na"], r["nb"])) for r in rows]
        yield batch.select(["a", "b"]).filter(pa.array(can, pa.bool_()))


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, texts) that link, with their overlap."""

    @cache
    def one(packed: bytes) -> np.ndarray:
        text = np.frombuffer(zstandard.decompress(packed), np.uint8)
        return shingle_sets(text, np.array([0, len(text)]))[0]

    for batch in batches:
        a, b, overlap = [], [], []
        for row in batch.to_pylist():
            if one.cache_info().currsize > 256:
                one.cache_clear()
            x, y = one(row["ta"]), one(row["tb"])
            common = len(np.intersect1d(x, y, assume_unique=True))
            if common >= int(needed(len(x), len(y))):
                a.append(row["a"])
                b.append(row["b"])
                overlap.append(common)
        yield pa.record_batch([pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(overlap, pa.int64())], ["a", "b", "overlap"])


def _check_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All links between the classes of two blocks, or (``ys`` is null) within
    one, with their overlap and both classes' rows."""

    def sets(block: list[dict]) -> tuple[np.ndarray, np.ndarray]:
        data = [zstandard.decompress(r["text"]) for r in block]
        at = np.concatenate([[0], np.cumsum([len(x) for x in data])])
        found = shingle_sets(np.frombuffer(b"".join(data), np.uint8), at)
        return np.concatenate(found), np.array([len(x) for x in found], np.int64)

    for batch in batches:
        for row in batch.to_pylist():
            xs, ys = row["xs"], row["ys"]
            hashes, n = sets(xs)
            known, index = np.unique(hashes, return_inverse=True)
            at = np.concatenate([[0], np.cumsum(n)])
            if ys is None:
                ys, m, begin, place, there = xs, n, at[:-1], index, np.ones(len(index), bool)
            else:
                hashes, m = sets(ys)
                place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                there = known[place] == hashes
                begin = np.concatenate([[0], np.cumsum(m)])[:-1]
            out = []
            for i, x in enumerate(xs):
                mark = np.zeros(len(known), bool)
                mark[index[at[i] : at[i + 1]]] = True
                overlap = np.add.reduceat((mark[place] & there).astype(np.int64), begin)
                links = overlap >= needed(n[i], m)
                if ys is xs:
                    links[: i + 1] = False
                for j in np.flatnonzero(links).tolist():
                    a, b = sorted((x, ys[j]), key=lambda r: r["class"])
                    out.append((a["class"], b["class"], int(overlap[j]), a["copies"], b["copies"]))
            if out:
                kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64())
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], [c.split()[0] for c in LINK_SCHEMA.split(", ")])


# ---- the join --------------------------------------------------------------------


def _class(f1: str = "f1", f2: str = "f2"):
    return F.concat(F.lpad(F.hex(f1), 16, "0"), F.lpad(F.hex(f2), 16, "0"))


def _of_representatives(rows: DataFrame, listed: DataFrame) -> DataFrame:
    """For each class of ``listed`` (class, rep) one of its ``rows`` with the
    id rep. The join's keys are never null and are also those of equal rows,
    so that texts are shuffled once."""
    keys = ["class", "__id", "__none"]

    def keyed(df: DataFrame, id_col: str) -> DataFrame:
        return df.withColumns({"__id": F.coalesce(id_col, F.lit(0).cast("long")), "__none": F.col(id_col).isNull()})

    found = keyed(rows, "doc_id").join(keyed(listed, "rep").select(keys), keys, "left_semi")
    return found.dropDuplicates(keys).select(*rows.columns)


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    small = texts.select("class", "n", "cells")
    rows = pairs.join(small.toDF("a", "na", "ca"), "a").join(small.toDF("b", "nb", "cb"), "b")
    left = stage(rows.select("a", "b", "na", "nb", "ca", "cb").mapInArrow(textops.freed(_suffix_filter), "a string, b string"), "ngram-candidates")
    ends = left.select(F.explode(F.array("a", "b")).alias("class"))
    whole = texts.filter(maybe_among(ends, "class", F.col("class"), 2 * left.count())).select("class", "text")
    rows = left.join(whole.toDF("a", "ta"), "a").join(whole.toDF("b", "tb"), "b").select("a", "b", "ta", "tb")
    return rows.mapInArrow(textops.freed(_check), "a string, b string, overlap long")


def _all_links(texts: DataFrame, lists: DataFrame, roots: DataFrame, classes: DataFrame) -> DataFrame:
    """Every two classes that link, as ``LINK_SCHEMA``. ``roots`` is (class,
    root) of the classes with a link, ``lists`` (list, class) of those."""
    grade = F.floor(F.log("n") / F.log(F.lit(100 / PERCENT))).alias("grade")  # linked sizes are at most one apart
    placed = roots.join(classes.select("class", "copies", "n"), "class").select("class", "root", "copies", "n", grade)
    most = F.greatest(F.count(F.lit(1)) / BLOCK_CLASSES, F.sum("n") / BLOCK_SHINGLES)
    cells = placed.groupBy("root", "grade").agg(F.ceil(most).alias("blocks"))
    salt = F.pmod(F.xxhash64("class"), F.col("blocks"))
    block = F.concat_ws(":", "root", F.col("grade").cast("string"), salt.cast("string")).alias("block")
    placed = stage(placed.join(cells, ["root", "grade"]).select("class", "copies", "root", "grade", block), "ngram-placed")
    row = F.struct("class", "copies", "text").alias("row")
    blocks = texts.select("class", "text").join(placed, "class").select("block", row)
    blocks = stage(blocks.groupBy("block").agg(F.collect_list("row").alias("xs")), "ngram-blocks")  # of bounded size

    at = lists.join(placed, "class").select(F.concat_ws(":", "list", "root").alias("list"), "block", "grade").distinct()
    several = at.groupBy("list").agg(F.min("block").alias("lo"), F.max("block").alias("hi")).filter("lo != hi").select("list")
    at = stage(at.join(several, "list", "left_semi"), "ngram-block-lists")
    at = stage(_same_members(at, "block"), "ngram-block-pairs")
    x, y = at.alias("x"), at.alias("y")
    meet = x.join(y, (F.col("x.list") == F.col("y.list")) & (F.col("x.block") < F.col("y.block")) & F.expr("abs(x.grade - y.grade) <= 1"))
    meet = meet.select(F.col("x.block").alias("a"), F.col("y.block").alias("b")).distinct()
    cross = meet.join(blocks.toDF("a", "xs"), "a").join(blocks.toDF("b", "ys"), "b").select("xs", "ys")
    own = blocks.filter(F.size("xs") > 1).select("xs", F.lit(None).cast(blocks.schema["xs"].dataType).alias("ys"))
    return stage(own.unionByName(cross).mapInArrow(textops.freed(_check_blocks), LINK_SCHEMA), "ngram-all-links")


def _scanned(df: DataFrame, id_col: str, text_col: str, key_col: str | None) -> tuple[DataFrame, DataFrame, DataFrame, np.ndarray]:
    """(id and text of each row, id, size and class of each row, classes, counts by cell)."""
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    key = F.lit(None).cast("string") if key_col is None else F.col(key_col)
    keyed = df.select(F.col(id_col).cast("long").alias("doc_id"), key.alias("key"), F.col(text_col).alias("text"))
    scanned = stage(keyed.mapInArrow(textops.freed(_scan), SCAN_SCHEMA), "ngram-scan")
    rows = scanned.filter("chunk IS NULL").select("doc_id", "key", "n", "f1", _class().alias("class"))
    cells = scanned.filter("chunk IS NOT NULL").select("chunk", "counts").groupBy("chunk").applyInPandas(_add, "chunk int, counts binary")
    counts = np.zeros(CELLS, np.int64)
    for r in cells.collect():  # CELLS numbers, whatever the input
        counts[r["chunk"] * CELL_CHUNK : (r["chunk"] + 1) * CELL_CHUNK] = np.frombuffer(r["counts"], np.int64)
    classes = stage(
        rows.filter("n > 0").groupBy("class").agg(F.min("doc_id").alias("rep"), F.first("f1").alias("f1"), F.first("n").alias("n"), F.count(F.lit(1)).alias("copies")), "ngram-classes"
    )
    return docs, rows, classes, counts


def _can_link(x: str, y: str):
    """Length and positional filters between the postings ``x`` and ``y``."""
    can = F.expr(f"least({x}.n - {x}.pos, {y}.n - {y}.pos)")
    need = F.ceil(F.expr(f"{x}.n + {y}.n") * PERCENT / (100 + PERCENT))
    return F.expr(f"100 * least({x}.n, {y}.n) >= {PERCENT} * greatest({x}.n, {y}.n)") & (can >= need)


def _ordered(x: str, y: str) -> list:
    return [F.least(f"{x}.class", f"{y}.class").alias("a"), F.greatest(f"{x}.class", f"{y}.class").alias("b")]


def _connected(docs: DataFrame, classes: DataFrame, counts: np.ndarray) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(class and root of linked classes, texts of listed classes, postings
    (list, class) of shared prefix shingles).

    In each round the members of a list meet its hub, which then leaves the
    list, having met all; lists whose members are one component are done. In
    the last round every two members of different components meet."""
    spark = docs.sparkSession
    total = classes.agg(F.sum(F.expr(f"n div {round(100 / (100 - PERCENT))} + 1"))).first()[0] or 0
    bits = max(0, int(total / PART_POSTINGS).bit_length())
    packed = docs.mapInArrow(textops.freed(_postings(spark.sparkContext.broadcast(counts), bits)), "part long, packed binary")
    found = stage(packed.groupBy("part").applyInPandas(_lists, LIST_SCHEMA), "ngram-all-lists")
    hubs = found.filter("hub IS NOT NULL").select(F.col("hub").alias("x"), F.col("f1").alias("y"))
    lists = stage(_same_members(found.filter("hub IS NULL").drop("hub")), "ngram-lists")

    named = classes.select("f1", "class")
    listed = stage(lists.select("f1").distinct().join(classes, "f1").select("class", "rep"), "ngram-listed")
    wanted = docs.filter(maybe_among(listed, "rep", F.col("doc_id"))).mapInArrow(textops.freed(_pack_texts), "doc_id long, f1 long, f2 long, n long, cells binary, text binary")
    texts = stage(_of_representatives(wanted.select("doc_id", _class().alias("class"), "n", "cells", "text"), listed), "ngram-texts")

    a = hubs.distinct().join(named.select(F.col("f1").alias("x"), F.col("class").alias("p")), "x")
    b = a.join(named.select(F.col("f1").alias("y"), F.col("class").alias("q")), "y")
    pairs = b.filter("p != q").select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()
    left = None  # postings of members that have not met all others of their list
    tried = links = roots = None
    for k in range(HUB_ROUNDS + 1):
        pairs = stage(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "ngram-pairs")
        new = stage(_verified(pairs, texts).select("a", "b"), "ngram-links")
        tried = pairs if tried is None else tried.unionByName(pairs)
        if roots is None or not new.isEmpty():
            links = new if links is None else links.unionByName(new)
            roots = components(links)
        if k == HUB_ROUNDS:
            break
        left = _still_mixed(lists, named, left, roots)
        if left.isEmpty():
            break
        if k + 1 == HUB_ROUNDS:
            x, y = left.alias("x"), left.alias("y")
            meet = x.join(y, (F.col("x.list") == F.col("y.list")) & (F.col("x.root") < F.col("y.root")) & _can_link("x", "y"))
        else:
            hub = left.groupBy("list").agg(F.min(F.struct("f1", "class", "n", "pos", "root")).alias("h")).select("list", "h.*")
            x, y = left.alias("x"), hub.alias("y")
            meet = x.join(y, (F.col("x.list") == F.col("y.list")) & (F.col("x.root") != F.col("y.root")) & _can_link("x", "y"))
        pairs = meet.select(*_ordered("x", "y")).distinct()
    return roots, texts, lists.select("list", "f1").join(named, "f1").select("list", "class")


def _still_mixed(lists: DataFrame, named: DataFrame, left: DataFrame | None, roots: DataFrame) -> DataFrame:
    """``(list, f1, class, n, pos, root)`` of lists with members of several
    components, without the hub that the last round let them meet."""
    if left is None:
        left = lists.select("list", "f1", "n", "pos").join(named, "f1")
    left = left.select("list", "f1", "class", "n", "pos")
    hub = left.groupBy("list").agg(F.min("f1").alias("f1"))
    left = left.join(hub, ["list", "f1"], "left_anti").join(roots.withColumnRenamed("v", "class"), "class", "left")
    left = left.withColumn("root", F.coalesce("root", "class"))
    mixed = left.groupBy("list").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo != hi").select("list")
    return stage(left.join(mixed, "list", "left_semi").select("list", "f1", "class", "n", "pos", "root"), "ngram-mixed")


def _components(classes: DataFrame, roots: DataFrame) -> DataFrame:
    """``(class, root, component_id)`` of every class."""
    placed = classes.join(roots.withColumnRenamed("v", "class"), "class", "left").select("class", "rep", F.coalesce("root", "class").alias("root"))
    least = placed.groupBy("root").agg(F.min("rep").alias("component_id"))
    return stage(placed.join(least, "root").select("class", "root", "component_id"), "ngram-components")


def ngram_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_col: str | None = None) -> DataFrame:
    """``(doc_id, n_shingles, class, component_id, root, key)``, a row per row
    of ``df``: ``root`` is equal exactly within a component (null for wordless
    texts), ``key`` the string column ``key_col`` passed on. Pairs are only
    verified until the components stand."""
    docs, rows, classes, counts = _scanned(df, id_col, text_col, key_col)
    roots, _, _ = _connected(docs, classes, counts)
    members = rows.join(_components(classes, roots), "class", "left")
    return members.select("doc_id", F.col("n").alias("n_shingles"), "class", F.coalesce("component_id", "doc_id").alias("component_id"), "root", "key")


def ngram_join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(members, links): members as ``ngram_components`` has them, with
    ``n_links``; links is ``(a, b, overlap)`` of every two different classes
    that link, found within each component once it stands."""
    docs, rows, classes, counts = _scanned(df, id_col, text_col, key_col)
    roots, texts, lists = _connected(docs, classes, counts)
    found = _components(classes, roots)
    links = _all_links(texts, lists, roots.withColumnRenamed("v", "class"), classes)
    ends = links.select(F.col("a").alias("class"), F.col("copies_b").alias("n")).unionByName(links.select(F.col("b").alias("class"), F.col("copies_a").alias("n")))
    others = ends.groupBy("class").agg(F.sum("n").alias("others"))
    counted = classes.join(others, "class", "left").select("class", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    found = stage(found.join(counted, "class"), "ngram-found")
    members = rows.join(found, "class", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), "class", F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "root", "key",
    )
    return members, links.select("a", "b", "overlap")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
