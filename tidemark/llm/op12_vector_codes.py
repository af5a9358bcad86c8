"""Vector code compression: codebooks by dual-tree Lloyd rounds.

Vectors are cut into ``PARTS`` equal parts; each part position has a codebook
of ``ENTRIES`` entries and a vector's code is the number of the nearest entry
of every part. A Lloyd round is one pass over the vectors:

* a task takes its vectors in blocks and builds, for each part position, a
  tree over the block's parts (median splits, tight boxes, cached sums and
  counts) and a tree over the entries;
* pairs of nodes go down both trees together: a pair is dropped when the
  least distance of its boxes exceeds the greatest distance at which the part
  node surely has an entry. A part node with one entry left is assigned whole
  with its cached sum; leaves that keep several entries are decided by exact
  integer distances, ties to the lower index;
* sums and counts by (position, entry) are added up within the task and then
  by Spark; the driver gets ``PARTS * ENTRIES`` sums, whatever the input, and
  sends the new entries out with the next pass.

Everything is integer arithmetic: 64-bit where squared distances fit
(``fits``), exact Python integers in arrays of objects where not, by block.

Defined cases: a vector that is null or holds null or non-finite components
is dropped; an empty table gives an empty result; fewer vectors than entries
give shorter codebooks; rows with equal ids are rows of their own, in the
order of their vectors, and a null id comes after all others when the first
entries are chosen; kept vectors of different lengths, or of a length that
``parts`` does not divide, are an error; an error (or a sum of errors) beyond
64 bits is null; null labels are one label; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction
from math import floor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.staging import read, stage

NAME = "op12_vector_codes"
PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Parts of a leaf, entries of a leaf, vectors of a block at most, components of a block at most.
LEAF_PARTS, LEAF_ENTRIES, BLOCK_ROWS, BLOCK_VALUES = 16, 4, 8192, 1 << 20
#: Sums are sent in limbs of so many bits.
LIMB = 30
#: Rows of one label meet the label's sum in so many pieces.
LABEL_SALTS = 16


def _sql() -> str:
    """Rounds as subqueries; ``a{r}`` assigns every part to codebook ``c{r}``."""
    sql = f"""
WITH kept AS (
  SELECT vec_id, label, embedding, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), v AS (SELECT *, row_number() OVER (ORDER BY vec_id, embedding) AS r FROM kept),
p AS (
  SELECT r, p, v[p * (len(v) // {PARTS}) + 1:(p + 1) * (len(v) // {PARTS})] AS v FROM v, (SELECT unnest(range({PARTS})) AS p)
), c0 AS (SELECT p, r - 1 AS e, v FROM p WHERE r <= {ENTRIES})"""
    for i in range(ROUNDS + 1):
        sql += f""",
a{i} AS (
  SELECT r, p, m % {ENTRIES} AS e, m // {ENTRIES} AS d FROM (
    SELECT p.r, p.p, min(c.e + {ENTRIES} * coalesce(list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 0)::BIGINT) AS m
    FROM p JOIN c{i} c ON p.p = c.p GROUP BY p.r, p.p)
)"""
        if i < ROUNDS:
            sql += f""",
s{i} AS (
  SELECT p, e, k, ((sum(x) - (sum(x) % count(*) + count(*)) % count(*)) // count(*))::BIGINT AS x FROM (
    SELECT a.p, a.e, unnest(p.v) AS x, generate_subscripts(p.v, 1) AS k FROM a{i} a JOIN p ON a.r = p.r AND a.p = p.p) GROUP BY p, e, k
), c{i + 1} AS (
  SELECT c.p, c.e, coalesce(n.v, c.v) AS v FROM c{i} c
  LEFT JOIN (SELECT p, e, list(x ORDER BY k) AS v FROM s{i} GROUP BY p, e) n ON c.p = n.p AND c.e = n.e
)"""
    sql += f""",
codes AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{ROUNDS} GROUP BY r),
book AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS h FROM c{ROUNDS})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
FROM v JOIN codes USING (r) CROSS JOIN book
"""
    return sql


ORACLE_SQL = _sql()


# ---- integers --------------------------------------------------------------------


def quantised(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of finite doubles, in 64 bits or as Python integers."""
    values = np.asarray(values, np.float64)
    if not values.size or np.abs(values).max() < 2.0**40:
        return np.floor(values * scale).astype(np.int64)
    exact = [floor(Fraction(x) * scale) for x in values.ravel().tolist()]
    return np.array(exact, object).reshape(values.shape)


def fits(*arrays: np.ndarray) -> bool:
    """Whether sums of squared differences of these arrays stay in 64 bits."""
    top = max((max(abs(int(a.max())), abs(int(a.min()))) for a in arrays if a.size), default=0)
    width = max((a.shape[-1] for a in arrays), default=1)
    return 4 * top * top * max(width, 1) < 1 << 62


def _squares(a: np.ndarray) -> np.ndarray:
    return (a * a).sum(-1)


# ---- trees -----------------------------------------------------------------------


class Tree:
    """A binary tree over points by median splits of the widest component.

    All nodes of a level hold the same number of places; level ``l`` has
    ``2**l`` nodes, node ``i`` has children ``2 i`` and ``2 i + 1``. Places
    beyond the points repeat a point and have no weight. ``order`` is the
    point at each place; boxes, sums and counts are kept by level.
    """

    def __init__(self, points: np.ndarray, leaf: int):
        n, width = points.shape
        depth = 0
        while leaf << depth < n:
            depth += 1
        size = (n + (1 << depth) - 1 >> depth) << depth
        order = np.concatenate([np.arange(n), np.full(size - n, n - 1, np.int64)])
        weight = np.concatenate([np.ones(n, np.int64), np.zeros(size - n, np.int64)])
        order, weight = order.reshape(1, size), weight.reshape(1, size)
        self.lo, self.hi = [], []
        for level in range(depth + 1):
            some = points[order]
            lo, hi = some.min(1), some.max(1)
            self.lo.append(lo)
            self.hi.append(hi)
            if level < depth:
                if width:
                    widest = np.argmax(hi - lo, axis=1)
                    key = np.take_along_axis(some, widest[:, None, None], 2)[:, :, 0]
                    by = np.argsort(key, axis=1, kind="stable")
                    order, weight = np.take_along_axis(order, by, 1), np.take_along_axis(weight, by, 1)
                order, weight = order.reshape(2 << level, -1), weight.reshape(2 << level, -1)
        self.depth, self.order, self.weight = depth, order, weight
        sums, counts = (points[order] * weight[:, :, None]).sum(1), weight.sum(1)
        self.sums, self.counts = [sums], [counts]
        for _ in range(depth):
            sums, counts = sums[0::2] + sums[1::2], counts[0::2] + counts[1::2]
            self.sums.insert(0, sums)
            self.counts.insert(0, counts)


def _least(alo: np.ndarray, ahi: np.ndarray, blo: np.ndarray, bhi: np.ndarray) -> np.ndarray:
    return _squares(np.maximum(np.maximum(blo - ahi, alo - bhi), 0))


def _greatest(alo: np.ndarray, ahi: np.ndarray, blo: np.ndarray, bhi: np.ndarray) -> np.ndarray:
    return _squares(np.maximum(ahi - blo, bhi - alo))


def _prune(q: np.ndarray, e: np.ndarray, boxes: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs, ascending by q, without those that a node's surest entry beats."""
    first = np.flatnonzero(np.diff(q, prepend=-1))
    surest = np.minimum.reduceat(_greatest(*boxes), first)
    keep = _least(*boxes) <= np.repeat(surest, np.diff(first, append=len(q)))
    return q[keep], e[keep]


class Assigned:
    """Of one block and part position: the nearest entry of every point, and
    the sums and counts of the entries' points; ``whole`` counts the points
    that were assigned with their node."""

    def __init__(self, points: np.ndarray, entries: np.ndarray, codes: bool = True):
        kind = np.int64 if points.dtype != object and entries.dtype != object and fits(points, entries) else object
        points, entries = points.astype(kind), entries.astype(kind)
        k, width = entries.shape
        self.sums, self.counts, self.whole = np.zeros((k, width), kind), np.zeros(k, np.int64), 0
        self.code = np.zeros(len(points), np.int64) if codes else None
        parts, book = Tree(points, LEAF_PARTS), Tree(entries, LEAF_ENTRIES)
        q = e = np.zeros(1, np.int64)
        level_q = level_e = 0
        last = book.depth + 1  # below the leaves of the book are its entries
        while True:
            if level_e < last:
                q, e = self._open_entries(book, q, e, level_e)
                level_e += 1
                boxes = (entries[e], entries[e]) if level_e == last else (book.lo[level_e][e], book.hi[level_e][e])
                q, e = _prune(q, e, (parts.lo[level_q][q], parts.hi[level_q][q], *boxes))
            if level_e == last:
                q, e = self._take_whole(parts, level_q, q, e)
            if not len(q) or (level_q == parts.depth and level_e == last):
                break
            if level_q < parts.depth:
                q = np.concatenate([2 * q, 2 * q + 1])
                by = np.argsort(q, kind="stable")
                q, e = q[by], np.concatenate([e, e])[by]
                level_q += 1
                boxes = (entries[e], entries[e]) if level_e == last else (book.lo[level_e][e], book.hi[level_e][e])
                q, e = _prune(q, e, (parts.lo[level_q][q], parts.hi[level_q][q], *boxes))
        if len(q):
            self._decide(points, entries, parts, q, e)

    @staticmethod
    def _open_entries(book: Tree, q: np.ndarray, e: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        if level < book.depth:
            return np.repeat(q, 2), (2 * e[:, None] + np.arange(2)).ravel()
        places = book.order.shape[1]
        inside = book.weight[e].ravel() > 0
        q, e = np.repeat(q, places)[inside], book.order[e].ravel()[inside]
        by = np.lexsort((e, q))
        return q[by], e[by]

    def _take_whole(self, parts: Tree, level: int, q: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Part nodes with one entry left take it, with their cached sums."""
        first = np.flatnonzero(np.diff(q, prepend=-1))
        alone = np.diff(first, append=len(q)) == 1
        nodes, entry = q[first[alone]], e[first[alone]]
        np.add.at(self.sums, entry, parts.sums[level][nodes])
        np.add.at(self.counts, entry, parts.counts[level][nodes])
        self.whole += int(parts.counts[level][nodes].sum())
        if self.code is not None and len(nodes):
            places = parts.order.reshape(len(parts.counts[level]), -1)[nodes]
            self.code[places] = entry[:, None]
        rest = np.repeat(~alone, np.diff(first, append=len(q)))
        return q[rest], e[rest]

    def _decide(self, points: np.ndarray, entries: np.ndarray, parts: Tree, q: np.ndarray, e: np.ndarray) -> None:
        """Leaves with several entries, by exact distances."""
        first = np.flatnonzero(np.diff(q, prepend=-1))
        size = np.diff(first, append=len(q))
        nodes = q[first]
        of = np.repeat(np.arange(len(nodes)), size)
        place = parts.order[nodes]
        far = _squares(points[place[of]] - entries[e][:, None, :])
        least = np.minimum.reduceat(far, first, axis=0)
        best = np.minimum.reduceat(np.where(far == least[of], e[:, None], len(entries)), first, axis=0)
        used = parts.weight[nodes] > 0
        rows, entry = place[used], best[used]
        np.add.at(self.sums, entry, points[rows])
        self.counts += np.bincount(entry, minlength=len(entries))
        if self.code is not None:
            self.code[rows] = entry


# ---- passes ----------------------------------------------------------------------


def _blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    rows = max(1, min(BLOCK_ROWS, BLOCK_VALUES // max(dim, 1)))
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            some = batch.slice(at, rows)
            yield some, some.column("v").flatten().to_numpy(zero_copy_only=False).reshape(some.num_rows, dim)


def limbs(value: int) -> list[int]:
    """``value`` in base 2**LIMB; the last limb carries the sign."""
    out = []
    while not -(1 << LIMB) < value < 1 << LIMB:
        out.append(value & (1 << LIMB) - 1)
        value >>= LIMB
    return [*out, value]


def _sums(vectors: DataFrame, books: list[np.ndarray], dim: int, scale: int) -> DataFrame:
    """(position, entry, component, limb, total): count rows have component -1."""
    parts, k = len(books), len(books[0])
    width = dim // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, k, width), object), np.zeros((parts, k), np.int64)
        for _, values in _blocks(batches, dim):
            whole = quantised(values, scale).reshape(len(values), parts, width)
            for p in range(parts):
                got = Assigned(whole[:, p], books[p], codes=False)
                sums[p] += got.sums
                counts[p] += got.counts
        rows = []
        for p, e in zip(*np.nonzero(counts)):
            rows.append((p, e, -1, 0, counts[p, e]))
            rows += [(p, e, c, i, x) for c in range(width) for i, x in enumerate(limbs(int(sums[p, e, c]))) if x]
        columns = list(zip(*rows)) if rows else [()] * 5
        yield pa.record_batch([pa.array([int(x) for x in c], pa.int64()) for c in columns], ["position", "entry", "component", "limb", "total"])

    schema = "position long, entry long, component long, limb long, total long"
    return vectors.select("v").mapInArrow(run, schema).groupBy("position", "entry", "component", "limb").agg(F.sum("total").alias("total"))


def lloyd_round(vectors: DataFrame, books: list[np.ndarray], dim: int, scale: int) -> list[np.ndarray]:
    """The codebooks after one round; entries without parts stay."""
    total: dict[tuple[int, int], dict[int, int]] = {}
    for r in _sums(vectors, books, dim, scale).collect():  # bounded: parts x entries x components x limbs
        one = total.setdefault((r.position, r.entry), {})
        one[r.component] = one.get(r.component, 0) + (r.total << LIMB * r.limb)
    books = [b.astype(object) for b in books]
    for (p, e), one in total.items():
        books[p][e] = [one.get(c, 0) // one[-1] for c in range(dim // len(books))]
    return [_narrow(b) for b in books]


def _narrow(book: np.ndarray) -> np.ndarray:
    return book.astype(np.int64) if all(abs(x) < 1 << 62 for x in book.ravel()) else book


def first_books(vectors: DataFrame, parts: int, entries: int, scale: int) -> tuple[list[np.ndarray], int]:
    """The parts of the vectors with the smallest ids, and the dimension."""
    sizes = vectors.agg(F.min(F.size("v")).alias("lo"), F.max(F.size("v")).alias("hi")).first()
    dim = sizes.lo or 0
    if sizes.lo != sizes.hi or dim % parts:
        raise ValueError(f"vectors must have one length that {parts} divides, found {sizes.lo} to {sizes.hi}")
    rows = vectors.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    first = quantised(np.array([r.v for r in rows], np.float64).reshape(len(rows), dim), scale)
    return list(first.reshape(len(rows), parts, dim // parts).transpose(1, 0, 2)), dim


def assign(vectors: DataFrame, books: list[np.ndarray], dim: int, scale: int = SCALE) -> DataFrame:
    """``(id, label, codes, error)``: an entry's number of each part, and the
    squared distances added up."""
    parts = len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, values in _blocks(batches, dim):
            whole = quantised(values, scale).reshape(len(values), parts, dim // parts)
            codes = np.stack([Assigned(whole[:, p], books[p]).code for p in range(parts)], 1)
            error = np.zeros(len(values), object)
            for p in range(parts):
                kind = np.int64 if whole.dtype != object and books[p].dtype != object and fits(whole[:, p], books[p]) else object
                error = error + _squares(whole[:, p].astype(kind) - books[p].astype(kind)[codes[:, p]])
            error = [int(x) if x < 1 << 63 else None for x in error]
            lists = pa.ListArray.from_arrays(np.arange(len(codes) + 1, dtype=np.int32) * parts, pa.array(codes.ravel(), pa.int32()))
            yield pa.record_batch([some.column("id"), some.column("label"), lists, pa.array(error, pa.int64())], ["id", "label", "codes", "error"])

    label = vectors.schema["label"].dataType.simpleString()
    return vectors.mapInArrow(run, f"id long, label {label}, codes array<int>, error long")


def usable(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), v.alias("v"))
    return rows.filter(F.col("v").isNotNull() & fine)


def compress(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, list[np.ndarray]]:
    """``(id, label, codes, error)`` of every usable row, and the codebooks."""
    vectors = stage(usable(df, id_col, vector_col, label_col), "code-vectors")
    books, dim = first_books(vectors, parts, entries, scale)
    for _ in range(rounds if len(books[0]) else 0):
        books = lloyd_round(vectors, books, dim, scale)
    return assign(vectors, books, dim, scale), books


def codebooks_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(x)) for book in books for x in book.ravel()).encode()).hexdigest()


def label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``. Sums are taken with map-side partial
    aggregation; a label that holds most rows meets its sum in pieces."""
    whole = F.when(F.count("error") == F.count(F.lit(1)), F.try_sum("error"))
    sums = coded.groupBy(F.col("label").alias("__of")).agg(whole.alias("label_error"))
    sums = sums.withColumn("__piece", F.explode(F.sequence(F.lit(0), F.lit(LABEL_SALTS - 1))))
    pieces = coded.withColumn("__salt", F.pmod(F.xxhash64("id", "codes"), F.lit(LABEL_SALTS)).cast("int"))
    return pieces.join(sums, F.col("label").eqNullSafe(F.col("__of")) & (F.col("__salt") == F.col("__piece"))).drop("__of", "__piece", "__salt")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(read(spark, sf_dir, "embeddings"))
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    rows = label_errors(stage(coded, "codes"))
    return rows.select(F.col("id").alias("vec_id"), code.alias("code"), "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
