"""Exact top-k inner products with a KD-tree per shard.

Vectors are dealt to shards by a hash of their row. Each shard builds a tree
by median splits of its widest component down to ``LEAF_ROWS`` vectors, every
node with the tight bounding box of its vectors. Queries travel in blocks. A
traversal is best-first by the upper bound of the inner product over a box,
sum(max(q * lo, q * hi)), and ends at the first bound below the k-th score;
``VISIT_QUERIES`` queries share one, each leaving a node that it need not see.

A block first meets one shard; each query's k-th score there is carried to all
others, where it prunes from the start. For these, groups of shards and groups
of blocks make a grid of tiles: a task holds a tile's queries with their k best
so far, and the tile's trees pass it one by one. So a tree travels once per
group of blocks, a block once per group of shards, and a tile returns k rows a
query at most. Components travel in the fewest bytes that hold them.

Defined cases: a vector that is null, empty or holds null or non-finite
components, or has no id, takes no part; components are floor(scale * x) as longs;
sums are exact at any size (doubles, longs or Python's integers, by the values),
and one that a long cannot hold counts as the nearest long, -(2^63 - 1) at least;
vectors of different lengths do not meet; every row is a candidate of its own, also
one whose id occurs again, but for rows with the query's id; query rows of one id
have one list, the k best of all their scores; equal scores go by smaller id; fewer
than k candidates give fewer rows; an empty table gives an empty result; other
columns are not read. Equal rows travel once, with their number up to k.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.staging import read, stage

NAME = "op8_kd_topk"
K = 20
SCALE = 64
QUERY_STEP = 20
SHARD_ROWS = 8192
LEAF_ROWS = 256
BLOCK_QUERIES = 256
#: The queries of one traversal.
VISIT_QUERIES = 1024
#: About the most results that a task holds and bytes of vectors that pass it; tiles per core.
TILE_RESULTS, TILE_BYTES, CORE_TILES = 1 << 21, 1 << 26, 4

ORACLE_SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % {QUERY_STEP} = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= {K}
"""
INDEX_SCHEMA = "shard long, dim int, ids binary, vectors binary, begin binary, end binary, left binary, lo binary, hi binary"
BLOCK_SCHEMA = "block long, dim int, ids binary, vectors binary, copies binary"
KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
INDEX, BLOCK = (pa.schema([(c.split()[0], KINDS[c.split()[1]]) for c in x.split(", ")]) for x in (INDEX_SCHEMA, BLOCK_SCHEMA))
TOP = 2**63 - 1
NONE = -(2**63)


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) in doubles as longs; null if not usable."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    return F.when(fine & (F.size(vector) > 0), whole)


def _narrow(vectors: np.ndarray) -> np.ndarray:
    """The same integers in the fewest bytes."""
    for kind in (np.int8, np.int16, np.int32):
        if vectors.min() >= np.iinfo(kind).min and vectors.max() <= np.iinfo(kind).max:
            return vectors.astype(kind)
    return vectors


def _rows(table: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(dimension, ids ascending, vectors, copies) of one group's rows."""
    table = table.sort_by("id").combine_chunks()
    sizes = pc.list_value_length(table["v"]).to_numpy()
    for dim in np.unique(sizes):
        some = table.take(np.flatnonzero(sizes == dim))
        vectors = pc.list_flatten(some["v"]).to_numpy().reshape(-1, dim)
        yield int(dim), some["id"].to_numpy(), _narrow(vectors), some["copies"].to_numpy()


def _longs(values: np.ndarray) -> np.ndarray:
    """Python's integers as the nearest longs; other numbers as they are."""
    if values.dtype != object:
        return values
    return np.array([max(-TOP, min(TOP, x)) for x in values.ravel().tolist()], np.int64).reshape(values.shape)


def build_tree(ids: np.ndarray, vectors: np.ndarray) -> dict[str, np.ndarray]:
    """Nodes in the order of their making: rows [begin, end), first child
    ``left`` (the second follows it; 0 for a leaf), box [lo, hi]."""
    order = np.arange(len(ids))
    begin, end, left, lo, hi = [0], [len(ids)], [], [], []
    node = 0
    while node < len(begin):
        rows = order[begin[node] : end[node]]
        some = vectors[rows]
        lo.append(some.min(0))
        hi.append(some.max(0))
        spread = hi[-1].astype(np.float64) - lo[-1]
        if len(rows) > LEAF_ROWS and spread.size and spread.max() > 0:
            half = len(rows) // 2
            split = np.argpartition(some[:, spread.argmax()], half)
            order[begin[node] : end[node]] = rows[split]
            left.append(len(begin))
            begin += [begin[node], begin[node] + half]
            end += [begin[node] + half, end[node]]
        else:
            left.append(0)
        node += 1
    ints = {k: np.array(v, np.int64) for k, v in (("begin", begin), ("end", end), ("left", left))}
    return ints | {"ids": ids[order], "vectors": vectors[order], "lo": np.array(lo), "hi": np.array(hi)}


class Lists:
    """Queries of a tile with the k best rows that each has met, equal scores
    by smaller id; places without a row hold ``NONE``."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, floors: np.ndarray, k: int, home: np.ndarray | None = None):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.floors, self.home = np.maximum(floors, NONE + 1), home
        self.scores, self.near = np.full((len(ids), k), NONE), np.full((len(ids), k), TOP)
        self.waiting: dict[int, list] = {}

    def visit(self, tree: dict, shard: int = -1) -> None:
        for start in range(0, len(self.ids), VISIT_QUERIES):
            who = np.arange(start, min(start + VISIT_QUERIES, len(self.ids)))
            if self.home is not None:
                who = who[self.home[who] != shard]
            if len(who):
                self._visit(tree, who, start)

    def _visit(self, tree: dict, who: np.ndarray, start: int) -> None:
        """Best-first for the queries ``who``: a node is seen by those whose
        bound there reaches their k-th score."""
        queries, ids = _as(tree, self.vectors[who]), self.ids[who]
        vectors, lo, hi = _in(tree, queries.dtype)
        bounds = _longs(hi @ np.maximum(queries, 0).T + lo @ np.minimum(queries, 0).T)
        lowest = NONE if bounds.dtype == np.int64 else -np.inf
        top = bounds.max(1).tolist()
        floors = self.floors[who].astype(bounds.dtype)
        waiting = self.waiting.setdefault(start, [])
        heap = [(-top[0], 0)]
        while heap:
            best, node = heapq.heappop(heap)
            if -best < floors.min():
                break
            here = np.flatnonzero(bounds[node] >= floors)
            child = int(tree["left"][node])
            if child or not len(here):
                for n in (child, child + 1) if len(here) else ():
                    heapq.heappush(heap, (-top[n], n))
                continue
            rows = slice(tree["begin"][node], tree["end"][node])
            scores = _longs((queries if len(here) == len(who) else queries[here]) @ vectors[rows].T)
            good = np.flatnonzero(scores.max(1) >= floors[here])
            if not len(good):
                continue
            near, here, scores = tree["ids"][rows], here[good], scores[good]
            scores[ids[here][:, None] == near] = lowest
            fine = scores >= floors[here][:, None]
            many = np.flatnonzero(fine.sum(1) > self.k)
            if len(many):  # k rows of this leaf reach their own k-th score
                kth = np.partition(scores[many], -self.k, 1)[:, -self.k]
                floors[here[many]] = kth
                self.floors[who[here[many]]] = kth.astype(np.int64)
                fine[many] = scores[many] >= kth[:, None]
            query, row = np.divmod(np.flatnonzero(fine), len(near))
            waiting.append((who[here[query]], scores[query, row].astype(np.int64), near[row]))
            if sum(len(x[0]) for x in waiting) >= 4 * VISIT_QUERIES:
                self._settle(waiting)
                floors = self.floors[who].astype(bounds.dtype)

    def _settle(self, waiting: list) -> None:
        """What waits goes into the lists."""
        if not waiting:
            return
        query, scores, near = (np.concatenate(x) for x in zip(*waiting))
        waiting.clear()
        some, query = np.unique(query, return_inverse=True)
        query = np.concatenate([query, np.repeat(np.arange(len(some)), self.k)])
        scores, near = np.concatenate([scores, self.scores[some].ravel()]), np.concatenate([near, self.near[some].ravel()])
        order = np.lexsort((near, ~scores, query))
        first = order[np.searchsorted(query[order], np.arange(len(some)))[:, None] + np.arange(self.k)]
        self.scores[some], self.near[some] = scores[first], near[first]
        self.floors[some] = np.maximum(self.floors[some], self.scores[some, -1])

    def best(self) -> tuple[np.ndarray, np.ndarray]:
        """(scores, ids) per query."""
        for waiting in self.waiting.values():
            self._settle(waiting)
        return self.scores, self.near


def search(tree: dict[str, np.ndarray], query_id: int, query: np.ndarray, k: int, kth: float) -> tuple[np.ndarray, np.ndarray]:
    """The k best (ids, scores) whose score is at least ``kth``."""
    floor = NONE if kth == -np.inf else int(kth)
    lists = Lists(np.array([query_id]), query.astype(np.int64)[None], np.array([floor]), k)
    lists.visit(tree)
    scores, ids = (x[0] for x in lists.best())
    return ids[scores > NONE], scores[scores > NONE]


def build_index(vectors: DataFrame, shards: int) -> DataFrame:
    """One row per shard and dimension of ``(id, v, copies)``."""

    def build(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        rows = []
        for dim, ids, v, copies in _rows(table):
            tree = build_tree(np.repeat(ids, copies), np.repeat(v, copies, axis=0))
            rows.append({"shard": shard, "dim": dim} | {name: np.ascontiguousarray(a).tobytes() for name, a in tree.items()})
        return pa.Table.from_pylist(rows, INDEX)

    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("id", "v"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(build, INDEX_SCHEMA)


def query_blocks(queries: DataFrame, blocks: int) -> DataFrame:
    def pack(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        rows = [{"block": block, "dim": d, "ids": i.tobytes(), "vectors": v.tobytes(), "copies": c.tobytes()} for d, i, v, c in _rows(table)]
        return pa.Table.from_pylist(rows, BLOCK)

    dealt = queries.withColumn("block", F.pmod(F.xxhash64("id", "v", F.lit("block")), F.lit(blocks)))
    return dealt.groupBy("block").applyInArrow(pack, BLOCK_SCHEMA)


def _whole(packed: bytes, rows: int, dim: int) -> np.ndarray:
    """Packed vectors, of 8 to 64 bits a component."""
    return np.frombuffer(packed, f"i{len(packed) // (rows * dim)}").reshape(rows, dim)


def _tree(row: dict) -> dict[str, np.ndarray]:
    ints = {k: np.frombuffer(row[k], np.int64) for k in ("ids", "begin", "end", "left")}
    sizes = {"vectors": len(ints["ids"]), "lo": len(ints["begin"]), "hi": len(ints["begin"])}
    return ints | {k: _whole(row[k], n, row["dim"]) for k, n in sizes.items()}


def _in(tree: dict, kind: np.dtype) -> list[np.ndarray]:
    """A tree's vectors and boxes as numbers of this kind, made once."""
    if kind not in tree:
        tree[kind] = [tree[x].astype(kind) for x in ("vectors", "lo", "hi")]
    return tree[kind]


def _top(low: np.ndarray, high: np.ndarray) -> float:
    return max(float(high.max()), -float(low.min()))


def _as(tree: dict, queries: np.ndarray) -> np.ndarray:
    """The queries in the fastest numbers whose sums with the tree's vectors
    are exact: all sums of products stay below 2^24, 2^52 or 2^62."""
    most = _top(tree["lo"][0], tree["hi"][0]) * _top(queries, queries) * queries.shape[1]
    kinds = ((2.0**24, np.float32), (2.0**52, np.float64), (2.0**62, np.int64))
    return queries.astype(next((kind for limit, kind in kinds if most < limit), object))


def _visit(rows: DataFrame, tasks: int, k: int) -> DataFrame:
    """Rows of blocks and trees, dealt to tiles -> (block, query_id, vec_id, score)
    of all that share a tile and a dimension, but for a block's own home."""

    def lists(blocks: list[dict]) -> tuple[np.ndarray, np.ndarray, Lists]:
        ids = [np.frombuffer(b["ids"], np.int64) for b in blocks]
        vectors = _narrow(np.concatenate([_whole(b["vectors"], len(i), b["dim"]) for b, i in zip(blocks, ids)]))
        known = [dict(zip(b["kth_ids"] or (), b["kth_scores"] or ())) for b in blocks]
        floors = np.array([kth.get(x, NONE) for kth, i in zip(known, ids) for x in i.tolist()])
        each = [np.repeat([b[name] for b in blocks], [len(i) for i in ids]) for name in ("block", "shard")]
        copies = np.concatenate([np.frombuffer(b["copies"], np.int64) for b in blocks])
        return each[0], copies, Lists(np.concatenate(ids), vectors, floors, k, each[1])

    def told(block: np.ndarray, copies: np.ndarray, found: Lists) -> Iterator[pa.RecordBatch]:
        scores, near = found.best()
        for i in range(0, len(block), VISIT_QUERIES):
            some = slice(i, i + VISIT_QUERIES)
            query, rank = np.nonzero(scores[some] > NONE)
            number = np.clip(k - rank * copies[some][query], 0, copies[some][query])  # each row as often as the query, up to k in all
            query, rank = (np.repeat(x, number) for x in (query + i, rank))
            columns = (block[query], found.ids[query], near[query, rank], scores[query, rank])
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["block", "query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, blocks, held = None, [], None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if at != (row["tile"], row["dim"]):
                    if held:
                        yield from told(*held)
                    at, blocks, held = (row["tile"], row["dim"]), [], None
                if row["begin"] is None:
                    blocks.append(row)
                elif blocks:
                    held = held or lists(blocks)
                    held[2].visit(_tree(row), row["shard"])
        if held:
            yield from told(*held)

    dealt = rows.repartition(tasks, "tile").sortWithinPartitions("tile", "dim", F.col("begin").isNotNull())
    return dealt.mapInArrow(run, "block long, query_id long, vec_id long, score long")


def grid(n: int, m: int, shards: int, blocks: int, size: int, k: int, cores: int) -> tuple[int, int]:
    """(groups of shards, groups of blocks) for ``n`` vectors of ``size`` bytes and
    ``m`` queries, so that trees, blocks and results that travel are about the least."""
    tiles = CORE_TILES * cores
    asked = m * (size / n + 12 * k)
    down = min(blocks, max(1, ceil(m * k / TILE_RESULTS), round(sqrt(tiles * asked / size))))
    return min(shards, max(ceil(tiles / down), ceil(size / TILE_BYTES))), down


def _apart(spark: SparkSession, tiles: int) -> Column:
    """Numbers for tiles, by place, that Spark deals to ``tiles`` different tasks."""
    dealt = spark.range(64 * tiles).groupBy(F.pmod(F.hash("id"), F.lit(tiles)).alias("task")).agg(F.min("id").alias("id"))
    return F.array(*[F.lit(row["id"]) for row in dealt.collect()])


def _each(first: Column, count: int, step: int = 1) -> Column:
    return F.explode(F.sequence(first, first + (count - 1) * step, F.lit(step).cast("long")))


def top_k(
    df: DataFrame, k: int = K, query_filter: Column | None = None, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for every id of ``df`` that
    ``query_filter`` (on column ``id``) selects, its k best rows of other ids."""
    usable = df.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), scale).alias("v"))
    rows = usable.filter("id IS NOT NULL AND v IS NOT NULL").groupBy("id", "v").agg(F.least(F.count(F.lit(1)), F.lit(k)).alias("copies"))
    vectors = stage(rows, "kd-vectors")
    chosen = F.lit(True) if query_filter is None else query_filter
    n, m = vectors.agg(F.count(F.lit(1)), F.count_if(chosen)).first()
    shards, blocks = max(1, ceil(n / SHARD_ROWS)), max(1, ceil(m / BLOCK_QUERIES))
    index = stage(build_index(vectors, shards), "kd-index")
    block = stage(query_blocks(vectors.filter(chosen), blocks), "kd-queries").withColumn("home", F.pmod("block", F.lit(shards)))
    cores = df.sparkSession.sparkContext.defaultParallelism
    none = F.lit(None).cast("array<long>")
    asked = block.withColumns({"tile": F.col("home"), "shard": F.lit(-1).cast("long"), "kth_ids": none, "kth_scores": none})
    first = index.withColumn("tile", F.col("shard")).unionByName(asked.drop("home"), True)
    near = every = stage(_visit(first, min(shards, CORE_TILES * cores), k), "kd-first")
    if shards > 1:
        own = Window.partitionBy("block", "query_id").orderBy(F.desc("score"), "vec_id")
        kth = near.withColumn("rank", F.row_number().over(own)).filter(F.col("rank") == k).groupBy("block")
        kth = kth.agg(F.collect_list("query_id").alias("kth_ids"), F.collect_list("score").alias("kth_scores"))
        across, down = grid(n, m, shards, blocks, index.agg(F.sum(F.length("vectors"))).first()[0], k, cores)
        others = block.join(kth, "block", "left").withColumnRenamed("home", "shard")
        others = others.withColumn("tile", _each(F.pmod("block", F.lit(down)) * across, across))
        trees = index.withColumn("tile", _each(F.pmod("shard", F.lit(across)), down, across))
        tile = F.coalesce(F.get(_apart(df.sparkSession, across * down), F.col("tile").cast("int")), -1 - F.col("tile"))
        every = near.unionByName(_visit(trees.unionByName(others, True).withColumn("tile", tile), across * down, k))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    every = every.withColumn("rank", F.row_number().over(best).cast("int"))
    return every.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read(spark, sf_dir, "embeddings"), K, F.col("id") % QUERY_STEP == 0)
