import numpy as np
import pandas as pd

from tidemark.llm import op8_kd_topk as op

SCHEMA = "vec_id long, embedding array<float>, label int, id long, shard string"


def _write(spark, path, rows):
    spark.createDataFrame([(i, v, 1, 7, "x") for i, v in rows], SCHEMA).write.parquet(f"{path}/embeddings.parquet")


def _same(got, want):
    by = ["query_id", "rank"]
    got, want = (x.sort_values(by).reset_index(drop=True)[["query_id", "rank", "vec_id", "score"]] for x in (got, want))
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_query_equals_sql_with_ties_and_unusable_vectors(spark, tmp_path, duck, monkeypatch):
    monkeypatch.setattr(op, "SHARD_ROWS", 300)
    monkeypatch.setattr(op, "BLOCK_QUERIES", 16)
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=6) * (0.05 if i % 3 else 3)).tolist()) for i in range(1500)]
    rows += [(i, [0.5] * 6) for i in range(2000, 2400)]  # equal vectors
    rows += [(3000, None), (3020, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (3040, [float("nan")] * 6), (3060, [float("inf")] * 6)]
    path = str(tmp_path)
    _write(spark, path, rows)
    _same(op.query(spark, path).toPandas(), duck(op.ORACLE_SQL, embeddings=f"{path}/embeddings.parquet/*.parquet"))


def test_repeated_ids_and_wide_components_equal_sql(spark, tmp_path, duck, monkeypatch):
    monkeypatch.setattr(op, "SHARD_ROWS", 100)
    monkeypatch.setattr(op, "BLOCK_QUERIES", 8)
    rng = np.random.default_rng(4)
    rows = [(int(i), (rng.normal(size=4) * 2.0 ** rng.integers(0, 20)).tolist()) for i in rng.integers(0, 120, 500)]  # different rows of one id
    rows += [(i, [2.0**25 + 4 * (i % 9), 1.0, -2.0, 3.0]) for i in (20, 41, 42, 43)]  # beyond 32 bits
    rows += [(40, [3.0, 1.0, 2.0, 0.0])] * 60 + [(77, [2.0**25 + 64, 8.0, 8.0, 1.0])] * 70  # copies of a query, of a best candidate
    path = str(tmp_path)
    _write(spark, path, rows)
    _same(op.query(spark, path).toPandas(), duck(op.ORACLE_SQL, embeddings=f"{path}/embeddings.parquet/*.parquet"))


def test_lengths_repeats_few_candidates_and_empty(spark, tmp_path):
    rows = [(0, [1.0, 1.0]), (0, [1.0, 1.0]), (1, [1.0, 2.0]), (20, [1.0, 1.0, 1.0]), (None, [9.0, 9.0]), (40, [])]
    _write(spark, str(tmp_path / "a"), rows)
    got = op.query(spark, str(tmp_path / "a")).collect()
    assert [tuple(r) for r in got] == [(0, rank, 1, 64 * 64 + 64 * 128) for rank in (1, 2)]
    _write(spark, str(tmp_path / "b"), [])
    assert op.query(spark, str(tmp_path / "b")).count() == 0


def test_large_components_stay_exact_and_trees_cover_their_rows():
    rng = np.random.default_rng(2)
    for top in (40, 1 << 30, 1 << 33):
        v = rng.integers(-top, top, (2000, 4)).astype(np.int32 if top < 1 << 31 else np.int64)
        ids = np.arange(2000)
        tree = op.build_tree(ids, v)
        row = {"dim": 4} | {k: a.tobytes() for k, a in tree.items()}
        q = v[7]
        got, scores = op.search(op._tree(row), 7, op._as(op._tree(row), q[None])[0], 20, -np.inf)
        every = [(-max(-op.TOP, min(op.TOP, sum(int(a) * int(b) for a, b in zip(x, q)))), i) for i, x in enumerate(v) if i != 7]
        assert [(-int(s), i) for i, s in zip(got, scores)] == sorted(every)[:20]
        assert sorted(tree["ids"]) == list(ids)


def test_trees_and_blocks_travel_once_per_group_in_few_bytes(spark, tmp_path, duck, monkeypatch):
    for name, value in (("SHARD_ROWS", 20), ("BLOCK_QUERIES", 1), ("TILE_RESULTS", 400), ("CORE_TILES", 1)):
        monkeypatch.setattr(op, name, value, raising=False)
    sent, visit = [], op._visit
    monkeypatch.setattr(op, "_visit", lambda rows, *rest: sent.append(rows.count()) or visit(rows, *rest))
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=6) / 2).tolist()) for i in range(1180)] + [(i, [0.25] * 6) for i in range(1180, 1200)]
    path = str(tmp_path)
    _write(spark, path, rows)
    _same(op.query(spark, path).toPandas(), duck(op.ORACLE_SQL, embeddings=f"{path}/embeddings.parquet/*.parquet"))
    assert sum(sent) < 60 * 60 / 2  # shards x blocks
    _write(spark, f"{path}/none", rows[1:20] + rows[21:40])
    assert op.query(spark, f"{path}/none").count() == 0
    some = spark.createDataFrame([(i, [i, -i, 127], 1) for i in range(30)], "id long, v array<long>, copies long")
    assert [len(r["vectors"]) for r in op.build_index(some, 1).collect()] == [30 * 3]


def test_lists_equal_the_sorted_scores_of_all_other_shards(monkeypatch):
    monkeypatch.setattr(op, "VISIT_QUERIES", 8)
    monkeypatch.setattr(op, "LEAF_ROWS", 16)
    rng = np.random.default_rng(6)
    v = rng.integers(-3, 4, (600, 3))  # many ties
    v[350:360] *= 1 << 40
    ids, shard = rng.permutation(600), np.arange(600) // 100
    who = np.arange(0, 600, 12)
    home = np.where(who % 5 == 0, -1, shard[who])
    floors = np.full(len(who), op.NONE)
    floors[3] = 4
    lists = op.Lists(ids[who], v[who], floors, 5, home)
    for s in range(6):
        lists.visit(op.build_tree(ids[shard == s], op._narrow(v[shard == s])), s)
    for i, h, floor, scores, near in zip(who, home, floors, *lists.best()):
        every = [(-max(-op.TOP, min(op.TOP, sum(int(a) * int(b) for a, b in zip(x, v[i])))), n) for x, n, s in zip(v, ids, shard) if n != ids[i] and s != h]
        want = [(s, n) for s, n in sorted(every) if -s >= floor][:5]
        assert [(-int(s), n) for s, n in zip(scores, near) if s > op.NONE][: len(want)] == want
