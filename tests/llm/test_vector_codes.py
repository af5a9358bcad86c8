import hashlib
import math
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import op12_vector_codes as op

SCHEMA = "vec_id long, embedding array<double>, label int, id long, v string, codes int"


def brute(rows, parts=16, entries=64, rounds=2, scale=256):
    """Rows (id, vector, label) -> {row number: (code, error, label error)}, digest."""
    fine = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    fine.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [[math.floor(Fraction(x) * scale) for x in r[1]] for r in fine]
    w = len(whole[0]) // parts if whole else 0
    cut = [[v[p * w : p * w + w] for p in range(parts)] for v in whole]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), e) for e, entry in enumerate(books[p]))

    for _ in range(rounds):
        new = [list(b) for b in books]
        for p in range(parts):
            took = {}
            for c in cut:
                took.setdefault(nearest(p, c[p])[1], []).append(c[p])
            for e, some in took.items():
                new[p][e] = [sum(x) // len(some) for x in zip(*some)]
        books = new
    final = [[nearest(p, c[p]) for p in range(parts)] for c in cut]
    error = [sum(d for d, _ in f) for f in final]
    by_label = {}
    for r, e in zip(fine, error):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    fit = lambda x: x if x < 1 << 63 else None
    return [(r[0], "".join(f"{e:02x}" for _, e in f), fit(x), fit(by_label[r[2]]), digest) for r, f, x in zip(fine, final, error)]


def write(spark, path, rows, schema=SCHEMA):
    spark.createDataFrame([(i, v, n, 7, "x", 1) for i, v, n in rows], schema).repartition(3).write.parquet(f"{path}/embeddings.parquet")


def made(seed, n, dim=32):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(20, dim))
    near = middle[rng.integers(0, 20, n)] + rng.normal(size=(n, dim)) * rng.choice([0, 0.01, 0.4], (n, 1))
    return [(int(i), v.tolist(), int(i) % 3 if i % 7 else None) for i, v in zip(rng.permutation(n), near)]


def test_query_equals_brute_force_and_sql(spark, tmp_path, duck):
    rows = made(1, 500) + [(9001, None, 1), (9002, [float("nan")] * 32, 1), (9003, [None] + [0.5] * 31, 2), (9004, [float("inf")] + [0.0] * 31, 0)]
    rows += [(9100 + i, [0.25] * 32, 5) for i in range(40)] + [(3, [0.5] * 32, None), (3, [0.5] * 32, None)]
    path = str(tmp_path)
    write(spark, path, rows)
    got = sorted(tuple(r) for r in op.query(spark, path).collect())
    assert got == sorted(brute(rows))
    sql = duck(op.ORACLE_SQL, embeddings=f"{path}/embeddings.parquet/*.parquet")
    assert sorted(tuple(r) for r in sql.itertuples(index=False)) == got
    assert pd.DataFrame(got)[4].nunique() == 1


def test_large_values_few_rows_null_ids_and_empty(spark, tmp_path):
    big = [(1, [1e300, -1e300, -1e-300, -0.1] * 8, 1), (2, [2.0**41 + 0.5, -(2.0**41) - 0.25, 0.0, 1.0] * 8, 1), (None, [0.1, 0.2, 0.3, -0.4] * 8, 2), (5, [2.0**28] * 32, 3)]
    write(spark, str(tmp_path / "a"), big)
    key = lambda r: str(r)
    got = sorted((tuple(r) for r in op.query(spark, str(tmp_path / "a")).collect()), key=key)
    assert got == sorted(brute(big), key=key)
    moved = [(i, [x * 2.0**60 for x in v], n) for i, v, n in made(4, 100, 16)]
    write(spark, str(tmp_path / "d"), moved)
    assert sorted(map(str, op.query(spark, str(tmp_path / "d")).collect())) == sorted(map(str, (spark_row(r) for r in brute(moved))))
    write(spark, str(tmp_path / "b"), [(1, None, 1)])
    assert op.query(spark, str(tmp_path / "b")).count() == 0
    write(spark, str(tmp_path / "c"), [(1, [], 1), (2, [], None)])
    assert sorted(r.code for r in op.query(spark, str(tmp_path / "c")).collect()) == ["00" * 16] * 2


def spark_row(values):
    from pyspark.sql import Row

    return Row(**dict(zip(("vec_id", "code", "error", "label_error", "codebooks_sha256"), values)))


def test_lengths_must_agree(spark, tmp_path):
    for name, rows in (("a", [(1, [0.5] * 16, 1), (2, [0.5] * 32, 1)]), ("b", [(1, [0.5] * 15, 1)])):
        write(spark, str(tmp_path / name), rows)
        with pytest.raises(ValueError, match="one length"):
            op.query(spark, str(tmp_path / name))


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 300), st.integers(1, 70), st.integers(0, 3), st.sampled_from([2, 30, 10**6, 2**40]))
def test_both_trees_give_the_nearest_entries(seed, n, k, width, top):
    rng = np.random.default_rng(seed)
    points = rng.integers(-top, top, (n, width))
    entries = points[rng.integers(0, n, k)] + rng.integers(0, 2, (k, width))
    got = op.Assigned(points, entries)
    far = ((points[:, None].astype(object) - entries[None]) ** 2).sum(2) if width else np.zeros((n, k), object)
    want = np.array([min(range(k), key=lambda e: (row[e], e)) for row in far])
    assert (got.code == want).all() and (got.counts == np.bincount(want, minlength=k)).all()
    assert all((got.sums[e] == points[want == e].sum(0)).all() for e in range(k))


def test_whole_nodes_are_assigned_from_their_sums():
    rng = np.random.default_rng(3)
    entries = rng.integers(-10**4, 10**4, (64, 4))
    points = entries[rng.integers(0, 64, 5000)] + rng.integers(-3, 4, (5000, 4))
    assert op.Assigned(points, entries).whole > 4000


@given(st.integers(-(2**200), 2**200))
def test_limbs_add_up(value):
    assert sum(x << op.LIMB * i for i, x in enumerate(op.limbs(value))) == value
