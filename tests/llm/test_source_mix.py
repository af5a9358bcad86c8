import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.llm import op1_source_mix as op

SCHEMA = "doc_id long, text string, source string, n long, pass string"


def _rows(seed=1, n=400):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choices(["big", "mid", "small", None, "blank"], [60, 20, 10, 8, 2])[0]
        words = 0 if source == "blank" else rng.choice([0, 1, 5, 40, 300])
        rows.append((i, None if words == 0 and i % 2 else "w " * words, source, 7, "x"))
    return rows


def test_query_equals_sql_with_nulls_blank_sources_and_clashing_names(spark, tmp_path, duck):
    path = str(tmp_path)
    spark.createDataFrame(_rows() + [(3, "again", "big", 0, "")], SCHEMA).write.parquet(f"{path}/documents.parquet")
    got = op.query(spark, path).toPandas()
    want = duck(op.ORACLE_SQL, documents=f"{path}/documents.parquet/*.parquet")
    by = ["source", "pass", "order_key", "n_tokens"]
    got, want = (x.sort_values(by).reset_index(drop=True)[want.columns] for x in (got, want))
    pd.testing.assert_frame_equal(got, want, check_dtype=False)
    assert set(got["doc_id"]) == set(range(400))
    passes = got[got["n_tokens"] > 0].groupby("source", dropna=False)["pass"].max() + 1
    assert passes["big"] == 1 and passes["small"] > 1


def test_blocks_hold_the_target_weights(spark):
    rows = [(i, "w " * 10, "a" if i % 10 else "b") for i in range(30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = op.source_mix(docs, None, 3.0).toPandas()
    share = got.groupby(["block", "source"])["n_tokens"].sum().unstack()
    whole = share.iloc[:-1]
    ratio = whole["b"] / whole.sum(axis=1)
    assert len(whole) >= 2 and ratio.between(0.24, 0.26).all()  # (1/9)^(1 - ln 3 / ln 9) = 1/3


@pytest.mark.parametrize("goal", [0.9, 0.97, 1.0])
def test_exponent_meets_the_entropy(spark, goal):
    counts = [1000, 100, 100, 10]
    shares = op.source_shares(spark.createDataFrame([(str(i), n) for i, n in enumerate(counts)], "source string, n long"))
    a = op.temperature(shares, goal)
    w = [(n / sum(counts)) ** a for n in counts]
    h = -sum(x / sum(w) * math.log(x / sum(w)) for x in w)
    assert h == pytest.approx(goal * math.log(4), abs=1e-9)


def test_budget_below_one_pass_and_empty_table(spark):
    docs = spark.createDataFrame([(i, "w " * 10, "a") for i in range(100)], "doc_id long, text string, source string")
    got = op.source_mix(docs, None, None, budget=305).toPandas()
    assert got["n_tokens"].sum() == 310 and got["doc_id"].is_unique
    assert op.source_mix(docs.filter("false")).count() == 0


def test_rows_of_one_id_have_one_order(spark):
    tokens = spark.createDataFrame([(7, "a", n) for n in (50, 3, 200, 8)], "doc_id long, source string, n long")
    plan = spark.createDataFrame([("a", 261, 4, 261, 60)], "source string, total long, docs long, budget long, quota long")
    blocks = [{r.n_tokens: r.block for r in op.mix(tokens.orderBy(o), plan).collect()} for o in ("n", F.desc("n"))]
    assert blocks[0] == blocks[1] == {3: 0, 8: 0, 50: 0, 200: 1}
