import pandas as pd

from tidemark.llm import op6_exact_dedup as op

SCHEMA = "doc_id long, text string, __t string, __len long"


def _table(spark, tmp_path, rows):
    path = str(tmp_path / "d")
    spark.createDataFrame([(i, t, "x", i) for i, t in rows], SCHEMA).write.parquet(f"{path}/documents.parquet")
    return path


def _compare(spark, duck, path):
    got = op.query(spark, path).toPandas().sort_values(["doc_id", "keep_id"]).reset_index(drop=True)
    want = duck(op.ORACLE_SQL, documents=f"{path}/documents.parquet/*.parquet")
    want = want.sort_values(["doc_id", "keep_id"]).reset_index(drop=True)[got.columns]
    pd.testing.assert_frame_equal(got, want, check_dtype=False)
    return got


def test_groups_whitespace_nulls_ties_and_long_texts(spark, tmp_path, duck):
    long = "wörter und mehr " * 40_000
    rows = [(5, "a  b"), (3, "a\tb"), (9, "a b c"), (1, None), (2, ""), (7, long), (8, long.replace(" ", "\n")),
            (11, long + "x"), (12, "a b"), (13, "x" * 80 + "1"), (14, "x" * 80 + "2"), (14, "x" * 80 + "2")]
    got = _compare(spark, duck, _table(spark, tmp_path, rows)).set_index("doc_id")
    assert got.loc[5, "keep_id"] == 3 and not got.loc[5, "kept"] and got.loc[3, "kept"]
    assert got.loc[2, "keep_id"] == 1 and got.loc[8, "keep_id"] == 7 and got.loc[11, "group_size"] == 1
    assert got.loc[13, "kept"] and list(got.loc[[14], "group_size"]) == [2, 2]


def test_hot_group_and_empty_table(spark, tmp_path, duck):
    _compare(spark, duck, _table(spark, tmp_path / "a", [(i, "same" if i % 3 else f"t{i}") for i in range(300)]))
    assert len(_compare(spark, duck, _table(spark, tmp_path / "b", []))) == 0


def test_drop_copies_keeps_all_columns(spark):
    df = spark.createDataFrame([(1, "a", "u", 1), (2, "a", "v", 2), (3, None, "w", 3)], SCHEMA)
    kept = op.drop_copies(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {1, 3}
