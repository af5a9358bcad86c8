import zlib


from tidemark.llm import op9_toxicity as op

SF = "/root/testdata/sf0.1"


def test_held_out_labels_are_found(spark):
    got = op.query(spark, SF).toPandas().set_index("doc_id")
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert len(got) == n and got["score"].between(0, 1).all()
    assert ((got["score"] >= 0.3).astype(int) == got["predicted"]).all()
    assert list(got["held_out"]) == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.index]
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id")["toxic"]
    test = got[got["held_out"] & got.index.isin(labels.index)]
    y = labels[test.index]
    hit = (test["predicted"] == 1) & (y == 1)
    assert hit.sum() / (y == 1).sum() >= 0.65
    assert hit.sum() / (test["predicted"] == 1).sum() >= 0.8


def test_windows_and_distances():
    assert op.windows(None) == [b"  "] and op.windows("")
    text = "x" * 1000
    covered = b"".join(w[: op.STRIDE] for w in op.windows(text)[:-1]) + op.windows(text)[-1]
    assert covered == b" " + text.encode() + b" "
    base = b"the house and the garden with a tree and a river " * 20
    d = op.distances("the house and a blortfizzle with the tree", base, b" blortfizzle " + base)
    assert d.max() >= 3 and op.distances("the house and the garden", base, b" blortfizzle " + base).max() <= 1


def test_no_labels_nulls_and_empty(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a text"), (None, "b"), (3, "a text")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (3, None)], "doc_id long, toxic int")
    model = op.fit(docs, labels)
    assert [(r.score, r.predicted) for r in op.score(docs, model).collect()] == [(0.0, 0)] * 5
    rows = [(i, f"plain words in text {i} about a house" + (" zorgblat fiend" if i % 3 == 0 else ""), int(i % 3 == 0)) for i in range(90)]
    model = op.train(spark.createDataFrame(rows, "id long, text string, toxic int"))
    got = {r.doc_id: r.score for r in op.score(docs, model).collect()}
    assert all(0 <= s <= 1 for s in got.values())
    bad = op.score(spark.createDataFrame([(1, "plain zorgblat fiend about a house"), (2, "plain words about a house")], "doc_id long, text string"), model)
    assert {r.doc_id: r.predicted for r in bad.collect()} == {1: 1, 2: 0}
    assert op.score(docs.filter("false"), model).count() == 0
