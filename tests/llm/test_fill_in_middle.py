import hashlib
import random
import re

import pandas as pd

from tidemark.llm import op13_fill_in_middle as op


def expected(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def texts():
    rng = random.Random(5)
    alphabet = [*"ab Zé\n\r \U0001f600$\\<>PSM{}", "word", "\x00", "́", "<P", "S>"]
    some = ["".join(rng.choices(alphabet, k=rng.randrange(30))) for _ in range(400)]
    some += [None, "", " ", "<P>", "a<S>b", "x<M>", "same", "same", "<<P", "$1\\2"]
    return some + ["wort " * 60_000, "x" * 300_000, ". " * 100_000, "\U0001f600" * 50_000]


def test_query_equals_brute_force_and_sql(spark, tmp_path, duck):
    rows = [(i if i % 97 else None, t, "c", 7, "x") for i, t in enumerate(texts())] + [(5, "again", "c", 7, "x")] * 2
    path = str(tmp_path)
    schema = "doc_id long, text string, n string, a int, Form string"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{path}/documents.parquet")
    got = sorted((tuple(r) for r in op.query(spark, path).collect()), key=str)
    want = []
    for doc_id, text, *_ in rows:
        *head, output = expected(doc_id, text)
        want.append((doc_id, *head, sha(output), sha(text or "")))
    assert got == sorted(want, key=str)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    frame = duck(op.ORACLE_SQL, documents=f"{path}/documents.parquet/*.parquet").astype(object)
    sql = [tuple(None if pd.isna(v) else v for v in r) for r in frame.itertuples(index=False)]
    assert sorted(sql, key=str) == got


def test_other_columns_stay_and_own_ones_are_replaced(spark):
    df = spark.createDataFrame([(1, "a b c", "old", 3, "t")], "doc_id long, text string, Output string, __a0 int, `odd.name` string")
    row = op.fill_in_middle(df, rate=100, spm_rate=100).first()
    assert row.asDict().keys() == {"doc_id", "text", "__a0", "odd.name", "n", "form", "prefix_chars", "middle_chars", "output"}
    assert (row["odd.name"], row["__a0"], row.n, row.form) == ("t", 3, 5, "spm") and row.output.startswith("<S>")
    assert op.fill_in_middle(df.filter("false")).count() == 0


def test_other_units_markers_and_no_shuffle(spark):
    df = spark.createDataFrame([(i, "ab cd ef" * i) for i in range(20)], "doc_id long, text string")
    marks = ("[p]", "(s)", "|m|")
    made = op.fill_in_middle(df, unit=r"\s|\S+", markers=marks, rate=100, seed="other")
    assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()
    back = made.select("text", op.restore(made.output, made.form, marks).alias("back"), "form").collect()
    assert all(r.text == r.back for r in back) and {r.form for r in back} >= {"psm", "spm"}
