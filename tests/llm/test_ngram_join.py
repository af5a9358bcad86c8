import random
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm import op2_ngram_join as op
from tidemark.llm.components import components
from tidemark.llm.staging import maybe_among

SCHEMA = "doc_id long, text string, n long, class string, f1 string"


def shingles(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y]):
                a, b = sorted((root(x), root(y)))
                up[b] = a
    return {i: (len(sets[i]), root(i)) for i in ids}


def corpus(seed=1):
    rng = random.Random(seed)
    word = lambda: rng.choice(["alpha", "Beta", "gamma", "délta", "eps", "zeta", "eta", "x"]) + str(rng.randrange(40))
    line = " ".join(word() for _ in range(30))
    rows, texts = [], []
    for _ in range(60):
        texts.append([word() for _ in range(rng.choice([1, 3, 5, 9, 40, 120, 400]))])
    for _ in range(150):  # copies with few changes, chains of them
        t = list(rng.choice(texts))
        for _ in range(rng.randrange(0, 1 + len(t) // 15)):
            t[rng.randrange(len(t))] = word()
        texts.append(t)
    base = [word() for _ in range(200)]
    for _ in range(60):  # one large group
        t = list(base)
        for _ in range(rng.randrange(6)):
            t[rng.randrange(200)] = word()
        texts.append(t)
    for t in texts:
        rows.append(" ".join(t).upper() if rng.random() < 0.1 else rng.choice([" ", "\n\t"]).join(t))
    rows += [None, "", " \n", "one two", "ONE two", line, line + " " + line, "w " * 50_000, "w " * 50_000 + "end"]
    rows += [line + " " + word() + " " + word() for _ in range(20)]
    order = list(range(len(rows)))
    rng.shuffle(order)
    return [(i * 3, t) for i, t in zip(order, rows)]


def test_query_equals_brute_force(spark, tmp_path):
    rows = corpus()
    path = str(tmp_path)
    spark.createDataFrame([(i, t, 9, "c", "f") for i, t in rows], SCHEMA).repartition(5).write.parquet(f"{path}/documents.parquet")
    got = op.query(spark, path).toPandas().sort_values("doc_id").reset_index(drop=True)
    want = brute(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.itertuples()} == want


def test_sql_equals_brute_force(duck):
    rows = [(i, t) for i, t in corpus(2) if len(t or "") < 2000][:90]
    sql = duck(op.ORACLE_SQL, documents=pd.DataFrame(rows, columns=["doc_id", "text"]))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in sql.itertuples()} == brute(rows)


def test_repeated_rows_null_ids_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(4, text), (4, text), (None, text), (9, text + " more"), (None, "alone here"), (5, None)], "doc_id long, text string")
    members, links = op.ngram_join(df)
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in members.collect())
    assert got == [(-1, 1, None), (-1, 36, 4), (4, 36, 4), (4, 36, 4), (5, 0, 5), (9, 37, 4)]
    assert links.count() == 1
    assert op.ngram_join(df.filter("false"))[0].count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.range(60).selectExpr("id AS a", "id + 1 AS b").union(spark.createDataFrame([(1000, 900), (900, 901)], "a long, b long"))
    got = {r.v: r.root for r in components(edges).collect()}
    assert all(got[i] == 0 for i in range(61)) and got[1000] == got[901] == got[900] == 900


def test_links_are_all_pairs_of_classes(spark, monkeypatch):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = corpus(3) + [(5_000, None), (5_001, "lonely words of no one else here")]
    for i in range(70):  # all near copies of each other
        t = list(base)
        t[rng.randrange(120)] = f"x{i}"
        rows.append((6_000 + i, " ".join(t)))
    rows += [(7_000, rows[-1][1]), (7_001, rows[-1][1])]  # copies count as links, not as classes
    sets = {i: frozenset(shingles(t)) for i, t in rows}
    want, n_links = set(), dict.fromkeys(sets, 0)
    for x in sets:
        for y in sets:
            if x < y and sets[x] and 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y]):
                n_links[x] += 1
                n_links[y] += 1
                if sets[x] != sets[y]:
                    want.add((frozenset((sets[x], sets[y])), len(sets[x] & sets[y])))
    for most in (op.BLOCK_CLASSES, 7):  # one block for a group, several
        monkeypatch.setattr(op, "BLOCK_CLASSES", most)
        members, links = op.ngram_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
        members = members.collect()
        assert {r.doc_id: r.n_links for r in members} == n_links
        of = {r["class"]: sets[r.doc_id] for r in members}
        got = [(frozenset((of[r.a], of[r.b])), r.overlap) for r in links.collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_parts_do_not_follow_the_order_of_hashes():
    """Of equally rare shingles prefixes hold the smallest hashes; the parts
    of the postings are of like size all the same."""
    rng = random.Random(3)
    texts = [" ".join(str(rng.randrange(10**9)) for _ in range(200)) for _ in range(100)]

    class Counts:
        value = op.np.zeros(op.CELLS, op.np.int64)

    batch = op.pa.record_batch([op.pa.array(texts)], ["text"])
    sizes = [0] * 8
    for found in op._postings(Counts, 3)(iter([batch])):
        for part, packed in zip(found.column("part").to_pylist(), found.column("packed").to_pylist()):
            sizes[part] += len(packed)
    assert max(sizes) < 1.3 * sum(sizes) / 8


def test_a_task_sends_postings_in_small_batches_and_a_class_once(monkeypatch):
    class Sent:
        value = np.ones(op.CELLS, np.int64)

    monkeypatch.setattr(op, "FLUSH_POSTINGS", 50)
    monkeypatch.setattr(op, "SLICE_BYTES", 1)
    texts = [" ".join(f"{kind}{i}" for i in range(60)) for kind in "abcdefgh"] * 3
    batch = pa.record_batch([pa.array(texts)], ["text"])
    sizes = [sum(map(len, b.column("packed").to_pylist())) // 20 for b in op._postings(Sent, 2)(iter([batch]))]
    one = op.prefix_size(60 - op.WORDS + 1)
    assert sum(sizes) == 8 * one and max(sizes) < 50 + one
    assert op.FLUSH_POSTINGS == 50 and op.PART_POSTINGS * 20 <= 5 << 20


def test_texts_are_shuffled_once_to_find_those_of_representatives(spark):
    rows = [(i, c, f"{c} {i}") for c, i in (("a", 1), ("a", 1), ("a", 2), ("b", None), ("b", None), ("c", 0), ("c", None), ("d", 5))]
    rows = spark.createDataFrame(rows, "doc_id long, class string, text string")
    listed = spark.createDataFrame([("a", 1), ("b", None), ("c", 0), ("e", 1)], "class string, rep long")
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = op._of_representatives(rows, listed)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert {tuple(r) for r in found.collect()} == {(None, "b", "b None"), (0, "c", "c 0"), (1, "a", "a 1")} and found.count() == 3
        assert plan.count("Exchange hashpartitioning") == 2  # one a side
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_only_texts_of_pairs_are_sent(spark):
    """Of many classes a round's few pairs move few texts."""
    texts = [f"{k} " + " ".join(f"w{k}x{i}" for i in range(20)) for k in range(300)]
    texts[1] = texts[0] + " more"
    packed = next(op._pack_texts(iter([pa.record_batch([pa.array(range(300)), pa.array(texts)], ["doc_id", "text"])]))).to_pandas()
    packed["class"] = [f"c{k}" for k in range(300)]
    rows = spark.createDataFrame(packed[["class", "n", "cells", "text"]])
    found = op._verified(spark.createDataFrame([("c0", "c1"), ("c2", "c3")], "a string, b string"), rows)
    assert [(r.a, r.b) for r in found.collect()] == [("c0", "c1")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("getbit") >= 2  # below the join, on either side

    keys = spark.range(200_000).withColumnRenamed("id", "k")
    others = spark.range(1_000_000, 1_100_000).withColumnRenamed("id", "k")
    assert others.filter(maybe_among(keys, "k", F.col("k"), 200_000)).count() < 15_000
    assert keys.filter(maybe_among(keys, "k", F.col("k"), 200_000)).count() == 200_000
