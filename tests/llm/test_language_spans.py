import zlib

import numpy as np
import pytest

from tidemark.llm import op5_language_spans as op

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_on_whole_table(spark):
    got = op.query(spark, SF).toPandas().set_index("doc_id")
    lang = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas().set_index("doc_id")["lang"]
    assert len(got) == len(lang) and got["score"].between(0, 1).all()
    fold = np.array([zlib.crc32(str(i).encode()) % 5 == 0 for i in got.index])
    assert (got["held_out"] == fold).all()
    test = got[fold]
    right = test["lang_pred"] == lang[test.index]
    assert right.mean() >= 0.95


def test_viterbi_equals_brute_force():
    rng = np.random.default_rng(1)
    sizes = np.array([0, 1, 7, 3, 0, 5])
    scores = rng.normal(size=(sizes.sum(), 3)).astype(np.float32) * 3
    got, at = op.viterbi(scores, sizes, 2.0), 0
    for n in sizes:
        if n:
            some = scores[at : at + n]
            paths = np.stack(np.meshgrid(*[range(3)] * n, indexing="ij"), -1).reshape(-1, n)
            value = some[np.arange(n), paths].sum(1) - 2.0 * (np.diff(paths, axis=1) != 0).sum(1)
            mine = got[at : at + n]
            own = some[np.arange(n), mine].sum() - 2.0 * (np.diff(mine.astype(int)) != 0).sum()
            assert own == pytest.approx(value.max(), abs=1e-4)
        at += n


def test_mixed_scripts_spans_nulls_and_empty(spark):
    en, ru, de = "the house and the garden with a tree ", "дом и сад с деревом ", "das haus und der garten mit einem baum "
    rows = [(i, t * 5, l) for i in range(40) for t, l in ((en, "en"), (ru, "ru"), (de, "de"))]
    model = op.train(spark.createDataFrame(rows, "id long, text string, lang string"))
    assert model.languages == ["de", "en", "ru"]
    texts = [en * 3 + ru * 9, de * 4 + en, None, "", "123 😀 !?", de * 20_000, ru + "한국어", en, en]
    df = spark.createDataFrame([(i, t, "xx", 0.5) for i, t in enumerate(texts)], "doc_id long, text string, lang_pred string, score double")
    got = {r.doc_id: r for r in op.predict(df, model).collect()}
    assert [got[i].lang_pred for i in range(9)] == ["ru", "de", "und", "und", "und", "de", "ru", "en", "en"]
    assert [(s.lang, s.first_word, s.end_word) for s in got[0].spans] == [("en", 0, 24), ("ru", 24, 69)]
    assert got[2].score == 0 and got[4].spans == [] and got[1].score < 1
    assert op.predict(df.filter("false"), model).count() == 0
    none = op.train(spark.createDataFrame([(1, "a", None)], "id long, text string, lang string"))
    assert {r.lang_pred for r in op.predict(df, none).collect()} == {"und"}


def test_more_languages_than_a_byte_counts():
    scores = np.zeros((6, 300), np.float32)
    scores[:4, 290] = 3
    scores[4:, 34] = 9
    assert op.viterbi(scores, np.array([6]), 1.0).tolist() == [290] * 4 + [34] * 2


def _above_chance(model, word, lang):
    """A word's log-probability against evenly drawn n-grams, gram by gram."""
    padded, total = b" " + word + b" ", 0.0
    for order in (2, 3, 4):
        for i in range(len(padded) - order + 1):
            value = np.array([int.from_bytes(padded[i : i + order], "big")], np.uint32)
            total += model.table[op._hash(value, order)[0], model.languages.index(lang)] + np.log(op.BUCKETS)
    return total


def test_rows_stay_by_evidence_as_in_brute_force(spark):
    en, ru, de = "the house and the garden with a tree ", "дом и сад с деревом ", "das haus und der garten mit einem baum "
    rows = [(i, t * 5, lang) for i in range(30) for t, lang in ((en, "en"), (ru, "ru"), (de, "de"))]
    model = op.train(spark.createDataFrame(rows, "id long, text string, lang string"))
    texts = [en * 4 + de * 3 + ru * 4, en, "zzqq xkcd wvvw " * 20, "qqzz the house", "12 34", "", None, "δένδρο και σπίτι", "baum", de * 3_000]
    texts = texts * 2 + [" ".join(np.random.default_rng(i).permutation((en + de + ru + "xq zz vv").split())[:9]) for i in range(20)]
    want = []
    for text in texts:
        _, _, spans, _ = op.label(model, [op.textops.buffers(op.pa.array([text]))])
        words = (text or "").encode().split()
        sums = {}
        for s in spans[0]:
            sums[s["lang"]] = sums.get(s["lang"], 0.0) + sum(_above_chance(model, w, s["lang"]) for w in words[s["first_word"] : s["end_word"]])
        if any(v > 0 for v in sums.values()):
            want.append(text)
    df = spark.createDataFrame([(None, t, "x") for t in texts], "id long, text string, lang string")
    got = [r.text for r in op.keep_known(df, model).collect()]
    assert sorted(got) == sorted(want)
    assert texts[0] in got and en in got and texts[2] not in got and "12 34" not in got and None not in got
