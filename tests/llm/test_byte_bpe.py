import hashlib
import random
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from tidemark.llm import op3_byte_bpe as op

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=op.ranks(PATH), special_tokens={})


def texts():
    rng = random.Random(7)
    alphabet = list("ab sTÉé''1९ \n\t!ß中é😀") + ["'s", "'re ", "don't", " the", "tion", "<|endoftext|>", "ñ", "  "]
    out = ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(200)]
    return out + [None, "", " \n", "x" * 700, "ab" * 300, "-" * 3_000, "wort und " * 20_000, "same", "same", "z" * 48, "z" * 49]


def test_query_equals_library(spark, tmp_path, library):
    rows = [(i, t, "c", [1]) for i, t in enumerate(texts())]
    path = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, words string, ids array<int>").repartition(2).write.parquet(f"{path}/documents.parquet")
    got = {r.doc_id: r for r in op.query(spark, path).collect()}
    assert len(got) == len(rows)
    for doc, text, *_ in rows:
        ids = library.encode_ordinary(text or "")
        r = got[doc]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()), repr(text)[:80]
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_encode_gives_ids_and_empty_tables_stay_empty(spark, library):
    df = spark.createDataFrame([(1, "Hello wörld"), (None, None), (1, "Hello wörld")], "doc_id long, text string")
    got = op.encode(df, PATH)
    ids = library.encode_ordinary("Hello wörld")
    assert sorted(((r.doc_id or 0), r.ids) for r in got.collect()) == [(0, []), (1, ids), (1, ids)]
    decoded = op.decode(got, PATH).collect()
    assert sorted(bytes(r.bytes) for r in decoded) == [b"", "Hello wörld".encode(), "Hello wörld".encode()]
    with pytest.raises(ValueError):
        op.Decoder(PATH)(np.array([10**6]))
    assert op.encode(df.filter("false"), PATH).count() == 0


def test_long_word_merge_equals_library(library):
    rng = random.Random(2)
    for n in (1, 2, 49, 500):
        word = "".join(rng.choices("abehtion", k=n))
        assert op.merge_long(word.encode(), op.ranks(PATH)) == library.encode_ordinary(word)


def test_common_words_are_folded_once_for_all_parts(spark, library):
    rng = random.Random(5)
    words = ["".join(rng.choices("abehtionñ", k=rng.randrange(2, 14))) for _ in range(300)]
    rows = [(i, " ".join(rng.choices(words, k=80))) for i in range(400)] + [(400, None), (401, " neuwort" + "y" * 60), (402, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    known, (flat, sizes) = op.common_words(df, PATH, sample_rows=150)
    assert len(known) >= 250 and len(sizes) == len(known) and sizes.sum() == len(flat)
    met = op._words_to_ids(df, PATH, "doc_id", "text", spark.sparkContext.broadcast(known)).filter("ids IS NOT NULL")
    assert sum(len(r.ids) for r in met.collect()) < 4 * 100  # without common words: over 4 * 300
    got = op.encode(df, PATH, sample_rows=150).collect()
    assert {r.doc_id: r.ids for r in got} == {i: library.encode_ordinary(t or "") for i, t in rows}


def test_a_task_folds_a_word_once_over_its_batches(monkeypatch):
    none = SimpleNamespace(value=pa.array([], pa.binary()))
    parts = [pa.RecordBatch.from_pylist([{"doc_id": i, "text": f"wort abc{i % 10} Tag"}]) for i in range(120)]
    monkeypatch.setattr(op, "BATCH_BYTES", 1)

    def rows():
        made = [b.to_pylist()[0] for b in op._split(PATH, none)(iter(parts))]
        return [r for r in made if r["words"] is not None]

    once = rows()
    assert sum(len(r["words"]) for r in once) == 3 + 10  # a batch alone would give four a document
    assert [r["doc_id"] for r in once] == [1] + [0] * 119
    monkeypatch.setattr(op, "TASK_WORDS", 5)
    assert sum(r["doc_id"] for r in rows()) > 1


def test_plans_do_not_spell_out_the_ranks(spark, library):
    """The driver keeps and logs a description of each plan, again at each
    change of it; with the ranks in it, it had megabytes."""
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    encoded = op.encode(docs, PATH)
    assert {r.doc_id: r.ids for r in encoded.collect()} == {1: library.encode_ordinary("some words"), 2: []}
    assert len(encoded._jdf.queryExecution().toString()) < 200_000
