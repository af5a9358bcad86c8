import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import op4_huffman_ids as op

PATH = public_tokenizers.path("word_bpe_49k.json")


def library_ids(text):
    tok = Tokenizer.from_file(PATH)
    return tok.encode(text or "", add_special_tokens=False).ids + [1]


def test_query_equals_library_on_odd_texts(spark, tmp_path):
    rng = random.Random(3)
    alphabet = list("ab sTÉé''1९ \n!ß中İéΣΑ<|>") + ["'s", "'RE ", "don't", "<|endoftext|>", " "]
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(40))) for _ in range(300)]
    texts += [None, "", " \n", "wort " * 30_000, "x" * 5_000, "same", "same"]
    rows = [(i * 7 % 997, t, "c", 1) for i, t in enumerate(texts)]
    path = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, ids string, start int").repartition(3).write.parquet(f"{path}/documents.parquet")
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in op.query(spark, path).collect()}
    at = 0
    for doc, text, *_ in sorted(rows):
        ids = library_ids(text)
        assert got[doc] == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), repr(text)
        at += len(ids)
    assert len(got) == len(rows)


def test_null_and_repeated_ids_and_empty_table(spark, tmp_path):
    df = spark.createDataFrame([(None, "a b"), (4, "c"), (4, "c d e"), (4, "c")], "doc_id long, text string")
    path = str(tmp_path / "f")
    op.write_ids(op.encode_ids(df, PATH), path, op.id_type(PATH))
    rows = sorted(op.read_ids(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 4, 4, 4]
    assert [r.start for r in rows] == list(np.cumsum([0] + [len(r.ids) // 4 for r in rows[:-1]]))
    empty = str(tmp_path / "e")
    op.write_ids(op.encode_ids(df.filter("false"), PATH), empty, op.id_type(PATH))
    assert op.read_ids(spark, empty).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 10**6), min_size=1, max_size=300), st.integers(4, 20))
def test_code_is_limited_complete_and_round_trips(counts, bits):
    counts = np.array([0, *counts, 0])
    lengths = op.code_lengths(counts, bits)
    used = np.flatnonzero(counts)
    limit = max(bits, int(np.ceil(np.log2(max(2, len(used))))))
    assert lengths[used].max() <= limit and not lengths[counts == 0].any()
    if len(used) > 1:
        assert sum(2.0 ** -int(x) for x in lengths[used]) == pytest.approx(1)
    ids = np.random.default_rng(1).choice(used, 1500).astype(np.uint32)
    payload, marks = op.pack(ids, op.canonical_codes(lengths), lengths)
    out = op.Decoder(lengths).blocks([payload, payload], [marks, marks], [len(ids)] * 2)
    assert all(np.array_equal(x, ids) for x in out)


def test_without_a_limit_the_code_is_as_short_as_huffman():
    import heapq

    counts = np.random.default_rng(5).integers(1, 1000, 200)
    heap, cost = sorted(counts.tolist()), 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    assert int((op.code_lengths(counts, 40) * counts).sum()) == cost


def test_added_tokens_in_texts_equal_unmodified_library(spark):
    tok = Tokenizer.from_file(PATH)
    texts = ["hello <|endoftext|> world", "<|startoftext|>a<|endoftext|>", "x<|EndOfText|>y", "<|endoftext|", "<|endoftext|><|endoftext|>", "plain words", ""]
    texts += ["so<|endoftext|>", "|>", "<|", "endoftext|> next", "É <|startoftext|> e\u0301"]
    rng = random.Random(4)
    alphabet = [*"ab sTÉé''1९ \n!ß中İéΣΑ<|>", "'s", "'RE ", "<|endoftext|>", "<|startoftext|>"]
    texts += ["".join(rng.choices(alphabet, k=rng.randrange(40))) for _ in range(300)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r.doc_id: np.frombuffer(r.ids, op.id_type(PATH)).tolist() for r in op.encode_ids(rows, PATH).collect()}
    assert got == {i: tok.encode(t, add_special_tokens=False).ids + [1] for i, t in enumerate(texts)}
    assert 49407 in got[0] and 49406 in got[1]


def test_ids_of_many_documents_are_counted_together(monkeypatch):
    calls, bincount = [], np.bincount
    monkeypatch.setattr(op.np, "bincount", lambda *a, **b: calls.append(1) or bincount(*a, **b))
    rows = [np.array([i % 5, 40_000 if i == 7 else 1], "<u2").tobytes() for i in range(1000)] + [b""]
    total = op.added_counts(np.array([3, 0]), pa.array(rows, pa.binary()), "<u2")
    assert total[:5].tolist() == [203, 1199, 200, 200, 200] and total[40_000] == 1 and total.sum() == 2003
    assert len(calls) == 1  # not a vocabulary's array for each document
    monkeypatch.setattr(op, "COUNT_BYTES", 8)
    assert np.array_equal(op.added_counts(np.array([3, 0]), pa.array(rows, pa.binary()), "<u2"), total)


def test_words_are_encoded_once_for_all_tasks_of_a_worker(monkeypatch):
    """Words stay known from task to task, in bounded bytes."""
    path = op.public_tokenizers.path("word_bpe_49k.json")
    encoder = op._encoder(path)
    assert op._encoder(path) is encoder
    encoder.clear()
    texts = [["some words here"], ["here words, and " + "x" * 300], ["some more words"], ["words"]]
    for limit in (op.CACHED_BYTES, 64):
        monkeypatch.setattr(op, "CACHED_BYTES", limit)
        for some in texts * 2:
            ids, _ = encoder.texts(op.pa.array(some))
            assert ids.tolist() == encoder.tok.encode(some[0], add_special_tokens=False).ids
            assert encoder.size == sum(map(len, encoder.known))
    assert encoder.size < 64
    encoder.clear()


def test_words_met_again_stay_known_when_the_room_is_full(monkeypatch):
    encoder = op.WordEncoder(PATH)
    library, encoded = encoder.tok, []

    class Counting:
        def encode_batch_fast(self, texts, **kwargs):
            encoded.extend(texts[0].split())
            return library.encode_batch_fast(texts, **kwargs)

    encoder.tok = Counting()
    monkeypatch.setattr(op, "CACHED_WORDS", 12)
    for i in range(20):
        text = "common words here " + " ".join(f"{a}x{b}" for a in "abc" for b in "pqrstuvwxyz"[i % 11])
        text += " " + "".join("abcdefghij"[int(c)] for c in str(i * 7919 + 100000))
        ids, _ = encoder.texts(pa.array([text]))
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(encoder.known) <= 12 + 7
    assert [encoded.count(w) for w in ("common", "words", "here")] == [1, 1, 1]
