import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import op11_chunked_bpe as op

PATH = public_tokenizers.path("word_bpe_49k.json")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(tok, doc_id, text):
    ids = tok.encode(text or "", add_special_tokens=False).ids
    return doc_id, len(ids), sha(" ".join(map(str, ids))), sha(tok.decode(ids, skip_special_tokens=False))


def prose(rng, words):
    return "".join(rng.choice(["wort", "Don't", "l'été", "x1y", "and,", "ﬁ", "中文", "é", "<|endoftext|>", "İs", "a" * 9]) + rng.choice([" ", " ", "\n", "  ", "\x0b", " ", "-"]) for _ in range(words))


def texts():
    rng = random.Random(8)
    shared = [prose(rng, 900) for _ in range(4)]
    out = [prose(rng, rng.randrange(300)) + rng.choice(shared) + prose(rng, rng.randrange(200)) for _ in range(40)]
    out += [rng.choice(shared)[rng.randrange(900) :] + rng.choice(shared) for _ in range(40)]
    out += [prose(rng, 250) for _ in range(20)] + [shared[0]] * 30
    alphabet = [*"ab sTÉé''1९ \n!ß中İéΣΑ<|>\x0b\x0c\x1c ́", "'s", "'RE ", "<|endoftext|>", "<|startoftext|>"]
    out += ["".join(rng.choices(alphabet, k=rng.randrange(40))) for _ in range(200)]
    out += [None, "", " \n", "wort " * 30_000, "x" * 20_000, "中" * 9_000 + " " + "中" * 9_000, " " * 5_000, "a " * 9_000]
    return out


def write(spark, path, rows):
    spark.createDataFrame([(i, t, "r", b"h", 3) for i, t in rows], "doc_id long, text string, row string, hash binary, ids int").repartition(5).write.parquet(f"{path}/documents.parquet")


def test_query_equals_the_library(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(op, "HOT", 20)
    tok = Tokenizer.from_file(PATH)
    rows = list(enumerate(texts())) + [(None, "no id"), (None, None), (3, "again " * 300), (3, "again " * 300)]
    write(spark, str(tmp_path), rows)
    got = sorted((tuple(r) for r in op.query(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted((expected(tok, *r) for r in rows), key=str)


def test_bodies_are_encoded_once_and_most_of_a_copy_comes_from_them(spark, tmp_path, monkeypatch):
    rng = random.Random(2)
    passage = " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(3000))
    rows = spark.createDataFrame([(i, f"start {i} " + passage + f" end {i}") for i in range(30)], "doc_id long, text string").repartition(4)
    shared = op.shared_bodies(rows)
    bits, hot = op.bits_of(shared, shared.count()), op.bits_of(shared, 0)
    parts = op._parted(rows, PATH, bits, hot)
    assert op._alone(rows, PATH, bits, iter, op.ENCODED).count() == 0
    table = op._bodies(parts, PATH, hot).toPandas()
    assert table["hash"].is_unique and len(table) <= shared.count() + 2
    kept = sum(len(x) for r in parts.filter("row IS NOT NULL").collect() for x in r.kept)
    whole = sum(len(r.ids) for r in op._assembled(parts, op._bodies(parts, PATH, hot), iter, op.ENCODED).collect())
    assert 0 < kept < whole / 4


def test_empty_and_unshared_tables(spark):
    df = spark.createDataFrame([(1, "one two three"), (2, None)], "doc_id long, text string")
    assert {r.doc_id: r.text for r in op.decode(op.encode(df, PATH), PATH).collect()} == {1: "one</w> two</w> three</w>", 2: ""}
    assert op.decode(op.encode(df.filter("false"), PATH), PATH).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 10**6), st.integers(0, 4000), st.integers(0, 4000))
def test_cuts_depend_on_content_only(seed, before, after):
    rng = random.Random(seed)
    word = lambda n: " ".join("".join(rng.choices("abcdefgh", k=4)) for _ in range(n // 5))
    passage = word(100_000)
    one, two = (op.Text(pa.array([t])) for t in (passage, word(before) + passage + word(after)))
    a, b = ({t.digest(x) for x in t.bodies(0)} for t in (one, two))
    assert len(a & b) >= 0.8 * len(a)


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 10**6))
def test_joins_and_bodies_tile_the_text_and_read_as_the_whole(seed):
    rng = random.Random(seed)
    raw = prose(rng, 600)
    text, encoder = op.Text(pa.array([raw])), op.Encoder(PATH)
    bodies = [x for x in text.bodies(0) if rng.random() < 0.7]
    kept, joins = op.repaired(text, 0, bodies, encoder)
    order = [x for pair in zip(joins, [*kept, None]) for x in pair if x]
    assert b"".join(text.raw[a:b] for a, b in order) == raw.encode()
    ids = np.concatenate(encoder.pieces(pa.array([text.raw[a:b] for a, b in order], pa.large_binary())))
    assert ids.tolist() == Tokenizer.from_file(PATH).encode(raw, add_special_tokens=False).ids


def test_a_join_that_needs_more_words_widens_and_gives_up_bodies():
    class Merging(op.Encoder):
        """Reads "b" and "c" as one id if "x" is anywhere before them."""

        def whole(self, pieces):
            out = []
            for p in pieces:
                words = p.decode().split()
                out.append(np.array([9 if w in "bc" and "x" in words[:i] else 1 for i, w in enumerate(words)], np.uint16))
            return out

    rng = random.Random(1)
    raw = "x " + " ".join(rng.choice(["aa", "bb", "cc"]) for _ in range(2000)) + " b c " + " ".join(rng.choice("bc") for _ in range(2000))
    text = op.Text(pa.array([raw]))
    kept, joins = op.repaired(text, 0, text.bodies(0), Merging(PATH))
    for (a, b), left in zip(joins[1:], kept):
        seen = text.raw[left[0] : b].split()
        assert b"x" not in seen or not {b"b", b"c"} & set(seen)
