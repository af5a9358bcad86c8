import hashlib
import random
from collections import Counter

import numpy as np

from tidemark.llm import op7_suffix_dedup as op


def brute(texts, length=op.LENGTH):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def corpus():
    rng = random.Random(4)
    word = lambda: rng.choice(["alpha", "bét", "gamma", "d", "eps", "zeta"]) + str(rng.randrange(50))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, line = text(90), text(12)
    texts = [text(rng.choice([5, 60, 200, 500])) for _ in range(40)]
    texts += [text(40) + " " + passage[a:] + " " + text(30) for a in (0, 1, 40, 100, 200)]
    texts += [passage, passage[:399], passage[:400], passage[:401] + "x"]
    texts += [" ".join([line] * 20), line + text(50), text(60) + line]
    base = text(400)
    for _ in range(15):
        t = list(base)
        t[rng.randrange(len(t))] = "#"
        texts.append("".join(t))
    return texts + [base, base, None, "", "a" * 399, "a" * 1200, "ab" * 600, texts[0], "é" * 500]


def test_query_equals_brute_force(spark, tmp_path):
    texts = corpus()
    rows = [(i, t, 1, "k") for i, t in enumerate(texts)]
    path = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, n_spans long, key string").repartition(4).write.parquet(f"{path}/documents.parquet")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op.query(spark, path).collect()}
    want = dict(enumerate(brute(texts)))
    assert {i for i in want if got.get(i) != want[i]} == set()


def test_repeated_rows_null_ids_and_empty(spark, tmp_path):
    text = " ".join(f"w{i}" for i in range(150))
    for name, rows in (("a", [(1, text), (1, text), (None, "x" + text), (2, "short")]), ("b", [])):
        spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/{name}/documents.parquet")
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in op.query(spark, f"{tmp_path}/a").collect())
    n = len(text)
    assert got == [(0, n + 1, n), (1, n, n), (1, n, n), (2, 5, 0)]
    assert op.query(spark, f"{tmp_path}/b").count() == 0


def test_anchors_are_those_of_each_window_in_any_stretch(monkeypatch):
    rng = np.random.default_rng(1)
    data = rng.integers(97, 100, 9000).astype(np.uint8)
    data[3000:4000] = data[100:1100]
    offsets = np.array([0, 50, 2500, 2500, 8990, 9000])
    whole = op.anchors(data, offsets, op.LENGTH, op.GRAM)
    monkeypatch.setattr(op, "SLICE_BYTES", 1000)
    parts = op.text_anchors(data, offsets)
    assert set(zip(*whole)) <= set(zip(*parts))
    for s in range(2500, 8990 - op.LENGTH + 1):
        assert ((whole[0] >= s) & (whole[0] <= s + op.LENGTH - op.GRAM)).any()


def test_column_sort_equals_brute_force():
    rng = np.random.default_rng(2)
    group = rng.integers(0, 5, 300)
    symbols = rng.integers(0, 2, (14, 300)).astype(np.int32)
    symbols[:, 50:] = symbols[:, rng.integers(0, 50, 250)]
    symbols[rng.integers(0, 14, 90), rng.integers(0, 300, 90)] = 2
    symbols[-2:, :20] = op.END
    got = op.repeated_starts(group, symbols, 8, 7)
    for c in range(7):
        seen = Counter((g, bytes(w.astype(np.uint8))) for g, w, ok in zip(group, symbols[c : c + 8].T, (symbols[c : c + 8] != op.END).all(0)) if ok)
        for i in range(300):
            w = symbols[c : c + 8, i]
            assert got[c, i] == ((w != op.END).all() and seen[group[i], bytes(w.astype(np.uint8))] > 1)


def test_equal_windows_pick_alike_in_batches_of_any_size():
    rng = np.random.default_rng(9)
    text = rng.integers(97, 101, 5_000).astype(np.uint8)
    alone, _ = op.anchors(text, np.array([0, len(text)]))
    padding = rng.integers(97, 101, 300_000).astype(np.uint8)
    both, _ = op.anchors(np.concatenate([text, padding]), np.array([0, len(text), len(text) + len(padding)]))
    assert alone.tolist() == [p for p in both.tolist() if p < len(text)]


def test_anchors_are_dealt_evenly_to_the_parts():
    """Anchors are smallest hashes; their parts do not follow those."""
    data = np.frombuffer(random.Random(8).randbytes(200_000), np.uint8)
    _, h = op.anchors(data, np.array([0, len(data)]))
    sizes = np.bincount(op.part_of(h, 3), minlength=8)
    assert len(sizes) == 8 and sizes.sum() == len(h)
    assert sizes.max() < 1.5 * len(h) / 8
    assert (op.part_of(h, 0) == 0).all()
