import importlib.util
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from test_ngram_join import brute

import corpus_pipeline as pipe
from tidemark.llm import op3_byte_bpe, op6_exact_dedup, textops

SF = "/root/testdata/sf0.001"


def test_every_stage_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = [(10_001, None), (10_002, "12 34 !?"), (10_003, "  ")]
    docs = docs.unionByName(spark.createDataFrame([(i, t, "en", "src0", 0) for i, t in extra], docs.schema))
    columns, rows = docs.columns, {}
    kept = docs
    for k, (name, apply) in enumerate(pipe.STAGES):
        apply(spark, kept, SF).write.parquet(f"{tmp_path}/{k}")
        kept = spark.read.parquet(f"{tmp_path}/{k}")
        assert name == pipe.STAGES[-1][0] or kept.columns == columns
        rows[name] = kept.collect()
    before = {r.doc_id: r for r in docs.collect()}
    first = {r.doc_id for r in rows["language_id"]}
    assert first <= before.keys() - {i for i, _ in extra} and len(first) >= 0.98 * (len(before) - len(extra))
    texts = {}
    for r in sorted(rows["language_id"], key=lambda r: r.doc_id):
        texts.setdefault(" ".join(__import__("re").split(r"[\x20\x09-\x0D]+", r.text)), r.doc_id)
    assert {r.doc_id for r in rows["exact_dedup"]} == set(texts.values())
    groups = brute([(r.doc_id, r.text) for r in rows["exact_dedup"]])
    near = {i for i, (_, root) in groups.items() if root == i}
    assert sorted(r.doc_id for r in rows["near_dedup"]) == sorted(near)
    assert {r.doc_id for r in rows["source_mix"]} == near
    assert all(r == before[r.doc_id] for r in rows["source_mix"])
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=op3_byte_bpe.ranks(public_tokenizers.path(pipe.TOKENIZER)), special_tokens={})
    assert len(rows["byte_bpe"]) == len(rows["source_mix"])
    ids = {i: library.encode_ordinary(before[i].text) for i in near}
    assert all(r.ids == ids[r.doc_id] and r.n_tokens == len(r.ids) for r in rows["byte_bpe"])


def test_registered_with_all_operators():
    path = Path(__file__).resolve().parents[2] / "__spark_entry__.py"
    spec = importlib.util.spec_from_file_location("entry_for_test", path)
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert op6_exact_dedup.NAME in entry.oracle_sql()


def test_stages_decide_by_row_not_by_id(spark):
    words = [f"w{i}" for i in range(60)]
    base, near, other = " ".join(words), " ".join(words + ["more"]), " ".join(f"o{i}" for i in range(30))
    lone = [" ".join(f"{x}{i}" for i in range(20)) for x in "pq"]
    schema = "doc_id long, text string, lang string, source string, n_chars long"

    def table(*rows):
        return spark.createDataFrame([(i, t, None, s, 1) for i, t, s in rows], schema)

    def left(df):
        return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)

    exact = table((3, "A", "s"), (5, "A", "s"), (5, "B", "s"), (7, "C", "s"), (7, "C", "s"), (None, "D", "s"), (None, "D", "s"), (None, "C", "s"))
    assert left(pipe.exact_dedup(spark, exact, SF)) == sorted([(3, "A"), (5, "B"), (7, "C"), (None, "D")], key=str)

    rows = [(3, base, "s"), (5, near, "s"), (5, other, "s"), (5, other, "s"), (None, lone[0], "s"), (None, lone[0] + " z", "s"), (None, lone[1], "s"), (9, "", "s")]
    got = left(pipe.near_dedup(spark, table(*rows), SF))
    assert [t for i, t in got if i is None and t.startswith("q")] == [lone[1]]
    assert len([t for i, t in got if i is None and t.startswith("p")]) == 1
    assert sorted((i, t) for i, t in got if i is not None) == sorted([(3, base), (5, other), (9, "")])

    rows = [(i, f"text {i}", "large") for i in range(40)] + [(7, "other text", "large"), (7, "other text", "large")]
    rows += [(None, f"null {i}", "large") for i in range(3)] + [(None, None, "large"), (None, None, "large")]
    rows += [(5, "small one", "small"), (5, "small one", None)]
    mixed = [(r.doc_id, r.text, r.source) for r in pipe.source_mix(spark, table(*rows), SF).collect()]
    assert set(mixed) == set(rows)
    assert all(mixed.count(r) == rows.count(r) for r in rows if r[2] == "large")


def test_arrow_steps_over_texts_get_batches_of_bounded_bytes(spark):
    limit = pipe.ARROW_LIMIT
    rows = [(i, f"{i} the words of a text " * 400, "en", "s", 1) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)

    def sizes(batches):
        for b in batches:
            yield pa.record_batch([pa.array([b.nbytes])], ["n"])

    for own, most in ((None, pipe.ARROW_BYTES), (str(1 << 20), 1 << 20)):
        spark.conf.unset(limit) if own is None else spark.conf.set(limit, own)
        try:
            pipe.byte_bpe(spark, docs, SF)
            assert max(r.n for r in docs.mapInArrow(sizes, "n long").collect()) < most + (1 << 17)
        finally:
            spark.conf.unset(limit)


def test_a_step_gives_its_memory_back():
    """What many small arrays took is free again at the end of the step."""

    def anonymous():
        return int(next(x for x in Path("/proc/self/status").read_text().splitlines() if x.startswith("RssAnon")).split()[1])

    def step(batches):
        for batch in batches:
            held = [np.ones(8_000) for _ in range(4_000)]  # 256 MB
            last = np.ones(8_000)  # above them
            kept.append(last)
            del held
            yield batch

    kept = []
    before = anonymous()
    assert [b.num_rows for b in textops.freed(step)([pa.record_batch([pa.array([1, 2])], ["x"])])] == [2]
    assert anonymous() - before < 100_000
