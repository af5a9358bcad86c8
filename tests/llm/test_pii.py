import hashlib
import random
import re

from tidemark.llm import op10_pii as op

REGEX = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def brute(text):
    spans = []
    for kind, rx in REGEX.items():
        for m in re.finditer(rx, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if (
                kind == "email"
                or kind == "ip" and all(int(p) <= 255 for p in m.group().split("."))
                or kind == "card" and 16 <= len(digits) <= 19 and luhn(digits)
                or kind == "phone" and 8 <= len(digits) <= 15
            ):
                spans.append((kind, m.start(), m.end()))
    return spans


def corpus():
    rng = random.Random(3)
    parts = list("a.@-+ 0123456789()é😀\n") + ["a@b.c", "x.y_%@mail-1.example.com", "1.2.3.4", "255.255.255.255", "300.1.1.1", "4111111111111111",
             "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (988) 555-2485", "+49 30 1234567", "00.001.0255.7", "1.2.3.4.5.6.7.8", " at ", "@@", ".."]
    out = ["".join(rng.choices(parts, k=rng.randrange(30))) for _ in range(400)]
    return out + [None, "", "a" * 60_000, "1" * 60_000, "1 " * 3_000, "x.y" * 20_000 + "@", "1.2" * 9000, "plain", "+1" + " 2" * 5000]


def test_base_spans_equal_brute_force(spark, tmp_path):
    texts = corpus()
    rows = [(i, t, "e", 5) for i, t in enumerate(texts)]
    path = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, email string, key int").repartition(3).write.parquet(f"{path}/documents.parquet")
    got = {r.doc_id: r for r in op.query(spark, path).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        spans = brute(t)
        want = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        r = got[i]
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest(), (t or "")[:200]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for k, _, _ in spans) for x in REGEX)
        assert r.spans == want or r.spans.startswith(want + ",other:" if want else "other:")


def test_contexts_of_seeds_find_unseen_identifiers(spark):
    rows = [(i, f"please write to user{i}@example.com now or later") for i in range(12)]
    rows += [(100, "please write to user77(at)example now or never"), (101, "version 2.0 of it"), (101, "version 2.0 of it"), (None, "none 3")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, len(r.email), [tuple(s) for s in r.other]) for r in op.find_pii(df).collect()]
    assert (100, 0, [(16, 33)]) in got
    assert got.count((101, 0, [])) == 2 and (None, 0, []) in got and (5, 1, []) in got
    assert op.find_pii(df.filter("false")).count() == 0


def test_known_instances_are_added_where_their_own_context_is_strong(spark):
    rows = [(i, f"please write to user{i}@example.com now or later") for i in range(12)]
    rows += [(50, "call +1 (988) 555-2485 ok"), (51, "please write to 555-2485 soon, to 555-2485 now"), (52, "section 555-2485 ends")]
    got = {r.doc_id: [tuple(s) for s in r.other] for r in op.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got.pop(51) == [(16, 24), (34, 42)] and not any(got.values())


def test_a_text_with_very_many_matches(spark):
    n = 100_000
    text = " ".join(f"1.2.3.{i % 300} é" for i in range(n))
    r = op.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).selectExpr("size(words) AS n", "ip[size(ip) - 1] AS last", "size(ip) AS ips").first()
    want = [(a, b) for kind, a, b in brute(text) if kind == "ip"]
    assert (r.n, r.ips, tuple(r["last"])) == (n, len(want), want[-1])


def test_scores_equal_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, 0, 1, f"w{rng.randrange(30)}", rng.choice("abc"), rng.choice("xyz1"), None) for i in range(150)]
    known = {f"w{i}" for i in range(18)}
    rows = [(*r[:6], r[3] in known) for r in rows]
    found = spark.createDataFrame(rows, "key int, start int, end int, word string, left string, right string, known boolean")
    edges = {(r[3], s, c) for r in rows for s, c in (("left", r[4]), ("right", r[5])) if c != "1"}
    words = {r[3] for r in rows}
    score = {w: float(w in known) for w in words}
    for _ in range(op.ROUNDS):
        pattern = {}
        for p in {(s, c) for _, s, c in edges}:
            own = [w for w, *q in edges if tuple(q) == p]
            pattern[p] = (sum(score[w] for w in own) / (len(own) + 1), sum(w in known for w in own))
        score = {
            w: 1.0 if w in known else max([0.0, *(pattern[s, c][0] for x, s, c in edges if x == w and pattern[s, c][1] >= op.LEAST_SEEDS)]) for w in words
        }
    got = {r.word: r.score for r in op.bootstrap(found)[0].collect()}
    assert got.keys() == score.keys() and all(abs(got[w] - score[w]) < 1e-9 for w in score)
