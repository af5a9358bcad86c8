"""Personal data by bootstrapped contexts, DataFrame functions only.

Base spans come from four patterns (e-mail, ip, card, phone). They are the
seeds: every word that holds a digit or an at sign is an instance, its
patterns are the word before it and the word after it, and an instance that
overlaps a base span is known. In each of ``ROUNDS`` rounds a pattern's score
is the mean score of its distinct instances (one is added to their number, so
that rare patterns stay low), and an unknown instance's score is that of its
best pattern with at least ``LEAST_SEEDS`` known instances. Occurrences that
overlap no base span are added as spans of kind ``other``: those of unknown
instances that end at ``CONFIDENT`` or above, and those of instances known from
elsewhere that stand in such a pattern of ``CONFIDENT`` or above themselves.

One scan computes the spans and instances of each text; only texts with a
digit or an at sign are searched. Scores move over the graph of distinct
(pattern, instance) edges by joins and aggregates with map-side combine.

The expressions equal the leftmost, greedy patterns of the kinds but never
try a start within a run that has failed, so long runs cost their length.
Offsets are summed in blocks of ``BLOCK`` matches, so a text costs about its
matches times ``BLOCK``.

Defined cases: null text is empty and has no spans; rows with a null or
repeated id are told apart by their text, and identical rows get identical
results; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.staging import read, stage

NAME = "op10_pii"
ORACLE_SQL = None
ROUNDS = 3
LEAST_SEEDS = 3
CONFIDENT = 0.6
CONTEXT_CHARS = 80
BLOCK = 256

_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
#: Kind -> (expression, what a text must hold).
KINDS = {
    "email": (rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++", "@"),
    "ip": (r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}", "[0-9]\\.[0-9]"),
    "card": (r"[0-9]++(?:[\x20-][0-9]++)*+", r"[0-9](?:[\x20-]?[0-9]){15}"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
}
INSTANCE = r"(?<![^\x20\x09-\x0D])(?=[^\x20\x09-\x0D]*[0-9@])[^\x20\x09-\x0D]++"
SPAN = "array<struct<start:int,end:int>>"
WORD = "array<struct<start:int,end:int,word:string,left:string,right:string>>"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        bare = F.transform(F.split(match, r"\."), lambda p: F.ltrim(p, F.lit("0")))
        return F.forall(bare, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        digits = _digits(match)
        return F.length(digits).between(16, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(_digits(match)).between(8, 15)
    return F.lit(True)


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _matches(text: Column, expression: str, keep, build, kind: str) -> Column:
    """Matches in order, with code point offsets: between the pieces that a
    split by the expression leaves."""
    one = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))
    many = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kind}>").alias("out"))

    def step(state: Column, row: Column) -> Column:
        begin = state["at"] + F.length(row["before"])
        end = begin + F.length(row["match"])
        new = F.array(build(begin, end, row)).cast(kind)
        return F.struct(end.alias("at"), F.when(keep(row["match"]), F.concat(state["out"], new)).otherwise(state["out"]).alias("out"))

    def zipped(x: Column) -> Column:
        size = F.size(x["found"])
        after = F.slice(x["pieces"], F.lit(2), size)
        return F.arrays_zip(F.slice(x["pieces"], F.lit(1), size).alias("before"), x["found"].alias("match"), after.alias("after"))

    def blocks(rows: Column) -> Column:
        # a match is appended to its block's array, a block's array to the one of blocks
        def block(state: Column, number: Column) -> Column:
            begin = F.struct(state["at"].alias("at"), one["out"].alias("out"))
            some = F.aggregate(F.slice(rows, number * BLOCK + 1, F.lit(BLOCK)), begin, step)
            return _bound(some, lambda x: F.struct(x["at"].alias("at"), F.concat(state["out"], F.array(x["out"])).alias("out")))

        return F.aggregate(F.sequence(F.lit(0), F.floor(F.size(rows) / BLOCK).cast("int")), many, block, lambda s: F.flatten(s["out"]))

    parts = F.struct(F.regexp_extract_all(text, F.lit(expression), F.lit(0)).alias("found"), F.split(text, expression, -1).alias("pieces"))
    return _bound(parts, lambda x: _bound(zipped(x), blocks))


def base_spans(text: Column, kind: str) -> Column:
    """The spans of one kind, an array of (start, end) in code points."""
    expression, needs = KINDS[kind]
    spans = _matches(text, expression, lambda m: _valid(kind, m), lambda a, b, _: F.struct(a.alias("start"), b.alias("end")), SPAN)
    return F.when(text.rlike(needs), spans).otherwise(F.array().cast(SPAN))


def _instances(text: Column) -> Column:
    """Words with a digit or an at sign, and the words beside them."""

    def plain(part: Column) -> Column:
        return F.lower(F.regexp_replace(part, r"[\x09-\x0D]", " "))

    def build(a: Column, b: Column, row: Column) -> Column:
        left = F.substring_index(F.rtrim(plain(F.right(row["before"], F.lit(CONTEXT_CHARS)))), " ", -1)
        right = F.substring_index(F.ltrim(plain(F.left(row["after"], F.lit(CONTEXT_CHARS)))), " ", 1)
        return F.struct(a.alias("start"), b.alias("end"), row["match"].alias("word"), left.alias("left"), right.alias("right"))

    found = _matches(text, INSTANCE, lambda m: F.lit(True), build, WORD)
    return F.when(text.rlike("[0-9@]"), found).otherwise(F.array().cast(WORD))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, key, email, ip, card, phone, words)`` of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    doc = F.col(id_col).cast("long")
    rows = df.select(doc.alias("doc_id"), F.xxhash64(doc, text).alias("key"), text.alias("text"))
    return rows.select("doc_id", "key", *[base_spans(F.col("text"), k).alias(k) for k in KINDS], _instances(F.col("text")).alias("words"))


def occurrences(scanned: DataFrame) -> DataFrame:
    """``(key, start, end, word, left, right, known)`` of every instance."""
    spans = F.concat(*[F.col(k) for k in KINDS])
    rows = scanned.filter(F.size("words") > 0).select("key", spans.alias("spans"), F.explode("words").alias("w"))
    known = F.exists("spans", lambda s: (s["start"] < F.col("w.end")) & (F.col("w.start") < s["end"]))
    return rows.select("key", "w.start", "w.end", "w.word", "w.left", "w.right", known.alias("known")).distinct()


def bootstrap(found: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """(scores, patterns): ``(word, known, score)`` of every instance and
    ``(side, context, n, seeds, score)`` of every lexical pattern."""
    words = stage(found.groupBy("word").agg(F.max("known").alias("known")), "pii-words")
    sides = F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("context")) for s in ("left", "right")])
    edges = found.select("word", F.explode(sides).alias("p")).select("word", "p.side", "p.context")
    edges = stage(edges.filter(F.col("context").rlike(r"\p{L}") & ~F.col("context").rlike("[0-9@]")).distinct(), "pii-edges")
    scores = words.withColumn("score", F.col("known").cast("double"))
    for _ in range(rounds):
        patterns = edges.join(scores, "word").groupBy("side", "context").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("known").cast("long")).alias("seeds"), F.sum("score").alias("total")
        )
        patterns = stage(patterns.select("side", "context", "n", "seeds", (F.col("total") / (F.col("n") + 1)).alias("score")), "pii-patterns")
        strong = patterns.filter(F.col("seeds") >= LEAST_SEEDS).select("side", "context", F.col("score").alias("p"))
        best = edges.join(strong, ["side", "context"]).groupBy("word").agg(F.max("p").alias("p"))
        scores = words.join(best, "word", "left").select(
            "word", "known", F.when(F.col("known"), 1.0).otherwise(F.coalesce("p", F.lit(0.0))).alias("score")
        )
        scores = stage(scores, "pii-scores")
    return scores, patterns


def find_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, key, email, ip, card, phone, other)``: arrays of spans."""
    scanned = stage(scan(df, id_col, text_col), "pii-spans")
    found = stage(occurrences(scanned), "pii-instances")
    scores, patterns = bootstrap(found)
    new = scores.filter(~F.col("known") & (F.col("score") >= CONFIDENT)).select("word")
    added = found.join(new, "word").select("key", "start", "end")
    again = found.filter(~F.col("known")).join(scores.filter("known").select("word"), "word")
    sides = F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("context")) for s in ("left", "right")]))
    strong = patterns.filter((F.col("seeds") >= LEAST_SEEDS) & (F.col("score") >= CONFIDENT)).select("side", "context")
    again = again.select("key", "start", "end", sides.alias("p")).select("key", "start", "end", "p.*").join(strong, ["side", "context"])
    every = added.unionByName(again.select("key", "start", "end").distinct())
    other = every.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("other"))
    rows = scanned.drop("words").join(other, "key", "left")
    return rows.withColumn("other", F.coalesce("other", F.array().cast(SPAN)))


def _text(kind: str) -> Column:
    return F.transform(kind, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(read(spark, sf_dir, "documents"))
    base = F.concat(*[_text(k) for k in KINDS])
    return found.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in [*KINDS, "other"]],
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, _text("other")), ",").alias("spans"),
    )
