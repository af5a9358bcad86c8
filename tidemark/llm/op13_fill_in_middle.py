"""Fill-in-the-middle transformation by counted quantifiers.

A text is ``n`` units (``UNIT``), as ``regexp_count`` finds them. Two cuts
``a <= b`` between units come from the id's hash, and a pattern made for the
row, ``(unit{a})(unit{b-a})(rest)``, captures prefix, middle and suffix in
one match, which ``regexp_replace`` writes in the order of the row's form.
The counted groups are possessive: the units of a text are unambiguous, so
nothing is ever given back and the match is linear and needs no stack.

``fill_in_middle`` adds columns to whole rows, ``restore`` rebuilds the text
from output and form. All of it is one projection of built-in functions: no
shuffle, no state, each row by itself.

Defined cases: a null text is empty; an empty text, and one that holds a
marker, is plain (the markers of an output are its own, so ``restore`` is
exact); a null id hashes like the empty string, so null ids share their cuts;
equal rows give equal results; added columns replace columns of the same
name (``COLUMNS``), all others stay; an empty table stays empty. A text's
units are counted within one row: a text needs some tens of bytes of memory
a unit while it is counted.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.staging import read

NAME = "op13_fill_in_middle"
UNIT = "[A-Za-z]+|[^A-Za-z]"
MARKERS = ("<P>", "<S>", "<M>")
#: Of 100 rows, so many are rearranged; of 100 of those, so many get the suffix first.
RATE, SPM_RATE = 90, 20
SEED = "1"
COLUMNS = ("n", "form", "prefix_chars", "middle_chars", "output")

ORACLE_SQL = f"""
WITH u AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{UNIT}') AS u,
         sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), c AS (
  SELECT *, len(u) AS n, list_transform([1, 9, 17, 25], lambda i: ('0x' || substr(h, i, 8))::BIGINT) AS k FROM u
), f AS (
  SELECT *, least(k[1] % (n + 1), k[2] % (n + 1)) AS a, greatest(k[1] % (n + 1), k[2] % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR k[3] % 100 >= {RATE} THEN 'plain'
         WHEN k[4] % 100 < {SPM_RATE} THEN 'spm' ELSE 'psm' END AS form
  FROM c
), p AS (
  SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:n], '') AS suf FROM f
)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(pre)::BIGINT END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(mid)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
         ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""


def draws(id_col: str, seed: str = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers from the hash of a row's id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def cut_pattern(unit: str, first: Column, second: Column) -> Column:
    """The row's pattern: groups 1 to 3 are prefix, middle and suffix."""
    counted = F.lit(f"((?:{unit}){{")
    return F.concat(
        F.lit(r"(?s)\A"), counted, first.cast("string"), F.lit("}+)"),
        counted, (second - first).cast("string"), F.lit("}+)"), F.lit(r"(.*+)\z"),
    )


def fill_in_middle(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    unit: str = UNIT,
    markers: Sequence[str] = MARKERS,
    rate: int = RATE,
    spm_rate: int = SPM_RATE,
    seed: str = SEED,
) -> DataFrame:
    """``df`` with ``COLUMNS``: units, form, characters of prefix and middle
    (null if plain) and the output. ``unit`` must not hold capturing groups
    and must find the same units one after the other as within a text."""
    prefix, suffix, middle = markers
    text = F.coalesce(F.col(text_col), F.lit(""))
    h1, h2, h3, h4 = draws(id_col, seed)
    # names that no column of df has, also with case ignored
    taken = {c.lower() for c in df.columns}
    own = lambda name: next(c for i in range(len(taken) + 1) if (c := f"__{name}{i}") not in taken)
    t, n, form, a, b, out = map(own, ("text", "n", "form", "a", "b", "out"))
    whole = F.col(t)
    marked = whole.rlike("|".join(re.escape(m) for m in markers))
    kept = [c for c in df.columns if c.lower() not in COLUMNS]
    cuts = df.select(*(F.col(f"`{c}`") for c in kept), text.alias(t), h1.alias(a), h2.alias(b),
                     F.when((text == "") | (h3 % 100 >= rate), "plain").when(h4 % 100 < spm_rate, "spm").otherwise("psm").alias(form))
    cuts = cuts.withColumns({n: F.regexp_count(whole, F.lit(unit)).cast("long"), form: F.when(marked, "plain").otherwise(F.col(form))})
    cuts = cuts.withColumns({a: F.col(a) % (F.col(n) + 1), b: F.col(b) % (F.col(n) + 1)})
    order = F.when(F.col(form) == "spm", f"{suffix}$3{prefix}$1{middle}$2").otherwise(f"{prefix}$1{suffix}$3{middle}$2")
    pattern = cut_pattern(unit, F.least(a, b), F.greatest(a, b))
    cuts = cuts.withColumn(out, F.when(F.col(form) == "plain", whole).otherwise(F.regexp_replace(whole, pattern, order)))
    # the output's parts lie between its markers, which no text of it holds
    parts = F.split(F.col(out), "|".join(re.escape(m) for m in markers), -1)
    at = F.when(F.col(form) == "spm", 2).when(F.col(form) == "psm", 1)
    result = {
        "n": F.col(n), "form": F.col(form), "prefix_chars": F.char_length(parts[at]).cast("long"),
        "middle_chars": F.when(at.isNotNull(), F.char_length(parts[3])).cast("long"), "output": F.col(out),
    }
    return cuts.select(*(F.col(f"`{c}`") for c in kept), *(column.alias(name) for name, column in result.items()))


def restore(output: Column, form: Column, markers: Sequence[str] = MARKERS) -> Column:
    """The text that ``fill_in_middle`` was given."""
    parts = F.split(output, "|".join(re.escape(m) for m in markers), -1)
    psm, spm = F.concat(parts[1], parts[3], parts[2]), F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
