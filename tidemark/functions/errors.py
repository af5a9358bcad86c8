"""Rule tags: (condition, tag) pairs, kept in rule order.

Rows are selected on the OR of the conditions first (a cheap boolean that
Catalyst can push towards the scan); the ``array<string>`` of tags is then
built only for the offending rows, from one-element arrays that are
flattened — plain codegen-friendly expressions, no higher-order lambda.
A null condition means "not violated".
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[Column, str]


def tag_when(condition: Column, tag: str) -> Rule:
    return (condition, tag)


def any_rule(rules: Sequence[Rule]) -> Column:
    """True when at least one condition is true (nulls count as false)."""
    out = F.lit(False)
    for cond, _ in rules:
        out = out | F.coalesce(cond, F.lit(False))
    return out


def error_array(rules: Sequence[Rule]) -> Column:
    """array<string> of the tags whose condition holds, in rule order."""
    empty = F.array().cast("array<string>")
    if not rules:
        return empty
    return F.flatten(F.array(*[F.when(cond, F.array(F.lit(tag))).otherwise(empty) for cond, tag in rules]))


def required_tags(columns: Sequence[str]) -> list[Rule]:
    return [tag_when(F.col(c).isNull(), f"required:{c}") for c in columns]


def category_tags(allowed: Mapping[str, Sequence[str]]) -> list[Rule]:
    """Null is invalid; matching is exact and case-sensitive."""
    return [tag_when(F.col(c).isNull() | ~F.col(c).isin(*values), f"category:{c}") for c, values in allowed.items()]
