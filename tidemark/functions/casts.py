"""Contract casts: null-on-failure conversion and the lossless round trip."""

from __future__ import annotations


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def lossy_cast_sql(source: str, source_type: str, dtype: str) -> str:
    """True when a non-null value converts to null or does not come back as the
    same typed value (decimal rounding, overflow, time-of-day loss)."""
    c = _q(source)
    converted = f"try_cast({c} AS {dtype})"
    return f"({c} IS NOT NULL AND ({converted} IS NULL OR NOT ({c} <=> try_cast({converted} AS {source_type}))))"


def cast_is_null_sql(source: str, dtype: str) -> str:
    return f"(try_cast({_q(source)} AS {dtype}) IS NULL)"


def not_allowed_sql(source: str, dtype: str, values) -> str:
    """Null or outside the whitelist, on the contract-typed value."""
    typed = f"try_cast({_q(source)} AS {dtype})"
    listed = ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)
    return f"({typed} IS NULL OR {typed} NOT IN ({listed}))"
