"""Delivery flags and measures shared by marts and monitoring.

Null semantics are deliberate and asymmetric: a line with a null commit or
receipt date is *not on time* (Q2) and also *not delayed* (Q3, monitoring).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_on_time(receipt: str = "receipt_date", commit: str = "commit_date") -> Column:
    """1 when received on or before the commit date, else 0 (null ⇒ 0)."""
    return F.when(F.col(receipt) <= F.col(commit), 1).otherwise(0)


def is_delayed(receipt: str = "receipt_date", commit: str = "commit_date") -> Column:
    """1 when received strictly after the commit date, else 0 (null ⇒ 0)."""
    return F.when(F.col(receipt) > F.col(commit), 1).otherwise(0)


def days_between(end: str, start: str) -> Column:
    return F.datediff(F.col(end), F.col(start))


def month_of(column: str) -> Column:
    """Month bucket as a timestamp (what date_trunc returns for a DATE)."""
    return F.date_trunc("month", F.col(column))


def rate_pct(numerator: str, denominator: str) -> Column:
    """round(numerator / denominator * 100, 2), a DOUBLE."""
    return F.round(F.col(numerator) / F.col(denominator) * 100, 2)
