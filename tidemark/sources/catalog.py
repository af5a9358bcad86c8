"""Catalog metadata: table existence, storage format guard, listings."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from tidemark.sources.tables import quote


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def table_provider(spark: SparkSession, name: str) -> str | None:
    """Storage provider (``parquet``, ``delta``, ...) from DESCRIBE TABLE
    EXTENDED; ``view`` for a view; None if the table does not exist."""
    if not table_exists(spark, name):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quote(name)}").collect()
    info = {r.col_name.strip(): (r.data_type or "").strip() for r in rows if r.col_name}
    if info.get("Type", "").upper() == "VIEW":
        return "view"
    return (info.get("Provider") or "").lower() or None


def require_format(spark: SparkSession, name: str, fmt: str, allow_view: bool = False) -> None:
    """Refuse to touch an existing table stored in another format."""
    provider = table_provider(spark, name)
    if provider is None or provider == fmt.lower() or (allow_view and provider == "view"):
        return
    raise ValueError(f"{name} is stored as {provider}, not as {fmt}; it is left as it is")


def require_source_format(spark: SparkSession, name: str, fmt: str) -> None:
    """A source table must exist and be stored in ``fmt`` (views of such
    tables are accepted)."""
    provider = table_provider(spark, name)
    if provider is None:
        raise ValueError(f"{name}: source table does not exist")
    if provider not in (fmt.lower(), "view"):
        raise ValueError(f"{name}: Bronze source must be a {fmt} table (provider: {provider})")


def list_tables(spark: SparkSession, namespace: str) -> list[str]:
    """Table names in a namespace (SHOW TABLES)."""
    return sorted(t.name for t in spark.catalog.listTables(namespace))


def create_namespace(spark: SparkSession, namespace: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quote(namespace)}")


def resolved_name(spark: SparkSession, namespace: str) -> str:
    """A namespace with its catalog, lower case: equal for two spellings of
    the same place."""
    parts = [p.strip("`").casefold() for p in namespace.split(".")]
    return ".".join(parts if len(parts) > 1 else [spark.catalog.currentCatalog().casefold(), *parts])


def _rename(spark: SparkSession, was: str, to: str) -> None:
    """The new name is one of the same catalog, without it."""
    spark.sql(f"ALTER TABLE {quote(was)} RENAME TO {quote(*to.split('.')[-2:])}")


def recover_table(spark: SparkSession, name: str) -> str | None:
    """Bring a table back to one whole state after a driver was lost within
    ``replace_table``; returns what was done. The names that are left tell the
    step: the old table steps aside only when the new one is complete, so a
    new one beside an old one that has stepped aside takes its place; an old
    one alone comes back; everything else beside a table is dropped."""
    namespace, _, table = name.rpartition(".")
    if not spark.catalog.databaseExists(namespace):
        return None
    left = {t.name for t in spark.catalog.listTables(namespace) if re.fullmatch(re.escape(table) + "__(new|old)_[0-9a-f]{12}", t.name)}
    done = None
    if not table_exists(spark, name):
        for old in sorted(t for t in left if t.startswith(f"{table}__old_")):
            fresh = old.replace("__old_", "__new_")
            taken = fresh if fresh in left else old
            _rename(spark, f"{namespace}.{taken}", name)
            left.discard(taken)
            done = "finished" if taken == fresh else "restored"
            break
    for rest in sorted(left):
        spark.sql(f"DROP TABLE {quote(f'{namespace}.{rest}')}")
        done = done or "cleaned"
    return done


def replace_table(spark: SparkSession, name: str, write: Callable[[str], None]) -> None:
    """Replace a table by what ``write`` puts into a table of the name it is
    given. The old table stays as it is until the new one is complete, and
    comes back if it can't take its place; an unfinished one is dropped. What
    an earlier call left, whose driver was lost, is put right first. One
    writer a table at a time."""
    recover_table(spark, name)
    mark = uuid.uuid4().hex[:12]
    fresh, old = f"{name}__new_{mark}", f"{name}__old_{mark}"
    try:
        write(fresh)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {quote(fresh)}")
        raise
    moved = table_exists(spark, name)
    if moved:
        _rename(spark, name, old)
    try:
        _rename(spark, fresh, name)
    except BaseException:
        if moved:
            _rename(spark, old, name)
        raise
    if moved:
        spark.sql(f"DROP TABLE {quote(old)}")


def view_target(spark: SparkSession, name: str) -> str | None:
    """The table that a view made by ``switch_view`` reads, without its namespace."""
    if table_provider(spark, name) != "view":
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quote(name)}").collect()
    text = next((r.data_type or "" for r in rows if (r.col_name or "").strip() == "View Text"), "")
    return text.strip().rstrip("`").rpartition("`")[2] or None


def switch_view(spark: SparkSession, name: str, target: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {quote(name)} AS SELECT * FROM {quote(target)}")
