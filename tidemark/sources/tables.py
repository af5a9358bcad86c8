"""Table scans: Parquet paths of the driver data and catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SOURCE_TABLES = ("region", "nation", "supplier", "customer", "part", "orders", "lineitem")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a scale-factor directory (column pruning and
    filter pushdown happen at this scan)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quote(*names: str) -> str:
    """Dotted identifiers with every part back-quoted; a blank part is refused."""
    pieces = []
    for name in names:
        if not isinstance(name, str) or not all(piece.strip() for piece in name.split(".")):
            raise ValueError(f"not an identifier: {name!r}")
        pieces += name.split(".")
    return ".".join("`" + piece.replace("`", "``") + "`" for piece in pieces)
