"""Where the layers live: catalog, schema prefix and storage format."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class LakeConfig:
    catalog: str = "spark_catalog"
    prefix: str = "tpch"
    fmt: str = "parquet"
    # Buckets for the order_key-clustered Silver tables: 0 = not bucketed,
    # -1 = sized from the Bronze line-item table (about 256 MB per bucket),
    # n > 0 = exactly n.
    buckets: int = 0

    @property
    def bronze(self) -> str:
        return f"{self.catalog}.{self.prefix}_bronze"

    @property
    def silver(self) -> str:
        return f"{self.catalog}.{self.prefix}_silver"

    @property
    def gold(self) -> str:
        return f"{self.catalog}.{self.prefix}_gold"
