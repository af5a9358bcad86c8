"""tidemark — delivery-performance analytics on Spark DataFrames.

Layers: ``sources`` (scans, rules, driver adapter, catalog guards),
``functions`` (column builders), ``operators`` (checks, marts, monitoring,
profiling, copy verification), ``plans`` (Bronze/Silver/Gold jobs, gates,
sinks, query registry), ``streaming`` (incremental monitoring).
"""

__version__ = "0.1.0"
