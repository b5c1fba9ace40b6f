"""lakeledger: a PySpark-native medallion pipeline for a keyed payments log.

Subpackages: ``sources`` (log, Parquet tables, fixture), ``functions`` (rules, wire
codec), ``operators`` (bronze, silver, quality, gold, generator, audits),
``streaming`` (ingest, watermark dedup), ``plans`` (runs, registry).
"""

__version__ = "0.1.0"
