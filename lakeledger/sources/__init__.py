"""The message log and the Parquet tables."""

from lakeledger.sources.log import keyed_log, keyless_log, read_log, read_log_stream, write_log
from lakeledger.sources.tables import append, append_once, compact, read_table, replace_all, replace_partitions, sweep

__all__ = ["keyed_log", "keyless_log", "read_log", "read_log_stream", "write_log",
           "append", "append_once", "compact", "read_table", "replace_all", "replace_partitions", "sweep"]
