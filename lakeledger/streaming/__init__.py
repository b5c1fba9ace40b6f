"""Structured Streaming jobs: effectively-once ingest and watermark dedup."""

from lakeledger.streaming.dedup import dedup_within_watermark, kept_rows, late_rows, start_dedup_stream
from lakeledger.streaming.ingest import drain, ingest_stream, land_batch

__all__ = ["dedup_within_watermark", "kept_rows", "late_rows", "start_dedup_stream", "drain", "ingest_stream", "land_batch"]
