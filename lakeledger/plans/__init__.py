"""Runs: ingest, refine, the daily sequence."""

from lakeledger.plans.medallion import Layout, ingest, refine, run_daily

__all__ = ["Layout", "ingest", "refine", "run_daily"]
