"""The command line drives the same library calls, in-process."""

from __future__ import annotations

import json

from rows import SF_SMALL
from lakeledger.cli import main
from lakeledger.plans.medallion import Layout
from lakeledger.session import ensure_utc
from lakeledger.sources.fixtures import payments_log
from lakeledger.sources.log import write_log


def said(capsys):
    return [json.loads(line) for line in capsys.readouterr().out.strip().splitlines() if line.startswith("{")]


def test_commands(spark, tmp_path, capsys):
    ensure_utc(spark)
    log, wh = str(tmp_path / "log"), str(tmp_path / "wh")
    write_log(payments_log(spark, SF_SMALL), log, max_records_per_file=400)

    def call(*args):
        return main([*args, "--warehouse", wh], spark=spark)

    assert call("ingest") == 2
    assert call("ingest", "--log", log, "--max-per-trigger", "2") == 0
    capsys.readouterr()
    assert call("refine", "--run-id", "one") == 0
    summary = said(capsys)[-1]
    rows = Layout(wh).read(spark, "bronze").count()
    assert summary["bronze_rows"] == rows
    assert call("refine", "--run-id", "two", "--dq-threshold", "0.001") == 1
    assert capsys.readouterr().err.startswith("DATA QUALITY GATE FAILED")
    assert call("refine", "--run-id", "three", "--rules", "domain", "--dq-threshold", "1") == 0
    capsys.readouterr()
    assert call("optimize", "--tables", "bronze,gold,nope") == 0
    assert [r.get("rows") for r in said(capsys)] == [rows, Layout(wh).read(spark, "gold").count(), None]
    assert call("vacuum", "--tables", "all") == 0
    assert all(r.get("removed", []) == [] for r in said(capsys))
    assert call("daily", "--run-id", "four") == 0


def test_generate_then_ingest(spark, tmp_path, capsys):
    log, wh = str(tmp_path / "log"), str(tmp_path / "wh")
    assert main(["generate"], spark=spark) == 2
    assert main(["generate", "--log", log, "--count", "400", "--seed", "3", "--records-per-file", "150"], spark=spark) == 0
    assert said(capsys)[-1]["delivered"] == 400
    assert main(["ingest", "--warehouse", wh, "--log", log], spark=spark) == 0
    layout = Layout(wh)
    assert layout.read(spark, "bronze").count() + layout.read(spark, "bronze_dlq").count() == 400


def test_new_only_retention_and_quarantine(spark, tmp_path, capsys):
    ensure_utc(spark)
    log, wh = str(tmp_path / "log"), str(tmp_path / "wh")
    write_log(payments_log(spark, SF_SMALL), log, max_records_per_file=400)

    def call(*args):
        return main([*args, "--warehouse", wh], spark=spark)

    assert call("ingest", "--log", log) == 0
    assert call("refine", "--new-only", "--rules", "domain") == 2
    assert call("refine", "--new-only", "--run-id", "a") == 0 and call("refine", "--new-only", "--run-id", "b") == 0
    first, second = said(capsys)[-2:]
    assert first["batches"] and second["batches"] == [] and second["run"] == 1
    assert call("vacuum", "--retain-hours", "1") == 2 and "--short-retention" in capsys.readouterr().err
    assert call("vacuum", "--retain-hours", "1", "--short-retention", "--tables", "bronze") == 0
    assert call("refine", "--run-id", "c") == 0
    capsys.readouterr()
    assert call("vacuum", "--tables", "quarantine") == 0
    assert said(capsys)[-1] == {"table": "quarantine", "removed": [], "kept_with": "silver"}
