"""Command-line entry: ``python -m lakeledger <command> --warehouse <root> ...``.

Commands map one-to-one onto library calls; the arguments only select tables,
run ids and limits. A failed data-quality gate exits with status 1 and one
readable line on stderr, after the evidence (DQ rows, gold) is written.
"""

from __future__ import annotations

import argparse
import json
import sys

from lakeledger.functions.rules import QUARANTINE_RULES, WIRE_RULES
from lakeledger.operators.quality import DataQualityBreach
from lakeledger.plans.incremental import IncrementalLayout, refine_new
from lakeledger.plans.medallion import Layout, ingest, refine, run_daily, threshold_override
from lakeledger.schemas import DEFAULT_RETAIN_HOURS
from lakeledger.session import build_session
from lakeledger.sources import tables as tb


#: Fixed value: what a scheduler looks for on stderr when the gate closes.
GATE_MESSAGE = "DATA QUALITY GATE FAILED"


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lakeledger", description="Payments log medallion.")
    p.add_argument("command",
                   choices=["generate", "ingest", "refine", "optimize", "vacuum", "daily"])
    p.add_argument("--warehouse", default=None, help="root folder of the tables")
    p.add_argument("--log", help="ingest: folder of the Parquet log")
    p.add_argument("--seconds", type=float, default=None,
                   help="ingest: run this long on the default trigger (default: drain)")
    p.add_argument("--max-per-trigger", type=int, default=None, help="ingest: batch cap")
    p.add_argument("--run-id", default=None, help="refine/daily: name its DQ rows are kept under")
    p.add_argument("--dq-threshold", type=float, default=None,
                   help="refine/daily: highest share of failed rows that any check may have")
    p.add_argument("--new-only", action="store_true",
                   help="refine: only batches that landed since the last such run (tables of its own)")
    p.add_argument("--rules", choices=["silver", "domain"], default="silver",
                   help="refine: the four silver rules, or the domain model's checks")
    p.add_argument("--tables", default="bronze,silver,gold",
                   help="optimize/vacuum: comma list of tables, or 'all'")
    p.add_argument("--retain-hours", type=float, default=DEFAULT_RETAIN_HOURS,
                   help="vacuum/daily: age from which an unfinished batch may go")
    p.add_argument("--short-retention", action="store_true",
                   help="vacuum/daily: allow --retain-hours under a week (a slow writer's batch could go)")
    p.add_argument("--bootstrap-servers", default=None, help="ingest/generate: Kafka brokers (with --topic)")
    p.add_argument("--topic", default=None, help="ingest/generate: Kafka topic")
    p.add_argument("--starting-offsets", default="earliest", help="ingest: where a new checkpoint starts")
    p.add_argument("--app-id", default="bronze", help="ingest: name of this line of batches")
    p.add_argument("--master", default=None)
    g = p.add_argument_group("generate (writes --count messages to --log)")
    g.add_argument("--count", type=int, default=500)
    g.add_argument("--seed", type=int, default=0)
    g.add_argument("--records-per-file", type=int, default=None, help="cut log files at so many rows")
    for name, default in (("duplicate", 0.05), ("late", 0.02), ("null-field", 0.01),
                          ("negative-amount", 0.01), ("unknown-currency", 0.01)):
        g.add_argument(f"--{name}", type=float, default=default)
    return p


def _generate(spark, args) -> int:
    from datetime import UTC, datetime

    from lakeledger.operators.generate import DefectRates, generate_log
    from lakeledger.sources.log import write_log

    if not (args.log or args.bootstrap_servers):
        print("generate needs --log or --bootstrap-servers", file=sys.stderr)
        return 2
    defects = DefectRates(duplicate=args.duplicate, late=args.late, null_field=args.null_field,
                          negative_amount=args.negative_amount,
                          unknown_currency=args.unknown_currency)
    ids = spark.range(args.count).withColumnRenamed("id", "seq")
    log = generate_log(ids, args.count, seed=args.seed, defects=defects,
                       clock=datetime.now(UTC))
    topic = {"topic": args.topic} if args.topic else {}
    delivered = write_log(log, args.log, bootstrap_servers=args.bootstrap_servers,
                          max_records_per_file=args.records_per_file, **topic)
    print(json.dumps({"delivered": delivered, "log": args.log}))
    return 0


def _upkeep(spark, layout, args, name: str) -> dict:
    """optimize: a compacted copy beside the table; vacuum: remove crashed batches."""
    if name == "quarantine":  # a verdict of the judged rows, stored with silver
        return _upkeep(spark, layout, args, "silver") | {"table": name, "kept_with": "silver"}
    if name not in layout.TABLES:
        return {"table": name, "skipped": "unknown table"}
    path, (_, schema, parts) = layout.path(name), layout.TABLES[name]
    if not tb.exists(spark, path):
        return {"table": name, "skipped": "not written yet"}
    if args.command == "vacuum":
        return {"table": name, "removed": tb.sweep(spark, path, retain_hours=args.retain_hours)}
    out = f"{path}_compacted"
    return {"table": name, "out": out, "rows": tb.compact(spark, path, out, schema=schema, partition_by=parts)}


def main(argv: list[str] | None = None, spark=None) -> int:
    args = _parser().parse_args(argv)
    spark = spark or build_session(f"lakeledger-{args.command}", master=args.master)
    if args.command == "generate":
        return _generate(spark, args)
    if not args.warehouse:
        print(f"{args.command} needs --warehouse", file=sys.stderr)
        return 2
    if args.command in ("vacuum", "daily") and args.retain_hours < DEFAULT_RETAIN_HOURS and not args.short_retention:
        print(f"{args.command}: under {DEFAULT_RETAIN_HOURS} hours a batch that is still being written could go; "
              "add --short-retention if none is", file=sys.stderr)
        return 2
    layout = IncrementalLayout(args.warehouse) if args.new_only else Layout(args.warehouse)
    try:
        if args.command == "ingest":
            if not (args.log or args.bootstrap_servers):
                print("ingest needs --log or --bootstrap-servers", file=sys.stderr)
                return 2
            ingest(spark, layout, args.log, bootstrap_servers=args.bootstrap_servers, topic=args.topic,
                   starting_offsets=args.starting_offsets, app_id=args.app_id,
                   max_per_trigger=args.max_per_trigger, run_seconds=args.seconds)
            print(json.dumps({"ingested_into": layout.path("bronze")}))
        elif args.command == "refine":
            rules = WIRE_RULES if args.rules == "domain" else QUARANTINE_RULES
            if args.new_only and rules != QUARANTINE_RULES:
                print("refine --new-only keeps its counts by the silver rules", file=sys.stderr)
                return 2
            out = (refine_new if args.new_only else refine)(
                spark, layout, run_id=args.run_id, rules=rules, thresholds=threshold_override(args.dq_threshold, rules))
            print(json.dumps(out, default=str))
        elif args.command == "daily":
            out = run_daily(spark, layout, args.run_id or "daily",
                            thresholds=threshold_override(args.dq_threshold), retain_hours=args.retain_hours)
            print(json.dumps(out, default=str))
        else:
            for name in layout.TABLES if args.tables == "all" else args.tables.split(","):
                print(json.dumps(_upkeep(spark, layout, args, name), default=str))
    except DataQualityBreach as exc:
        print(f"{GATE_MESSAGE}: {exc.args[0]}", file=sys.stderr)
        return 1
    return 0
