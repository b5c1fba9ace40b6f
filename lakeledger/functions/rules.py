"""Declarative row rules: (name, SQL predicate), TRUE meaning the row is BAD.

A rule is a SQL string, not a Column, so the same text drives the quarantine
reason, the DQ count and the oracle, and a module-level tuple needs no session.
Every predicate is TRUE for a null it should catch: ``x NOT IN (...)`` alone is NULL, not
TRUE, when x is null, and the row would slip through as clean.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeledger.schemas import CURRENCIES, DEFAULT_FAILURE_THRESHOLD, STATUSES

Rule = tuple[str, str]


def outside(column: str, allowed: Iterable[str]) -> str:
    """Predicate: null, or none of the allowed values."""
    listed = ", ".join("'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'" for value in allowed)
    return f"coalesce({column} NOT IN ({listed}), true)" if listed else "true"


# The four silver rules (name, predicate TRUE = bad), in reason order.
QUARANTINE_RULES: tuple[Rule, ...] = (
    ("non_positive_amount", "amount_minor IS NULL OR amount_minor <= 0"),
    ("unknown_currency", outside("currency", CURRENCIES)),
    ("unknown_status", outside("status", STATUSES)),
    ("missing_counterparty", "counterparty_id IS NULL"),
)

# A zone designator at the end of an ISO time: Z or +hh:mm / -hhmm / +hh.
ZONE_SUFFIX = r"(Z|[+-][0-9]{2}(:?[0-9]{2})?)$"

# Opt-in rules of the domain model, checked on parsed bronze rows. The event time
# must carry a zone on the wire and must not be after the batch's clock, a Kafka key
# cannot be built from an empty account id, and an empty id names no transaction.
WIRE_RULES: tuple[Rule, ...] = QUARANTINE_RULES[:3] + (
    (
        "naive_event_time",
        "get_json_object(raw_payload, '$.event_time') IS NOT NULL AND "
        f"NOT regexp_like(get_json_object(raw_payload, '$.event_time'), '{ZONE_SUFFIX}')",
    ),
    ("future_event_time", "event_time IS NULL OR ingested_at IS NULL OR event_time > ingested_at"),
    ("empty_account_id", "account_id IS NULL OR account_id = ''"),
    ("empty_transaction_id", "transaction_id IS NULL OR transaction_id = ''"),
)


def reason_list(rules: Iterable[Rule] = QUARANTINE_RULES) -> Column:
    """Comma list of every failed rule name, in rule order; '' when none failed."""
    return F.concat_ws(",", *[F.when(F.expr(pred), F.lit(name)) for name, pred in rules])


def resolve_thresholds(
    overrides: Mapping[str, float] | None = None,
    rules: Iterable[Rule] = QUARANTINE_RULES,
    default: float = DEFAULT_FAILURE_THRESHOLD,
) -> dict[str, float]:
    """Per-check limits: the default for every rule, overrides merged on top.

    A rule with no explicit threshold falls back to the default instead of failing.
    """
    limits = {name: float(default) for name, _ in rules}
    for name, value in (overrides or {}).items():
        limits[name] = float(value)
    return limits
