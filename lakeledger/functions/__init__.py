"""Rules and the wire codec."""

from lakeledger.functions.rules import (
    QUARANTINE_RULES,
    WIRE_RULES,
    reason_list,
    resolve_thresholds,
)
from lakeledger.functions.wire import iso_instant, kafka_key, parse_wire, to_wire

__all__ = [
    "QUARANTINE_RULES", "WIRE_RULES", "reason_list", "resolve_thresholds",
    "iso_instant", "kafka_key", "parse_wire", "to_wire",
]
