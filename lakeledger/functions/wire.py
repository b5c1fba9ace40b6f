"""Wire codec: structured columns to JSON payload bytes and back, and the message key.

Encode is ``to_json`` over the eight wire fields in alphabetical order (sorted keys,
UTF-8), with instants pre-formatted as ISO-8601 text carrying microseconds and an
offset. Decode is a PERMISSIVE ``from_json`` against the declared schema: malformed
input gives null fields, unknown fields are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeledger.schemas import WIRE_FIELDS, WIRE_SCHEMA, WIRE_TIME_FORMAT


def iso_instant(col: Column | str) -> Column:
    """ISO-8601 text of a timestamp, microsecond precision, numeric offset."""
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(c, WIRE_TIME_FORMAT)


def to_wire(df, *, time_columns: tuple[str, ...] = ("event_time", "ingest_time")):
    """Encode a frame holding the eight wire fields into a ``value`` bytes column."""
    fields = []
    for name in sorted(WIRE_FIELDS):
        c = F.col(name)
        if name in time_columns and not isinstance(df.schema[name].dataType, T.StringType):
            c = iso_instant(c.cast(T.TimestampType()))
        fields.append(c.alias(name))
    return df.withColumn("value", F.to_json(F.struct(*fields)).cast(T.BinaryType()))


def parse_wire(value: Column | str = "value") -> Column:
    """Decode payload bytes with the declared schema (PERMISSIVE)."""
    c = F.col(value) if isinstance(value, str) else value
    return F.from_json(c.cast(T.StringType()), WIRE_SCHEMA)


def kafka_key(account_id: Column | str = "account_id", *, strict: bool = False) -> Column:
    """Message key = account id bytes, so one account's records share a partition.

    An empty or null account has no key. With ``strict`` the row raises instead,
    which is what the domain model does for a record it would publish.
    """
    c = F.col(account_id) if isinstance(account_id, str) else account_id
    ok = c.isNotNull() & (F.length(c) > 0)
    if strict:
        return F.when(ok, F.encode(c, "UTF-8")).otherwise(
            F.raise_error(F.lit("Cannot build a message key: account_id is empty or null"))
        )
    return F.when(ok, F.encode(c, "UTF-8"))
