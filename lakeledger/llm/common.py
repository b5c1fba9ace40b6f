"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeledger.session import scratch_path

#: White space that separates words, as a character class body (space, TAB..CR).
SPACE = r"\x20\x09-\x0D"

#: A lookup table is broadcast up to this many values (8 bytes each: 16 MB);
#: beyond it the same join runs as a shuffle join.
BROADCAST_VALUES = 2_000_000


def col(name: str) -> Column:
    """The column of exactly this name, dots and back-ticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def others(df: DataFrame, taken) -> list[str]:
    """Column names of ``df`` that the operator's own output columns don't replace
    (Spark compares names without case)."""
    own = {t.lower() for t in taken}
    return [c for c in df.columns if c.lower() not in own]


def by_place(df: DataFrame) -> DataFrame:
    """``df`` with its columns named by place: mapInArrow and mapInPandas can't take names
    that hold dots. The names of what comes out are those of the given schema."""
    return df.toDF(*(f"_{i}" for i in range(len(df.columns))))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder under the shared checkpoint folder and read it
    back: lineage ends there, and a lost executor re-reads files instead of
    recomputing. The folder lives as long as the shared scratch space; it cannot go
    earlier because the returned frame reads it lazily."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Views of at most ``rows`` rows, so that what a task makes of a batch goes out before
    the next part is made."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def lookup_join(df: DataFrame, table: DataFrame, on, values: int, how: str = "inner") -> DataFrame:
    """Join ``df`` with a lookup ``table`` of ``values`` values: broadcast within
    BROADCAST_VALUES, else as an ordinary (shuffled, skew-split by AQE) join."""
    small = F.broadcast(table) if values <= BROADCAST_VALUES else table
    return df.join(small, on, how)


def let(value: str, name: str, body: str) -> str:
    """SQL text that evaluates ``value`` once and names it inside ``body``."""
    return f"transform(array({value}), {name} -> {body})[0]"


def words(text: str = "text") -> str:
    """SQL text for the words of a text: runs of non-space (null: none)."""
    return f"filter(split(coalesce({text}, ''), '[{SPACE}]+'), w -> w != '')".replace("\\", "\\\\")


def uniform(*parts: str) -> str:
    """SQL text for a uniform double in (0, 1) that depends only on ``parts``."""
    return f"((shiftrightunsigned(xxhash64({', '.join(parts)}), 11) + 0.5D) * {2.0**-53!r}D)"
