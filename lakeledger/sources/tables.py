"""Tables as plain Parquet folders, written by Spark's own writers.

Three shapes, none with metadata of its own:

* **batch tables** (bronze, dead letters): ``app_id=<app>/batch_id=<n>/[<part>=<v>/]``. A
  batch is one overwrite of its own folder, so writing it again after a crash replaces
  what the crash left; a batch whose folder holds ``_SUCCESS`` is complete and never
  written again. One existence check per write, whatever the number of batches.
* **whole tables** (silver, quarantine): overwritten by each run.
* **partition tables** (gold, DQ rows): dynamic partition overwrite of the targeted
  values; a target without new rows is dropped by name.

``write_format`` passes through to the writers, so a table format on the classpath
(one with atomic overwrites) can take Parquet's place. With bare Parquet a reader may
see a folder while it is being overwritten; the daily sequence runs one step at a time.
"""

from __future__ import annotations

import re
import time
from collections.abc import Iterable, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

APP, BATCH = "app_id", "batch_id"
DONE = "_SUCCESS"


class TableNotFound(FileNotFoundError):
    pass


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _at(spark, path)
    return fs.exists(place)


def drop_folder(spark: SparkSession, path: str) -> None:
    fs, place = _at(spark, path)
    fs.delete(place, True)


def _listed(spark: SparkSession, pattern: str) -> list:
    """Folder entries that match (one listing call)."""
    fs, place = _at(spark, pattern)
    return list(fs.globStatus(place) or [])


def _escaped(value) -> str:
    """A partition value as Spark names its folder."""
    if value is None:
        return "__HIVE_DEFAULT_PARTITION__"
    return re.sub(r"[^\w. -]", lambda m: f"%{ord(m[0]):02X}" if m[0].isascii() else m[0], str(value))


def batch_folder(path: str, app_id: str, version: int | str) -> str:
    """ASCII signs are escaped the way Spark reads partition names (%XX, the per cent sign
    included), so no two app ids share a folder."""
    return f"{path.rstrip('/')}/{APP}={_escaped(app_id)}/{BATCH}={version}"


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, *, batches: bool = False,
               read_format: str = "parquet") -> DataFrame:
    """The table's rows. With ``schema`` (declared columns) nothing is inferred: columns a
    part of the table lacks read as null, partition values take their declared type.
    ``batches`` keeps the app id and batch id columns of a batch table."""
    if not exists(spark, path):
        raise TableNotFound(path)
    reader = spark.read.format(read_format)
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField(APP, T.StringType()), T.StructField(BATCH, T.LongType())])
                               if _listed(spark, f"{path}/{APP}=*") else schema)
    df = reader.load(path)
    return df if batches else df.drop(APP, BATCH)


def _rebalanced(df: DataFrame, partition_by: Iterable[str]) -> DataFrame:
    """Rows of a partition value together, a hot value split by AQE: no small files and no
    overloaded writer."""
    by = list(partition_by)
    return df.hint("rebalance", *by) if by else df


def append_once(df: DataFrame, path: str, *, app_id: str, version: int, partition_by: Iterable[str] = (),
                write_format: str = "parquet") -> bool:
    """Write batch ``version`` of ``app_id``, at most once; False if it is there already."""
    spark, folder = df.sparkSession, batch_folder(path, app_id, version)
    if exists(spark, f"{folder}/{DONE}"):
        return False
    df.write.format(write_format).mode("overwrite").partitionBy(*partition_by).save(folder)
    return True


def holds_batches(spark: SparkSession, path: str, app_id: str) -> bool:
    return bool(_listed(spark, f"{batch_folder(path, app_id, '*')}/{DONE}"))


def landed_batches(spark: SparkSession, path: str) -> set[tuple[str, int]]:
    """(app id, batch id) of every complete batch: one listing."""
    names = (s.getPath().getParent() for s in _listed(spark, f"{path.rstrip('/')}/{APP}=*/{BATCH}=*/{DONE}"))
    return {(unquote(f.getParent().getName().partition("=")[2]), int(f.getName().partition("=")[2])) for f in names}


def read_batches(spark: SparkSession, path: str, schema: T.StructType, batches: Iterable[tuple[str, int]], *,
                 read_format: str = "parquet") -> DataFrame:
    """Rows of these batches; no folder of another one is listed or opened."""
    folders = [batch_folder(path, app, n) for app, n in sorted(batches)]
    if not folders:
        return spark.createDataFrame([], schema)
    wide = T.StructType([*schema.fields, T.StructField(APP, T.StringType()), T.StructField(BATCH, T.LongType())])
    return spark.read.format(read_format).schema(wide).option("basePath", path).load(folders).drop(APP, BATCH)


def append(df: DataFrame, path: str, *, partition_by: Iterable[str] = (), write_format: str = "parquet") -> None:
    """Plain append. Columns may be added over time; readers pass the widest schema."""
    df.write.format(write_format).mode("append").partitionBy(*partition_by).save(path)


def replace_all(df: DataFrame, path: str, *, partition_by: Iterable[str] = (), write_format: str = "parquet") -> None:
    """The table becomes ``df``, columns included. ``df`` must not read from ``path``."""
    _rebalanced(df, partition_by).write.format(write_format).mode("overwrite").option(
        "partitionOverwriteMode", "static").partitionBy(*partition_by).save(path)


def replace_partitions(df: DataFrame, path: str, *, column: str, values: Iterable, present: Iterable | None = None,
                       write_format: str = "parquet") -> None:
    """Replace the partitions ``values`` of ``column`` by the rows of ``df`` (which holds no
    others). Targets that ``df`` has no rows for leave the table; ``present`` names those
    it has rows for, where the caller knows them (else they are counted)."""
    spark = df.sparkSession
    if present is None:
        present = [r[0] for r in df.select(F.col(column).cast("string")).distinct().collect()]
    _rebalanced(df, [column]).write.format(write_format).mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(column).save(path)
    vanished = {str(v) for v in values} - {str(v) for v in present}
    for value in sorted(vanished & set(partition_values(spark, path, column))):
        drop_folder(spark, f"{path}/{column}={value}")


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values the table holds (one listing)."""
    return sorted(s.getPath().getName().partition("=")[2] for s in _listed(spark, f"{path}/{column}=*"))


def in_partitions(touched: Iterable[Sequence], columns: Sequence[str]) -> Column:
    """Predicate: the partition columns hold one of these tuples. Prunes folders."""
    each = [reduce(Column.__and__, (F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(columns, values))) for values in touched]
    return reduce(Column.__or__, each) if each else F.lit(False)


def touched_partitions(df: DataFrame, columns: Sequence[str]) -> list[tuple]:
    """The distinct partition tuples of ``df``: one row for each folder that it touches."""
    return sorted((tuple(r) for r in df.select(*columns).distinct().collect()), key=str)


def _folder(path: str, columns: Sequence[str], values: Sequence) -> str:
    return "/".join([path.rstrip("/"), *(f"{c}={_escaped(v)}" for c, v in zip(columns, values))])


def rewrite_partitions(df: DataFrame, path: str, *, partition_by: Sequence[str], touched: Iterable[Sequence],
                       schema: T.StructType) -> None:
    """The partitions ``touched`` become the rows of ``df`` (which holds no others, and may
    read them); no other file is opened for writing.

    The new rows are complete in a folder beside the table before any old one goes, so a
    writer that dies is rolled forward: ``finish_rewrite`` (called here first) puts what it
    left complete in place, and drops what it left incomplete."""
    spark, beside = df.sparkSession, f"{path.rstrip('/')}.rewrite"
    touched = [tuple(t) for t in touched]
    finish_rewrite(spark, path, schema=schema, partition_by=partition_by)
    if not touched:
        return
    by = list(partition_by)
    listed = spark.createDataFrame([tuple(None if v is None else str(v) for v in t) for t in touched], ", ".join(f"`{c}` string" for c in by))
    listed.coalesce(1).write.mode("overwrite").parquet(f"{beside}/touched")
    _rebalanced(df, by).write.mode("overwrite").partitionBy(*by).parquet(f"{beside}/rows")
    finish_rewrite(spark, path, schema=schema, partition_by=by)


def finish_rewrite(spark: SparkSession, path: str, *, schema: T.StructType, partition_by: Sequence[str]) -> bool:
    """Put a rewrite that is complete beside the table in place; True if there was one."""
    by, beside = list(partition_by), f"{path.rstrip('/')}.rewrite"
    if not exists(spark, f"{beside}/rows/{DONE}"):
        drop_folder(spark, beside)
        return False
    touched = [tuple(r) for r in spark.read.parquet(f"{beside}/touched").collect()]
    rows = spark.read.schema(schema).parquet(f"{beside}/rows")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    for values in touched:
        if not exists(spark, _folder(f"{beside}/rows", by, values)):
            drop_folder(spark, _folder(path, by, values))  # all of its rows went
    drop_folder(spark, beside)
    return True


def upsert(changes: DataFrame, path: str, *, key: Sequence[str], partition_by: Sequence[str], schema: T.StructType,
           deleted: str | None = None) -> list[tuple]:
    """Merge ``changes`` into a table partitioned by ``partition_by`` (part of ``key``): rows
    whose key is there are replaced, others added, and those where the boolean column
    ``deleted`` holds go. At most one change for each key; null keys are equal.

    Only partitions that the changes name are read, joined (full outer on the key) and
    rewritten; returns them."""
    spark, names = changes.sparkSession, schema.names
    gone = F.coalesce(F.col(deleted), F.lit(False)) if deleted else F.lit(False)
    new = changes.select(*[F.col(n).alias(f"_n_{n}") for n in names], gone.alias("_gone"), F.lit(True).alias("_is_new"))
    touched = touched_partitions(changes, partition_by)
    if not exists(spark, path):
        old = spark.createDataFrame([], schema)
    else:
        finish_rewrite(spark, path, schema=schema, partition_by=partition_by)
        old = read_table(spark, path, schema).where(in_partitions(touched, partition_by))
    same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_n_{k}")) for k in key))
    merged = old.withColumn("_is_old", F.lit(True)).join(new, same, "full_outer").where(~F.coalesce(F.col("_gone"), F.lit(False)))
    rows = merged.select(*[F.when(F.col("_is_new"), F.col(f"_n_{n}")).otherwise(F.col(n)).alias(n) for n in names])
    rewrite_partitions(rows, path, partition_by=partition_by, touched=touched, schema=schema)
    return touched


def compact(spark: SparkSession, path: str, out: str, *, schema: T.StructType | None = None, partition_by: Iterable[str] = ()) -> int:
    """Rows of a table in files of the advisory size, as a new table ``out``; returns its
    row count. Who reads the table switches to ``out``; the old one can then go."""
    replace_all(read_table(spark, path, schema), out, partition_by=partition_by)
    return read_table(spark, out, schema).count()


def sweep(spark: SparkSession, path: str, *, retain_hours: float) -> list[str]:
    """Remove batch folders that a crash left incomplete, once they are older than
    ``retain_hours`` (a running writer's folder is younger). Two listings."""
    done = {s.getPath().getParent().toString() for s in _listed(spark, f"{path}/{APP}=*/{BATCH}=*/{DONE}")}
    limit = (time.time() - 3600 * retain_hours) * 1000
    gone = [s.getPath().toString() for s in _listed(spark, f"{path}/{APP}=*/{BATCH}=*")
            if s.getPath().toString() not in done and s.getModificationTime() <= limit]
    for folder in gone:
        drop_folder(spark, folder)
    return gone
