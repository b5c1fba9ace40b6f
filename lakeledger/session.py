"""Session-level settings the pipeline relies on, and where scratch tables live."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(
    app_name: str = "lakeledger",
    *,
    master: str | None = None,
    shuffle_partitions: int | None = None,
) -> SparkSession:
    """A session with the settings the pipeline relies on: UTC session zone, AQE on,
    no web UI. On a cluster leave ``master`` and ``shuffle_partitions`` unset (the
    cluster's defaults, coalesced by AQE); locally pass a small partition count.
    Returns the running session if there is one, with the zone pinned."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Pin the session zone to UTC: every instant on the wire is UTC-aware, and a
    host zone would shift event dates and ingest dates."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Scratch tables and stream checkpoints go there so every executor sees them.
    Only when the setting is absent (a bare local session, as in tests) is a
    private folder created and recorded.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            # Executors cannot see a folder on the driver's disk.
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a shared folder (HDFS or object "
                "store) for stream checkpoints and scratch tables"
            )
        configured = tempfile.mkdtemp(prefix="lakeledger-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared folder."""
    path = f"{shared_dir(spark)}/lakeledger/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Remove every scratch folder this process has named so far; returns how many. For
    callers that are done with the frames read from them (a frame is lazy, so a folder
    can't go when its query returns)."""
    paths, _SCRATCH[:] = list(_SCRATCH), []
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return len(paths)
