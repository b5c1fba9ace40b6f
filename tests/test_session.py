"""Session settings the pipeline relies on, and the shared scratch folder."""

from __future__ import annotations

from lakeledger.session import build_session, ensure_utc, scratch_path, shared_dir


def test_session_is_utc_with_aqe(spark):
    s = build_session("lakeledger-tests")
    assert s is spark, "an existing session is reused"
    assert s.conf.get("spark.sql.session.timeZone") == "UTC"
    assert s.conf.get("spark.sql.adaptive.enabled") == "true"
    assert s.version.startswith("4.")


def test_shuffle_partitions_tuned_for_local(spark):
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) <= 16


def test_ensure_utc_repins_the_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    ensure_utc(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_scratch_lives_under_the_shared_checkpoint_folder(spark):
    root = shared_dir(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(root) and b.startswith(root) and a != b


def test_no_driver_local_scratch_on_a_cluster():
    import pytest

    class _Conf:
        def get(self, key, default=None):
            return default

    class _Ctx:
        master = "yarn"

        def getConf(self):
            return _Conf()

    class _Session:
        conf = _Conf()
        sparkContext = _Ctx()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_Session())
