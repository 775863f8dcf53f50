"""Session settings the reports rely on, and where scratch files go."""

import pytest

from ledgerlens.session import configure, is_local, scratch_path, scratch_root


def test_configure_pins_zone_and_static_broadcast(spark):
    old_tz = spark.conf.get("spark.sql.session.timeZone")
    old_bc = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Guatemala")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760b")   # Spark's default
        configure(spark)
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
        assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "5m")           # cluster's own choice
        configure(spark)
        assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") in ("5m", "5242880b")
        assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old_tz)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old_bc)


def test_scratch_goes_below_the_checkpoint_dir(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert root and scratch_root(spark) == root.rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(root.rstrip("/") + "/") and a != b
    assert spark.sparkContext.getCheckpointDir() is not None


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(Session())
    assert is_local("local") and is_local("local[4]") and not is_local("local-cluster[2,1,1024]") and not is_local("yarn")
