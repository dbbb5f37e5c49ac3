"""Session helpers: shared folder, temporary shuffle width, topic spreading."""

from __future__ import annotations

from rideflux.session import ensure_utc, run_dir, shared_dir, shuffle_partitions


def test_shared_dir_uses_the_configured_checkpoint_folder(spark):
    d = shared_dir(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert configured and configured.rstrip("/") == d
    a, b = run_dir(spark, "x"), run_dir(spark, "x")
    assert a != b and a.startswith(d + "/x-")


def test_shuffle_partitions_is_restored(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with shuffle_partitions(spark, 3):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    with shuffle_partitions(spark, None):
        assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_default_folder_is_under_the_warehouse():
    class Conf:
        def get(self, key, *default):
            return "/shared/warehouse" if key == "spark.sql.warehouse.dir" else default[0]

    class Context:
        def __init__(self):
            self.dir = None

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, d):
            self.dir = d

    class Session:
        conf, sparkContext = Conf(), Context()

    assert shared_dir(Session()) == "/shared/warehouse/_rideflux" == Session.sparkContext.dir


def test_ensure_utc(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
        ensure_utc(spark)
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
