"""Session settings and the shared folder."""

from tidelog.session import configure_session, scratch_path, shared_dir


def test_shared_dir_and_unique_scratch(spark):
    base = shared_dir(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(base) and b.startswith(base)


def test_configured_checkpoint_dir_wins(spark):
    # a static setting: whatever the session was started with is used
    configured = spark.conf.get("spark.checkpoint.dir", None)
    expected = (configured or spark.sparkContext.getCheckpointDir()).rstrip("/")
    assert shared_dir(spark) == expected


def test_time_zone_pinned(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    configure_session(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    spark.conf.set("spark.sql.session.timeZone", old)
