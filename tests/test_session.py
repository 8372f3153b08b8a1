from tripflow.session import BASE_CONF, checkpoint_root, get_session, scratch_path


def test_get_session_reuses_active_session_without_resizing(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    again = get_session()
    assert again is spark
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.adaptive.enabled"):
        assert spark.conf.get(key) == BASE_CONF[key]


def test_scratch_paths_live_under_the_checkpoint_root(spark):
    root = checkpoint_root(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b
    assert a.startswith(root.rstrip("/")) and b.startswith(root.rstrip("/"))
