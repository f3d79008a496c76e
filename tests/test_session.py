from clickscope.session import run_dir, work_dir


def test_work_dir_is_the_checkpoint_dir(spark):
    d = work_dir(spark)
    assert d == spark.sparkContext.getCheckpointDir()
    assert run_dir(spark, "x").startswith(d.rstrip("/") + "/x-")
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_publish_refuses_existing_target(spark, scratch):
    import os

    from clickscope.session import fs_publish
    a, b, t = os.path.join(scratch, "a"), os.path.join(scratch, "b"), os.path.join(scratch, "t")
    for d, f in ((a, "x"), (b, "y")):
        os.makedirs(d)
        open(os.path.join(d, f), "w").write("1")
    assert fs_publish(spark, a, t) is True
    assert fs_publish(spark, b, t) is False  # not nested into t, staging dropped
    assert sorted(os.listdir(t)) == ["x"] and not os.path.exists(b)
