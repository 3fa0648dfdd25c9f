import os

from tripwire.session import checkpoint_root, ensure_utc, scratch_path


def test_checkpoint_root_is_a_folder_and_stable(spark):
    root = checkpoint_root(spark)
    assert os.path.isdir(root.replace("file:", ""))
    assert checkpoint_root(spark) == root  # set once, then read back from the session


def test_scratch_paths_are_unique(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(checkpoint_root(spark))


def test_ensure_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    ensure_utc(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
