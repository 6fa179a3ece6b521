from types import SimpleNamespace

import pytest

from metaloom import session


def fake(master, **settings):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: settings.get(key, default)),
        sparkContext=SimpleNamespace(master=master),
    )


def test_the_session_names_the_folder():
    named = fake("spark://host:7077", **{session.CHECKPOINT_DIR: "s3://shared/staging/"})
    assert session.staging_root(named) == "s3://shared/staging"
    assert session.staging_path(named, "x").startswith("s3://shared/staging/x-")
    assert session.staging_path(named, "x") != session.staging_path(named, "x")


def test_a_cluster_must_name_it():
    with pytest.raises(RuntimeError, match="every executor can reach"):
        session.staging_root(fake("spark://host:7077"))


def test_local_mode_makes_one():
    local = fake("local[2]")
    assert session.staging_root(local) == session.staging_root(local)


def test_staged_rows_do_not_depend_on_their_source(spark):
    path = session.staging_path(spark, "source")
    spark.range(5).write.parquet(path)
    staged = session.stage(spark.read.parquet(path), "copy")
    assert staged.count() == 5 and path not in staged.inputFiles()[0]
