import pytest

from metaloom.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = local_session(
        8,
        3,
        **{
            "spark.default.parallelism": "2",
            "spark.checkpoint.dir": str(folder / "checkpoint"),
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    changed = {}

    def set_conf(**settings):
        for key, value in settings.items():
            key = key.replace("__", ".")
            changed.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_conf
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
