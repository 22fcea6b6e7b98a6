import pytest

from tidemark import session


class Conf(dict):
    def set(self, name, value):
        self[name] = value


class Fake:
    def __init__(self, **conf):
        self.conf = Conf({k.replace("__", "."): v for k, v in conf.items()})


def test_shared_folder_comes_from_the_session():
    fake = Fake(spark__checkpoint__dir="hdfs://x/shared/", spark__master="yarn")
    path = session.shared_dir(fake, "expiry")
    assert path.startswith("hdfs://x/shared/tidemark/expiry-")
    assert path != session.shared_dir(fake, "expiry")


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Fake(spark__master="yarn"), "expiry")


def test_local_sessions_get_their_own_folder():
    fake = Fake(spark__master="local[2]")
    assert session.shared_dir(fake, "a").startswith(fake.conf["spark.checkpoint.dir"])


def test_written_reads_back_the_same_rows(spark):
    df = spark.range(10).selectExpr("id", "id % 3 AS r")
    assert session.written_to(df, session.shared_dir(spark, "test")).exceptAll(df).count() == 0
