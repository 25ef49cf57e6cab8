import pytest

from newslake import shared_dir


class Fake:
    def __init__(self, **conf):
        self.values, self.conf = {k.replace("_", "."): v for k, v in conf.items()}, self

    def get(self, key, default=None):
        return self.values.get(key, default)


def test_the_configured_folder_is_used(spark):
    one, other = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert one != other and one.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_a_cluster_must_name_its_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Fake(spark_master="yarn", spark_app_id="a"), "x")


def test_a_local_session_gets_one_of_its_own():
    session = Fake(spark_master="local[2]", spark_app_id="b")
    one, other = shared_dir(session, "x"), shared_dir(session, "x")
    assert one != other and one.split("/newslake/")[0] == other.split("/newslake/")[0]
