import pytest

from paywatch import session


class Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Spark:
    def __init__(self, master, folder=None, named=None):
        self.sparkContext = Context(master, folder)
        self.conf = Conf({"spark.checkpoint.dir": named} if named else {})


def test_named_folder_is_used():
    assert session.shared_folder(Spark("yarn", named="hdfs://x/y/")) == "hdfs://x/y"


def test_local_session_gets_one_folder_of_its_own():
    spark = Spark("local[2]")
    assert session.shared_folder(spark) == session.shared_folder(spark)


def test_cluster_without_a_folder_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Spark("yarn"))


def test_materialized_rows_are_the_rows(spark):
    df = spark.range(5).selectExpr("id", "cast(id AS decimal(9,2)) AS v")
    again = session.materialize(df, "t")
    assert again.dtypes == df.dtypes
    assert sorted(again.collect()) == sorted(df.collect())
    assert again.inputFiles()[0].split("paywatch/t-")[0].endswith("/")
