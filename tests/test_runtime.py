import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from weftline.runtime import attach, hot_keys, materialize, release, rows_of, salted_join, shared_dir


def test_materialize_cuts_lineage_and_release_deletes(spark):
    df = materialize(spark.range(10).withColumn("x", F.col("id") * 2), "t")
    assert df.count() == 10
    assert "Range" not in df._jdf.queryExecution().optimizedPlan().toString()
    release(df)
    with pytest.raises(Exception):  # noqa: B017
        df.count()


class _Session:
    """As much of a session as the lookup needs."""

    def __init__(self, found, master):
        self.conf = self
        self.sparkContext = self
        self.found, self.master = found, master

    def get(self, key, default=None):
        return self.found if key == "spark.checkpoint.dir" else default

    def getConf(self):
        return self

    @property
    def _jsc(self):
        return self

    def sc(self):
        return self

    def getCheckpointDir(self):
        return self

    def isDefined(self):
        return False


def test_shared_dir_is_the_sessions():
    assert shared_dir(_Session("hdfs://x/shared/", "yarn")) == "hdfs://x/shared"


def test_a_cluster_without_a_shared_dir_is_an_error():
    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            shared_dir(_Session(None, master))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_the_plain_join(spark, how):
    left = spark.createDataFrame([(("hot" if i % 3 else f"k{i % 7}") if i % 11 else None, i) for i in range(200)], "k string, v int")
    right = spark.createDataFrame([("hot", "a"), ("hot", "b"), ("k0", "c"), ("k3", "d"), (None, "e")], "k string, w string")
    plain = left.join(right, "k", how)
    salted = salted_join(left, right, ["k"], how, hot_rows=10)
    assert rows(salted.select(*plain.columns)) == rows(plain)


def test_hot_keys_are_counted(spark):
    left = spark.createDataFrame([("a",)] * 9 + [("b",)], "k string")
    assert [(r["k"], r["_n"]) for r in hot_keys(left, ["k"], 5).collect()] == [("a", 9)]


def test_salted_join_refuses_other_kinds(spark):
    with pytest.raises(ValueError):
        salted_join(spark.range(1), spark.range(1), ["id"], "full")


def test_rows_are_counted_while_written(spark):
    assert rows_of(materialize(spark.range(7), "t")) == 7 == rows_of(spark.range(7))
    assert rows_of(materialize(spark.range(7).where("id > 9"), "t")) == 0 == rows_of(materialize(spark.createDataFrame([], "a int"), "t"))


def test_keys_beyond_the_broadcast_bound_are_attached_all_the_same(spark):
    left = spark.range(60).selectExpr("CASE WHEN id < 30 THEN 0 WHEN id < 55 THEN id % 7 END AS k", "id AS v")
    keys = materialize(spark.createDataFrame([(0, 9), (2, 5), (3, 4), (9, 1)], "k long, w int"), "keys")
    want = rows(left.join(keys, "k", "left").select("k", "v", "w"))
    for bound in (0, 1, 2, 100):
        assert rows(attach(left, keys, ["k"], "w", bound).select("k", "v", "w")) == want
