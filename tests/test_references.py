from datetime import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import rows
from weftline.operators.references import Parents, References, orphan_references, orphan_report

REF = "id string, k string, at timestamp_ntz, target string, key string"
PAR = "k string, since timestamp_ntz, gone timestamp_ntz, extra int"


def run(spark, refs, parents, **kw):
    r = spark.createDataFrame(refs, REF)
    p = spark.createDataFrame(parents, PAR)
    return orphan_references([References("t", r, "id", "at", {"k": "p"})], [Parents("p", p, "k", "since", F.col("gone"))], **kw)


def test_missing_late_deleted(spark):
    d = lambda n: dt(2024, 1, n)
    refs = [("ok", "a", d(5), "x", "y"), ("late", "a", d(1), None, None), ("gone", "b", d(9), None, None), ("before", "b", d(7), None, None), ("miss", "z", d(5), None, None), ("blank", "", d(5), None, None), ("null", None, d(5), None, None), ("notime", "a", None, None, None)]
    parents = [("a", d(3), None, 1), ("a", d(2), None, 2), ("b", d(1), d(8), 3), (None, d(1), None, 4), ("", d(1), None, 5)]
    got = {r["row_key"]: r["orphan_kind"] for r in run(spark, refs, parents).collect()}
    assert got == {"late": "late", "gone": "deleted", "miss": "missing", "blank": "missing"}


def test_hot_key_is_salted_alike(spark):
    d = dt(2024, 1, 1)
    refs = [(str(i), "hot" if i % 3 else f"k{i}", d, None, None) for i in range(300)]
    parents = [("hot", dt(2024, 1, 2), None, 0)] + [(f"k{i}", dt(2023, 1, 1), None, 0) for i in range(0, 300, 6)]
    assert rows(run(spark, refs, parents, hot_rows=20)) == rows(run(spark, refs, parents))


def test_empty_tables(spark):
    assert run(spark, [], []).count() == 0
    one = run(spark, [("1", "a", dt(2024, 1, 1), None, None)], [])
    assert rows(orphan_report(one)) == [("t", "k", "missing", "2024-01", 1, 1)]
