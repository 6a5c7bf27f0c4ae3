import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tests.conftest import rows
from weftline.operators.snapshots import HASHES, _slots, hash_longs, peel, snapshot_changes

SCHEMA = "snapshot string, k string, v string, o int, key string"


def brute(data):
    states = {}
    for s, k, v, o, _ in data:
        if s is not None and k is not None:
            old = states.setdefault(s, {}).get(k)
            new = (o, v if v is not None else "\0")
            states[s][k] = max(old, new) if old else new
    out, names = [], sorted(states)
    for a, b in zip(names, names[1:], strict=False):
        x, y = states[a], states[b]
        out += [(b, k, "added") for k in y if k not in x] + [(b, k, "removed") for k in x if k not in y]
        out += [(b, k, "changed") for k in y if k in x and x[k][1] != y[k][1]]
    return sorted(out, key=repr)


def run(spark, data, **kw):
    df = spark.createDataFrame(data, SCHEMA)
    return snapshot_changes(df, "k", F.col("snapshot"), F.col("v"), "o", **kw)


def test_hash_equals_the_engine(spark):
    a, b = [1, -5, 1 << 62, 0], [7, 8, -9, 0]
    df = spark.createDataFrame(list(zip(a, b, strict=True)), "a long, b long")
    want = [r[0] for r in df.select(F.xxhash64("a", "b")).collect()]
    assert hash_longs(np.array(a), np.array(b)).tolist() == want


def test_random_snapshots_equal_brute_force(spark):
    rng = random.Random(3)
    data = [(f"s{s}" if rng.random() > 0.02 else None, f"k{rng.randrange(60)}" if rng.random() > 0.05 else None, rng.choice(["a", "b", None, "c"]), rng.randrange(4), "x") for s in range(4) for _ in range(80)]
    data += data[:40]
    assert rows(run(spark, data)) == brute(data)


def test_small_tables_are_enlarged_until_they_peel(spark):
    data = [("a", f"k{i}", "1", 0, None) for i in range(900)] + [("b", f"k{i}", "2", 0, None) for i in range(300, 1200)]
    assert rows(run(spark, data, bucket_keys=200, first_cells=0.01)) == brute(data)
    assert rows(run(spark, data, bucket_keys=200, first_cells=0.01, most_cells=0)) == brute(data)  # compared instead


def test_one_or_no_snapshot(spark):
    assert run(spark, []).count() == 0
    assert run(spark, [("a", "k", "v", 0, None)]).count() == 0
    assert run(spark, [("a", "k", "v", 0, None), ("b", "k", "v", 0, None)]).count() == 0


def test_peel_reports_a_table_that_is_too_full():
    k = np.arange(100)
    width = 10
    cells = np.zeros((HASHES * width, 5), np.int64)
    c = hash_longs(k, k, k)
    for row in _slots(k, k, k, 0, width):
        np.add.at(cells[:, 0], row, 1)
        for j, x in enumerate((k, k, k, c), 1):
            np.bitwise_xor.at(cells[:, j], row, x)
    df = pd.DataFrame(cells, columns=["n", "k1", "k2", "v", "c"])
    df["cell"] = np.arange(len(df))
    assert not peel(df, 0, width)[1]
