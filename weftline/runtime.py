"""Session-level helpers shared by the operators.

* ``shared_dir`` / ``materialize`` / ``release``: cut lineage with a table written to the
  folder all executors share (``spark.checkpoint.dir``).
* ``rows_of``: the row count of a written table, taken while it was written.
* ``salted_join``: an equi-join that splits the heaviest keys of its left side.
* ``attach``: a left join with a table of heavy keys that never gathers one of them.
* ``bounded_broadcast``: a broadcast hint that is only given after the row count was checked.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

#: A table of at most this many keys may be broadcast. Keys beyond the heaviest so many have less than this share of all rows each.
BROADCAST_KEYS = 200_000


def session(app: str = "weftline", cpus: str = "*", partitions: int | None = None) -> SparkSession:
    """A local session with the settings the operators assume (AQE on, UTC)."""
    b = (
        SparkSession.builder.appName(app)
        .master(f"local[{cpus}]")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if partitions:
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder shared by driver and executors for written intermediate tables.

    ``spark.checkpoint.dir`` of the session wins, then a checkpoint directory set on the
    context. Only a local session may fall back to a temporary folder; a cluster without the
    setting is an error, because a machine-local folder would lose data with its machine.
    """
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return str(current.get()).rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = "file://" + tempfile.mkdtemp(prefix="weftline-")
    sc.setCheckpointDir(own)
    return str(sc._jsc.sc().getCheckpointDir().get()).rstrip("/")


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def materialize(df: DataFrame, label: str = "step", partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as Parquet under :func:`shared_dir` and read it back (lineage ends here).

    The rows are counted while they are written (:func:`rows_of`). The files are deleted by
    :func:`release`, or when the JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/weftline/{label}-{uuid.uuid4().hex}"
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("error")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    out = spark.read.schema(df.schema).parquet(path)
    out._weftline_path, out._weftline_rows = path, int(seen.get["n"])  # both stay with the frame
    return out


def rows_of(df: DataFrame) -> int:
    """Rows of a table made by :func:`materialize`, without a job; others are counted."""
    known = getattr(df, "_weftline_rows", None)
    return df.count() if known is None else known


def release(*frames: DataFrame | None) -> None:
    """Delete the files behind frames made by :func:`materialize` that nothing reads any more."""
    for df in frames:
        path = getattr(df, "_weftline_path", None) if df is not None else None
        if path:
            delete(df.sparkSession, path)


def bounded_broadcast(df: DataFrame, rows: int, bound: int = 200_000) -> DataFrame:
    """Hint a broadcast only when ``rows``, the counted size of ``df``, is within ``bound``."""
    return F.broadcast(df) if rows <= bound else df


def hot_keys(df: DataFrame, on: Sequence[str], hot_rows: int) -> DataFrame:
    """The keys of ``df`` with over ``hot_rows`` rows each (``_n``), written.

    Of more than ``BROADCAST_KEYS`` such keys the heaviest are given; any other has less than one
    row in ``BROADCAST_KEYS``, which no task notices.
    """
    counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    return materialize(counts.orderBy(F.desc("_n")).limit(BROADCAST_KEYS), "hot")


def attach(rows: DataFrame, keys: DataFrame, on: Sequence[str], weight: str, bound: int = BROADCAST_KEYS) -> DataFrame:
    """``rows`` left join ``keys``, a written table with one row for each of some keys.

    Up to ``bound`` keys are broadcast. Of more, the heaviest ``bound`` are broadcast, and only rows
    of the other keys, none of which has over one part in ``bound``, are shuffled to theirs.
    """
    on = list(on)
    if rows_of(keys) <= bound:
        return rows.join(F.broadcast(keys), on, "left")
    heavy = materialize(keys.orderBy(F.desc(weight), *on).limit(bound), "heavy")
    rest = keys.join(F.broadcast(heavy.select(*on)), on, "left_anti")
    light = rows.join(F.broadcast(heavy.select(*on)), on, "left_anti").join(rest, on, "left")
    return rows.join(F.broadcast(heavy), on).unionByName(light)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    hot_rows: int = 500_000,
    max_salts: int = 256,
    hint: str | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Equi-join whose heaviest left keys are split over several tasks.

    Key counts are taken first (aggregated before the shuffle). A key with over ``hot_rows``
    rows is cut into ``ceil(rows / hot_rows)`` salts by a hash of the whole left row (so a
    retried task salts alike); the matching right rows are repeated once per salt. Rows with a
    null key match nothing and are spread too. ``how`` is inner, left, left_semi or left_anti.
    ``rows``: a count of the left rows, or of the rows of their heaviest key, if the caller has
    one; no key can be hot within it. Duplicate column names outside ``on`` are the caller's to avoid.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salted_join can't do {how}")
    on = list(on)
    any_null = F.lit(False)
    for c in on:
        any_null = any_null | F.col(c).isNull()
    rows = getattr(left, "_weftline_rows", None) if rows is None else rows
    right = right.hint(hint) if hint else right
    if rows is not None and rows <= hot_rows:
        return left.join(right, on, how)
    hot = hot_keys(left, on, hot_rows)
    if not rows_of(hot):
        release(hot)
        return left.join(right, on, how)
    hashable = [c for c, t in left.dtypes if "map<" not in t and "variant" not in t]
    spread = F.xxhash64(*hashable)
    keyed = F.broadcast(hot.where(~any_null).select(*on, F.least(F.lit(max_salts), F.ceil(F.col("_n") / hot_rows)).cast("int").alias("_salts")))
    left = left.join(keyed, on, "left")
    right = right.join(keyed, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    salt = F.when(any_null, F.pmod(spread, F.lit(max_salts))).otherwise(F.pmod(spread, F.coalesce("_salts", F.lit(1)).cast("long")))
    left = left.withColumn("_salt", salt.cast("int")).drop("_salts")
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def row_numbers(rows: DataFrame, order: Sequence[Column | str], name: str) -> DataFrame:
    """Adds consecutive numbers from 0 in an order, without a one-task window: a range-partitioned sort, counts per partition, offsets."""
    placed = materialize(rows.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()), "numbered")
    counts = placed.groupBy(F.shiftright("_id", 33).alias("_p")).agg(F.count(F.lit(1)).alias("_c"))  # one row a task
    offset = counts.select("_p", F.coalesce(F.sum("_c").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_o"))
    at = F.col("_o") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("_p", F.shiftright("_id", 33)).join(F.broadcast(offset), "_p").withColumn(name, at).drop("_id", "_p", "_o")


def ranks_within(rows: DataFrame, groups: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Adds the rank from 0 within a group, however large: the position in one sort less that of the group's first row."""
    placed = row_numbers(rows, [*groups, *order], "_at")
    first = placed.groupBy(*groups).agg(F.min("_at").alias("_first"))
    return salted_join(placed, first, groups, "inner").withColumn(name, F.col("_at") - F.col("_first")).drop("_at", "_first")


def squeeze(c: Column | str) -> Column:
    """Trim, and reduce inner whitespace to one blank."""
    c = F.col(c) if isinstance(c, str) else c
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))
