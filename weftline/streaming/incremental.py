"""Streaming forms: the judgment log consolidated as it grows, and windowed counts with late data.

Extensions: batch results over the same rows are the same. A keyed target is kept in buckets of a hash of
the key: a micro-batch rewrites the buckets it touches and no others, and a manifest per batch says
which version of each bucket counts.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weftline.operators.judging import last_wins
from weftline.sources.files import exists, read_document, write_document


def read_log(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 16) -> DataFrame:
    """An append-only folder of Parquet files as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def streaming_last_wins(log: DataFrame, keys: list[str], order: list[str], keep: list[str]) -> DataFrame:
    """The newest record per key as a streaming aggregation (update or complete mode): one struct of state a key."""
    return last_wins(log, keys, order, keep)


def deduplicated(log: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """Records appended again dropped, with state bounded by the watermark."""
    return log.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def windowed_counts(events: DataFrame, time: str, kind: str, window: str, delay: str) -> DataFrame:
    """Counts per tumbling window and kind, in update mode; data later than the delay is dropped, and so is the state of closed windows."""
    w = F.window(time, window)
    return events.withWatermark(time, delay).groupBy(w, kind).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), kind, "n")


def _manifest(target: str, batch: int) -> str:
    return f"{target}/manifest-{batch}.json"


def current(spark: SparkSession, target: str) -> DataFrame | None:
    """The target as of its last whole batch, None before the first."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(target)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [x.getPath().getName() for x in fs.listStatus(root)] if fs.exists(root) else []
    done = [int(m.group(1)) for n in names if (m := re.fullmatch(r"manifest-(\d+)\.json", n))]
    if not done:
        return None
    return _read(spark, target, read_document(spark, _manifest(target, max(done))))


def _read(spark: SparkSession, target: str, versions: dict[str, int], only: set[int] | None = None) -> DataFrame | None:
    paths = [f"{target}/v{v}/bucket={b}" for b, v in versions.items() if only is None or int(b) in only]
    return spark.read.parquet(*paths) if paths else None


def upsert_changes(stream: DataFrame, target: str, checkpoint: str, keys: list[str], order: list[str], keep: list[str], buckets: int = 64, mode: str = "append"):
    """``foreachBatch`` upsert of the newest record per key into a bucketed target; read it with :func:`current`.

    A batch that comes again after a failure finds its manifest and does nothing. A batch whose
    predecessor's manifest is gone is an error, not a loss.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if exists(spark, _manifest(target, batch_id)):
            return
        if batch_id and not exists(spark, _manifest(target, batch_id - 1)):
            raise RuntimeError(f"batch {batch_id} has no state to build on: {_manifest(target, batch_id - 1)} is missing")
        versions = read_document(spark, _manifest(target, batch_id - 1)) if batch_id else {}
        rows = batch.select(*keys, *order, *[k for k in keep if k not in order])
        at = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        touched = {r[0] for r in rows.select(at).distinct().collect()}  # at most the number of buckets
        old = _read(spark, target, versions, touched)
        if old is not None:
            rows = rows.unionByName(old.select(*rows.columns))
        best = last_wins(rows, keys, order, list(dict.fromkeys([*order, *keep])))
        best.withColumn("bucket", at).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/v{batch_id}")
        there = {b: batch_id for b in touched if exists(spark, f"{target}/v{batch_id}/bucket={b}")}
        write_document(spark, _manifest(target, batch_id), versions | {str(b): v for b, v in there.items()})

    return stream.writeStream.outputMode(mode).foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True)
