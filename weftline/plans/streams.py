"""Streaming queries, run over what has landed (available-now triggers)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.plans.judging import _LAST
from weftline.runtime import delete, materialize, shared_dir
from weftline.sources.tables import table
from weftline.streaming.incremental import current, read_log, upsert_changes, windowed_counts


def _landed(spark: SparkSession, d: str, name: str) -> tuple[str, DataFrame]:
    """A pattern the file stream can watch (a folder of parts, or the one file), and the batch form."""
    return f"{d}/{name}.parquet*", table(spark, d, name)


def _upserted(spark: SparkSession, stream: DataFrame, keys: list[str], order: list[str], keep: list[str], mode: str) -> DataFrame:
    """Runs a stream over what has landed and gives the target, written once more so that the stream's own files can go."""
    out = f"{shared_dir(spark)}/weftline/stream-{uuid.uuid4().hex}"
    upsert_changes(stream, f"{out}/table", f"{out}/checkpoint", keys, order, keep, mode=mode).start().awaitTermination()
    got = current(spark, f"{out}/table")
    kept = materialize(got if got is not None else spark.createDataFrame([], stream.select(*keys, *order, *[k for k in keep if k not in order]).schema), "streamed")
    delete(spark, out)
    return kept


def stream_last_wins(spark: SparkSession, d: str) -> DataFrame:
    """The judgment log consolidated by micro-batches of few files."""
    path, batch = _landed(spark, d, "company_tag_judgments")
    out = _upserted(spark, read_log(spark, path, batch.schema, 8), ["company_id", "tag_id"], ["created_at", "appended_at", "judgment_id"], ["decision", "confidence"], "append")
    return out.select("company_id", "tag_id", "judgment_id", "decision", "confidence")


def stream_event_counts(spark: SparkSession, d: str) -> DataFrame:
    """Events per day and type over event-time windows."""
    path, batch = _landed(spark, d, "events")
    events = read_log(spark, path, batch.schema).withColumn("at", F.col("ts").cast("timestamp"))
    out = _upserted(spark, windowed_counts(events, "at", "event_type", "1 day", "2 hours"), ["start", "event_type"], ["n"], [], "update")
    return out.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n")


QUERIES = {"stream_last_wins": stream_last_wins, "stream_event_counts": stream_event_counts}
ORACLES = {
    "stream_last_wins": f"WITH {_LAST} SELECT company_id, tag_id, judgment_id, decision, confidence FROM last",
    "stream_event_counts": "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY ALL",
}
