"""The company directory: landed JSON by Spark's own scans, and adapters for other ways to get it.

``read_landed`` reads JSON arrays or lines from any file system Spark knows and keeps what is no
record apart. ``register(spark)`` makes ``spark.read.format("directory")`` available, which asks an
adapter for records: one partition a resource. An HTTP adapter is there; others are added to ``ADAPTERS``.
"""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Iterator
from datetime import UTC, datetime
from typing import Any, Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from weftline.functions.text import clean
from weftline.operators.normalize import taxonomy_counts

RAW = "company_id string, source string, source_url string, retrieved_at timestamp, source_last_updated string, payload string, content_hash string"


def raw_rows(records: DataFrame, source: str, prefix: str = "id", last_updated: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(raw rows, rejected: source_url, record, error) of ``records`` (source_url, record: JSON text). The payload is canonical: keys sorted, no blanks."""
    r = records.withColumn("v", F.try_parse_json("record")).withColumn("id", F.get_json_object("record", "$.id")).withColumn("name", F.get_json_object("record", "$.name"))
    error = F.when(F.col("v").isNull(), "not JSON").when(~F.ltrim("record").startswith("{"), "not an object").when(F.col("id").isNull(), "no id").when(clean(F.col("name")).isNull(), "no name")
    r = r.withColumn("error", error)
    payload = F.to_json("v")
    good = r.where("error IS NULL").select(
        F.concat(F.lit(f"{prefix}:"), "id").alias("company_id"), F.lit(source).alias("source"), "source_url", F.current_timestamp().alias("retrieved_at"), F.lit(last_updated).cast("string").alias("source_last_updated"), payload.alias("payload"), F.sha2(payload, 256).alias("content_hash")
    )
    return good, r.where("error IS NOT NULL").select("source_url", "record", "error")


def read_landed(spark: SparkSession, path: str, lines: bool = False, limit: int | None = None, **how) -> tuple[DataFrame, DataFrame]:
    """(raw rows, rejected) of landed files: a JSON array a file, or a record a line. ``limit``: the first so many records in the order of files and places."""
    if lines:
        rows = spark.read.text(path).where("trim(value) <> ''").select(F.col("_metadata.file_path").alias("source_url"), F.monotonically_increasing_id().alias("pos"), F.col("value").alias("record"))
    else:
        whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("source_url"), F.from_json("value", "array<string>").alias("a"))
        rows = whole.select("source_url", F.posexplode("a").alias("pos", "record"))
    if limit is not None:
        rows = rows.orderBy("source_url", "pos").limit(limit)
    return raw_rows(rows.where("record IS NOT NULL").select("source_url", "record"), "landed", **how)


def fixture_terms(raw: DataFrame) -> DataFrame:
    """kind, slug, name, company_count of the terms that raw records carry: taxonomy of a sample that has no meta document."""
    kind = "subindustry string, stage string, status string, regions array<string>, tags array<string>, industry string, batch string"
    p = raw.select(F.from_json("payload", kind).alias("p")).select("p.*")
    one = lambda n: F.array(F.col(n))
    many = lambda n: F.coalesce(n, F.array().cast("array<string>"))
    return taxonomy_counts(p, {"subindustry": one("subindustry"), "stage": one("stage"), "status": one("status"), "industry": one("industry"), "batch": one("batch"), "region": many("regions"), "tag": many("tags")})


class Adapter(Protocol):
    """What a source has to offer: the resources to read, one partition each, and the records of one."""

    name: str

    def resources(self, options: dict[str, str]) -> list[str]: ...

    def records(self, resource: str) -> Iterator[Any]: ...


class HttpDirectory:
    """A directory served as JSON: ``path`` is one URL, or several with blanks between them. An HTTP error is an error."""

    name = "http"

    def resources(self, options: dict[str, str]) -> list[str]:
        return options["path"].split()

    def get(self, url: str) -> Any:
        with urllib.request.urlopen(urllib.request.Request(url, headers={"Accept": "application/json"}), timeout=60) as r:
            return json.load(r)

    def records(self, resource: str) -> Iterator[Any]:
        yield from self.get(resource)


ADAPTERS: dict[str, Adapter] = {HttpDirectory.name: HttpDirectory()}


class _Part(InputPartition):
    def __init__(self, resource: str):
        self.resource = resource


class DirectoryReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options
        self.adapter = ADAPTERS[options.get("adapter", HttpDirectory.name)]

    def partitions(self) -> list[_Part]:
        return [_Part(x) for x in self.adapter.resources(self.options)]

    def read(self, partition: _Part) -> Iterator[tuple]:
        now = datetime.now(UTC)
        for r in self.adapter.records(partition.resource):
            yield (partition.resource, now, json.dumps(r, ensure_ascii=False))


class DirectorySource(DataSource):
    """source_url, retrieved_at, record: every record as it came; :func:`raw_rows` sorts them."""

    @classmethod
    def name(cls) -> str:
        return "directory"

    def schema(self) -> str:
        return "source_url string, retrieved_at timestamp, record string"

    def reader(self, schema) -> DirectoryReader:
        return DirectoryReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(DirectorySource)
