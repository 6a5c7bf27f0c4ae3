"""Scans and sinks for JSON lines, Parquet, CSV, matrices and releases."""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructType

from weftline.functions.hashing import shard_for
from weftline.operators.quality import file_checksums


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_jsonl(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of a JSON lines table; a missing file is an empty table; blank lines are skipped."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_jsonl_quarantined(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, broken lines)."""
    rows = spark.read.text(path).where("trim(value) <> ''")
    parsed = rows.select("value", F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("r"), F.from_json("value", "MAP<STRING, STRING>").alias("m"))
    return parsed.where("m IS NOT NULL").select("r.*"), parsed.where("m IS NULL").select("value")


def write_jsonl(df: DataFrame, path: str, key: str, files: int | None = None) -> None:
    """JSON lines sorted by key (range-partitioned; one file only for small tables that ask for it)."""
    out = df.orderBy(key)
    (out.coalesce(files) if files else out).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def append(df: DataFrame, path: str, batch: str | None = None) -> bool:
    """Append to a log. A named batch is written to a part of its own once: a replay finds it and adds nothing (False)."""
    if batch is None:
        df.write.mode("append").parquet(path)
        return True
    part = f"{path}/batch={batch}"
    if exists(df.sparkSession, f"{part}/_SUCCESS"):
        return False
    df.write.mode("overwrite").parquet(part)
    return True


def write_document(spark: SparkSession, path: str, value: Any) -> None:
    """One small JSON document, keys sorted, put in place by one overwriting rename: a reader sees the old one or the new one."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    tmp, dest = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp"), jvm.org.apache.hadoop.fs.Path(path)
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(dest.toUri() if "://" in path or path.startswith("file:") else tmp.getFileSystem(conf).getUri(), conf)
    fs = dest.getFileSystem(conf)
    out = fs.create(tmp, True)
    out.write(bytearray(json.dumps(value, sort_keys=True, separators=(",", ":"), default=str, ensure_ascii=False).encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files.rename(tmp, dest, options)


def read_document(spark: SparkSession, path: str) -> Any:
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def csv_columns(df: DataFrame) -> DataFrame:
    """Lists of strings joined with '; ', other nested columns dropped."""
    out: list[Column] = []
    for f in df.schema:
        if isinstance(f.dataType, ArrayType) and isinstance(f.dataType.elementType, StringType):
            out.append(F.array_join(f.name, "; ").alias(f.name))
        elif not isinstance(f.dataType, (ArrayType, MapType, StructType)):
            out.append(F.col(f.name))
    return df.select(*out)


def export_bundle(tables: dict[str, DataFrame], folder: str, csv: bool = True) -> dict[str, int]:
    """Every table as zstd Parquet (and CSV); returns row counts, taken while writing."""
    from pyspark.sql import Observation

    counts = {}
    for name, df in tables.items():
        seen = Observation(name)
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/{name}.parquet")
        counts[name] = int(seen.get["n"])
        if csv:
            csv_columns(df).write.mode("overwrite").option("header", True).csv(f"{folder}/{name}.csv")
    return counts


def write_matrix(coo: DataFrame, indptr: DataFrame, folder: str) -> int:
    """A CSR matrix as sorted coordinates and row pointers; returns the number of entries."""
    coo.orderBy("r", "c").write.mode("overwrite").parquet(f"{folder}/entries.parquet")
    indptr.orderBy("r").write.mode("overwrite").parquet(f"{folder}/indptr.parquet")
    return coo.sparkSession.read.parquet(f"{folder}/entries.parquet").count()


def write_details(records: DataFrame, path: str, shards: int = 64) -> None:
    """company_id, record partitioned by shard; empty shards get a marker row, so every shard exists."""
    spark = records.sparkSession
    all_shards = spark.range(shards).select(F.col("id").cast("int").alias("shard"))
    full = all_shards.join(records.select("shard", "company_id", "record"), "shard", "left")
    full.repartition("shard").write.mode("overwrite").partitionBy("shard").parquet(path)


def lookup_detail(spark: SparkSession, path: str, company_id: str, shards: int = 64) -> DataFrame:
    """One company's record; the shard is computed first, so a single partition is read."""
    shard = spark.range(1).select(shard_for(F.lit(company_id), shards)).first()[0]
    return spark.read.parquet(path).where((F.col("shard") == shard) & (F.col("company_id") == company_id))


def release_checksums(spark: SparkSession, folder: str, manifest: str = "manifest.json") -> dict[str, str]:
    """path -> digest of every file of a release but its manifest (names and digests only)."""
    return {r["path"]: r["digest"] for r in file_checksums(spark, folder).where(F.col("path") != manifest).orderBy("path").toLocalIterator()}
