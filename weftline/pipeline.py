"""Stage manifest: which stages are fresh, judged by the content of their inputs and settings."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from datetime import UTC, datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators.quality import file_checksums
from weftline.sources.files import exists, read_document, write_document
from weftline.sources.tables import table


def fingerprint(value: Any) -> str:
    return hashlib.sha256(json.dumps(value, sort_keys=True, default=str).encode()).hexdigest()


def table_digest(df: DataFrame) -> list[str]:
    """Schema, rows and two sums of row hashes: the content, whatever the order and the files. Read by the executors."""
    row = F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)), {"ignoreNullFields": "false"})
    total = lambda x: F.coalesce(F.sum(x.cast("decimal(20,0)")), F.lit(0)).cast("string")
    sums = df.select(F.xxhash64(row).alias("a"), F.xxhash64(F.lit(5), row).alias("b")).agg(F.count(F.lit(1)).cast("string").alias("n"), total(F.col("a")).alias("a"), total(F.col("b")).alias("b")).first()
    return [df.schema.json(), *sums]


@dataclass
class Store:
    """A warehouse folder with a manifest of the stages that ran."""

    spark: SparkSession
    root: str
    manifest: dict[str, dict] = field(default_factory=dict)

    def __post_init__(self) -> None:
        path = f"{self.root}/manifest.json"
        if exists(self.spark, path):
            self.manifest = read_document(self.spark, path)

    def key(self, stage: str, settings: dict, inputs: Iterable[str], sources: Iterable[tuple[str, str]] = ()) -> str:
        """Settings, prompts and models, the files of every input and the rows of every source, a (folder, table)."""
        seen = {}
        for i in inputs:
            path = f"{self.root}/{i}"
            seen[i] = [(r["path"], r["digest"]) for r in file_checksums(self.spark, path).orderBy("path").toLocalIterator()] if exists(self.spark, path) else None
        read = {name: table_digest(table(self.spark, folder, name)) for folder, name in sources}
        return fingerprint([stage, settings, seen, read])

    def fresh(self, stage: str, key: str, outputs: Iterable[str]) -> bool:
        """Same key as last time, and no output is missing."""
        return self.manifest.get(stage, {}).get("key") == key and all(exists(self.spark, f"{self.root}/{o}") for o in outputs)

    def record(self, stage: str, key: str, counts: dict[str, int]) -> None:
        self.manifest[stage] = {"key": key, "counts": counts, "at": datetime.now(UTC).isoformat()}
        write_document(self.spark, f"{self.root}/manifest.json", self.manifest)


def run_stage(store: Store, stage: str, settings: dict, inputs: list[str], outputs: list[str], work: Callable[[], dict[str, int]], force: bool = False, sources: Iterable[tuple[str, str]] = ()) -> bool:
    """Run a stage unless it is fresh; True if it ran."""
    key = store.key(stage, settings, inputs, sources)
    if not force and store.fresh(stage, key, outputs):
        return False
    store.record(stage, key, work())
    return True
