"""References to records that do not exist.

All references of all tables form one stream, all parent keys another. Both are co-partitioned
and sorted on (target, key) and merged in one linear pass: Spark's sort-merge join. The parents
are first reduced to one validity interval per key, which tells *missing*, *late* and *deleted*
apart. Heavy keys are salted (:func:`weftline.runtime.salted_join`).

Defined cases: a null reference is no orphan; an empty string is always missing; a null event
time can only be missing; a parent without a start is never late; repeated parents give the
earliest start and the earliest deletion; repeated references give repeated rows (the reports
count distinct row keys). Empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.runtime import salted_join


@dataclass(frozen=True)
class References:
    """One referring table: ``columns`` maps each referring column to its target's name."""

    table: str
    rows: DataFrame
    row_key: str
    event_time: str
    columns: dict[str, str]


@dataclass(frozen=True)
class Parents:
    """One target. ``deleted_at`` is null for a key that is still there."""

    target: str
    rows: DataFrame
    key: str
    valid_from: str
    deleted_at: Column | None = None


def _references(refs: Sequence[References]) -> DataFrame:
    out = None
    for r in refs:
        pairs = F.array(*(
            F.struct(F.lit(c).alias("ref_column"), F.lit(t).alias("target"), r.rows[c].cast("string").alias("key"))
            for c, t in r.columns.items()
        ))
        one = (
            r.rows.select(
                r.rows[r.row_key].cast("string").alias("row_key"),
                r.rows[r.event_time].alias("event_time"),
                F.explode(pairs).alias("p"),
            )
            .where("p.key IS NOT NULL")
            .select(F.lit(r.table).alias("src_table"), "p.ref_column", "p.target", "p.key", "row_key", "event_time")
        )
        out = one if out is None else out.unionByName(one)
    return out


def _intervals(parents: Sequence[Parents]) -> DataFrame:
    out = None
    for p in parents:
        gone = p.deleted_at if p.deleted_at is not None else F.lit(None).cast("timestamp_ntz")
        one = p.rows.where(p.rows[p.key].isNotNull()).select(
            F.lit(p.target).alias("target"), p.rows[p.key].cast("string").alias("key"),
            p.rows[p.valid_from].cast("timestamp_ntz").alias("s"), gone.cast("timestamp_ntz").alias("d"),
        )
        out = one if out is None else out.unionByName(one)
    return out.groupBy("target", "key").agg(
        F.min("s").alias("valid_from"), F.min("d").alias("deleted_at"), F.lit(True).alias("present")
    )


def orphan_references(
    refs: Sequence[References], parents: Sequence[Parents], hot_rows: int = 500_000
) -> DataFrame:
    """Every orphan reference: src_table, ref_column, key, row_key, event_time, orphan_kind."""
    merged = salted_join(
        _references(refs), _intervals(parents), ["target", "key"], "left", hot_rows=hot_rows, hint="merge"
    )
    at = F.col("event_time").cast("timestamp_ntz")
    kind = (
        F.when(F.col("present").isNull() | (F.col("key") == ""), "missing")
        .when(F.col("valid_from") > at, "late")
        .when(F.col("deleted_at") <= at, "deleted")
    )
    return (
        merged.withColumn("orphan_kind", kind).where("orphan_kind IS NOT NULL")
        .select("src_table", "ref_column", "key", "row_key", "event_time", "orphan_kind")
    )


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Distinct orphan rows and keys per table, column, kind and month of the event time."""
    return orphans.groupBy(
        "src_table", "ref_column", "orphan_kind", F.date_format("event_time", "yyyy-MM").alias("month")
    ).agg(
        F.count_distinct("row_key").alias("orphan_rows"), F.count_distinct("key").alias("orphan_keys")
    )
