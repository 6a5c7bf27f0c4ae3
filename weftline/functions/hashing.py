"""Stable identifiers from content."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_hash(**fields: Column) -> Column:
    """sha256 of the canonical JSON: keys sorted, no blanks, nulls kept."""
    return F.sha2(F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields))), {"ignoreNullFields": "false"}), 256)


def short_hash(c: Column, length: int) -> Column:
    return F.left(F.sha2(c, 256), F.lit(length))


def shard_for(c: Column, shards: int = 64) -> Column:
    """The 31-fold rolling code of an ASCII id, modulo 2^32, modulo the number of shards."""
    codes = F.transform(F.split(c, ""), lambda ch: F.ascii(ch).cast("long"))
    h = F.aggregate(codes, F.lit(0).cast("long"), lambda h, x: (h * 31 + x).bitwiseAND(F.lit(0xFFFFFFFF)))
    return F.when(F.length(c) > 0, F.pmod(h, F.lit(shards))).otherwise(F.lit(0)).cast("int")
