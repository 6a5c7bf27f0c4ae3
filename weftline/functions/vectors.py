"""Vector functions on array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Shares of the description, metadata and tag vectors in the combined one.
COMBINED = {"description": 0.55, "metadata": 0.20, "tags": 0.25}


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once and not for every element of a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def l2_normalize(v: Column) -> Column:
    return let(F.greatest(norm(v), F.lit(1e-12)), lambda n: F.transform(v, lambda x: x.cast("double") / n))


def is_zero(v: Column) -> Column:
    return v.isNull() | ~F.exists(v, lambda x: x != 0)


def combine(parts: dict[str, Column], weights: dict[str, float] = COMBINED, strict: bool = True) -> Column:
    """Weighted sum of the unit vectors that are there, weights renormalised, result of unit length.

    No part at all is an error, or null if not ``strict``.
    """
    there = {k: ~is_zero(v) for k, v in parts.items()}
    scale = F.array(*(F.when(there[k], weights[k] / F.greatest(norm(v), F.lit(1e-12))).otherwise(0.0) for k, v in parts.items()))
    dim = F.greatest(*(F.when(there[k], F.size(v)).otherwise(0) for k, v in parts.items())) if len(parts) > 1 else F.size(next(iter(parts.values())))

    def mixed(w: Column) -> Column:
        def at(i: Column) -> Column:
            return sum((F.coalesce(F.try_element_at(v, i).cast("double"), F.lit(0.0)) * F.element_at(w, k + 1) for k, v in enumerate(parts.values())), F.lit(0.0))

        return F.transform(F.sequence(F.lit(1), dim), at)

    some = F.array_max(scale) > 0
    nothing = F.raise_error(F.lit("no vector is there to combine")) if strict else F.lit(None)
    return F.when(some, let(let(scale, mixed), l2_normalize)).otherwise(nothing)


def quantize_int8(v: Column, scale: Column) -> Column:
    """Signed bytes of v / scale, rounded half to even, within -127..127."""
    return F.transform(v, lambda x: F.greatest(F.lit(-127), F.least(F.lit(127), F.bround(x.cast("double") / scale * 127, 0))).cast("tinyint"))
