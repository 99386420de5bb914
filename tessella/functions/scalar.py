"""Scalar expressions as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RTOL, ATOL = 1e-5, 1e-8


def is_close(a: Column, b: Column, rtol: float = RTOL, atol: float = ATOL) -> Column:
    """|a - b| <= atol + rtol * |b|; false where either is null or NaN, true for equal infinities."""
    near = F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b)
    finite = ~F.isnan(a) & ~F.isnan(b) & (F.abs(a) != F.lit(float("inf"))) & (F.abs(b) != F.lit(float("inf")))
    return F.coalesce(F.when(finite, near).otherwise(~F.isnan(a) & (a == b)), F.lit(False))


def is_nodata(value: Column, nodata: Column, nan_is_nodata: bool = True) -> Column:
    """Whether a value counts as missing: close to the declared nodata value. A declared NaN takes NaN values unless
    nan_is_nodata is off; without a declared value nothing is missing."""
    found = is_close(value, nodata)
    return found | (F.coalesce(F.isnan(nodata), F.lit(False)) & F.coalesce(F.isnan(value), F.lit(False))) if nan_is_nodata else found


def trunc_int(x: Column) -> Column:
    """Toward zero."""
    return x.cast("int")


def clamp(x: Column, low: int | Column, high: int | Column) -> Column:
    low, high = (v if isinstance(v, Column) else F.lit(v) for v in (low, high))
    return F.greatest(low, F.least(high, x))


def label(group: Column) -> Column:
    """A group's text in reports; null is the empty text."""
    return F.coalesce(group.cast("string"), F.lit(""))


def file_stem(path: Column) -> Column:
    """The last part of a path without its last suffix."""
    return F.regexp_extract(path, r"([^/\\]+?)(?:\.[^./\\]*)?$", 1)
