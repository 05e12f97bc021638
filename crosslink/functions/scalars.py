"""Scalar Column expressions used by the cleaning and enrichment steps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_int_key(c: str | Column) -> Column:
    """Join key as INT; unparsable or out-of-range values become null.

    ``try_cast`` keeps the lenient behavior (bad text → null, surrounding
    blanks ignored) under ANSI mode instead of failing the job.
    """
    return _col(c).try_cast("int")


def flag_to_int(c: str | Column) -> Column:
    """1 iff the value, rendered as text, equals ``true`` in any case; else 0.

    So ``True``/``"TRUE"`` give 1 while ``1``, ``"yes"``, ``False`` and null
    give 0.
    """
    return F.when(F.lower(_col(c).cast("string")) == F.lit("true"), F.lit(1)).otherwise(F.lit(0))


def tag_count(c: str | Column) -> Column:
    """Number of tags; a missing list counts as 0."""
    tags = _col(c)
    return F.when(tags.isNull(), F.lit(0)).otherwise(F.size(tags))


def primary_tag(c: str | Column) -> Column:
    """First tag, or null for a missing or empty list (never raises)."""
    return F.get(_col(c), 0)


def null_or_nan(c: str | Column, dtype: DataType) -> Column:
    """Missing-value test: null, plus NaN for floating types only."""
    x = _col(c)
    if isinstance(dtype, (DoubleType, FloatType)):
        return x.isNull() | F.isnan(x)
    return x.isNull()


def qid_from_uri(c: str | Column) -> Column:
    """Entity id = text after the last ``/`` of the URI; null if no URI."""
    uri = _col(c)
    return F.when(uri.isNull() | (uri == F.lit("")), F.lit(None).cast("string")).otherwise(
        F.element_at(F.split(uri, "/"), -1)
    )
