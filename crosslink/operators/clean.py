"""Cleaning: key casts, renames, required-field filters, deterministic dedup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crosslink.functions import to_int_key

_RN = "__crosslink_rn"


def cast_key(df: DataFrame, name: str = "app_id") -> DataFrame:
    """Key column to INT via ``try_cast``; a no-op if the column is absent."""
    if name not in df.columns:
        return df
    return df.withColumn(name, to_int_key(name))


def rename_key(df: DataFrame, old: str = "appid", new: str = "app_id") -> DataFrame:
    """Rename the popularity feed's ``appid`` to the shared key name."""
    return df.withColumnRenamed(old, new)


def drop_incomplete(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of ``subset`` (columns that exist)."""
    present = [c for c in subset if c in df.columns]
    return df.dropna(how="any", subset=present) if present else df


def filter_not_null(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col(name).isNotNull())


def _order(cols: Sequence[str | Column]) -> list[Column]:
    out = []
    for c in cols:
        out.append(F.col(c).asc_nulls_last() if isinstance(c, str) else c)
    return out


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)])


def dedup_first(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Keep one row per ``keys``: the first in ``order`` (ascending, nulls last).

    Without ``order`` a hash of the whole row decides (then all its columns), so
    the survivor is deterministic and no column's smaller values are favoured.
    Null keys compare equal (one survivor per null key).

    Plan shape: ``row_number() = 1`` lets Spark insert a partial
    ``WindowGroupLimit`` *before* the shuffle, so each map task forwards at
    most one row per key — a key holding a third of the table costs one row
    per map task in the exchange, not a third of the table in one task.
    """
    cols = df.columns
    order_cols = list(order) if order else [_row_hash(df), *(c for c in cols if c not in keys)]
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*_order(order_cols))
    ranked = df.select("*", F.row_number().over(w).alias(_RN))
    return ranked.filter(F.col(_RN) == 1).select(*cols)


def keep_first_with_key(
    df: DataFrame,
    key: str,
    order: Sequence[str],
) -> DataFrame:
    """Keep-first by ``key`` in ``order``; rows whose key is null or empty are all kept.

    Rows without a key bypass the window: only keyed rows are ranked, limited
    on the map side and shuffled, so any number of keyless rows stays spread.
    """
    keyless = F.col(key).isNull() | (F.col(key) == "")
    return dedup_first(df.filter(~keyless), [key], order).unionByName(df.filter(keyless))
