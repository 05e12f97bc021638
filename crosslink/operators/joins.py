"""Join helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NEVER = "\x00"  # no cleaned key begins with it


def spread_nulls(key: Column, row_id: Column) -> Column:
    """A text key for the left side of a left join; rows without one get keys of their own.

    A null key matches nothing, but in a shuffle join all its rows would meet in
    one partition. A key made of the row's id, which no right-hand key equals,
    matches nothing either and spreads them.
    """
    return F.coalesce(key, F.concat(F.lit(_NEVER), row_id.cast("string")), F.lit(_NEVER))
