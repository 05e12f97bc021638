"""Column expressions. All are built-in Spark functions (codegen, no UDFs)."""

from crosslink.functions.scalars import (
    flag_to_int,
    null_or_nan,
    primary_tag,
    qid_from_uri,
    tag_count,
    to_int_key,
)
from crosslink.functions.text import has_title_key, normalize_title, title_key

__all__ = [
    "flag_to_int",
    "has_title_key",
    "normalize_title",
    "null_or_nan",
    "primary_tag",
    "qid_from_uri",
    "tag_count",
    "title_key",
    "to_int_key",
]
