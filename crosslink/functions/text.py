"""Title normalization for the second entity-resolution stage."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference): characters deleted after lower-casing,
# and the whitespace class that is collapsed to one space.
DELETE_PATTERN = r"[^a-z0-9\s]"
SPACE_PATTERN = r"\s+"
KEPT_PATTERN = r"[a-z0-9]"  # what DELETE_PATTERN leaves, blanks aside


def normalize_title(c: str | Column) -> Column:
    """lower → delete every char outside ``[a-z0-9\\s]`` → squeeze blanks → trim.

    Accented letters are deleted, not transliterated (``Pokémon`` → ``pokmon``);
    a title made only of other scripts becomes ``""``; null stays null.
    """
    x = F.col(c) if isinstance(c, str) else c
    lowered = F.lower(x)
    kept = F.regexp_replace(lowered, DELETE_PATTERN, "")
    squeezed = F.regexp_replace(kept, SPACE_PATTERN, " ")
    return F.trim(squeezed)


def title_key(c: str | Column, empty_matches: bool = False) -> Column:
    """Join key for title matching.

    ``""`` (e.g. an all-CJK title) would match every other empty key, so by
    default it is turned into null (no match); ``empty_matches=True`` keeps
    the reference behavior.
    """
    key = normalize_title(c)
    if empty_matches:
        return key
    return F.nullif(key, F.lit(""))  # the title is normalized once


def has_title_key(c: str | Column, empty_matches: bool = False) -> Column:
    """True iff ``title_key`` is not null, without normalizing the title (else false or null)."""
    x = F.col(c) if isinstance(c, str) else c
    return x.isNotNull() if empty_matches else F.lower(x).rlike(KEPT_PATTERN)
