"""Two-stage entity resolution against the knowledge base (KB).

Stage 1 joins on the exact id (``app_id = steam_app_id``); stage 2 joins on
the normalized title. Both KB sides are de-duplicated on their key (first by
``wikidata_qid``) so neither stage can multiply rows, and both run at game
grain. The stages are then combined either field by field (reference) or
entity by entity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from crosslink.config import Options
from crosslink.functions import has_title_key, normalize_title, title_key, to_int_key
from crosslink.operators.clean import dedup_first
from crosslink.operators.joins import spread_nulls
from crosslink.schemas import KB_RESULT_FIELDS

ID_HIT = "_kb_id_hit"
TITLE_HIT = "_kb_title_hit"
TITLE_SUFFIX = "_t"
MATCH_STAGE = "wd_match_stage"
_TITLE_KEY = "__crosslink_title_key"

_RESULT_COLS = [r for _, r in KB_RESULT_FIELDS]
_TIE_ORDER = _RESULT_COLS  # wikidata_qid first, then the other fields


def project_kb(kb: DataFrame, key: str, key_expr, suffix: str = "", extra=()) -> DataFrame:
    """KB projected to ``key`` plus the result fields (renamed, suffixed)."""
    cols = [key_expr.alias(key)] + [F.col(s).alias(r + suffix) for s, r in KB_RESULT_FIELDS]
    return kb.select(*cols, *extra)


def kb_by_id(kb: DataFrame, extra=()) -> DataFrame:
    """Stage-1 side: one entity per INT ``app_id`` (bad ids dropped).

    Texts without a digit go before the cast, which raises an error inside for
    each text that is no number.
    """
    if isinstance(kb.schema["steam_app_id"].dataType, StringType):
        kb = kb.filter(F.col("steam_app_id").rlike("[0-9]"))
    df = project_kb(kb, "app_id", to_int_key("steam_app_id"), extra=extra)
    df = df.filter(F.col("app_id").isNotNull())
    return dedup_first(df, ["app_id"], _TIE_ORDER)


def kb_by_title(kb: DataFrame, empty_matches: bool = False, suffix: str = "", extra=()) -> DataFrame:
    """Stage-2 side: one entity per normalized title (null keys dropped).

    Names without a key go before the projection, and the key can't be null:
    a filter on it would be pushed below and normalize each name twice more.
    """
    kb = kb.filter(has_title_key("name", empty_matches))
    df = project_kb(kb, "title_key", F.coalesce(normalize_title("name"), F.lit("")), suffix, extra)
    return dedup_first(df, ["title_key"], [c + suffix for c in _TIE_ORDER])


def join_kb_by_id(df: DataFrame, kb: DataFrame) -> DataFrame:
    """df ⟕ stage-1 entities on ``app_id``; adds ``wikidata_qid, wd_*``."""
    return df.join(kb_by_id(kb, extra=[F.lit(True).alias(ID_HIT)]), "app_id", "left")


def join_kb_by_title(
    df: DataFrame,
    kb: DataFrame,
    options: Options = Options(),
    title_col: str = "title",
) -> DataFrame:
    """df ⟕ stage-2 entities on the normalized title; adds ``*_t`` fields.

    The key is a column of its own: as an expression of the join it would be
    normalized anew in each comparison of the join's sort.
    """
    side = kb_by_title(
        kb, options.empty_title_matches, TITLE_SUFFIX, [F.lit(True).alias(TITLE_HIT)]
    )
    df = df.withColumn(_TITLE_KEY, spread_nulls(title_key(df[title_col], options.empty_title_matches), df["app_id"]))
    return df.join(side, df[_TITLE_KEY] == side["title_key"], "left").drop(side["title_key"]).drop(_TITLE_KEY)


def coalesce_fields(df: DataFrame, mode: str = "field", provenance: bool = False) -> DataFrame:
    """Combine the two stages' ``wd_*`` columns and drop the helpers.

    ``field``: each field independently prefers stage 1, then stage 2 — a row
    may mix two entities. ``entity``: stage 2 only where stage 1 found nothing.
    """
    id_hit = F.col(ID_HIT).isNotNull()
    helpers = {ID_HIT, TITLE_HIT, *[c + TITLE_SUFFIX for c in _RESULT_COLS]}
    out = []
    for c in df.columns:
        if c in helpers:
            continue
        if c in _RESULT_COLS:
            alt = F.col(c + TITLE_SUFFIX)
            combined = F.coalesce(F.col(c), alt) if mode == "field" else F.when(id_hit, F.col(c)).otherwise(alt)
            out.append(combined.alias(c))
        else:
            out.append(F.col(c))
    if provenance:
        stage = F.when(id_hit, F.lit("id")).when(F.col(TITLE_HIT).isNotNull(), F.lit("title"))
        out.append(stage.alias(MATCH_STAGE))
    return df.select(*out)


def resolve_entities(
    df: DataFrame,
    kb: DataFrame,
    options: Options = Options(),
    title_col: str = "title",
    provenance: bool = False,
) -> DataFrame:
    """Two-stage ER on a game-grain frame with ``app_id`` and ``title_col``.

    Stage 2 is evaluated for every row (as in the reference), so with the
    default field-wise fallback a stage-1 match with a null field takes that
    field from the title match. ``provenance`` adds ``wd_match_stage``.
    """
    staged = join_kb_by_title(join_kb_by_id(df, kb), kb, options, title_col)
    return coalesce_fields(staged, options.fallback, provenance)
