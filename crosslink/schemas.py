"""Explicit schemas of the sources, payloads and the result (no inference pass).

Key columns of text sources are read as strings and converted with
``to_int_key`` so that values such as ``" 8 "`` still parse and bad values
become null instead of failing the read.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)


def _s(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


STR = StringType()

GAMES = _s(("app_id", STR), ("title", STR))

METADATA = _s(("app_id", STR), ("tags", ArrayType(STR)))

RECS = _s(("app_id", STR), ("user_id", STR), ("is_recommended", STR))

# The popularity feed's record fields, in feed order.
POPULARITY_FIELDS = (
    "appid",
    "name",
    "developer",
    "publisher",
    "owners",
    "average_forever",
    "median_forever",
    "ccu",
    "price",
)
_POP_INT = {"appid", "average_forever", "median_forever", "ccu", "price"}
POPULARITY = _s(*[(f, IntegerType() if f in _POP_INT else STR) for f in POPULARITY_FIELDS])

CATEGORIES = _s(("genre", STR), ("category", STR))

# Flattened knowledge-base row, in file order.
KB_FIELDS = (
    "wikidata_qid",
    "wikidata_uri",
    "steam_app_id",
    "name",
    "release_date",
    "metacritic",
    "publisher",
    "country",
)
KB = _s(*[(f, STR) for f in KB_FIELDS])

# The SPARQL result variables of one binding.
KB_BINDING_VARS = (
    "game",
    "gameLabel",
    "steamAppId",
    "releaseDate",
    "metacritic",
    "publisherLabel",
    "countryLabel",
)
_NODE = _s(("type", STR), ("value", STR))
KB_BINDING = _s(*[(v, _NODE) for v in KB_BINDING_VARS])
KB_PAYLOAD = _s(("results", _s(("bindings", ArrayType(KB_BINDING)))))

# The feed writes numbers bare or quoted: read as text, then converted.
POPULARITY_RECORD = _s(*[(f, STR) for f in POPULARITY_FIELDS])
POPULARITY_PAYLOAD = MapType(STR, POPULARITY_RECORD)

# Knowledge-base fields carried to the result, as (source column, result column).
KB_RESULT_FIELDS = (
    ("wikidata_qid", "wikidata_qid"),
    ("release_date", "wd_release_date"),
    ("metacritic", "wd_metacritic"),
    ("publisher", "wd_publisher"),
    ("country", "wd_country"),
)

# Result columns in output order (KB columns only when a KB was joined).
RESULT_STEAM_COLUMNS = (
    "app_id",
    "steam_recommend_rate",
    "num_reviews",
    "num_positive_reviews",
)
RESULT_DESCRIPTOR_COLUMNS = ("title", "primary_tag", "genre_category", "price")
RESULT_KB_COLUMNS = tuple(r for _, r in KB_RESULT_FIELDS)

RESULT = StructType(
    [
        StructField("app_id", IntegerType(), False),
        StructField("steam_recommend_rate", DoubleType(), True),
        StructField("num_reviews", LongType(), False),
        StructField("num_positive_reviews", LongType(), True),
        StructField("title", STR, True),
        StructField("primary_tag", STR, True),
        StructField("genre_category", STR, True),
        StructField("price", IntegerType(), True),
    ]
    + [StructField(c, STR, True) for c in RESULT_KB_COLUMNS]
)
