"""Acquired payloads → flat tables (the parse/flatten half of acquisition).

Two raw shapes are supported, each stored as one JSON document per page
(a bounded group: one API/SPARQL page):

* knowledge base: ``{"results": {"bindings": [{var: {"value": …}}, …]}}``
* popularity feed: ``{"<appid>": {field: value, …}, …}``

Parsing is ``from_json`` with an explicit schema, then ``posexplode`` /
``explode`` — executor-side, one page per row, never collected.
The HTTP clients that fetch pages are not part of this library.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crosslink import schemas
from crosslink.config import DEFAULT_MAX_GAMES
from crosslink.functions import qid_from_uri, to_int_key
from crosslink.operators.clean import keep_first_with_key
from crosslink.sources.standins import KB_URI_PREFIX, parts_with_supplier, table

log = logging.getLogger(__name__)

ARRIVAL_ORDER = ("page_no", "pos")


# --------------------------------------------------------------------------- #
#  Knowledge-base bindings
# --------------------------------------------------------------------------- #

def parse_kb_bindings(pages: DataFrame, payload_col: str = "payload") -> DataFrame:
    """Flatten SPARQL result pages to one row per binding.

    ``wikidata_qid`` = text after the last ``/`` of the entity URI (null when
    the URI is missing); ``wikidata_uri`` = the URI or ``""``; ``steam_app_id``
    = INT or null when unparsable; any other missing variable → null.
    ``page_no, pos`` record arrival order.
    """
    parsed = pages.select("page_no", F.from_json(payload_col, schemas.KB_PAYLOAD).alias("_p"))
    rows = parsed.select("page_no", F.posexplode("_p.results.bindings").alias("pos", "b"))

    def v(var: str) -> Column:
        return F.col(f"b.{var}.value")

    return rows.select(
        "page_no",
        "pos",
        qid_from_uri(v("game")).alias("wikidata_qid"),
        F.coalesce(v("game"), F.lit("")).alias("wikidata_uri"),
        to_int_key(v("steamAppId")).alias("steam_app_id"),
        v("gameLabel").alias("name"),
        v("releaseDate").alias("release_date"),
        v("metacritic").alias("metacritic"),
        v("publisherLabel").alias("publisher"),
        v("countryLabel").alias("country"),
    )


def cap_rows(df: DataFrame, n: int = DEFAULT_MAX_GAMES, order: Sequence[str] = ARRIVAL_ORDER) -> DataFrame:
    """The first ``n`` rows in ``order`` (the acquisition cap, ``max_games``)."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)


def dedup_kb_by_qid(bindings: DataFrame, order: Sequence[str] = ARRIVAL_ORDER) -> DataFrame:
    """Keep the first binding of each entity; bindings without an id (null or empty) are all kept."""
    return keep_first_with_key(bindings, "wikidata_qid", list(order))


def kb_from_pages(pages: DataFrame, max_games: int | None = None) -> DataFrame:
    """Pages → flat → de-duplicated KB rows (the JSON-lines file).

    ``max_games`` caps the bindings taken, in arrival order, as the acquisition
    does (``DEFAULT_MAX_GAMES``); by default all are taken. A cap that removes
    rows is logged with their number.
    """
    flat = parse_kb_bindings(pages)
    if max_games is not None:
        total = flat.count()
        if total > max_games:
            log.warning("cap of %d bindings: %d of %d left out", max_games, total - max_games, total)
        flat = cap_rows(flat, max_games)
    return dedup_kb_by_qid(flat).select(*schemas.KB_FIELDS)


def kb_payload_pages(spark: SparkSession, sf_dir: str, page_parts: int = 100) -> DataFrame:
    """Stand-in SPARQL pages derived from part ⋈ supplier ⋈ nation.

    One binding per part; a second binding with another publisher for the
    same entity on some parts (the duplicate an OPTIONAL clause produces);
    bindings without an entity URI, or with one that ends before the id, on
    others. A page holds the bindings of
    ``page_parts`` consecutive parts, so page size stays bounded.
    """
    base = parts_with_supplier(spark, sf_dir, how="left")
    key = F.col("p_partkey")
    ks = key.cast("string")

    def node(c: Column, kind: str = "literal") -> Column:
        return F.when(c.isNotNull(), F.struct(F.lit(kind).alias("type"), c.alias("value")))

    label = F.concat(F.col("p_name"), F.lit(" "), F.lower("p_brand"), F.lit(" "), ks)
    release = F.when(key % 3 != 0, F.concat((F.col("p_size") + 1970).cast("string"), F.lit("-01-01T00:00:00Z")))
    app = F.when(key % 5 == 2, F.lit("n/a")).when(key % 5 != 4, ks)
    meta = F.when(key % 11 == 0, (F.col("p_size") * 2).cast("string"))
    uri = F.concat(F.lit(KB_URI_PREFIX + "Q"), ks)

    def binding(variant: int, game: Column, publisher: Column, name: Column) -> Column:
        return F.struct(
            key.alias("k"),
            F.lit(variant).alias("variant"),
            F.struct(
                node(game, "uri").alias("game"),
                node(name).alias("gameLabel"),
                node(app).alias("steamAppId"),
                node(release).alias("releaseDate"),
                node(meta).alias("metacritic"),
                node(publisher).alias("publisherLabel"),
                node(F.col("n_name")).alias("countryLabel"),
            ).alias("b"),
        )

    no_pub = F.when(key % 7 != 0, F.col("s_name"))
    variants = F.array(
        binding(0, uri, no_pub, label),
        F.when(key % 13 == 0, binding(1, uri, F.lit("Second publisher"), label)),
        F.when(key % 17 == 0, binding(2, F.lit(None).cast("string"), no_pub, F.concat(F.lit("unnamed "), ks))),
        F.when(key % 19 == 0, binding(3, F.lit(KB_URI_PREFIX), no_pub, F.concat(F.lit("no id "), ks))),
    )
    exploded = base.select(
        F.floor(key / page_parts).alias("page_no"),
        F.explode(F.filter(variants, lambda x: x.isNotNull())).alias("e"),
    )
    pages = exploded.groupBy("page_no").agg(F.sort_array(F.collect_list("e")).alias("es"))
    bindings = F.transform("es", lambda e: e["b"])
    return pages.select(
        "page_no",
        F.to_json(F.struct(F.struct(bindings.alias("bindings")).alias("results"))).alias("payload"),
    )


# --------------------------------------------------------------------------- #
#  Popularity feed
# --------------------------------------------------------------------------- #

def parse_popularity_payload(pages: DataFrame, payload_col: str = "payload") -> DataFrame:
    """Flatten ``{appid: record}`` pages to the nine feed fields.

    Numbers may be bare or quoted; text that is no number becomes null. A field
    missing from a record becomes null (the reference writes ``""``, which its
    CSV re-read turns into null).
    """
    m = pages.select(F.from_json(payload_col, schemas.POPULARITY_PAYLOAD).alias("_m"))
    recs = m.select(F.explode("_m").alias("_key", "r"))
    types = {f.name: f.dataType for f in schemas.POPULARITY.fields}
    return recs.select(*[F.col(f"r.{f}").try_cast(types[f]).alias(f) for f in schemas.POPULARITY_FIELDS])


def popularity_payload_pages(spark: SparkSession, sf_dir: str, page_parts: int = 1000) -> DataFrame:
    """Stand-in feed pages: one record per part, keyed by its id; odd pages quote their prices."""
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    rec = F.struct(
        key.cast("int").alias("appid"),
        F.col("p_name").alias("name"),
        F.concat(F.lit("Studio "), F.col("p_brand")).alias("developer"),
        F.col("p_brand").alias("publisher"),
        F.concat((F.col("p_size") * 1000).cast("string"), F.lit(" .. "), (F.col("p_size") * 2000).cast("string")).alias(
            "owners"
        ),
        (F.col("p_size") * 10).cast("int").alias("average_forever"),
        (F.col("p_size") * 5).cast("int").alias("median_forever"),
        F.col("p_size").cast("int").alias("ccu"),
        F.when(key % 40 != 0, F.floor("p_retailprice").cast("int")).alias("price"),
    )
    pages = part.groupBy(F.floor(key / page_parts).alias("page_no")).agg(
        F.map_from_entries(F.collect_list(F.struct(key.cast("string"), rec))).alias("m")
    )
    quoted = F.regexp_replace(F.to_json("m"), r'"price":(\d+)', '"price":"$1"')
    return pages.select("page_no", F.when(F.col("page_no") % 2 == 1, quoted).otherwise(F.to_json("m")).alias("payload"))
