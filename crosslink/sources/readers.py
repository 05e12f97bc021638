"""Readers for the six logical sources and the ``Sources`` bundle.

Every reader uses an explicit schema (no ``inferSchema`` pass over the large
review file) and PERMISSIVE mode, so malformed cells become null and are then
removed by the cleaning step where they matter.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from crosslink import schemas
from crosslink.sources.contract import available, require
from crosslink.sources.ledger import malformed_lines, rejected_cells

log = logging.getLogger(__name__)

REQUIRED = ("games", "metadata", "recs", "popularity", "categories")
OPTIONAL = ("kb",)


@dataclass(frozen=True)
class Sources:
    """The six logical inputs. ``kb`` is optional (None → no KB columns).

    ``review_order`` lists columns of ``recs`` that give a total order inside
    one ``(app_id, user_id)`` group; the first review in that order survives
    de-duplication. Empty means "by a hash of the whole row", which favours no
    value of any column.
    """

    games: DataFrame
    metadata: DataFrame
    recs: DataFrame
    popularity: DataFrame
    categories: DataFrame
    kb: DataFrame | None = None
    review_order: tuple[str, ...] = field(default=())
    rejected: DataFrame | None = None  # what the readers could not parse, if asked for (see sources.ledger)

    def items(self) -> Iterator[tuple[str, DataFrame]]:
        for name in REQUIRED + OPTIONAL:
            df = getattr(self, name)
            if df is not None:
                yield name, df

    def without_kb(self) -> Sources:
        return replace(self, kb=None)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    delimiter: str = ",",
    header: bool = True,
) -> DataFrame:
    """CSV with header, columns picked **by header name** (not position).

    The file is read as text columns (only the header line is inspected, no
    inference pass), then each column of ``schema`` is converted with
    ``try_cast``, so a malformed cell becomes null. Columns of ``schema`` absent
    from the file are skipped (callers treat them as optional); columns of the
    file that ``schema`` lacks follow as text. CRLF line ends are accepted.
    """
    raw = (
        spark.read.option("header", header)
        .option("sep", delimiter)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    cols = []
    for f in schema.fields:
        if f.name not in raw.columns:
            continue
        c = F.col(f"`{f.name}`")
        cols.append(c if isinstance(f.dataType, StringType) else c.try_cast(f.dataType).alias(f.name))
    extra = [F.col(f"`{c}`") for c in raw.columns if c not in schema.names]
    return raw.select(*cols, *extra)


def read_json_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def read_categories(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """Genre → category lookup; the delimiter is an option (tab-separated too)."""
    return read_csv(spark, path, schemas.CATEGORIES, delimiter=delimiter)


@dataclass(frozen=True)
class SourcePaths:
    """Where the sources lie.

    ``review_order``: columns of the review file that order the reviews of one
    user on one game. ``review_types``: Spark types of further review columns
    (text otherwise), so that numbers and dates sort as such.
    """

    games: str
    metadata: str
    recs: str
    popularity: str
    categories: str
    kb: str | None = None
    categories_delimiter: str = ","
    review_order: tuple[str, ...] = ()
    review_types: Mapping[str, str] = field(default_factory=dict)


def read_reviews(
    spark: SparkSession, path: str, order: Sequence[str] = (), types: Mapping[str, str] | None = None
) -> DataFrame:
    """Reviews with all columns of the file; ``ValueError`` if an order column is absent."""
    recs = read_csv(spark, path, schemas.RECS)
    absent = [c for c in (*order, *(types or {})) if c not in recs.columns]
    if absent:
        raise ValueError(f"review columns {absent} are not in {path}; it has {recs.columns}")
    return recs.withColumns({c: F.col(c).try_cast(t) for c, t in (types or {}).items()})


def read_ledger(spark: SparkSession, paths: SourcePaths, with_kb: bool) -> DataFrame:
    """What the permissive readers lose of all sources: cells, rows of another length, lines that hold no object."""
    csv = [
        rejected_cells(spark, paths.games, schemas.GAMES, "games"),
        rejected_cells(spark, paths.recs, schemas.RECS, "recs", types=paths.review_types),
        rejected_cells(spark, paths.popularity, schemas.POPULARITY, "popularity"),
        rejected_cells(spark, paths.categories, schemas.CATEGORIES, "categories", paths.categories_delimiter),
    ]
    lines = [malformed_lines(spark, paths.metadata, "metadata")]
    if with_kb:
        lines.append(malformed_lines(spark, paths.kb, "kb"))
    return reduce(DataFrame.unionByName, [*csv, *lines])


def load_sources(spark: SparkSession, paths: SourcePaths, ledger: bool = False) -> Sources:
    """Check all required inputs first, then build the (lazy) readers; ``ledger``: and that of what they lose."""
    for name in REQUIRED:
        require(spark, getattr(paths, name))
    kb = None
    if available(spark, paths.kb):
        kb = read_json_lines(spark, paths.kb, schemas.KB)
    else:
        log.warning("knowledge base %s absent or empty: KB enrichment skipped", paths.kb)
    src = Sources(
        games=read_csv(spark, paths.games, schemas.GAMES),
        metadata=read_json_lines(spark, paths.metadata, schemas.METADATA),
        recs=read_reviews(spark, paths.recs, paths.review_order, paths.review_types),
        popularity=read_csv(spark, paths.popularity, schemas.POPULARITY),
        categories=read_categories(spark, paths.categories, paths.categories_delimiter),
        kb=kb,
        review_order=paths.review_order,
        rejected=read_ledger(spark, paths, kb is not None) if ledger else None,
    )
    for name, df in src.items():
        log.info("source %-10s -> %d columns", name, len(df.columns))
    return src
