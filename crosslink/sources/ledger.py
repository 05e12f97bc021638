"""The ledger of what permissive reading loses: cells, rows and lines, and keys that drift.

The readers turn a cell that does not parse into null and a line that does not
parse into a row of nulls.  Here each such loss is a row with its file and its
raw text, written by the executors that meet it; counts of it go to the report.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "__crosslink_corrupt"
#: types that the cleaning step gives to columns which schemas declare as text
KEY_TYPES = {"app_id": "int", "appid": "int"}
LEDGER = ("source", "file", "column", "expected", "raw")
WHOLE_ROW = "row of another length"
JSON_OBJECT = "json object"


def rejected_cells(
    spark: SparkSession,
    path: str,
    schema: StructType,
    source: str,
    delimiter: str = ",",
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """LEDGER rows of a CSV source: each non-null cell that its type turns into null, and each row with too many or few cells.

    ``types``: Spark types of columns that ``schema`` lacks or has as text (keys
    always are numbers, ``KEY_TYPES``).  A row of another length has no column
    name; its cells are judged too, as far as the reader takes them.
    """
    names = spark.read.option("header", True).option("sep", delimiter).csv(path).columns
    text = StructType([StructField(n, StringType()) for n in (*names, CORRUPT)])
    # without column pruning, else the parser does not see how many cells a row has
    rows = spark.read.schema(text).option("header", True).option("sep", delimiter).option("columnPruning", False).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path)
    wanted = {f.name: f.dataType.simpleString() for f in schema.fields} | {c: t for c, t in KEY_TYPES.items()} | dict(types or {})
    entry = lambda column, expected, raw: F.struct(F.lit(column).cast("string").alias("column"), F.lit(expected).alias("expected"), raw.alias("raw"))
    # Spark refuses to read the record alone, so a cell (its first 0 characters) is read with it
    record = F.concat(F.col(CORRUPT), F.left(F.coalesce(F.col(f"`{names[0]}`"), F.lit("")), F.lit(0)))
    lost = [F.when(F.col(CORRUPT).isNotNull(), entry(None, WHOLE_ROW, record))]
    for n in names:
        if wanted.get(n, "string") != "string":
            cell = F.col(f"`{n}`")
            lost.append(F.when(cell.isNotNull() & cell.try_cast(wanted[n]).isNull(), entry(n, wanted[n], cell)))
    found = rows.select(F.col("_metadata.file_path").alias("file"), F.inline(F.array_compact(F.array(*lost))))
    return found.select(F.lit(source).alias("source"), "file", "column", "expected", "raw")


def _records(spark: SparkSession, path: str) -> DataFrame:
    """(file, value, record): the lines that are not blank, and what they parse to."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value").where(F.trim("value") != "")
    return lines.withColumn("record", F.try_parse_json("value"))


def _is_object() -> Column:
    return F.coalesce(F.schema_of_variant("record").startswith("OBJECT"), F.lit(False))


def malformed_lines(spark: SparkSession, path: str, source: str) -> DataFrame:
    """LEDGER rows of the JSON lines that do not parse, or parse to something other than an object."""
    lines = _records(spark, path).where(~_is_object())
    none = F.lit(None).cast("string").alias("column")
    return lines.select(F.lit(source).alias("source"), "file", none, F.lit(JSON_OBJECT).alias("expected"), F.col("value").alias("raw"))


def key_census(spark: SparkSession, path: str, schema: StructType, source: str) -> DataFrame:
    """One row for each key of the JSON lines or of ``schema``: what it is declared as and what it holds.

    Columns source, key, expected (declared type), found (the type that holds all
    its values), lines (that have the key), absent (that lack it), nulls, kind:
    ``declared`` (same type), ``type`` (another), ``new`` (not declared), ``missing``
    (in no line).  Types are compared by name, so a number in a text column is told.
    """
    objects = _records(spark, path).where(_is_object()).select("record")
    keys = spark.sql(
        """SELECT key, schema_of_variant_agg(v.value) AS found, count(*) AS lines, count_if(is_variant_null(v.value)) AS nulls
           FROM {objects}, LATERAL variant_explode(record) AS v GROUP BY key""",
        objects=objects,
    )
    declared = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in schema.fields], "key string, expected string")
    found = F.regexp_replace(F.regexp_replace(F.lower("found"), "object<", "struct<"), "([:,]) ", "$1")
    both = keys.withColumn("found", found).join(declared, "key", "full").withColumn("lines", F.coalesce("lines", F.lit(0)))
    kind = F.when(F.col("expected").isNull(), "new").when(F.col("found").isNull(), "missing").when(F.col("found") == F.col("expected"), "declared").otherwise("type")
    both = spark.sql("SELECT *, (SELECT count(*) FROM {objects}) AS total FROM {both}", both=both, objects=objects)
    return both.select(
        F.lit(source).alias("source"), "key", "expected", "found", "lines", (F.col("total") - F.col("lines")).alias("absent"), F.coalesce("nulls", F.lit(0)).alias("nulls"), kind.alias("kind")
    )


def ledger_counts(ledger: DataFrame) -> DataFrame:
    """Report rows (section, subject, metric, value): how much each source's column lost."""
    subject = F.concat_ws(".", "source", F.coalesce("column", F.col("expected")))
    counts = ledger.groupBy(subject.alias("subject")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    return counts.select(F.lit("rejected").alias("section"), "subject", F.lit("lost").alias("metric"), "value")
