"""Schema conformance: each file of a source against the declared schema.

A source is a folder of files that many writers may have added to, so its schema
is looked at file by file: Parquet footers, CSV header lines, and the types that
the keys of JSON lines have.  The listing is a Spark job, footers are read in
tasks (a footer's bytes, never the data), and the differences are DataFrame
expressions over one row per file.  Text files are scanned once, which counts
their rows too.

A difference has a *kind*: ``missing`` (declared, not in the file), ``extra`` (in
the file, not declared), ``narrowed`` and ``widened`` (a numeric type of the
same family that is smaller or larger than declared), ``type`` (any other type)
and ``nullable`` (declared not null, nullable in the file).  Files that cannot be
opened have one row of the kind ``unreadable``.  A file without differences has
no row.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: families of numeric types, narrowest first
FAMILIES = (("tinyint", "smallint", "int", "bigint"), ("float", "double"))
FIELDS = "file string, num_rows long, fields array<struct<name:string,type:string,nullable:boolean>>, failure string"
UNREADABLE = "unreadable"


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, length) of the non-empty files below ``path``; contents are not read."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return listing.select(F.col("path").alias("file"), "length").where("length > 0")


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import pyarrow.fs
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import from_arrow_schema

    own_schema = b"org.apache.spark.sql.parquet.row.metadata"
    for batch in batches:
        rows = []
        for file in batch["file"].to_pylist():
            try:
                if re.match("file:|/", file):
                    fs, at = pyarrow.fs.LocalFileSystem(), re.sub("^file:/*", "/", file)
                else:
                    fs, at = pyarrow.fs.FileSystem.from_uri(quote(file, safe=":/@"))
                footer = pq.read_metadata(at, filesystem=fs)
                said = (footer.metadata or {}).get(own_schema)
                schema = StructType.fromJson(json.loads(said)) if said else from_arrow_schema(footer.schema.to_arrow_schema())
                fields = [{"name": f.name, "type": f.dataType.simpleString(), "nullable": f.nullable} for f in schema.fields]
                rows.append((file, footer.num_rows, fields, None))
            except (OSError, ValueError, pa.ArrowException) as exc:
                rows.append((file, None, None, type(exc).__name__))
        kinds = (pa.string(), pa.int64(), pa.list_(pa.struct([("name", pa.string()), ("type", pa.string()), ("nullable", pa.bool_())])), pa.string())
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["file", "num_rows", "fields", "failure"])


def parquet_fields(spark: SparkSession, path: str) -> DataFrame:
    """FIELDS of each Parquet file, from its footer; Spark's own schema where the footer has it.

    The listing is dealt over the cluster, so a folder of a million files is a
    million small reads by all executors.  Tasks open files themselves (local,
    HDFS, S3, GCS); a store that only Spark reads gives ``unreadable`` rows.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return list_files(spark, path).select("file").repartition(parts, "file").mapInArrow(_footers, FIELDS)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    file = F.col("_metadata.file_path").alias("file")
    return spark.read.option("recursiveFileLookup", "true").text(path).select("value", file, F.col("_metadata.file_block_start").alias("start"))


def csv_fields(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """FIELDS of each CSV file, from its first line; types are not known (null).

    Lines of a partition come in file order, so the first line of a file is the
    one with the least row number among those of its first split.
    """
    lines = _lines(spark, path).withColumn("nth", F.monotonically_increasing_id())
    head = F.min(F.when(F.col("start") == 0, F.struct("nth", "value")))["value"]
    files = lines.groupBy("file").agg((F.count(F.lit(1)) - 1).alias("num_rows"), head.alias("head"))
    names = F.split(F.regexp_replace("head", "^\\uFEFF|\\r$", ""), "\\Q" + delimiter + "\\E")
    fields = F.transform(names, lambda n: F.struct(F.regexp_replace(n, '^"|"$', "").alias("name"), F.lit(None).cast("string").alias("type"), F.lit(True).alias("nullable")))
    return files.select("file", "num_rows", fields.alias("fields"), F.lit(None).cast("string").alias("failure"))


def json_fields(spark: SparkSession, path: str) -> DataFrame:
    """FIELDS of each file of JSON lines: its keys, each with the type that holds all its values."""
    lines = _lines(spark, path).select("file", F.try_parse_json("value").alias("record"))
    counted = lines.groupBy("file").agg(F.count("record").alias("num_rows"))
    keys = spark.sql(
        "SELECT file, key, schema_of_variant_agg(v.value) AS type FROM {lines}, LATERAL variant_explode(record) AS v WHERE key IS NOT NULL GROUP BY file, key",
        lines=lines.where(F.schema_of_variant("record").startswith("OBJECT")),
    )
    field = F.struct(F.col("key").alias("name"), _spark_type(F.col("type")).alias("type"), F.lit(True).alias("nullable"))
    fields = keys.groupBy("file").agg(F.sort_array(F.collect_list(field)).alias("fields"))
    return counted.join(fields, "file", "left").select("file", "num_rows", F.coalesce("fields", F.expr("CAST(array() AS array<struct<name:string,type:string,nullable:boolean>>)")).alias("fields"), F.lit(None).cast("string").alias("failure"))


def _spark_type(variant: Column) -> Column:
    """Spark's name of a variant's type: OBJECT<a: BIGINT> is struct<a:bigint>."""
    return F.regexp_replace(F.regexp_replace(F.lower(variant), "object<", "struct<"), "([:,]) ", "$1")


def _changed_type(expected: Column, found: Column) -> Column:
    """narrowed, widened or type; null if the types are equal or one isn't known."""
    kind = F.lit("type")
    for family in FAMILIES:
        order = F.array(*map(F.lit, family))
        own, other = F.array_position(order, expected), F.array_position(order, found)
        kind = F.when((own > 0) & (other > 0), F.when(other < own, F.lit("narrowed")).otherwise(F.lit("widened"))).otherwise(kind)
    return F.when(expected != found, kind)


def differences(fields: DataFrame, declared: StructType, source: str) -> DataFrame:
    """(source, file, num_rows, column, expected, found, kind): what each file has otherwise than declared."""
    names = F.array(*(F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"), F.lit(f.nullable).alias("nullable")) for f in declared.fields))
    none = F.lit(None).cast("string")
    found = lambda d: F.get(F.filter("fields", lambda x: x["name"] == d["name"]), 0)
    row = lambda column, expected, got, kind: F.struct(column.alias("column"), expected.alias("expected"), got.alias("found"), kind.alias("kind"))

    def of_declared(d: Column) -> Column:
        f = found(d)
        null = lambda x: F.when(x["nullable"], F.lit("null")).otherwise(F.lit("not null"))
        return F.array(
            F.when(f.isNull(), row(d["name"], d["type"], none, F.lit("missing"))).when(_changed_type(d["type"], f["type"]).isNotNull(), row(d["name"], d["type"], f["type"], _changed_type(d["type"], f["type"]))),
            F.when(f["nullable"] & ~d["nullable"], row(d["name"], null(d), null(f), F.lit("nullable"))),
        )

    extra = F.transform(F.filter("fields", lambda x: ~F.array_contains(F.transform(names, lambda d: d["name"]), x["name"])), lambda x: row(x["name"], none, x["type"], F.lit("extra")))
    rows = F.filter(F.concat(F.flatten(F.transform(names, of_declared)), extra), lambda x: x.isNotNull())
    failed = F.array(row(none, none, F.col("failure"), F.lit(UNREADABLE)))
    every = F.when(F.col("failure").isNotNull(), failed).otherwise(rows)
    return fields.select(F.lit(source).alias("source"), "file", "num_rows", F.inline(every))


def schema_conformance(spark: SparkSession, path: str, declared: StructType, source: str, kind: str, delimiter: str = ",") -> DataFrame:
    """The differences of the files below ``path``; ``kind``: parquet, csv or json."""
    if kind == "parquet":
        fields = parquet_fields(spark, path)
    elif kind == "csv":
        fields = csv_fields(spark, path, delimiter)
    elif kind == "json":
        fields = json_fields(spark, path)
    else:
        raise ValueError(f"kind must be parquet, csv or json, got {kind!r}")
    return differences(fields, declared, source)
