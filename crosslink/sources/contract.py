"""Source contract: required inputs must exist and be non-empty.

The check is a Spark listing (``binaryFile`` with only ``path``/``length``
selected, so file contents are never read). It therefore works for any
Hadoop-compatible store the session can read — local, HDFS or object stores —
and for directories of part files as well as single files.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def total_bytes(spark: SparkSession, path: str) -> int | None:
    """Total size of the files at ``path``; None if the path does not exist."""
    try:
        listing = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .load(path)
            .select("path", "length")
        )
        row = listing.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("b")).first()
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc).lower():
            return None
        raise
    return int(row["b"] or 0)


def require(spark: SparkSession, path: str) -> str:
    """Raise ``FileNotFoundError`` if missing, ``ValueError`` if empty."""
    size = total_bytes(spark, path)
    if size is None:
        raise FileNotFoundError(f"Required input is missing: {path}")
    if size == 0:
        raise ValueError(f"Required input is empty: {path}")
    return path


def available(spark: SparkSession, path: str | None) -> bool:
    """Optional input: present and non-empty."""
    if not path:
        return False
    size = total_bytes(spark, path)
    return bool(size)
