"""Writers: canonical Parquet, CSV preview, JSON lines, report.

All writes are ``mode("overwrite")`` and go through Spark's committer, so a
task lost with its executor is simply re-run; nothing is staged on the
driver's local disk.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str) -> str:
    """Canonical output: unpartitioned Parquet, overwrite."""
    df.write.mode("overwrite").parquet(path)
    return path


def write_csv(df: DataFrame, path: str, header: bool = True, single_file: bool = False) -> str:
    """CSV with header (a directory of part files, or one part file)."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", header).csv(path)
    return path


def write_json_lines(df: DataFrame, path: str) -> str:
    """Newline-delimited JSON (nulls omitted, non-ASCII kept as is)."""
    df.write.mode("overwrite").json(path)
    return path


def write_csv_preview(
    spark: SparkSession,
    parquet_path: str,
    path: str,
    n: int = 100,
    key: str = "app_id",
) -> str:
    """First ``n`` rows by ``key`` of the *written* result, one CSV file.

    Reading the Parquet back (instead of re-planning the job) makes the
    preview a top-``n`` over one scan; ``TakeOrderedAndProject`` keeps only
    ``n`` rows per partition before the single-task merge.
    """
    result = spark.read.parquet(parquet_path)
    top = result.orderBy(F.col(key).asc_nulls_last()).limit(n)
    return write_csv(top, path, header=True, single_file=True)
