"""Data-quality metrics as DataFrames (never driver-side loops over rows).

Each metric is one aggregation pass producing a small long-format frame;
``dq_report`` unions them into ``(section, subject, metric, value)`` rows.
The processed (review-grain) stage is measured from the game-grain facts,
weighting each game by its review count (every review of a game shares the
game's columns), so the review table is not walked again for the report.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType, NumericType

from crosslink.config import MEAN_DECIMALS, Options
from crosslink.functions import null_or_nan
from crosslink.operators.aggregate import FLAGS_PRESENT
from crosslink.operators.resolve import MATCH_STAGE
from crosslink.sources.readers import Sources

def _stack(pairs: Sequence[tuple[str, Column]], key: str, val: str) -> Column:
    """``stack`` expression turning ``(name, value)`` pairs into rows."""
    args: list[Column] = [F.lit(len(pairs))]
    for name, c in pairs:
        args += [F.lit(name), c.cast("double")]
    return F.stack(*args).alias(key, val)


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def record_counts(sources: Sources) -> DataFrame:
    """``(source, num_rows, num_columns)`` for every present source."""
    return _union(
        [
            df.agg(F.count(F.lit(1)).alias("num_rows")).select(
                F.lit(name).alias("source"), "num_rows", F.lit(len(df.columns)).alias("num_columns")
            )
            for name, df in sources.items()
        ]
    )


def source_report(sources: Sources, options: Options) -> DataFrame:
    """Report rows of the raw sources: counts, null rates, too few records.

    One aggregation over each source's critical columns only; all its report
    rows are unpacked from that one row.
    """
    frames = []
    for name, df in sources.items():
        present = [c for c in options.critical_columns if c in df.columns]
        nulls = [F.count(F.when(F.col(c).isNull(), 1)).alias(f"nulls_{i}") for i, c in enumerate(present)]
        rows = F.col("rows").cast("double")
        lines = [_line("record_counts", f"raw:{name}", "rows", rows)]
        for i, c in enumerate(present):
            rate = F.when(rows == 0, F.lit(0.0)).otherwise(F.col(f"nulls_{i}") / rows)
            lines.append(_line("raw_null_rates", f"{name}.{c}", "null_rate", rate))
        low = F.when(rows < options.min_expected_records, rows)
        lines.append(_line("threshold_violations", f"min_records:{name}", "observed", low))
        frames.append(_lines(df.agg(F.count(F.lit(1)).alias("rows"), *nulls), lines))
    return _union(frames)


def _line(section: str, subject: str, metric: str, value: Column) -> Column:
    return F.struct(
        F.lit(section).alias("section"),
        F.lit(subject).alias("subject"),
        F.lit(metric).alias("metric"),
        value.cast("double").alias("value"),
    )


def _lines(one: DataFrame, lines: Sequence[Column]) -> DataFrame:
    """Report rows out of a one-row aggregate; a violation that is null did not occur."""
    out = one.select(F.inline(F.array(*lines)))
    return out.filter((F.col("section") != "threshold_violations") | F.col("value").isNotNull())


def null_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, null_rate)`` in one pass.

    Null — or NaN for float/double columns — counts as missing. An empty
    input gives 0.0 for every column; a column absent from ``df`` gives NaN.
    """
    if not columns:
        return df.sparkSession.createDataFrame([], "column_name string, null_rate double")
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    present = [c for c in columns if c in dtypes]
    aggs = [F.count(F.lit(1)).alias("_total")] + [
        F.sum(F.when(null_or_nan(c, dtypes[c]), 1).otherwise(0)).alias(f"_n{i}")
        for i, c in enumerate(present)
    ]
    counts = df.agg(*aggs)
    pairs = []
    for c in columns:
        if c in dtypes:
            n = F.col(f"_n{present.index(c)}")
            rate = F.when(F.col("_total") == 0, F.lit(0.0)).otherwise(n / F.col("_total"))
        else:
            rate = F.lit(float("nan"))
        pairs.append((c, rate))
    return counts.select(_stack(pairs, "column_name", "null_rate"))


def mean(c: str, dtype: DataType) -> Column:
    if isinstance(dtype, IntegralType):
        return F.sum(c).cast("double") / F.count(c)
    return F.round(F.avg(c), MEAN_DECIMALS)


def summary_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, min, max, mean)`` of the numeric columns present.

    The mean of an integer column is exact, that of a floating-point column
    has ``MEAN_DECIMALS`` decimals (see ``config``).
    """
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    avail = [c for c in columns if c in dtypes and isinstance(dtypes[c], NumericType)]
    spark = df.sparkSession
    if not avail:
        return spark.createDataFrame([], "column_name string, min double, max double, mean double")
    aggs = []
    for i, c in enumerate(avail):
        aggs += [
            F.min(c).cast("double").alias(f"_mi{i}"),
            F.max(c).cast("double").alias(f"_ma{i}"),
            mean(c, dtypes[c]).alias(f"_me{i}"),
        ]
    one = df.agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"_mi{i}").alias("min"),
                F.col(f"_ma{i}").alias("max"),
                F.col(f"_me{i}").alias("mean"),
            )
            for i, c in enumerate(avail)
        ]
    )
    return one.select(F.inline(rows))


def match_rate(summary: DataFrame) -> DataFrame:
    """Distinct games with a KB entity / distinct games, as a percentage.

    ``(0, 0, 0.0)`` on empty input. With a ``wd_match_stage`` column the
    matches are also split into ``id`` and ``title`` stage. Rows are reduced
    to one per game first (a partial aggregate, no row expansion).
    """
    has_stage = MATCH_STAGE in summary.columns
    hits = [("matched", F.col("wikidata_qid").isNotNull())]
    if has_stage:
        hits += [(f"matched_by_{s}", F.col(MATCH_STAGE) == s) for s in ("id", "title")]
    games = summary.filter(F.col("app_id").isNotNull()).groupBy("app_id")
    games = games.agg(*[F.max(F.coalesce(c, F.lit(False))).alias(n) for n, c in hits])
    out = games.agg(
        F.count_if(F.col("matched")).alias("matched"),
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(n)).alias(n) for n, _ in hits[1:]],
    )
    return out.withColumn(
        "match_rate_pct",
        F.when(F.col("total") == 0, F.lit(0.0)).otherwise(F.col("matched") / F.col("total") * 100),
    )


def sample_rows(df: DataFrame, n: int = 5, key: str = "app_id") -> DataFrame:
    """The first ``n`` rows by ``key`` (deterministic sample for the report)."""
    return df.orderBy(F.col(key).asc_nulls_last()).limit(n)


def threshold_violations(
    counts: DataFrame,
    rates: DataFrame,
    options: Options = Options(),
) -> DataFrame:
    """One row per violated threshold: ``(check_name, subject, observed, threshold)``.

    Sources with fewer than ``min_expected_records`` rows, and critical
    columns whose null rate exceeds ``max_null_rate`` (NaN rates — absent
    columns — are skipped). Violations warn; they never fail the job.
    """
    low = counts.filter(F.col("num_rows") < F.lit(options.min_expected_records)).select(
        F.lit("min_records").alias("check_name"),
        F.col("source").alias("subject"),
        F.col("num_rows").cast("double").alias("observed"),
        F.lit(float(options.min_expected_records)).alias("threshold"),
    )
    crit = list(options.critical_columns)
    high = rates.filter(
        F.col("column_name").isin(crit)
        & ~F.isnan("null_rate")
        & (F.col("null_rate") > F.lit(options.max_null_rate))
    ).select(
        F.lit("max_null_rate").alias("check_name"),
        F.col("column_name").alias("subject"),
        F.col("null_rate").alias("observed"),
        F.lit(float(options.max_null_rate)).alias("threshold"),
    )
    return low.unionByName(high)


def facts_report(facts: DataFrame, options: Options) -> DataFrame:
    """Every game-grain row of the report from ONE aggregation pass.

    ``facts`` has one row per game, so matches are conditional counts. Stage
    counts, weighted null rates of the processed stage and their violations,
    summary statistics and match rate are unpacked from one aggregate row.
    """
    dtypes = {f.name: f.dataType for f in facts.schema.fields}
    total = F.coalesce(F.sum("num_reviews"), F.lit(0))
    metrics: list[tuple[str, str, str, Column]] = [
        ("record_counts", "processed", "rows", total),
        ("record_counts", "aggregated", "rows", F.count(F.lit(1))),
    ]
    for c in options.critical_columns:
        if c == "is_recommended" and FLAGS_PRESENT in dtypes:
            missing = F.sum(F.col("num_reviews") - F.col(FLAGS_PRESENT))
        elif c in dtypes:
            missing = F.sum(F.when(null_or_nan(c, dtypes[c]), F.col("num_reviews")).otherwise(0))
        else:
            metrics.append(("null_rates", c, "null_rate", F.lit(float("nan"))))
            continue
        rate = F.when(total == 0, F.lit(0.0)).otherwise(missing / total)
        metrics.append(("null_rates", c, "null_rate", rate))
    for c in options.summary_columns:
        if c in dtypes and isinstance(dtypes[c], NumericType):
            metrics += [
                ("summary_stats", c, "min", F.min(c)),
                ("summary_stats", c, "max", F.max(c)),
                ("summary_stats", c, "mean", mean(c, dtypes[c])),
            ]
    if "wikidata_qid" in dtypes:
        matched, games = F.count("wikidata_qid"), F.count(F.lit(1))
        metrics += [
            ("match_rate", "kb", "matched", matched),
            ("match_rate", "kb", "total", games),
            ("match_rate", "kb", "match_rate_pct", F.when(games == 0, F.lit(0.0)).otherwise(matched / games * 100)),
        ]
        if MATCH_STAGE in dtypes:
            for stage in ("id", "title"):
                metrics.append(("match_rate", "kb", f"matched_by_{stage}", F.count_if(F.col(MATCH_STAGE) == stage)))
    one = facts.agg(*[m[3].cast("double").alias(f"_m{i}") for i, m in enumerate(metrics)])
    lines = []
    for i, (section, subject, metric, _) in enumerate(metrics):
        value = F.col(f"_m{i}")
        lines.append(_line(section, subject, metric, value))
        if section == "null_rates":
            high = F.when(~F.isnan(value) & (value > options.max_null_rate), value)
            lines.append(_line("threshold_violations", f"max_null_rate:{subject}", "observed", high))
    return _lines(one, lines)


def dq_report(sources: Sources, facts: DataFrame, options: Options = Options()) -> DataFrame:
    """The full report as ``(section, subject, metric, value)`` rows.

    ``facts`` is the game-grain table of ``aggregate.game_facts`` (the job
    writes it first). One aggregate over it and one over each raw source's
    critical columns give all sections, violations included. Without a KB there
    are no ``match_rate`` rows.
    """
    return source_report(sources, options).unionByName(facts_report(facts, options))
