"""Quality metrics over time: a history of reports, and what changed between two runs.

Fixed thresholds tell a bad value; the history tells a value that moved.  A run's
report (see ``quality.dq_report``) is one committed segment, so a run that failed
half way leaves none, and a run that is recorded again changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from crosslink.segments import SegmentStore

KEY = ("section", "subject", "metric")
METRICS = StructType([StructField(c, StringType()) for c in ("run", *KEY)] + [StructField("value", DoubleType())])
DEFAULT_TOLERANCE = 0.1


def history_store(spark: SparkSession, path: str) -> SegmentStore:
    """The history below ``path``: frame ``metrics``, a segment for each run."""
    return SegmentStore(spark, path, metrics=METRICS)


def record_run(store: SegmentStore, run: str, report: DataFrame) -> bool:
    """Add a run's report to the history; False if the run is recorded already."""
    return store.append(run, {"metrics": report.select(F.lit(run).alias("run"), *KEY, "value")})


def runs(store: SegmentStore) -> list[str]:
    """The recorded runs, oldest first."""
    return [c.batch for c in store.commits()]


def metric_drift(store: SegmentStore, run: str | None = None, before: str | None = None, tolerance: float = DEFAULT_TOLERANCE) -> DataFrame:
    """What changed from the run ``before`` (the one before ``run``) to ``run`` (the last).

    Columns section, subject, metric, previous, current, change (current -
    previous), status and alarm.  Status is ``new`` or ``gone`` for a metric that
    one run lacks, else ``same`` or ``changed``; two NaN are the same, as are two
    missing values.  ``alarm``: new or gone, or a change of more than ``tolerance``
    of the previous value's size (of anything, from zero).  The first run has no
    run before it: all its metrics are new.
    """
    known = runs(store)
    if run is None:
        run = known[-1] if known else ""
    if before is None:
        at = known.index(run) if run in known else 0
        before = known[at - 1] if at else ""
    metrics = store.read("metrics")
    own = lambda name, column: metrics.where(F.col("run") == name).groupBy(*KEY).agg(F.max("value").alias(column), F.lit(True).alias(f"in_{column}"))
    both = own(before, "previous").join(own(run, "current"), list(KEY), "full")
    same = F.col("previous").eqNullSafe(F.col("current"))
    status = F.when(F.col("in_previous").isNull(), "new").when(F.col("in_current").isNull(), "gone").when(same, "same").otherwise("changed")
    change = F.col("current") - F.col("previous")
    moved = F.coalesce(F.abs(change) > tolerance * F.abs("previous"), F.lit(True))
    out = both.withColumn("change", change).withColumn("status", status)
    alarm = F.when(F.col("status") == "same", False).when(F.col("status") == "changed", moved).otherwise(True)
    return out.select(*KEY, "previous", "current", "change", "status", alarm.alias("alarm"))
