"""Session helpers: a tuned builder and the shared scratch folder.

Intermediate files (round trips, previews, lineage cuts) go to the folder the
cluster names in ``spark.checkpoint.dir``. Only when that is unset and the
master is local (tests, laptops) do we create one under the system temp dir.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(
    master: str | None = None,
    app_name: str = "crosslink",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with AQE on.

    No plan hints a broadcast. Spark broadcasts a side whose size, estimated
    from the listed files, is below 10 MB, or that AQE *measured* below 64 MB.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": "10MB",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a local one only when unset locally."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return d.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; configure a shared folder for the cluster"
        )
    d = tempfile.mkdtemp(prefix="crosslink-ckpt-")
    sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder, removed when the program ends."""
    path = f"{checkpoint_dir(spark)}/scratch/{name}-{uuid.uuid4().hex[:12]}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch path; a session that was stopped before keeps its files."""
    sc = spark.sparkContext
    if sc._jsc is None or sc._jvm is None:
        return
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)
