"""Append-only state in committed segments, for jobs that run batch by batch.

A state is a folder.  Each batch writes its named frames below
``segments/<batch>/<name>`` and, when all are written, one commit row below
``commits``.  Readers take only segments with a commit, so a job that dies half
way leaves nothing behind that counts, and a batch that is applied again finds
its commit and does nothing.  There is one writer at a time.

The commits (one small row a batch) are what the driver reads; rows stay on the
executors.  ``compact`` writes a segment that stands for all before it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: a frame, or what makes it from the frames of the batch that are written before it
Frame = DataFrame | Callable[[dict[str, DataFrame]], DataFrame]
COMMIT = "seq long, batch string, segment string, base boolean, mark string"


@dataclass(frozen=True)
class Commit:
    seq: int
    batch: str
    segment: str
    base: bool  # this segment stands for all earlier ones
    mark: str | None  # what the batch has reached, as the writer states it


class SegmentStore:
    """Committed segments of frames with fixed schemas below ``path``."""

    def __init__(self, spark: SparkSession, path: str, **schemas: StructType):
        self.spark, self.path, self.schemas = spark, path.rstrip("/"), schemas

    def commits(self) -> list[Commit]:
        """All commits, in order."""
        try:
            rows = self.spark.read.schema(COMMIT).option("recursiveFileLookup", "true").parquet(f"{self.path}/commits").collect()
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" in str(exc):
                return []
            raise
        return sorted((Commit(**r.asDict()) for r in rows), key=lambda c: c.seq)

    def live(self) -> list[Commit]:
        """The commits from the last base on."""
        commits = self.commits()
        begin = max((k for k, c in enumerate(commits) if c.base), default=0)
        return commits[begin:]

    def mark(self) -> str | None:
        """The mark of the last commit that has one."""
        return next((c.mark for c in reversed(self.commits()) if c.mark is not None), None)

    def read(self, name: str) -> DataFrame:
        """The rows of one frame in all live segments; none before the first commit."""
        paths = [f"{c.segment}/{name}" for c in self.live()]
        if not paths:
            return self.spark.createDataFrame([], self.schemas[name])
        return self.spark.read.schema(self.schemas[name]).parquet(*paths)

    def append(self, batch: str, frames: dict[str, Frame], mark: str | None = None, base: bool = False) -> bool:
        """Write and commit the frames of a batch, in their order; False, without writing, if the batch has a commit.

        A frame given as a function is made from those before it, read back by name.
        """
        if set(frames) != set(self.schemas):
            raise ValueError(f"a batch has the frames {sorted(self.schemas)}, got {sorted(frames)}")
        commits = self.commits()
        if any(c.batch == batch for c in commits):
            return False
        segment = f"{self.path}/segments/{batch}-{uuid.uuid4().hex[:12]}"
        written: dict[str, DataFrame] = {}
        for name, frame in frames.items():
            df = frame if isinstance(frame, DataFrame) else frame(written)
            fields = self.schemas[name].fields
            df.select(*(df[f"`{f.name}`"].cast(f.dataType) for f in fields)).write.parquet(f"{segment}/{name}")
            written[name] = self.spark.read.schema(self.schemas[name]).parquet(f"{segment}/{name}")
        seq = commits[-1].seq + 1 if commits else 0
        row = self.spark.createDataFrame([(seq, batch, segment, base, mark)], COMMIT)
        row.coalesce(1).write.mode("errorifexists").parquet(f"{self.path}/commits/{seq:010d}")
        return True

    def compact(self, frames: dict[str, Frame]) -> None:
        """A base segment with ``frames``, which stand for all rows so far; the mark goes on."""
        commits = self.commits()
        if commits:
            self.append(f"base-{commits[-1].seq}", frames, self.mark(), base=True)
