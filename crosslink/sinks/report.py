"""Markdown rendering of the data-quality report.

The report is a small, bounded table: one row per source, per critical column
and per summary metric, plus the few sample rows. It is collected, formatted
as text and written back through Spark's text writer, so the file lands on
the job's (shared) output filesystem like every other output.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from crosslink.config import DEFAULT_PREVIEW_ROWS

# Section order and headings of the rendered report.
SECTIONS = (
    ("record_counts", "Record counts"),
    ("rejected", "Cells, rows and lines that did not parse"),
    ("raw_null_rates", "Null rates of critical columns, raw sources"),
    ("null_rates", "Null rates of critical columns, processed"),
    ("summary_stats", "Summary statistics, per game"),
    ("match_rate", "Knowledge-base match rate"),
    ("threshold_violations", "Threshold violations (warnings)"),
)



def _fmt(v) -> str:
    if v is None:
        return ""
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return str(int(v)) if v.is_integer() and abs(v) < 1e15 else f"{v:.4f}"
    return str(v).replace("|", "\\|").replace("\n", " ")


def _table(header: Sequence[str], rows: Iterable[Sequence]) -> list[str]:
    out = ["| " + " | ".join(header) + " |", "|" + "---|" * len(header)]
    out += ["| " + " | ".join(_fmt(v) for v in r) + " |" for r in rows]
    return out


def render_report_markdown(
    report_rows: Sequence[Sequence],
    sample_columns: Sequence[str] = (),
    sample_rows: Sequence[Sequence] = (),
    runtime_seconds: float | None = None,
    generated: datetime | None = None,
) -> str:
    """Markdown text of ``(section, subject, metric, value)`` report rows."""
    when = (generated or datetime.now(timezone.utc)).strftime("%Y-%m-%d %H:%M:%S UTC")
    lines = ["# Data quality report", "", f"_Generated: {when}_", ""]
    by_section: dict[str, list[Sequence]] = {}
    for r in sorted(report_rows, key=lambda r: (str(r[1]), str(r[2]))):
        by_section.setdefault(r[0], []).append(r[1:])  # stable text, whatever the partitioning
    known = [s for s, _ in SECTIONS]
    order = list(SECTIONS) + [(s, s) for s in by_section if s not in known]
    n = 0
    for section, heading in order:
        rows = by_section.get(section)
        if section == "threshold_violations":
            n += 1
            lines += [f"## {n}. {heading}", ""]
            lines += _table(("check", "metric", "observed"), rows) if rows else ["None."]
            lines.append("")
        elif section == "match_rate" and not rows:
            n += 1
            lines += [f"## {n}. {heading}", "", "No knowledge base was joined.", ""]
        elif rows:
            n += 1
            lines += [f"## {n}. {heading}", ""] + _table(("subject", "metric", "value"), rows) + [""]
    if sample_columns:
        n += 1
        lines += [f"## {n}. Sample rows", ""] + _table(sample_columns, sample_rows) + [""]
    if runtime_seconds is not None:
        n += 1
        lines += [f"## {n}. Runtime", "", f"Job runtime (load → save, validation excluded): "
                  f"{runtime_seconds:.1f} s", ""]
    return "\n".join(lines)


def write_report_markdown(
    spark: SparkSession,
    report: DataFrame,
    path: str,
    samples: DataFrame | None = None,
    runtime_seconds: float | None = None,
    rendered_sample_rows: int = DEFAULT_PREVIEW_ROWS,
) -> str:
    """Render ``report`` (and ``samples``) as Markdown; one text file under ``path``.

    The report has a row per source, critical column and metric. Of the samples
    the first ``rendered_sample_rows`` are shown; the sample table has them all.
    """
    rows = [tuple(r) for r in report.collect()]
    cols: list[str] = []
    srows: list[tuple] = []
    if samples is not None:
        cols = samples.columns
        srows = [tuple(r) for r in samples.limit(rendered_sample_rows).collect()]
    text = render_report_markdown(rows, cols, srows, runtime_seconds)
    if samples is not None and len(srows) == rendered_sample_rows:
        text += f"\n_At most {rendered_sample_rows} sample rows are shown._\n"
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path
