"""Job options (the tunables of the pipeline, with the reference defaults)."""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values that must equal the reference's defaults.
DEFAULT_MIN_EXPECTED_RECORDS = 100
DEFAULT_MAX_NULL_RATE = 0.05
DEFAULT_CRITICAL_COLUMNS = ("app_id", "title", "is_recommended")
DEFAULT_MAX_GAMES = 15000
DEFAULT_PREVIEW_ROWS = 100
DEFAULT_SAMPLE_ROWS = 5

# Means of integer columns are exact (sum / count). Means of floating-point
# columns (e.g. of per-game rates) depend on summation order, which varies with
# partitioning; they are reported to this many decimals.
MEAN_DECIMALS = 9


@dataclass(frozen=True)
class Options:
    """Behavioral switches and thresholds.

    ``fallback``
        ``"field"`` (default, like the reference): every knowledge-base field
        is ``coalesce(id_stage, title_stage)`` independently, so one output row
        may mix two entities. ``"entity"``: the title stage is used only for
        rows the id stage did not match.
    ``sample_rows`` / ``rendered_sample_rows``
        Rows of the report's sample table, and how many of them the Markdown
        rendering shows (it says so when it shows fewer).
    ``empty_title_matches``
        When False (default) a title that normalizes to ``""`` is treated as
        no key; True restores the reference, where all such titles match.
    """

    fallback: str = "field"
    empty_title_matches: bool = False
    min_expected_records: int = DEFAULT_MIN_EXPECTED_RECORDS
    max_null_rate: float = DEFAULT_MAX_NULL_RATE
    critical_columns: tuple[str, ...] = DEFAULT_CRITICAL_COLUMNS
    summary_columns: tuple[str, ...] = field(
        default=("steam_recommend_rate", "num_reviews", "num_positive_reviews")
    )
    sample_rows: int = DEFAULT_SAMPLE_ROWS
    rendered_sample_rows: int = DEFAULT_PREVIEW_ROWS
    preview_rows: int = DEFAULT_PREVIEW_ROWS

    def __post_init__(self) -> None:
        if self.fallback not in ("field", "entity"):
            raise ValueError(f"fallback must be 'field' or 'entity', got {self.fallback!r}")
