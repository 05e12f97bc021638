"""crosslink — cross-source review analytics on Spark.

Loads a large review (fact) table plus small dimension tables, cleans and
deterministically de-duplicates them, links items to an external knowledge
base in two stages (exact id, then normalized title), aggregates to one row
per item and reports data quality — all as DataFrame plans.

Sub-packages:

* ``functions`` — Column expressions (casts, flags, tags, title keys).
* ``sources``   — explicit-schema readers, source contract, payload parsing,
                  stand-in sources derived from the test tables.
* ``operators`` — DataFrame → DataFrame building blocks (clean, enrich,
                  resolve, aggregate, quality).
* ``sinks``     — Parquet / CSV / JSON-lines writers.
* ``plans``     — the end-to-end job and the query registry.
* ``streaming`` — intentionally empty: the workload is batch only.
"""

from crosslink.config import Options
from crosslink.sources.readers import Sources

__all__ = ["Options", "Sources"]
