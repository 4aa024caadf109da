"""tally: subscription, billing and event metrics as PySpark DataFrame jobs.

Layout
------
``sources``    raw-table readers (parquet fixtures, CSV sheets, JSON dictionaries)
``functions``  column-level helpers (rounding, time, text terms, category match)
``operators``  reusable DataFrame operators (union, sequence index, pivots,
               prefix aggregates, period explode, merges, window replace)
``plans``      the table jobs: bronze, silver, gold, cohorts, derived, text, quality
``sinks``      table writers (full replace, append/fail, window replace at rest)
"""

from tally.session import get_spark, utc_session

__all__ = ["get_spark", "utc_session"]
