"""Join helpers: broadcast only behind a size check.

``small_dim`` counts at most ``max_rows + 1`` rows of a dimension (a cheap,
bounded action) and adds a broadcast hint only when the dimension is within
the bound.  Beyond it the join is left to Catalyst/AQE, which picks a
sort-merge join or converts to broadcast from runtime statistics.  Fixed
tables built in code pass ``known_rows`` and skip the count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def small_dim(df: DataFrame, max_rows: int, known_rows: int | None = None) -> DataFrame:
    n = known_rows if known_rows is not None else df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
