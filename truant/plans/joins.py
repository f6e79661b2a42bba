"""Join helpers with an explicit size check before broadcasting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A broadcast side is shipped to every executor and held in memory there:
# keep it far below executor memory.  One row per category of a dimension
# (neighbourhood, class, bucket) is the intended use.
MAX_BROADCAST_ROWS = 2_000_000


def broadcast_if_small(small: DataFrame, n_rows: int | None = None,
                       max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only when the side is known to be small.

    ``n_rows`` is the row count when the caller already knows it (fitted
    state); otherwise it is counted here (``small`` is meant to be an
    aggregate, so the count is cheap).  Above the bound no hint is given and
    the planner falls back to a shuffle join (AQE may still convert it at
    runtime from measured sizes).
    """
    n = small.count() if n_rows is None else n_rows
    return F.broadcast(small) if n <= max_rows else small
