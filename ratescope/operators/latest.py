"""Latest row per key as a combining aggregate: no window, no sort, no whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order_by`` values per key. NULLs come last.

    Remaining columns break ties, so the result does not depend on row order.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    row = F.struct(*[F.col(c) for c in [*order_by, *rest]])
    best = df.groupBy(*keys).agg(F.max(row).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])
