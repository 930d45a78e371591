"""Distinct rows of wide tables in tasks of bounded size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratescope.operators.percentiles import hot_groups
from ratescope.sinks.scratch import write_portions

#: Rows that one task compares at most, but for chance and for rows repeated more often than this.
ROWS_PER_TASK = 250_000
# Every portion reads the table again.
_MOST_PORTIONS = 8


def distinct_rows(df: DataFrame, rows_per_task: int = ROWS_PER_TASK, rows_at_once: int | None = None) -> DataFrame:
    """``df.distinct()`` of a stored table.

    Spark's distinct holds whole rows in a table per task, before its shuffle as well as behind it. Tasks grow with the input,
    so on large inputs both outgrow the memory and are spilled. Here rows are shuffled as they are, into as many tasks as keep
    that table small, and compared once they are there. Rows repeated so often that they would crowd a task are left to
    Spark's distinct, which combines them before its shuffle: there are few such rows.

    Whole rows take several times as much disk shuffled as stored. With ``rows_at_once`` they are compared in portions of
    about that many, by a hash of the row, each shuffled and stored before the next one.
    """
    n_rows = df.count()
    if n_rows <= rows_per_task:
        return df.distinct()
    digest = F.xxhash64(*[df[c] for c in df.columns])
    hot = hot_groups(df.select(digest.alias("_digest")), ["_digest"], rows_per_task, n_rows)
    usual, repeated = df, None
    if hot is not None:
        # At most one in rows_per_task of all rows is the first of such repeats.
        usual = df.join(F.broadcast(hot), digest == hot["_digest"], "left_anti")
        repeated = df.join(F.broadcast(hot), digest == hot["_digest"], "left_semi").distinct()
    n = min(-(-n_rows // rows_at_once), _MOST_PORTIONS) if rows_at_once else 1
    place = F.pmod(F.xxhash64(*df.columns), F.lit(n))
    portions = [usual.where(place == k) if n > 1 else usual for k in range(n)]
    portions = [p.repartition(-(-n_rows // (n * rows_per_task)), *df.columns).distinct() for p in portions]
    usual = portions[0] if n == 1 else write_portions(portions, "distinct-rows")
    return usual if repeated is None else usual.unionByName(repeated)
