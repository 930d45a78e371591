"""Components of a growing graph that is only a table of links.

Each node has a root. A round of new links is mapped to roots; every root that has a smaller neighbour is hung on its
smallest one, and pointers are shortened by joining the pointer table with itself. A root with very many neighbours is no
single task's work: minima are combined before the shuffle, and joins are plain ones on a table with unique keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratescope.llm.common import write_stage


def _flattened(hung: DataFrame) -> DataFrame:
    """hi, lo with lo at the end of every chain; ``hung`` has one row per hi, and lo < hi, so there are no cycles.

    Each round doubles the length of the steps, so there are as many as the logarithm of the longest chain.
    """
    while True:
        further = hung.select(F.col("hi").alias("_hi"), F.col("lo").alias("_lo"))
        hung = write_stage(
            hung.join(further, F.col("lo") == F.col("_hi"), "left").select(
                "hi", F.coalesce("_lo", "lo").alias("lo"), F.col("_lo").isNotNull().alias("moved")
            ),
            "component-pointers",
        )
        if hung.where("moved").isEmpty():
            return hung.select("hi", "lo")


def joined_roots(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """node, root after ``links`` (a, b); nodes that are their own root have no row. ``roots`` is what was known before."""
    open_links = links.select("a", "b")
    while True:
        mapped = open_links
        if roots is not None:
            left = roots.select(F.col("node").alias("_na"), F.col("root").alias("_ra"))
            right = roots.select(F.col("node").alias("_nb"), F.col("root").alias("_rb"))
            mapped = (
                open_links.join(left, F.col("a") == F.col("_na"), "left").join(right, F.col("b") == F.col("_nb"), "left")
                .select(F.coalesce("_ra", "a").alias("a"), F.coalesce("_rb", "b").alias("b"))
            )
        mapped = write_stage(
            mapped.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
            "component-links",
        )
        if mapped.isEmpty():
            return roots if roots is not None else mapped.toDF("node", "root")
        hung = _flattened(mapped.groupBy(F.col("a").alias("hi")).agg(F.min("b").alias("lo")))
        if roots is None:
            roots = hung.toDF("node", "root")
        else:
            moved = roots.join(hung, F.col("root") == F.col("hi"), "left").select("node", F.coalesce("lo", "root").alias("root"))
            roots = write_stage(moved.unionByName(hung.toDF("node", "root")), "component-roots")
        open_links = mapped


def components(links: DataFrame) -> DataFrame:
    """node, root (smallest node reachable) for every node of ``links`` that is not its own root."""
    return joined_roots(None, links)
