"""Byte ranges of the text of files, plain or packed, read side by side, and the state of a small automaton at the start of each.

What a range does to the state is learnt for every state it may start in, without knowing the one it does start in.
These outcomes compose, so the states follow from a prefix composition: ranges are combined in blocks of ``FAN``, blocks
in blocks of blocks, and so on, and the states reached are handed down again. No row ever holds more than ``FAN``
ranges, whatever the file's size.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratescope.sources.streams import open_seekable_text, text_length

RANGE_BYTES = 16 * 1024 * 1024
#: Bytes of ranges, small ones together, that a task reads one after another.
TASK_BYTES = 4 * RANGE_BYTES
FAN = 256


def list_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """path, length and modification time of files; their content is not read."""
    return spark.read.format("binaryFile").load(list(paths)).select("path", "length", "modificationTime")


def text_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """path and length of the text of files; what packed files hold is told by their chunks."""
    return list_files(spark, paths).select("path", "length").mapInPandas(_text_lengths, "path string, length bigint")


def _text_lengths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch.assign(length=[text_length(p, n) for p, n in zip(batch["path"], batch["length"].tolist())])


def read_range(path: str, start: int, size: int) -> bytes:
    with open_seekable_text(path) as file:
        file.seek(start)
        return file.read(size)


def ranges_of(files: DataFrame, range_bytes: int) -> DataFrame:
    """path, length, begin and the number, start and size of each range of the bytes from ``begin`` on; an empty rest is one range."""
    first = F.floor(F.col("begin") / range_bytes)
    last = F.greatest(F.floor((F.col("length") - 1) / range_bytes), first)
    each = files.select("path", "length", "begin", first.alias("_first"), F.explode(F.sequence(first, last)).alias("_place"))
    start = F.greatest(F.col("_place") * range_bytes, F.col("begin"))
    return each.select(
        "path", "length", "begin", (F.col("_place") - F.col("_first")).alias("number"), start.alias("start"),
        (F.least((F.col("_place") + 1) * range_bytes, F.col("length")) - start).alias("size"),
    )


def extent(ranges: DataFrame) -> tuple[int, int]:
    """How many tasks the ranges are dealt to, and how many ranges the longest file has.

    Tasks follow the bytes, not the ranges: files and ranges may be small, and then a task each would cost more than reading.
    """
    n, n_bytes, longest = ranges.agg(F.count("*"), F.sum("size"), F.max("number") + 1).first()
    wanted = max(-(-(n_bytes or 0) // TASK_BYTES), 2 * ranges.sparkSession.sparkContext.defaultParallelism)
    return max(min(n, wanted), 1), longest or 1


def dealt(ranges: DataFrame, n_tasks: int) -> DataFrame:
    """The ranges side by side in ``n_tasks`` tasks."""
    return ranges.repartition(n_tasks)


def _follow(so_far: Column, step: Column) -> Column:
    taken = F.get(step, so_far["state"])
    return F.struct(taken["state"].alias("state"), (so_far["n"] + taken["n"]).alias("n"))


def _begin(state: int) -> Column:
    return F.struct(F.lit(state).alias("state"), F.lit(0).cast("bigint").alias("n"))


def with_states(each: DataFrame, n_states: int, first_state: int, longest: int) -> DataFrame:
    """``each`` with the state every range starts in, and the sum ``n`` over the ranges of its file before it.

    ``each`` has path, number and ``after``: for every state to start in, the state the range ends in and what it adds
    to n (a struct that may hold more). ``longest`` is the number of ranges of the longest file.
    """
    own = [c for c in each.columns if c not in ("path", "number")]
    parts = each.groupBy("path", F.floor(F.col("number") / FAN).alias("_block")).agg(
        F.sort_array(F.collect_list(F.struct("number", *own))).alias("_parts")
    )
    steps = F.transform("_parts", lambda p: p["after"])
    if longest <= FAN:
        placed = parts.withColumn("_reached", _begin(first_state))
    else:
        whole = F.array(*[F.aggregate(steps, _begin(s), _follow) for s in range(n_states)])
        blocks = parts.select("path", F.col("_block").alias("number"), whole.alias("after"))
        above = with_states(blocks, n_states, first_state, -(-longest // FAN)).select(
            F.col("path").alias("_path"), F.col("number").alias("_number"), F.struct("state", "n").alias("_reached")
        )
        placed = parts.join(above, (F.col("path") == F.col("_path")) & (F.col("_block") == F.col("_number")))
    told = F.transform(
        "_parts", lambda p, i: F.struct(p.alias("p"), F.aggregate(F.slice(steps, F.lit(1), i), F.col("_reached"), _follow).alias("at"))
    )
    flat = placed.select("path", F.inline(told))
    return flat.select("path", "p.number", *[F.col(f"p.{c}").alias(c) for c in own], "at.state", "at.n")
