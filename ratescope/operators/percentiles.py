"""Exact interpolated percentiles per group that hold when one group has a third of all rows.

Spark's ``percentile`` keeps every distinct value of a group in one buffer. That is the cheapest plan
while groups are small, so it is used for every group proven to have at most ``hot_group_rows`` rows.
Larger groups are ranked across tasks: values are counted per narrow value band, the bands that hold
the wanted ranks are found from the counts and cut finer while they are large, and only those are sorted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratescope.operators.lookups import null_safe
from ratescope.sinks.scratch import write_stage

# Hot keys up to this count are broadcast; the count is taken before the hint is given.
_BROADCAST_KEYS = 100_000
_BANDS_PER_DOUBLING = 1024
_LARGEST_BAND = 1_100.0 * _BANDS_PER_DOUBLING
# Each further step cuts a band 65,536-fold; after three, doubles cannot be told apart.
_SUB_BANDS = 65_536.0
_MAX_STEPS = 4


def hot_groups(df: DataFrame, keys: Sequence[str], limit: int, max_rows: int | None = None) -> DataFrame | None:
    """Keys of groups with more than ``limit`` rows as a written table, or None when there are none.

    ``max_rows`` is a known upper bound on the rows of ``df``. Hash buckets are counted first: a bucket
    within the limit proves the same for all its groups, so keys are counted in full only for the
    buckets above it.
    """
    total = df.count() if max_rows is None else max_rows
    if total <= limit:
        return None
    n_buckets = max(4_096, 4 * (total // limit + 1))
    bucket = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(n_buckets))
    crowded = df.groupBy(bucket.alias("_bucket")).count().filter(F.col("count") > limit).select("_bucket")
    crowded = write_stage(crowded, "crowded")
    n_crowded = crowded.count()
    if n_crowded == 0:
        return None
    suspects = df.withColumn("_bucket", bucket).join(
        F.broadcast(crowded) if n_crowded <= _BROADCAST_KEYS else crowded, "_bucket", "left_semi"
    )
    hot = suspects.groupBy(*keys).count().filter(F.col("count") > limit).select(*keys)
    hot = write_stage(hot, "hot")
    return hot if hot.count() else None


def percentiles_by_group(
    df: DataFrame,
    keys: Sequence[str],
    wanted: Mapping[str, tuple[Column, Sequence[float]]],
    others: Sequence[Column] = (),
    *,
    limit: int,
    max_rows: int | None = None,
) -> DataFrame:
    """One row per group: ``others`` plus, for each name in ``wanted``, the array of its percentiles.

    ``wanted`` maps an output name to (value expression, probabilities). NULL values are ignored and a
    group without values gets NULL.
    """
    builtin = [F.percentile(v, list(ps)).alias(name) for name, (v, ps) in wanted.items()]
    hot = hot_groups(df, keys, limit, max_rows)
    if hot is None:
        return df.groupBy(*keys).agg(*others, *builtin)
    side = F.broadcast(hot) if hot.count() <= _BROADCAST_KEYS else hot
    usual = df.join(side, null_safe(df, side, keys), "left_anti")
    crowded = df.join(side, null_safe(df, side, keys), "left_semi")
    ranked = _ranked_percentiles(crowded, keys, wanted, limit)
    rest = crowded.groupBy(*keys).agg(*others) if others else crowded.select(*keys).distinct()
    extra = [c for c in rest.columns if c not in keys]
    ranked = rest.join(ranked, null_safe(rest, ranked, keys), "left").select(
        *[rest[c] for c in [*keys, *extra]], *[ranked[n] for n in wanted]
    )
    return usual.groupBy(*keys).agg(*others, *builtin).unionByName(ranked)


def _band(value: Column) -> Column:
    """A non-decreasing step function of the value, about 0.07 percent wide; NaN sorts last."""
    size = F.floor(F.log2(F.lit(1.0) + F.least(F.abs(value), F.lit(1e300))) * _BANDS_PER_DOUBLING).cast("double")
    return F.when(F.isnan(value), F.lit(_LARGEST_BAND)).otherwise(F.signum(value) * size)


def _sub_band(value: Column, low: Column, high: Column) -> Column:
    """A non-decreasing split of the values from ``low`` to ``high`` into equal steps."""
    share = F.nanvl((value - low) / (high - low), F.lit(0.5))
    return (
        F.when(value == low, F.lit(0.0))
        .when(value == high, F.lit(_SUB_BANDS))
        .otherwise(F.floor(share * F.lit(_SUB_BANDS)).cast("double"))
    )


def _ranked_percentiles(
    df: DataFrame, keys: Sequence[str], wanted: Mapping[str, tuple[Column, Sequence[float]]], limit: int
) -> DataFrame:
    """Percentiles by distributed rank selection. No task ever holds a whole group.

    1. count rows per (group, value): combined before the shuffle, and spread by value;
    2. count rows per (group, band): a bounded number of bands per group;
    3. keep the bands that hold the two ranks around each wanted position;
    4. while a kept band has more than ``limit`` distinct values, cut it into finer bands and go to 2;
    5. rank the values inside the kept bands.
    """
    measures = F.array(*[
        F.struct(F.lit(i).alias("_measure"), v.cast("double").alias("_value"))
        for i, (v, _) in enumerate(wanted.values())
    ])
    group = [*keys, "_measure"]
    cell = [*group, "_cell"]
    values = (
        df.select(*keys, F.explode(measures).alias("_m"))
        .select(*keys, "_m._measure", "_m._value")
        .filter(F.col("_value").isNotNull())
        .withColumn("_band", _band(F.col("_value")))
        .groupBy(*group, "_band", "_value")
        .agg(F.count("*").alias("_n"))
        .withColumns({
            "_cell": F.lit(""), "_base": F.lit(0).cast("bigint"), "_total": F.lit(None).cast("bigint"),
        })
    )
    probabilities = _pick(
        F.col("_measure"), [F.array(*[F.lit(float(p)) for p in ps]) for _, ps in wanted.values()]
    )
    for step in range(_MAX_STEPS):
        values = write_stage(values, "counted-values")
        chosen = write_stage(_bands_with_ranks(values, cell, probabilities), "chosen-bands")
        members = _members(values, chosen, [*cell, "_band"])
        if step == _MAX_STEPS - 1 or chosen.filter(F.col("_n_values") > limit).limit(1).count() == 0:
            break
        values = members.withColumn("_band", _sub_band(F.col("_value"), F.col("_low"), F.col("_high")))

    in_cell = Window.partitionBy(*cell).orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = members.withColumn("_last", F.col("_base") + F.sum("_n").over(in_cell)).withColumn(
        "_first", F.col("_last") - F.col("_n")
    )
    columns = []
    for i, (name, (_, ps)) in enumerate(wanted.items()):
        total = F.max(F.when(F.col("_measure") == i, F.col("_total")))
        points = []
        for p in ps:
            at = F.lit(float(p)) * (F.col("_total") - 1)
            low, high = _value_at(i, F.floor(at)), _value_at(i, F.ceil(at))
            position = F.lit(float(p)) * (total - 1)
            points.append(
                F.when(low == high, low).otherwise(
                    (F.ceil(position) - position) * low + (position - F.floor(position)) * high
                )
            )
        columns.append(F.when(total.isNotNull(), F.array(*points)).alias(name))
    return ranked.groupBy(*keys).agg(*columns)


def _bands_with_ranks(values: DataFrame, cell: Sequence[str], probabilities: Column) -> DataFrame:
    """The bands of each cell that hold a wanted rank, with the rows before them and their value range."""
    in_order = Window.partitionBy(*cell).orderBy("_band").rowsBetween(Window.unboundedPreceding, 0)
    bands = (
        values.groupBy(*cell, "_band")
        .agg(
            F.sum("_n").alias("_n"), F.count("*").alias("_n_values"), F.min("_value").alias("_low"),
            F.max("_value").alias("_high"), F.max("_base").alias("_base"), F.max("_total").alias("_total"),
        )
        .withColumn("_upto", F.col("_base") + F.sum("_n").over(in_order))
        .withColumn("_before", F.col("_upto") - F.col("_n"))
        .withColumn("_total", F.coalesce("_total", F.sum("_n").over(Window.partitionBy(*cell))))
    )

    def within(rank: Column) -> Column:
        return (rank >= F.col("_before")) & (rank < F.col("_upto"))

    positions = F.transform(probabilities, lambda p: p * (F.col("_total") - 1))
    holds = F.exists(positions, lambda at: within(F.floor(at)) | within(F.ceil(at)))
    return bands.filter(holds).select(*cell, "_band", "_before", "_total", "_low", "_high", "_n_values")


def _members(values: DataFrame, chosen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The counted values of the chosen bands; each band becomes a cell of its own."""
    side = F.broadcast(chosen) if chosen.count() <= _BROADCAST_KEYS else chosen
    outer = [k for k in keys if k not in ("_cell", "_band")]
    return values.join(side, null_safe(values, side, keys)).select(
        *[values[k] for k in outer],
        F.concat(values["_cell"], F.lit("/"), values["_band"].cast("string")).alias("_cell"),
        values["_value"], values["_n"], side["_before"].alias("_base"), side["_total"], side["_low"], side["_high"],
    )


def _value_at(measure: int, rank: Column) -> Column:
    here = (F.col("_measure") == measure) & (rank >= F.col("_first")) & (rank < F.col("_last"))
    return F.max(F.when(here, F.col("_value")))


def _pick(index: Column, choices: Sequence[Column]) -> Column:
    numbered = list(enumerate(choices))
    return reduce(lambda rest, ic: F.when(index == ic[0], ic[1]).otherwise(rest), numbered[:-1], choices[-1])
