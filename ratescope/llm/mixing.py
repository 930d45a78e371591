"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source should be taken as often as the source's target asks, a fractional number. The whole part is
taken outright. The fractions of two documents meet: a random transfer of words between them, fair to both, makes one of
them whole and leaves the other to meet the next. So the words of a source stay at its target up to the one document
that is left, and are not off by the noise of independent draws.

Documents meet in blocks of about ``FAN_IN`` inside one task's row; each block leaves one document over, and the
leftovers meet in the next level of the tree. Large documents meet first, so what is left over tends to be small. A source with a third of all rows is thus many small blocks. Draws are
hashes of the document and the level, so reruns agree.

Null and empty texts have size 0 and take nothing. A null source is a source of its own, ordered last. Rows with equal
doc_id, source and size share one decision and weigh as many words as they hold together. A table without rows gives no
rows; further columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratescope.llm.common import words_of, write_stage

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST_COPIES = 2.0
FAN_IN = 64


def source_targets(sizes: DataFrame, share: float = SHARE, most: float = MOST_COPIES, weights=WEIGHTS) -> DataFrame:
    """source, source_size, n, target.

    Sharing the excess of full sources again and again ends where every source gets the smaller of its cap and one
    common rate times its weight. Ordered by cap per weight, the full sources come first, so sums over that order give
    the rate directly. The table has one row per source.
    """
    totals = sizes.groupBy("source").agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count("*").alias("n")
    )
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*map(F.lit, weights)), place + 1)
    ranked = totals.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    up_to = by_ratio.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ranked = (
        ranked.withColumn("to_share", share * F.sum("source_size").over(everything) - F.sum("cap").over(up_to) + F.col("cap"))
        .withColumn("rate", F.col("to_share") / F.sum("weight").over(onward))
        .withColumn("full", F.col("rate") * F.col("weight") >= F.col("cap"))
    )
    ranked = ranked.withColumn("place", F.row_number().over(by_ratio))
    common = F.min(F.when(~F.col("full"), F.struct("place", "rate"))).over(everything)["rate"]
    return ranked.select(
        "source", "source_size", "n",
        F.when(F.col("full"), F.col("cap")).otherwise(common * F.col("weight")).cast("double").alias("target"),
    )


def _draw(*parts: Column) -> Column:
    """A number in [0, 1) fixed by its parts."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def _meet(people: Column) -> Column:
    """Let the entries (key, whole, mass, held, draw) of an array meet one after another.

    ``held`` of ``mass`` words are taken so far; an entry is settled when held is 0 or mass. The result has the settled
    entries with their extra copy, and the one that is left.
    """
    settled = lambda x, extra: F.struct(x["key"].alias("key"), extra.cast("int").alias("extra"))
    holding = lambda x, held: F.struct(
        x["key"].alias("key"), x["mass"].alias("mass"), held.alias("held")
    )

    def step(state: Column, nxt: Column) -> Column:
        left = state["left"]
        to_left = F.least(left["mass"] - left["held"], nxt["held"])
        to_next = F.least(nxt["mass"] - nxt["held"], left["held"])
        give = nxt["draw"] * (to_left + to_next) < to_next
        # After a gift to the left one: it is full, or the next one is empty. And the other way round.
        left_full = left["mass"] - left["held"] <= nxt["held"]
        next_full = nxt["mass"] - nxt["held"] <= left["held"]
        done = (
            F.when(give & left_full, settled(left, F.lit(1)))
            .when(give, settled(nxt, F.lit(0)))
            .when(next_full, settled(nxt, F.lit(1)))
            .otherwise(settled(left, F.lit(0)))
        )
        stays = (
            F.when(give & left_full, holding(nxt, nxt["held"] - to_left))
            .when(give, holding(left, left["held"] + to_left))
            .when(next_full, holding(left, left["held"] - to_next))
            .otherwise(holding(nxt, nxt["held"] + to_next))
        )
        return F.struct(F.concat(state["done"], F.array(done)).alias("done"), stays.alias("left"))

    first = F.element_at(people, 1)
    start = F.struct(
        F.slice(F.array(settled(first, F.lit(0))), 1, 0).alias("done"), holding(first, first["held"]).alias("left")
    )
    return F.aggregate(F.slice(people, 2, F.greatest(F.size(people) - 1, F.lit(0))), start, step)


def decide(units: DataFrame, seed: int = 7, fan_in: int = FAN_IN) -> DataFrame:
    """key, extra for every unit with a fraction; ``units`` has source, key, mass, fraction, n (units of the source)."""
    spark = units.sparkSession
    blocks = F.ceil(F.col("n") / fan_in).cast("long")
    people = units.select(
        "source", blocks.alias("blocks"),
        F.pmod(F.xxhash64(F.lit(seed), F.col("key")), blocks).alias("block"),
        F.struct("key", "mass", (F.col("mass") * F.col("fraction")).alias("held")).alias("who"),
    )
    most = units.agg(F.max("n")).first()[0] or 0
    level, width, found = 0, most, []
    while True:
        who = F.struct(
            F.col("who.mass").alias("mass"), F.col("who.key").alias("key"), F.col("who.held").alias("held"),
            _draw(F.lit(seed + 1), F.lit(level), F.col("who.key")).alias("draw"),
        )
        gathered = people.groupBy("source", "blocks", "block").agg(F.sort_array(F.collect_list(who), asc=False).alias("people"))
        met = write_stage(
            gathered.select("source", "blocks", "block", _meet(F.col("people")).alias("met")), f"mixing-level-{level}"
        )
        found.append(met.select(F.inline("met.done")))
        width = -(-width // fan_in)
        if width <= 1:
            last = F.col("met.left")
            extra = (_draw(F.lit(seed + 2), last["key"]) * last["mass"] < last["held"]).cast("int")
            found.append(met.select(last["key"].alias("key"), extra.alias("extra")))
            break
        after = F.ceil(F.col("blocks") / fan_in).cast("long")
        people = met.select(
            "source", after.alias("blocks"), F.pmod(F.col("block"), after).alias("block"), F.col("met.left").alias("who")
        )
        level += 1
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result


def copies(docs: DataFrame, share: float = SHARE, most: float = MOST_COPIES, weights=WEIGHTS, seed: int = 7) -> DataFrame:
    """doc_id, source, size, rows (equal rows of the table), source_size, target, copies."""
    sizes = write_stage(
        docs.select("doc_id", "source", F.size(words_of(F.col("text"))).cast("long").alias("size"))
        .groupBy("doc_id", "source", "size").agg(F.count("*").alias("rows")),
        "mixing-sizes",
    )
    targets = write_stage(source_targets(sizes, share, most, weights).withColumnRenamed("source", "_target_source"), "mixing-targets")
    rate = F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0))
    rated = (
        sizes.join(targets, F.col("source").eqNullSafe(F.col("_target_source"))).drop("_target_source")
        .withColumn("rate", F.least(rate, F.lit(float(most))))
        .withColumn("whole", F.floor("rate").cast("int"))
        .withColumn("fraction", F.col("rate") - F.col("whole"))
        .withColumn("key", F.struct("doc_id", "source", "size"))
    )
    units = rated.where((F.col("fraction") > 0) & (F.col("size") > 0)).select(
        "source", "key", (F.col("size") * F.col("rows")).cast("double").alias("mass"), "fraction", "n"
    )
    extra = decide(units, seed).select(F.col("key").alias("_mx_key"), "extra")
    return rated.join(extra, F.col("key").eqNullSafe(F.col("_mx_key")), "left").select(
        "doc_id", "source", "size", "rows", "source_size", "target",
        (F.col("whole") + F.coalesce("extra", F.lit(0))).alias("copies"),
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` with their number of copies in ``copies``; rows that the mix leaves out are gone."""
    decided = copies(docs, **options).where(F.col("copies") > 0).select(
        F.col("doc_id").alias("_mx_doc"), F.col("source").alias("_mx_source"), F.col("size").alias("_mx_size"), "copies"
    )
    size = F.size(words_of(F.col("text"))).cast("long")
    here = docs.drop("copies").withColumn("_mx_own", size)
    joined = here.join(
        decided,
        F.col("doc_id").eqNullSafe(F.col("_mx_doc"))
        & F.col("source").eqNullSafe(F.col("_mx_source"))
        & (F.col("_mx_own") == F.col("_mx_size")),
    )
    return joined.drop("_mx_doc", "_mx_source", "_mx_size", "_mx_own")
