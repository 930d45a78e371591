"""Hard negatives: per anchor and positive, the best rows of other labels within a window below the positive's score.

Scores are integer inner products. Anchors are put into blocks of similar ones, and a block's anchors into a minimum
spanning tree by Euclidean distance. For a row c, score(child, c) = score(parent, c) + (child - parent).c lies within
edge length times norm of c of the parent's score, or of the parent's own bounds where that was not scored. Only rows
whose bounds overlap the child's window are scored exactly: for positives the window is what reaches the anchor's
present fifth place, for negatives what the positives' windows still take.

Anchors grow with the rows, so they go through in portions of at most some ``PORTION_BYTES``: a portion is broadcast and
all rows stream past it twice, once for the positives and once for the negatives. A task keeps the best few per anchor
and window; those of all tasks are merged by Spark. No pairs are emitted beyond these, no row is left out, and a label
that holds a third of all rows is no group anywhere.

Rows with a null label, a null vector or any null or non-finite component take no part. Components are held within
+-2^24 after scaling; components that a vector lacks count as zero. Each row is a candidate of its own, repeated rows
repeatedly; repeated anchors are mined one by one. An anchor's positives are rows with another id. Equal scores go by
smaller id, a null id last (the largest long stands for it inside tasks). Anchors without positives, and positives
without negatives in their window, give no rows. Further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratescope.llm.common import scratch_path, write_stage
from ratescope.llm.vectors import exact_products, is_whole, padded, quantised

BLOCK = 512
BLOCK_BYTES = 1 << 20
PORTION_BYTES = 16 << 20
_CHUNK = 4_096
_NO_ID = np.iinfo(np.int64).max
_LOWEST = np.iinfo(np.int64).min
#: Share of a bound by which doubles may be off, and what whole numbers lose beyond.
_MARGIN = 1e-9

_BLOCKS = "block bigint, ids binary, labels binary, vectors binary, width int, parents binary, edges binary, levels binary"
_FOUND = "block bigint, place int, nth int, score bigint, id bigint"


@dataclass
class Tree:
    """A block of anchors in the order of the spanning tree's levels; the root is its own parent."""

    block: int
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    parents: np.ndarray
    edges: np.ndarray
    levels: np.ndarray  # where each level ends

    @classmethod
    def packed(cls, row) -> "Tree":
        vectors = np.frombuffer(row["vectors"], np.int32).reshape(-1, row["width"])
        read = {c: np.frombuffer(row[c], t) for c, t in (("ids", np.int64), ("labels", np.int64), ("parents", np.int32), ("edges", np.float64), ("levels", np.int32))}
        return cls(row["block"], vectors=vectors, **read)


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order by level, parents as places in that order, edge lengths, ends of the levels. Prim's algorithm."""
    x = vectors.astype(np.float64)
    n = len(x)
    nearest, parent = np.full(n, np.inf), np.zeros(n, np.int64)
    depth, edge = np.zeros(n, np.int64), np.zeros(n)
    left = np.ones(n, dtype=bool)
    at = 0
    for _ in range(n):
        left[at] = False
        away = x - x[at]
        squared = np.einsum("ij,ij->i", away, away)
        closer = left & (squared < nearest)
        nearest[closer], parent[closer] = squared[closer], at
        if not left.any():
            break
        at = int(np.where(left, nearest, np.inf).argmin())
        depth[at], edge[at] = depth[parent[at]] + 1, np.sqrt(nearest[at])
    order = np.argsort(depth, kind="stable")
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    return order, place[parent[order]].astype(np.int32), edge[order], np.cumsum(np.bincount(depth)).astype(np.int32)


def _similarity_code(q: Column, planes: int = 16) -> Column:
    """Signs of a vector's products with fixed +-1 vectors: similar vectors have similar codes, so a sort brings them together."""
    numbered = F.transform(q, lambda x, i: F.struct(x.alias("x"), i.alias("i")))

    def side(plane: int) -> Column:
        sign = lambda i: F.when(F.xxhash64(i, F.lit(plane)) % 2 == 0, 1).otherwise(-1)
        total = F.aggregate(numbered, F.lit(0).cast("bigint"), lambda s, e: s + e["x"] * sign(e["i"]))
        return F.when(total >= 0, F.lit("1")).otherwise(F.lit("0"))

    return F.concat(*[side(p) for p in range(planes)])


def _in_blocks(block: int, block_bytes: int):
    """Sorted anchors of a partition, cut into blocks with their trees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        longest = 0

        def tree() -> pa.RecordBatch:
            width = max(1, *(len(q) for _, _, q in held))
            x = np.zeros((len(held), width), np.int32)
            for i, (_, _, q) in enumerate(held):
                x[i, :len(q)] = q
            order, parents, edges, levels = spanning_tree(x)
            ids, labels = np.array([h[0] for h in held], np.int64), np.array([h[1] for h in held], np.int64)
            row = (number, ids[order].tobytes(), labels[order].tobytes(), x[order].tobytes(), width, parents.tobytes(), edges.tobytes(), levels.tobytes())
            names = [c.split()[0] for c in _BLOCKS.split(", ")]
            types = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)

        for batch in batches:
            for item in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                longest = max(longest, len(item[2]))
                if held and (len(held) >= block or (len(held) + 1) * longest * 4 > block_bytes):
                    yield tree()
                    held, number, longest = [], number + 1, len(item[2])
                held.append(item)
        if held:
            yield tree()

    return run


class Best:
    """The best few (score, id) per anchor and window of a block, in order; ``least`` is what a newcomer must reach."""

    def __init__(self, shape: tuple[int, ...], keep: int):
        self.scores = np.full((*shape, keep), _LOWEST)
        self.ids = np.full((*shape, keep), _NO_ID)
        self.used = np.zeros(shape, np.int64)

    def least(self) -> np.ndarray:
        return self.scores[..., -1]

    def add(self, at, scores: np.ndarray, ids: np.ndarray) -> None:
        keep, n = self.scores.shape[-1], self.used[at]
        if len(scores) > keep:
            worst = np.partition(scores, len(scores) - keep)[len(scores) - keep]
            enough = scores >= worst
            scores, ids = scores[enough], ids[enough]
        s, i = np.concatenate([self.scores[at][:n], scores]), np.concatenate([self.ids[at][:n], ids])
        first = np.lexsort((i, -s))[:keep]
        self.scores[at][:len(first)], self.ids[at][:len(first)], self.used[at] = s[first], i[first], len(first)


def _scored(tree: Tree, rows: np.ndarray, norms: np.ndarray, wanted) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Anchor by anchor, the rows whose bounds overlap its window, and their exact scores.

    ``wanted(places, low, high)`` tells for some anchors and all rows which bounds overlap.
    """
    width = tree.vectors.shape[1]
    low, high = np.empty((len(tree.ids), len(rows))), np.empty((len(tree.ids), len(rows)))
    begin = 0
    for end in tree.levels.tolist():
        places = np.arange(begin, end)
        if begin == 0:
            low[:end], high[:end] = -np.inf, np.inf
        else:
            reach = np.outer(tree.edges[places], norms)
            reach += _MARGIN * (reach + np.abs(low[tree.parents[places]]).clip(max=1e18)) + 1
            low[places], high[places] = low[tree.parents[places]] - reach, high[tree.parents[places]] + reach
        need = wanted(places, low[places], high[places])
        if begin == 0:
            need[:] = True  # the root is scored for all rows, so that there are bounds to start from
        columns = np.flatnonzero(need.any(axis=0))
        if len(columns):
            scores = exact_products(tree.vectors[places], rows[columns, :width])
            low[np.ix_(places, columns)] = high[np.ix_(places, columns)] = scores
            for i, place in enumerate(places.tolist()):
                hit = need[i, columns]
                if hit.any():
                    yield place, columns[hit], scores[i][hit]
        begin = end


def _chunks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """ids, labels, vectors and norms of some thousand rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, _CHUNK):
            part = batch.slice(at, _CHUNK)
            x = padded(part.column(2), width)
            norms = np.sqrt(np.einsum("ij,ij->i", x, x, dtype=np.float64)) * (1 + _MARGIN)
            yield part.column(0).to_numpy(zero_copy_only=False), part.column(1).to_numpy(zero_copy_only=False), x, norms


def _told(trees: list[Tree], best: list[Best]) -> Iterator[pa.RecordBatch]:
    for tree, b in zip(trees, best):
        used = np.arange(b.scores.shape[-1]) < b.used[..., None]
        at = np.nonzero(used)
        nth = at[1] if used.ndim == 3 else np.zeros(len(at[0]), np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(at[0]), tree.block)), pa.array(at[0], pa.int32()), pa.array(nth, pa.int32()), pa.array(b.scores[used]), pa.array(b.ids[used])],
            [c.split()[0] for c in _FOUND.split(", ")],
        )


def _positives(shared, keep: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: list[Tree] = shared.value
        best = [Best((len(t.ids),), keep) for t in trees]
        for ids, labels, x, norms in _chunks(batches, max(t.vectors.shape[1] for t in trees)):
            for tree, held in zip(trees, best):
                mine = np.flatnonzero(np.isin(labels, tree.labels))
                if not len(mine):
                    continue
                own, own_ids = labels[mine], ids[mine]

                def wanted(places, low, high):
                    full = held.used[places] == keep
                    least = np.where(full, held.least()[places].astype(np.float64) - 1, -np.inf)
                    same = (tree.labels[places][:, None] == own) & (tree.ids[places][:, None] != own_ids)
                    return same & (high >= least[:, None])

                for place, rows, scores in _scored(tree, x[mine], norms[mine], wanted):
                    good = (own[rows] == tree.labels[place]) & (own_ids[rows] != tree.ids[place])
                    if held.used[place] == keep:
                        good &= scores >= held.least()[place]
                    if good.any():
                        held.add(place, scores[good], own_ids[rows[good]])
        yield from _told(trees, best)

    return run


def _negatives(shared, windows, keep: int):
    """``windows``: per block, lowest and highest score by anchor and positive; an empty window has lowest > highest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: list[Tree] = shared.value
        spans: list[tuple[np.ndarray, np.ndarray]] = windows.value
        best = [Best(lowest.shape, keep) for lowest, _ in spans]
        for ids, labels, x, norms in _chunks(batches, max(t.vectors.shape[1] for t in trees)):
            for tree, held, (lowest, highest) in zip(trees, best, spans):

                def still(places):
                    """What each window still takes."""
                    return np.where(held.used[places] == keep, np.maximum(held.least()[places], lowest[places]), lowest[places])

                def wanted(places, low, high):
                    from_, to = still(places), highest[places]
                    open_ = from_ <= to
                    from_ = np.where(open_, from_, np.iinfo(np.int64).max).min(axis=1).astype(np.float64) - 1
                    to = np.where(open_, to, _LOWEST).max(axis=1).astype(np.float64) + 1
                    return (tree.labels[places][:, None] != labels) & (high >= from_[:, None]) & (low <= to[:, None])

                for place, rows, scores in _scored(tree, x, norms, wanted):
                    other = labels[rows] != tree.labels[place]
                    rows, scores = rows[other], scores[other]
                    for nth, from_ in enumerate(still(place)):
                        good = (scores >= from_) & (scores <= highest[place, nth])
                        if good.any():
                            held.add((place, nth), scores[good], ids[rows[good]])
        yield from _told(trees, best)

    return run


def _first(found: DataFrame, keep: int, *keys: str) -> DataFrame:
    """The best ``keep`` of what the tasks kept, numbered from 1."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def mine(
    df: DataFrame, is_anchor: Column, id_column: str = "vec_id", label_column: str = "label", vector_column: str = "embedding", scale: int = 256,
    positives: int = 5, negatives: int = 3, least_percent: int = 50, most_percent: int = 95,
    block: int = BLOCK, block_bytes: int = BLOCK_BYTES, portion_bytes: int = PORTION_BYTES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A negative's score is from ``least_percent`` to ``most_percent`` of the positive's, both included; at a negative
    positive score there is no such number.
    """
    spark = df.sparkSession
    taking_part = df.where(F.col(label_column).isNotNull() & is_whole(F.col(vector_column))).select(
        F.coalesce(F.col(id_column).cast("bigint"), F.lit(int(_NO_ID))).alias("id"), F.col(label_column).cast("bigint").alias("label"),
        quantised(F.col(vector_column), scale).alias("q"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    )
    rows = write_stage(taking_part, "negatives-rows")
    anchors = rows.where("anchor").withColumn("code", _similarity_code(F.col("q")))
    sorted_ = anchors.repartitionByRange("label", "code").sortWithinPartitions("label", "code", "id").select("id", "label", "q")
    blocks = write_stage(sorted_.mapInArrow(_in_blocks(block, block_bytes), _BLOCKS), "negatives-blocks")
    size = blocks.agg(F.sum(F.length("vectors"))).first()[0] or 0
    portions = max(1, -(-int(size) // portion_bytes))
    out = scratch_path(spark, "negatives-found")
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    spark.createDataFrame([], schema).write.parquet(out)
    rows = rows.select("id", "label", "q")
    for portion in range(portions):
        trees = [Tree.packed(r) for r in blocks.where(F.pmod(F.xxhash64("block"), F.lit(portions)) == portion).collect()]
        if trees:
            _mine_portion(rows, trees, positives, negatives, least_percent, most_percent).write.mode("append").parquet(out)
    return spark.read.schema(schema).parquet(out)


def _mine_portion(rows: DataFrame, trees: list[Tree], positives: int, negatives: int, least_percent: int, most_percent: int) -> DataFrame:
    context = rows.sparkSession.sparkContext
    shared = context.broadcast(trees)
    found = rows.mapInArrow(_positives(shared, positives), _FOUND)
    best = write_stage(_first(found, positives, "block", "place").drop("nth"), "negatives-positives")
    # At most ``positives`` rows per anchor of the portion.
    told = best.select("block", "place", "rank", "score").toArrow()
    spans = {t.block: (np.full((len(t.ids), positives), np.iinfo(np.int64).max), np.full((len(t.ids), positives), _LOWEST)) for t in trees}
    columns = [told[c].to_pylist() for c in ("block", "place", "rank", "score")]
    for number, place, rank, score in zip(*columns):
        lowest, highest = spans[number]
        lowest[place, rank - 1], highest[place, rank - 1] = -(-least_percent * score // 100), most_percent * score // 100
    windows = context.broadcast([spans[t.block] for t in trees])
    taken = rows.mapInArrow(_negatives(shared, windows, negatives), _FOUND)
    chosen = _first(taken, negatives, "block", "place", "nth").toDF("_block", "_place", "_nth", "negative_score", "_negative", "_rank")
    ids = [(t.block, place, int(i)) for t in trees for place, i in enumerate(t.ids)]
    named = rows.sparkSession.createDataFrame(ids, "_a_block bigint, _a_place int, anchor_id bigint")
    joined = chosen.join(best, (F.col("_block") == F.col("block")) & (F.col("_place") == F.col("place")) & (F.col("_nth") + 1 == F.col("rank")))
    joined = joined.join(named, (F.col("_block") == F.col("_a_block")) & (F.col("_place") == F.col("_a_place")))
    real = lambda c: F.when(F.col(c) != int(_NO_ID), F.col(c))
    return joined.select(
        "anchor_id", real("id").alias("positive_id"), F.col("_rank").alias("rank"), real("_negative").alias("negative_id"),
        F.col("score").alias("positive_score"), "negative_score",
    )
