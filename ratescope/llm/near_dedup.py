"""MinHash near-duplicates through an LSH forest.

A signature is sorted in several orders, one per tree: tree t starts at its own part of the signature. In a sorted order
documents with long common prefixes are neighbours, whatever depth it takes to tell them apart from the rest of their
region. Trees are range-partitioned by their order, and a streaming pass over each partition names the neighbours. Rows of
a tree that share their first values, as many as ``least_depth`` says, are a region; that depth is the same for all. Two documents at the threshold share a region in some tree with a probability of
1 - 2.5e-7 at least.

Documents with the same set of shingles are one member for the forest. A first round joins each member's closest
neighbours. Then every region that still holds several components is cut into blocks, blocks meet in pairs, and all pairs
of members of different components are compared on their full sets: none is left out, whatever the size of the region, so
the work grows with the square of a region that doesn't join in the first round. Components come from a table of links.

Null texts and texts without words have an empty set and stay alone. A null doc_id gives a null component and is kept.
Rows that repeat a doc_id are one node with the links of all its rows, and are kept or dropped together. A table without
rows gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratescope.llm.common import few_rows, shuffle_slots, utf8, write_stage
from ratescope.llm.components import joined_roots
from ratescope.llm.hashing import WordHashes, mix, run_hashes

SHINGLE = 5
#: Least similarity of a link, in percent.
SIMILAR = 85
TREES = 16
#: Most that two documents at the threshold may be missed by all trees.
MISSED = 2.5e-7
#: Values of a tree's order that travel with a row; deeper ties are near copies in any case.
DEPTH = 12
SIGNATURE = TREES * 6
#: Neighbours that each member is compared with at first; enough to join nearly all of a large group.
FIRST_LINKS = 2
#: Rows and bytes of shingles that a block of a region holds, about.
BLOCK_ROWS, BLOCK_BYTES = 1_000, 4_000_000
_BLOCK = 1 << 13

_SIGNED = "doc_id bigint, n_shingles bigint, set_key binary, signature binary"
_NEAR = "a bigint, b bigint, depth int"


def shingle_set(text, hashes: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a text in small ASCII letters."""
    words = utf8(text).lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    run = run_hashes(hashes.of(words), min(size, len(words)))
    return np.unique(mix(run, len(words)) if len(words) < size else run)


def _multipliers() -> np.ndarray:
    return mix(np.arange(SIGNATURE, dtype=np.uint64), 11) | np.uint64(1)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Smallest 16-bit-truncated permuted value per hash function; long sets are folded in block by block."""
    factors = _multipliers()
    least = np.full(SIGNATURE, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(shingles), _BLOCK):
        part = shingles[start:start + _BLOCK]
        least = np.minimum(least, np.multiply.outer(factors, part).min(axis=1))
    # The leading bits of the smallest value are nearly always zero, so the value is mixed before it is cut.
    return (mix(least, 12) >> np.uint64(48)).astype(">u2")


def _sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    for batch in batches:
        out = []
        for doc, text in zip(batch["doc_id"], batch["text"]):
            shingles = shingle_set(text, hashes)
            key = np.array([len(shingles), shingles.sum(dtype=np.uint64), mix(shingles, 13).sum(dtype=np.uint64)], dtype=np.uint64)
            out.append((doc, len(shingles), key.tobytes(), signature(shingles).tobytes() if len(shingles) else None))
        frame = pd.DataFrame(out, columns=["doc_id", "n_shingles", "set_key", "signature"])
        yield frame.astype({"doc_id": "Int64"})


def least_depth(similar: int) -> int:
    """Most values that two documents at the threshold still share at the start of some tree, but for ``MISSED``."""
    depth = 1
    while depth < DEPTH and (1 - (similar / 100) ** (depth + 1)) ** TREES <= MISSED:
        depth += 1
    return depth


def _orders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row per member and tree: the signature from the tree's own place on, wrapped around."""
    width = SIGNATURE // TREES
    for batch in batches:
        if not len(batch):
            continue
        signs = np.frombuffer(b"".join(batch["signature"]), dtype=np.uint8).reshape(len(batch), -1)
        twice = np.concatenate([signs, signs], axis=1)
        for tree in range(TREES):
            first = 2 * tree * width
            keys = np.ascontiguousarray(twice[:, first:first + 2 * DEPTH])
            yield pd.DataFrame({"place": [bytes([tree]) + k.tobytes() for k in keys], "node": batch["node"].to_numpy()})


def _common(a: bytes, b: bytes) -> int:
    """Values that two places share from the start; 0 across trees."""
    if a[0] != b[0]:
        return 0
    if a == b:
        return DEPTH
    x = np.frombuffer(a, dtype=np.uint8, offset=1) != np.frombuffer(b, dtype=np.uint8, offset=1)
    return int(np.argmax(x)) // 2


def _shared(a: bytes, b: bytes, depth: int) -> bool:
    return a[: 1 + 2 * depth] == b[: 1 + 2 * depth]


def _neighbours(least: int):
    """For each row the row before it, if in its region; a partition's first and last row with themselves."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None
        for batch in batches:
            a, b, depth = [], [], []
            for place, node in zip(batch["place"], batch["node"].tolist()):
                place = bytes(place)
                if last is None:
                    a.append(node)
                    b.append(node)
                    depth.append(0)
                elif _shared(last[0], place, least):
                    a.append(node)
                    b.append(last[1])
                    depth.append(_common(last[0], place))
                last = place, node
            yield pd.DataFrame({"a": np.array(a, dtype="int64"), "b": np.array(b, dtype="int64"), "depth": np.array(depth, dtype="int32")})
        if last is not None:
            yield pd.DataFrame({"a": [last[1]], "b": [last[1]], "depth": np.zeros(1, dtype="int32")})

    return run


def _confirm(similar: int):
    """Pairs whose full sets are similar enough; both texts are in the row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            linked = []
            last, left = None, None
            for a, ta, tb in zip(batch["a"], batch["text_a"], batch["text_b"]):
                if a != last:
                    last, left = a, shingle_set(ta, hashes)
                right = shingle_set(tb, hashes)
                both = len(np.intersect1d(left, right, assume_unique=True))
                linked.append(100 * both >= similar * (len(left) + len(right) - both))
            yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "linked": linked})

    return run


def _confirmed(pairs: DataFrame, texts: DataFrame, similar: int) -> DataFrame:
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b").mapInPandas(
        _confirm(similar), "a bigint, b bigint, linked boolean"
    )


def signatures(docs: DataFrame) -> DataFrame:
    return write_stage(docs.select("doc_id", "text").mapInPandas(_sign, _SIGNED), "forest-signatures")


def _places(members: DataFrame) -> DataFrame:
    return members.select("node", "signature").mapInPandas(_orders, "place binary, node bigint")


def _forest(members: DataFrame, least: int) -> DataFrame:
    """Pairs of neighbours; members whose region may go on in another partition are paired with themselves."""
    dealt = _places(members).repartitionByRange(shuffle_slots(members.sparkSession), "place", "node").sortWithinPartitions("place", "node")
    return dealt.mapInPandas(_neighbours(least), _NEAR)


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    for batch in batches:
        yield pd.DataFrame({"node": batch["node"], "shingles": [shingle_set(t, hashes).tobytes() for t in batch["text"]]})


def block_links(left: list[bytes], left_roots: np.ndarray, right: list[bytes], right_roots: np.ndarray, similar: int) -> list[tuple[int, int]]:
    """Pairs of different roots that join all that similar pairs of the two blocks join."""
    sizes = np.array([len(x) // 8 for x in [*left, *right]], dtype=np.int64)
    _, ids = np.unique(np.frombuffer(b"".join([*left, *right]), dtype=np.uint64), return_inverse=True)
    ends = np.cumsum(sizes)
    cut = int(sizes[: len(left)].sum())
    others, to = ids[cut:], ends[len(left):] - cut
    size = sizes[len(left):]
    held = np.zeros(int(ids.max(initial=0)) + 1, dtype=bool)
    total = np.zeros(len(others) + 1, dtype=np.int64)
    up: dict[int, int] = {}
    found = []

    def top(x: int) -> int:
        while x in up:
            x = up[x]
        return x

    for i, root in enumerate(left_roots.tolist()):
        if (right_roots == root).all():
            continue
        mine = ids[ends[i] - sizes[i]:ends[i]]
        held[mine] = True
        np.cumsum(held[others], out=total[1:])
        held[mine] = False
        both = total[to] - total[to - size]
        linked = (right_roots != root) & (100 * both >= similar * (sizes[i] + size - both))
        for other in np.unique(right_roots[linked]).tolist():
            x, y = top(root), top(other)
            if x != y:
                up[max(x, y)] = min(x, y)
                found.append((root, other))
    return found


def _compare(similar: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            links = []
            for left, roots, right, others in zip(batch["shingles"], batch["roots"], batch["_shingles"], batch["_roots"]):
                links += block_links(list(left), np.asarray(roots), list(right), np.asarray(others), similar)
            yield pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return run


def _region_links(members: DataFrame, roots: DataFrame, texts: DataFrame, least: int, similar: int) -> DataFrame:
    """Links between components, from all pairs of members of one region and different components."""
    known = roots.select(F.col("node").alias("_node"), "root")
    rooted = members.select("node", "n_shingles").join(known, F.col("node") == F.col("_node"), "left").select(
        F.col("node").alias("_node"), "n_shingles", F.coalesce("root", "node").alias("root")
    )
    rooted = few_rows(write_stage(rooted, "forest-rooted"))
    placed = _places(members).select(F.substring("place", 1, 1 + 2 * least).alias("region"), "node")
    placed = write_stage(placed.join(rooted, F.col("node") == F.col("_node")).drop("_node"), "forest-regions")
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK_ROWS, F.sum("n_shingles") * 8 / BLOCK_BYTES)).cast("int")
    open_ = placed.groupBy("region").agg(F.min("root").alias("least"), F.max("root").alias("most"), blocks.alias("blocks"))
    open_ = write_stage(open_.where("least < most").select(F.col("region").alias("_region"), "blocks"), "forest-open-regions")
    rows = placed.join(few_rows(open_), F.col("region") == F.col("_region")).select("region", "blocks", "node", "root")
    rows = write_stage(rows, "forest-open-rows")
    wanted = few_rows(write_stage(rows.select("node").distinct(), "forest-open-nodes"))
    sets = texts.join(wanted, "node").mapInPandas(_sets, "node bigint, shingles binary")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    packed = rows.join(sets, "node").groupBy("region", "blocks", block.alias("block")).agg(
        F.collect_list("root").alias("roots"), F.collect_list("shingles").alias("shingles")
    )
    packed = write_stage(packed, "forest-blocks")
    left = packed.select("region", F.explode(F.sequence("block", F.col("blocks") - 1)).alias("other"), "roots", "shingles")
    right = packed.select(F.col("region").alias("_region"), "block", F.col("roots").alias("_roots"), F.col("shingles").alias("_shingles"))
    met = left.join(right, (F.col("region") == F.col("_region")) & (F.col("other") == F.col("block")))
    return met.select("roots", "shingles", "_roots", "_shingles").mapInPandas(_compare(similar), "a bigint, b bigint")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def near_components(docs: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``."""
    signed = signatures(docs)
    full = signed.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    groups = write_stage(
        full.groupBy("set_key").agg(F.min("doc_id").alias("node"), F.first("signature").alias("signature"), F.first("n_shingles").alias("n_shingles")), "forest-members"
    )
    members = groups.select("node", "signature", "n_shingles")
    least = least_depth(similar)

    # Round 1: each member's closest neighbours, by the longest prefix of any tree.
    named = write_stage(_forest(members, least).groupBy("a", "b").agg(F.max("depth").alias("depth")), "forest-neighbours")
    near = named.where("a != b")
    both = near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b"), "depth"))
    by_depth = F.sort_array(F.collect_set(F.struct(-F.col("depth"), F.xxhash64("a", "b"), F.col("b").alias("b"))))
    first = both.groupBy("a").agg(F.slice(by_depth, 1, FIRST_LINKS).alias("closest"))
    first = first.select("a", F.explode("closest.b").alias("b"))
    nodes = few_rows(write_stage(named.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "forest-near-nodes"))
    near_members = write_stage(members.join(nodes, "node"), "forest-near-members")
    texts = write_stage(docs.select(F.col("doc_id").alias("node"), "text").join(nodes, "node"), "forest-texts")

    outcome = write_stage(_confirmed(_ordered(first), texts, similar), "forest-outcome")
    roots = joined_roots(None, outcome.where("linked"))

    # Round 2: what is still apart within a region.
    links = write_stage(_region_links(near_members, roots, texts, least, similar), "forest-links")
    roots = joined_roots(roots, links)

    named = signed.select("doc_id", "n_shingles", "set_key")
    keys = groups.select(F.col("set_key").alias("_key"), F.col("node"))
    top = roots.select(F.col("node").alias("_node"), "root")
    classes = keys.join(top, F.col("node") == F.col("_node"), "left").select("_key", F.coalesce("root", "node").alias("component"))
    joined = named.join(classes, F.col("set_key") == F.col("_key"), "left")
    return joined.select(
        "doc_id", "n_shingles",
        F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def report(docs: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """doc_id, n_shingles, component_id, kept."""
    found = near_components(docs, similar)
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def first_of_each(docs: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """Rows of ``docs`` that come first in their component; the others are gone."""
    found = write_stage(report(docs, similar).where(~F.col("kept")).select(F.col("doc_id").alias("_nd_gone")).distinct(), "near-dropped")
    return docs.join(few_rows(found), F.col("doc_id") == F.col("_nd_gone"), "left_anti")
