"""Line dedup: lines that many documents share lose all their copies but one.

Normalised lines are hashed, distinct documents are counted per hash, lines over the threshold are dropped and the
rest is put together again by position.

Null and empty texts are one empty line. A table without rows gives no rows. Each row is a document: rows that repeat
a doc_id count one by one and lose the same lines, or none if theirs is the largest doc_id that holds the line. Rows
with a null doc_id never count and keep all their lines. Further columns are carried along, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratescope.llm.common import few_rows, utf8, write_stage

_KEYS = "doc_id bigint, key binary"
_NOTE = "_ld_key"


def line_key(line: bytes) -> bytes:
    """White space at both ends goes and A-Z become small; bytes methods know ASCII only, which is what is asked for."""
    return line.strip().lower()


def _long_enough(key: bytes, least: int) -> bool:
    if len(key) < least:
        return False
    return key.isascii() or len(key.decode("utf-8", "replace")) >= least


def _fingerprint(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def _distinct_keys(min_chars: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, keys = [], []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                if pd.isna(doc):
                    continue
                found = {_fingerprint(k) for k in map(line_key, utf8(text).split(b"\n")) if _long_enough(k, min_chars)}
                ids.extend([doc] * len(found))
                keys.extend(found)
            yield pd.DataFrame({"doc_id": pd.Series(ids, dtype="int64"), "key": pd.Series(keys, dtype="object")})

    return run


def crowded_keys(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """One row (doc_id, dropped: array of line fingerprints) per document that loses lines.

    Keys are counted with map-side combining, so a line that every document holds is a few rows per task. The crowded
    ones are written before the join: they are broadcast if few, and otherwise the join is on a table instead of an
    aggregate of the same stage, so that adaptive execution can split a hot key.
    """
    held = docs.select("doc_id", "text").mapInPandas(_distinct_keys(min_chars), _KEYS)
    crowded = write_stage(
        held.groupBy("key")
        .agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))
        .where(F.col("n") >= min_docs)
        .select("key", "keeper"),
        "crowded-lines",
    )
    return (
        held.join(few_rows(crowded), "key")
        .where(F.col("doc_id") != F.col("keeper"))
        .groupBy("doc_id")
        .agg(F.collect_set("key").alias("dropped"))
    )


def _rebuild(row_text, dropped, min_chars: int) -> tuple[bytes, int, int]:
    lines = utf8(row_text).split(b"\n")
    if dropped is None or len(dropped) == 0:
        return b"\n".join(lines), len(lines), 0
    gone = set(map(bytes, dropped))
    kept = []
    for line in lines:
        key = line_key(line)
        if _long_enough(key, min_chars) and _fingerprint(key) in gone:
            continue
        kept.append(line)
    return b"\n".join(kept), len(lines), len(lines) - len(kept)


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, digest_only: bool = False, counts: bool = True) -> DataFrame:
    """Documents without crowded lines.

    The columns of ``docs`` come back with ``text`` cleaned and, with ``counts``, ``n_lines`` and ``n_dropped`` in place
    of any columns of these names. With ``digest_only`` the result is (doc_id, n_lines, n_dropped, kept_sha256), so no
    text leaves the tasks.
    """
    drops = crowded_keys(docs, min_chars, min_docs).withColumnRenamed("doc_id", _NOTE)
    source = docs.select("doc_id", "text") if digest_only else docs
    joined = source.join(drops.withColumnRenamed("dropped", "_ld_dropped"), F.col("doc_id") == F.col(_NOTE), "left").drop(_NOTE)

    @F.pandas_udf("kept string, n_lines bigint, n_dropped bigint")
    def rebuild(texts: pd.Series, dropped: pd.Series) -> pd.DataFrame:
        out = [_rebuild(t, d, min_chars) for t, d in zip(texts, dropped)]
        if digest_only:
            kept = [hashlib.sha256(x[0]).hexdigest() for x in out]
        else:
            kept = [x[0].decode("utf-8", "surrogatepass") for x in out]
        return pd.DataFrame({"kept": kept, "n_lines": [x[1] for x in out], "n_dropped": [x[2] for x in out]})

    done = joined.withColumn("_ld", rebuild("text", "_ld_dropped"))
    if digest_only:
        return done.select("doc_id", "_ld.n_lines", "_ld.n_dropped", F.col("_ld.kept").alias("kept_sha256"))
    # A text that was null and lost nothing stays null.
    text = F.when(F.col("text").isNull(), F.col("text")).otherwise(F.col("_ld.kept"))
    own = [F.col("_ld.n_lines").alias("n_lines"), F.col("_ld.n_dropped").alias("n_dropped")] if counts else []
    replaced = {"n_lines", "n_dropped"} if counts else set()
    rest = [F.col(f"`{c}`") if c != "text" else text.alias("text") for c in docs.columns if c not in replaced]
    return done.select(*rest, *own)
