"""Substring dedup: passages that an earlier document holds already are removed.

A window is ``WINDOW`` consecutive words. A word goes if a window over it also starts in a document with a smaller
doc_id. Suffix automata of reference passages decide that: each document is streamed through the automaton of the
passages that earlier documents share with it, and where the longest match ending at a word reaches the window, the
window's words go. Matches are of words, never of hashes.

The reference is not the whole corpus but its repeated windows, cut into shards of ``SHARD`` window starts of their first
document. Finding them takes three narrow passes:

* Every window has an anchor, the smallest hash among its runs of ``ANCHOR`` words. Equal windows have equal anchors, and
  only about one word in thirteen gives a new one, so all documents can be compared by anchors.
* Windows under anchors that several documents hold are compared by hash; each repeated one names its first document.
* The first documents' shards around such windows are sent to the documents that repeat them.

Counts are combined before shuffles. What is shared is written before it is joined, so that the join is on a table instead
of an aggregate of the same stage, and adaptive execution can split a passage that a third of all documents hold.
Documents with the same words throughout are settled by digest beforehand.

Null texts have no words. Rows with a null doc_id have no place in the order: they lose nothing and serve nobody. Rows
that repeat a doc_id count as one document, so they lose nothing to each other. A table without rows gives no rows.
Further columns are carried along by ``remove_repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratescope.llm.common import few_rows, utf8, write_stage
from ratescope.llm.hashing import WordHashes, run_hashes
from ratescope.llm.suffix_automaton import SuffixAutomaton

WINDOW = 50
ANCHOR = 25
SHARD = 64
#: Digests in hexadecimal are wider than numbers, so fewer are broadcast: some 25 MB.
_FEW_DIGESTS = 200_000

_PROFILE = "doc_id bigint, n_words bigint, words_key string, anchors array<bigint>"
_WINDOWS = "doc_id bigint, start int, window bigint"
_SHARDS = "first bigint, shard int, passage binary"
_OUTCOME = "doc_id bigint, words_key string, n_removed bigint, kept_sha256 string, spans array<struct<start: int, end: int>>"


def split_words(text) -> list[bytes]:
    return utf8(text).split()


def smallest_in_each(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def anchors_of(words: np.ndarray, window: int, anchor: int) -> np.ndarray:
    """The anchor of every window."""
    runs = run_hashes(words, anchor, seed=21)
    width = window - anchor + 1
    return smallest_in_each(runs, width) if len(runs) >= width else np.empty(0, dtype=np.uint64)


def _profile(window: int, anchor: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            out = []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                words = split_words(text)
                found = np.unique(anchors_of(hashes.of(words), window, anchor)).view(np.int64) if len(words) >= window else []
                out.append((doc, len(words), hashlib.sha256(b" ".join(words)).hexdigest(), found))
            yield pd.DataFrame(out, columns=["doc_id", "n_words", "words_key", "anchors"]).astype({"doc_id": "Int64"})

    return run


def _windows(window: int, anchor: int):
    """Windows whose anchor other documents hold too."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            for doc, text, shared in zip(batch["doc_id"], batch["text"], batch["shared"]):
                words = hashes.of(split_words(text))
                held = np.isin(anchors_of(words, window, anchor).view(np.int64), shared)
                starts = np.flatnonzero(held)
                values = run_hashes(words, window, seed=31).view(np.int64)[starts]
                _, once = np.unique(values, return_index=True)
                yield pd.DataFrame({"doc_id": np.full(len(once), doc), "start": starts[once].astype(np.int32), "window": values[once]})

    return run


def _shards(window: int, shard: int):
    """The words below the shard's window starts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, text, wanted in zip(batch["doc_id"], batch["text"], batch["shards"]):
                words = split_words(text)
                for k in wanted:
                    out.append((doc, k, b" ".join(words[k * shard:(k + 1) * shard + window - 1])))
            yield pd.DataFrame(out, columns=["first", "shard", "passage"])

    return run


def _joined_passages(shards, shard: int) -> list[list[bytes]]:
    """Passages of the shards; neighbouring shards of a document become one."""
    passages, before, start = [], None, 0
    for row in sorted(shards, key=lambda r: (r["first"], r["shard"])):
        words = bytes(row["passage"]).split()
        # What the earlier shard holds beyond its own starts is the beginning of this one.
        overlap = len(passages[-1]) - (row["shard"] - start) * shard if before == (row["first"], row["shard"] - 1) else 0
        if overlap > 0 and passages[-1][-overlap:] == words[:overlap]:
            passages[-1].extend(words[overlap:])
        else:
            passages.append(words)
            start = row["shard"]
        before = (row["first"], row["shard"])
    return passages


def _stream(window: int, shard: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, text, shards in zip(batch["doc_id"], batch["text"], batch["shards"]):
                words = split_words(text)
                automaton = SuffixAutomaton([("", p) for p in _joined_passages(shards, shard)], window)
                spans, _ = automaton.hits(words)
                kept, at = [], 0
                for a, b in spans:
                    kept += words[at:a]
                    at = b
                kept += words[at:]
                key = hashlib.sha256(b" ".join(words)).hexdigest()
                out.append((doc, key, len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest(), [{"start": a, "end": b} for a, b in spans]))
            yield pd.DataFrame(out, columns=["doc_id", "words_key", "n_removed", "kept_sha256", "spans"])

    return run


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id and text of some documents; where their ids are few, the other texts are not shuffled."""
    named = few_rows(ids.select(F.col("doc_id").alias("_id")))
    return docs.select("doc_id", "text").join(named, F.col("doc_id") == F.col("_id"), "left_semi")


def _by_id(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("doc_id").alias("_by"), *[c for c in rows.columns if c != "doc_id"])


def repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, shard: int = SHARD) -> tuple[DataFrame, DataFrame]:
    """All documents as (doc_id, n_words, words_key, copy), and the outcome of those that were streamed.

    ``copy`` marks documents whose words an earlier document has throughout; they lose everything if they hold a window.
    """
    profile = write_stage(docs.select("doc_id", "text").mapInPandas(_profile(window, anchor), _PROFILE), "substring-profile")
    known = profile.where(F.col("doc_id").isNotNull() & (F.col("n_words") >= window))
    first = known.groupBy(F.col("words_key").alias("_key")).agg(F.min("doc_id").alias("_first"), F.max("doc_id").alias("_last"))
    several = write_stage(first.where(F.col("_first") < F.col("_last")).select("_key", "_first"), "substring-several")
    copies = write_stage(
        known.join(several, (F.col("words_key") == F.col("_key")) & (F.col("doc_id") > F.col("_first")), "left_semi").select("doc_id", "words_key"),
        "substring-copies",
    )
    is_copy = few_rows(copies.select(F.col("doc_id").alias("_id"), F.col("words_key").alias("_key"), F.lit(True).alias("copy")).distinct(), _FEW_DIGESTS)
    marked = profile.join(is_copy, (F.col("doc_id") == F.col("_id")) & (F.col("words_key") == F.col("_key")), "left").drop("_id", "_key")
    marked = marked.withColumn("copy", F.coalesce("copy", F.lit(False)))

    held = marked.where(~F.col("copy") & F.col("doc_id").isNotNull()).select("doc_id", F.explode("anchors").alias("anchor"))
    shared = write_stage(
        held.groupBy(F.col("anchor").alias("_anchor")).agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
        .where(F.col("a") < F.col("b")).select("_anchor"),
        "substring-anchors",
    )
    per_doc = held.join(shared, F.col("anchor") == F.col("_anchor"), "left_semi").groupBy("doc_id").agg(F.collect_set("anchor").alias("shared"))
    per_doc = write_stage(per_doc, "substring-shared")
    candidates = _texts_of(docs, per_doc).join(_by_id(per_doc), F.col("doc_id") == F.col("_by"))
    windows = write_stage(candidates.select("doc_id", "text", "shared").mapInPandas(_windows(window, anchor), _WINDOWS), "substring-windows")

    origin = write_stage(
        windows.groupBy(F.col("window").alias("_window"))
        .agg(F.min(F.struct("doc_id", "start")).alias("first"), F.max("doc_id").alias("last"))
        .where(F.col("first.doc_id") < F.col("last"))
        .select("_window", F.col("first.doc_id").alias("first"), F.floor(F.col("first.start") / shard).cast("int").alias("shard")),
        "substring-origins",
    )
    uses = write_stage(
        windows.join(origin, F.col("window") == F.col("_window")).where(F.col("doc_id") > F.col("first")).select("doc_id", "first", "shard").distinct(),
        "substring-uses",
    )
    sources = write_stage(uses.groupBy(F.col("first").alias("doc_id")).agg(F.collect_set("shard").alias("shards")), "substring-sources")
    passages = (
        _texts_of(docs, sources).join(_by_id(sources), F.col("doc_id") == F.col("_by")).select("doc_id", "text", "shards")
        .mapInPandas(_shards(window, shard), _SHARDS)
    )
    sent = uses.join(passages.toDF("_first", "_shard", "passage"), (F.col("first") == F.col("_first")) & (F.col("shard") == F.col("_shard")))
    received = sent.groupBy("doc_id").agg(F.collect_set(F.struct("first", "shard", "passage")).alias("shards"))
    users = write_stage(uses.select("doc_id").distinct(), "substring-users")
    streamed = (
        _texts_of(docs, users).join(_by_id(received), F.col("doc_id") == F.col("_by")).select("doc_id", "text", "shards")
        .mapInPandas(_stream(window, shard), _OUTCOME)
    )
    outcome = write_stage(streamed.dropDuplicates(["doc_id", "words_key"]), "substring-outcome")
    return marked, outcome


def _with_outcome(rows: DataFrame, outcome: DataFrame) -> DataFrame:
    o = outcome.select(*[F.col(c).alias(f"_o_{c}") for c in outcome.columns])
    return rows.join(o, (F.col("doc_id") == F.col("_o_doc_id")) & (F.col("words_key") == F.col("_o_words_key")), "left")


def report(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    marked, outcome = repeats(docs, window)
    joined = _with_outcome(marked.drop("anchors"), outcome.drop("spans"))
    nothing = hashlib.sha256(b"").hexdigest()
    return joined.select(
        "doc_id", "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("_o_n_removed", F.lit(0))).alias("n_removed"),
        F.when(F.col("copy"), F.lit(nothing)).otherwise(F.coalesce("_o_kept_sha256", "words_key")).alias("kept_sha256"),
    )


def _kept_text(texts: pd.Series, spans: pd.Series) -> pd.Series:
    out = []
    for text, gone in zip(texts, spans):
        if gone is None:
            out.append(text)
            continue
        words, kept, at = split_words(text), [], 0
        for s in gone:
            kept += words[at:s["start"]]
            at = s["end"]
        out.append(b" ".join(kept + words[at:]).decode("utf-8", "surrogatepass"))
    return pd.Series(out, dtype=object)


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the kept words as text where something was removed, and ``n_removed``."""
    marked, outcome = repeats(docs, window)
    change = _with_outcome(marked.select("doc_id", "words_key", "n_words", "copy"), outcome.select("doc_id", "words_key", "n_removed", "spans"))
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end")))
    change = change.where(F.col("copy") | (F.col("_o_n_removed") > 0)).select(
        F.col("doc_id").alias("_sd_id"), F.col("words_key").alias("_sd_key"),
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.col("_o_n_removed")).alias("_sd_removed"),
        F.when(F.col("copy"), whole).otherwise(F.col("_o_spans")).alias("_sd_spans"),
    ).dropDuplicates(["_sd_id", "_sd_key"])
    key = F.sha2(F.array_join(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""), " "), 256)
    cut = F.pandas_udf(_kept_text, "string")
    joined = docs.withColumn("_sd_own", key).join(change, (F.col("doc_id") == F.col("_sd_id")) & (F.col("_sd_own") == F.col("_sd_key")), "left")
    done = joined.withColumn("_sd_text", F.when(F.col("_sd_spans").isNotNull(), cut("text", "_sd_spans")).otherwise(F.col("text")))
    rest = [F.col("_sd_text").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns if c != "n_removed"]
    return done.select(*rest, F.coalesce("_sd_removed", F.lit(0)).alias("n_removed"))
