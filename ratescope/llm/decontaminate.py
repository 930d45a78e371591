"""Benchmark decontamination with a generalised suffix automaton over normalised test items.

The items' words become one automaton; each document is streamed through it, which gives at every word the length of
the longest item passage that ends there. Where it reaches the window, the last ``window`` words are a hit. An item
with fewer words counts whole. Items are built into automata of at most ``SHARD_WORDS`` words, each broadcast on its own
(about 60 MB at the bound), so a larger benchmark means more automata, not a larger one.

Words are maximal runs of ASCII letters and digits and of any other characters beyond ASCII, in small ASCII letters.
Null texts have no words. Each row is judged on its own, so repeated rows get equal results and a null doc_id is no
obstacle; rows of the benchmark with the same item_id are one item, null ids count as an item without a name. Without
items nothing is hit; a table without rows gives no rows. Further columns are carried along.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratescope.llm.common import utf8
from ratescope.llm.suffix_automaton import SuffixAutomaton

WINDOW = 10
SHARD_WORDS = 200_000
#: Documents with at least this share of hit words are dropped whole by ``decontaminate``.
MAX_COVERAGE = 0.5

_WORD_BYTES = bytes(b for b in range(256) if 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)
_TO_BLANK = bytes(b if b in _WORD_BYTES else 32 for b in range(256)).lower()
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_HITS = "n_words bigint, spans array<struct<start: int, end: int>>, items array<string>"


def normal_words(text) -> list[bytes]:
    return utf8(text).translate(_TO_BLANK).split()


def item_shards(items: DataFrame, shard_words: int = SHARD_WORDS) -> Iterator[list[tuple[str, str]]]:
    """Items in portions of about ``shard_words`` words; a portion is what the driver holds at a time."""
    named = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"), "text")
    size = named.agg(F.sum(F.size(F.split(F.coalesce("text", F.lit("")), "[^0-9A-Za-z\\x{80}-\\x{10FFFF}]+")))).first()[0] or 0
    portions = max(1, -(-int(size) // shard_words))
    for portion in range(portions):
        chosen = named.where(F.pmod(F.xxhash64("name"), F.lit(portions)) == portion)
        yield [(r["name"], r["text"]) for r in chosen.collect()]


def _find(automaton) -> Callable:
    @F.pandas_udf(_HITS)
    def find(texts: pd.Series) -> pd.DataFrame:
        found = []
        for text in texts:
            words = normal_words(text)
            spans, names = automaton.value.hits(words)
            found.append((len(words), [{"start": a, "end": b} for a, b in spans], names))
        return pd.DataFrame(found, columns=["n_words", "spans", "items"])

    return find


def _merged(parts: list[Column]) -> Column:
    """Hits of several automata as one."""

    @F.pandas_udf(_HITS)
    def merge(*each: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in zip(*[p.itertuples(index=False) for p in each]):
            spans: list[list[int]] = []
            for a, b in sorted((s["start"], s["end"]) for r in row for s in r.spans):
                if spans and spans[-1][1] >= a:
                    spans[-1][1] = max(b, spans[-1][1])
                else:
                    spans.append([a, b])
            out.append((row[0].n_words, [{"start": a, "end": b} for a, b in spans], sorted({i for r in row for i in r.items})))
        return pd.DataFrame(out, columns=["n_words", "spans", "items"])

    return parts[0] if len(parts) == 1 else merge(*parts)


def with_hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``docs`` with a struct ``_dc``: n_words, spans of hit words and the items hit."""
    context = docs.sparkSession.sparkContext
    parts, df = [], docs
    for portion in item_shards(items, shard_words):
        automaton = context.broadcast(SuffixAutomaton([(n, normal_words(t)) for n, t in portion], window))
        name = f"_dc_{len(parts)}"
        df = df.withColumn(name, _find(automaton)("text"))
        parts.append(name)
    return df.withColumn("_dc", _merged([F.col(p) for p in parts])).drop(*parts)


def n_hit(hits: Column) -> Column:
    return F.aggregate(hits["spans"], F.lit(0).cast("long"), lambda total, s: total + (s["end"] - s["start"]))


def report(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = with_hits(docs.select("doc_id", "text"), items, window).drop("text")
    hits = F.col("_dc")
    return found.select(
        "doc_id", "_dc.n_words", n_hit(hits).alias("n_hit"), F.size("_dc.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_dc.items", ","), 256).alias("items_sha256"), (n_hit(hits) > 0).alias("contaminated"),
    )


def _without(text, spans) -> str:
    raw = utf8(text)
    places = [m.span() for m in _WORD.finditer(raw)]
    kept, at = [], 0
    for span in spans:
        kept.append(raw[at:places[span["start"]][0]])
        at = places[span["end"] - 1][1]
    kept.append(raw[at:])
    return b"".join(kept).decode("utf-8", "surrogatepass")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE) -> DataFrame:
    """``docs`` without the hit passages; documents that are hit in ``max_coverage`` of their words or more are gone."""

    @F.pandas_udf("string")
    def cut(texts: pd.Series, hits: pd.DataFrame) -> pd.Series:
        return pd.Series([_without(t, s) if len(s) else t for t, s in zip(texts, hits["spans"])], dtype=object)

    found = with_hits(docs, items, window)
    hits = F.col("_dc")
    clean = F.size("_dc.spans") == 0
    kept = found.where(clean | (n_hit(hits) < max_coverage * F.col("_dc.n_words")))
    text = F.when(F.size("_dc.spans") == 0, F.col("text")).otherwise(cut("text", "_dc"))
    return kept.select(*[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])
