"""URL filter: a blocked Bloom filter of listed canonical URLs in front of an exact hash join.

A rule is a host, a path and a verdict. It fits the URLs of its host and of all its subdomains whose path starts with
the rule's path; of several that fit, the longest (host and path together, then the longer host) decides. The canonical
form of a URL is its host in small ASCII letters and its path, without scheme, query and fragment; a rule's is its own
host and path. A URL's possible rules are the suffixes of its host with the beginnings of its path, of the lengths that
rules have.

The hosts and the canonical forms of all rules are put into one filter of 256-bit blocks: a hash names the block, eight
more pieces of hash set one bit in each of its words. Host suffixes are asked first, whole forms only below hosts that
may be listed. What passes is joined with the rules by equality of host and path, which removes the false positives.
Where no rule fits, the list says nothing against the URL and the verdict is ``otherwise``.

The filter is built by one aggregation over the rules; its size follows their number up to ``MAX_BLOCKS`` (32 MB), and
beyond that more false positives reach the join, which are removed as ever. Equal URLs are decided once, so a URL that
many pages share is one row of the join; the rules are broadcast only after a count.

A null URL, or one without ``://``, has an empty host and path; a very long one is taken whole. Rules with a null host
or path are left out; of rules with equal host and path but different verdicts ``block`` wins. Repeated rows get equal
results; tables without rows give no rows. Further columns are carried along by ``judge``; columns of the names it adds
are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratescope.llm.common import few_rows, write_stage

RULES = "host string, path string, verdict string"
BITS_PER_KEY = 16
MAX_BLOCKS = 1 << 20
#: Host and path of a decided URL are some hundred bytes, so this many are some 20 MB.
_FEW_URLS = 200_000
_FEW_RULES = 200_000
_ADDED = ("host", "path", "rule", "verdict")
_WORDS = 8
_GAP = "\x00"


def small_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return small_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_suffixes(host: Column) -> Column:
    """The host and all it is a subdomain of."""
    labels = F.split(host, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."))


def _whole_key(host: Column, path: Column) -> Column:
    return F.concat(host, F.lit(_GAP), path)


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _bits(key: Column) -> Column:
    """40 bits that name one bit in each of eight words."""
    return F.xxhash64(key, F.lit(1))


class BlockedBloom:
    """Blocks of eight 32-bit words; built by Spark, asked by tasks."""

    def __init__(self, keys: DataFrame, column: str, n_keys: int, max_blocks: int = MAX_BLOCKS):
        spark = keys.sparkSession
        self.blocks = max(1, min(max_blocks, -(-n_keys * BITS_PER_KEY // (32 * _WORDS))))
        key = F.col(column)
        place = [F.shiftright(_bits(key), 5 * w).bitwiseAND(F.lit(31)).cast("int") for w in range(_WORDS)]
        bit = [F.call_function("shiftleft", F.lit(1).cast("bigint"), p) for p in place]
        set_ = keys.select(_block(key, self.blocks).alias("block"), *[b.alias(f"w{w}") for w, b in enumerate(bit)])
        rows = set_.groupBy("block").agg(*[F.bit_or(f"w{w}").alias(f"w{w}") for w in range(_WORDS)]).toArrow()
        words = np.zeros((self.blocks, _WORDS), dtype=np.uint32)
        for w in range(_WORDS):
            words[rows["block"].to_numpy(), w] = rows[f"w{w}"].to_numpy().astype(np.uint32)
        shared = spark.sparkContext.broadcast(words)

        @F.arrow_udf("boolean")
        def ask(block: pa.Array, bits: pa.Array) -> pa.Array:
            held = shared.value[block.to_numpy(zero_copy_only=False).astype(np.int64)]
            asked = bits.to_numpy(zero_copy_only=False).astype(np.int64)
            found = np.ones(len(asked), dtype=bool)
            for w in range(_WORDS):
                place = ((asked >> (5 * w)) & 31).astype(np.uint32)
                found &= (held[:, w] >> place) & 1 == 1
            return pa.array(found)

        self._ask = ask

    def may_hold(self, key: Column) -> Column:
        return self._ask(_block(key, self.blocks), _bits(key))


def known_rules(rules: DataFrame) -> DataFrame:
    """One row per host and path."""
    named = rules.where(F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("verdict").isNotNull())
    return named.groupBy(small_ascii(F.col("host")).alias("rule_host"), F.col("path").alias("rule_path")).agg(
        F.when(F.max(F.col("verdict") == "block"), F.lit("block")).otherwise(F.min("verdict")).alias("rule_verdict")
    )


def decide(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """host, path, rule and rule_verdict of the distinct (host, path) of ``urls`` that some rule fits."""
    listed = write_stage(known_rules(rules), "url-rules")
    lengths = [r[0] for r in listed.select(F.length("rule_path")).distinct().collect()]  # no longer than a path
    keys = listed.select(F.explode(F.array("rule_host", _whole_key(F.col("rule_host"), F.col("rule_path")))).alias("key")).distinct()
    keys = write_stage(keys, "url-keys")
    bloom = BlockedBloom(keys, "key", keys.count())
    distinct = urls.select("host", "path").distinct()
    hosts = distinct.select("host", "path", F.explode(host_suffixes(F.col("host"))).alias("_host")).where(bloom.may_hold(F.col("_host")))
    fitting_lengths = F.filter(F.array(*[F.lit(n) for n in sorted(lengths)]).cast("array<int>"), lambda n: n <= F.length("path"))
    starts = F.transform(fitting_lengths, lambda n: F.substring(F.col("path"), F.lit(1), n))
    possible = hosts.select("host", "path", "_host", F.explode(starts).alias("_path")).where(bloom.may_hold(_whole_key(F.col("_host"), F.col("_path"))))
    exact = (F.col("_host") == F.col("rule_host")) & (F.col("_path") == F.col("rule_path"))
    fitting = possible.join(few_rows(listed, _FEW_RULES), exact)
    longest = F.max_by(
        F.struct(F.concat("rule_host", "rule_path").alias("rule"), "rule_verdict"),
        F.struct(F.length("rule_host") + F.length("rule_path"), F.length("rule_host")),
    )
    return fitting.groupBy("host", "path").agg(longest.alias("_won")).select("host", "path", "_won.rule", "_won.rule_verdict")


def judge(pages: DataFrame, rules: DataFrame, url_column: str = "url", otherwise: str = "allow") -> DataFrame:
    """``pages`` with host, path, the rule that decides and the verdict."""
    carried = pages.drop(*[c for c in _ADDED if c != url_column])
    parsed = carried.withColumns({"_uf_host": host_of(F.col(url_column)), "_uf_path": path_of(F.col(url_column))})
    decided = write_stage(decide(parsed.select(F.col("_uf_host").alias("host"), F.col("_uf_path").alias("path")), rules), "url-decided")
    decided = few_rows(decided.toDF("_d_host", "_d_path", "rule", "_d_verdict"), _FEW_URLS)
    joined = parsed.join(decided, (F.col("_uf_host") == F.col("_d_host")) & (F.col("_uf_path") == F.col("_d_path")), "left")
    return joined.select(
        *[F.col(f"`{c}`") for c in carried.columns], F.col("_uf_host").alias("host"), F.col("_uf_path").alias("path"), "rule",
        F.coalesce("_d_verdict", F.lit(otherwise)).alias("verdict"),
    )
