"""Toxicity scores by weak supervision.

Lexicon entries and patterns vote on documents. A generative label model estimates from labelled and unlabelled documents
how often each voter speaks on toxic and on other documents, and how far voters speak together beyond that; correlated
voters share one voice. Its posterior labels train a linear classifier over words and word beginnings, which scores every
whole text in Spark tasks.

The lexicon and the classifier are fitted on a bounded sample of labelled documents, at most ``MAX_LABELLED``, chosen by a
hash of doc_id, none of them held out. The label model sees the votes on all documents that are not held out: one pass
counts how often each combination of votes (and label of the sample) occurs, and a round of expectation-maximisation is
one aggregate over these counts, of which a few numbers per voter reach the driver. Scores cover all documents. Only the
text enters a score.

Null and empty texts score what the classifier says without any word; very long ones vote and score as a whole. Rows with
a null doc_id are scored, count as not held out and are not learned from; repeated rows vote and count each, and get
equal scores; entries that speak equally well for toxicity are taken by the number of their slot; labels for a doc_id
without document, with null or contradicting values are left out. Without any usable label every score is 0.5. A table
without rows gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratescope.llm.common import write_stage

MAX_LABELLED = 16_000
#: Slots of the hashed features.
SLOTS = 1 << 18
LEXICON = 120
TOXIC_FROM = 0.7
#: Correlations below it are taken for chance.
LEAST_CORRELATION = 0.2
_CACHED_WORDS = 300_000
_WORD = re.compile(r"[^\W\d_]+")
_ASCII = re.compile(r"[\x00-\x7f]+")
_CAPITALS = bytes(range(65, 91))
_SMALL_LETTERS = bytes(range(97, 123))
N_PATTERNS = 4
_BEGINNINGS = (5, 7)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _slot(kind: str, piece: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{kind}:{piece}") % SLOTS


class WordSlots(dict):
    """Feature slots of a word: the word and its beginnings."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        found = [_slot("w", word)] + [_slot(str(n), word[:n]) for n in _BEGINNINGS if len(word) >= n]
        self[word] = tuple(found)
        return self[word]


def text_words(text) -> set[str]:
    return set(_WORD.findall(text.lower())) if isinstance(text, str) else set()


def letters_of(text: str) -> tuple[int, int]:
    """Capital letters and letters of a whole text."""
    raw = text.encode("utf-8", "surrogatepass")
    without = raw.translate(None, _CAPITALS)
    capitals = len(raw) - len(without)
    letters = capitals + len(without) - len(without.translate(None, _SMALL_LETTERS))
    if not text.isascii():
        others = _ASCII.sub("", text)
        capitals += sum(map(str.isupper, others))
        letters += sum(map(str.isalpha, others))
    return capitals, letters


def patterns(text) -> list[bool]:
    """Pattern voters: shouting, many exclamation marks, many symbols, one word over and over."""
    if not isinstance(text, str) or not text:
        return [False] * N_PATTERNS
    words = max(1, text.count(" ") + text.count("\n"))
    capitals, letters = letters_of(text)
    return [
        capitals > 0.5 * max(1, letters),
        text.count("!") > 0.2 * words,
        sum(text.count(c) for c in "#*$%&|") > 0.2 * words,
        len(set(text.split())) < 0.2 * words,
    ]


def _describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    slots = WordSlots()
    for batch in batches:
        held, said = [], []
        for text in batch["text"]:
            held.append(np.array(sorted({s for w in text_words(text) for s in slots[w]}), dtype=np.int32).tobytes())
            said.append(bytes(patterns(text)))
        yield pd.DataFrame({"toxic": batch["toxic"], "slots": held, "said": said})


def labelled_ids(labels: DataFrame, most: int) -> DataFrame:
    """doc_id and toxic of at most ``most`` documents to learn from; labels that contradict each other are left out."""
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("toxic").cast("int").alias("toxic"), F.max("toxic").alias("_other"))
        .where(F.col("toxic") == F.col("_other")).select("doc_id", "toxic")
    )
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def sample(docs: DataFrame, ids: DataFrame) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Slots, patterns and label of the labelled documents; ``ids`` has a proven bound and goes to every task."""
    picked = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("text", "toxic")
    rows = picked.mapInPandas(_describe, "toxic int, slots binary, said binary").toPandas()
    rows = sorted((int(t), bytes(held), bytes(said)) for t, held, said in zip(rows["toxic"], rows["slots"], rows["said"]))
    said = np.frombuffer(b"".join(r[2] for r in rows), dtype=bool).reshape(len(rows), N_PATTERNS)
    return [np.frombuffer(r[1], dtype=np.int32) for r in rows], said, np.array([r[0] for r in rows], dtype=np.int64)


def _cast_votes(entries):
    """What the lexicon entries and the patterns say of each text, as packed bits."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        number = {int(slot): i for i, slot in enumerate(entries.value)}
        slots, known = WordSlots(), {}
        for texts in batches:
            votes = np.zeros((len(texts), len(number) + N_PATTERNS), dtype=bool)
            for row, text in enumerate(texts):
                for word in text_words(text):
                    mine = known.get(word)
                    if mine is None:
                        if len(known) >= _CACHED_WORDS:
                            known.clear()
                        mine = known[word] = [number[s] for s in slots[word] if s in number]
                    if mine:
                        votes[row, mine] = True
                votes[row, len(number):] = patterns(text)
            yield pd.Series([v.tobytes() for v in np.packbits(votes, axis=1)], dtype=object)

    return run


def vote_counts(docs: DataFrame, ids: DataFrame, entries: np.ndarray) -> DataFrame:
    """votes, label (1, 0, or -1 for none) and n: how many documents not held out have them."""
    sent = docs.sparkSession.sparkContext.broadcast(entries)

    @F.pandas_udf("binary")
    def cast_votes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from _cast_votes(sent)(batches)

    learnt = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", cast_votes("text").alias("votes"))
    named = ids.select(F.col("doc_id").alias("_id"), F.col("toxic").alias("_toxic"))
    label = F.coalesce("_toxic", F.lit(-1)).alias("label")
    return learnt.join(F.broadcast(named), F.col("doc_id") == F.col("_id"), "left").groupBy("votes", label).agg(F.count("*").alias("n"))


def choose_lexicon(slots: list[np.ndarray], label: np.ndarray, most: int = LEXICON) -> np.ndarray:
    """Entries that speak for toxicity most reliably, by a cautious estimate of their share of toxic documents."""
    toxic, clean = np.zeros(SLOTS), np.zeros(SLOTS)
    for held, y in zip(slots, label):
        if y >= 0:
            (toxic if y else clean)[held] += 1
    total = toxic + clean
    share = (toxic + 0.5) / (total + 1)
    cautious = share - 1.3 * np.sqrt(share * (1 - share) / (total + 1))
    base = max(1e-3, toxic.max(initial=0) and (label == 1).sum() / max(1, (label >= 0).sum()))
    fit = np.flatnonzero((toxic >= 3) & (cautious > min(0.5, 3 * base)))
    return fit[np.argsort(-cautious[fit] * np.sqrt(toxic[fit]), kind="stable")[:most]]


@dataclass
class LabelModel:
    """Share of toxic documents, speaking rates of each voter in both classes, and each voter's own voice."""

    prior: float
    rates: np.ndarray
    voice: np.ndarray

    def posterior(self, votes: np.ndarray, label: np.ndarray) -> np.ndarray:
        told = np.log(self.rates[1] / self.rates[0]) * self.voice
        silent = np.log((1 - self.rates[1]) / (1 - self.rates[0])) * self.voice
        odds = np.log(self.prior / (1 - self.prior)) + votes @ (told - silent) + silent.sum()
        # A label is a voter too, a very reliable one.
        odds += np.where(label == 1, 4.0, np.where(label == 0, -4.0, 0.0))
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


_SUMS = "sums array<double>"


def _unpacked(batch: pd.DataFrame, voters: int) -> np.ndarray:
    packed = np.frombuffer(b"".join(map(bytes, batch["votes"])), np.uint8).reshape(len(batch), -1)
    return np.unpackbits(packed, axis=1, count=voters).astype(float)


def _moments(voters: int):
    """Documents, votes of each voter, and votes of each pair."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1 + voters + voters * voters)
        for batch in batches:
            if len(batch):
                x, n = _unpacked(batch, voters), batch["n"].to_numpy(float)
                total += np.concatenate([[n.sum()], n @ x, ((x * n[:, None]).T @ x).ravel()])
        yield pd.DataFrame({"sums": [total]})

    return run


def _soft_sums(voters: int, model: "LabelModel | None", share: float):
    """Sums of the soft labels, of their squares, and of the votes weighted by them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(2 + voters)
        for batch in batches:
            if len(batch):
                x, n, label = _unpacked(batch, voters), batch["n"].to_numpy(float), batch["label"].to_numpy()
                soft = np.where(label >= 0, label, share) if model is None else model.posterior(x, label)
                total += np.concatenate([[n @ soft, n @ soft**2], (n * soft) @ x])
        yield pd.DataFrame({"sums": [total]})

    return run


def _summed(counts: DataFrame, run) -> np.ndarray:
    """Sums over all tasks; each sends some numbers per voter, and Spark adds them up."""
    parts = counts.mapInPandas(run, _SUMS).select(F.posexplode("sums").alias("place", "value"))
    rows = parts.groupBy("place").agg(F.sum("value").alias("value")).orderBy("place").collect()
    return np.array([r["value"] for r in rows])


def fit_label_model(counts: DataFrame, voters: int, rounds: int = 15) -> LabelModel:
    """Expectation-maximisation from the labels over counted votes; correlations are those left within the classes.

    With s the soft label of a document, a voter is expected to speak at rate r0 + s (r1 - r0); what is left of all pairs'
    votes follows from the pairs' votes themselves and from the sums of s, of its square and of s times the votes.
    """
    fixed = _summed(counts, _moments(voters))
    n, said, pairs = fixed[0], fixed[1:1 + voters], fixed[1 + voters:].reshape(voters, voters)
    known = counts.where("label >= 0").agg(F.sum(F.col("n") * F.col("label")) / F.sum("n")).first()[0]
    model = None
    for _ in range(rounds):
        sums = _summed(counts, _soft_sums(voters, model, 0.5 if known is None else float(known)))
        soft, squares, soft_said = sums[0], sums[1], sums[2:]
        weight = np.array([n - soft, soft])
        rates = np.array([said - soft_said + 0.1, soft_said + 0.2]) / (weight + 2)[:, None]
        rates = np.clip(rates, 1e-4, 0.999)
        low, gap = rates[0], rates[1] - rates[0]
        both = lambda a, b: np.outer(a, b) + np.outer(b, a)
        left = pairs - both(said, low) + n * np.outer(low, low) - both(soft_said, gap) + soft * both(low, gap) + squares * np.outer(gap, gap)
        mean = (said - n * low - soft * gap) / n
        spread = np.sqrt(np.maximum(np.diag(left) / n - mean**2, 0)) + 1e-9
        together = left / n / np.outer(spread, spread)
        together = np.where(together > LEAST_CORRELATION, np.minimum(together, 1), 0)
        model = LabelModel(float(np.clip(soft / n, 0.01, 0.9)), rates, 1 / np.clip(together.sum(axis=1), 1, None))
    return model


def telling_slots(slots: list[np.ndarray], target: np.ndarray, deviations: float = 4.5) -> np.ndarray:
    """Features whose documents are toxic more or less often than chance allows; the others are noise in long texts."""
    held = np.concatenate(slots)
    n = np.bincount(held, minlength=SLOTS)
    toxic = np.bincount(held, np.repeat(target, [len(s) for s in slots]), minlength=SLOTS)
    base = np.clip(target.mean(), 1e-3, 1 - 1e-3)
    return (n >= 3) & (np.abs(toxic - n * base) > deviations * np.sqrt(n * base * (1 - base)))


def fit_classifier(slots: list[np.ndarray], target: np.ndarray, rounds: int = 60, penalty: float = 2e-4, rate: float = 0.1) -> tuple[np.ndarray, float]:
    """Logistic regression on the held slots by Adam over fixed batches; weights and intercept."""
    n = len(slots)
    weights, moment, square = np.zeros(SLOTS + 1), np.zeros(SLOTS + 1), np.zeros(SLOTS + 1)
    telling = telling_slots(slots, target)
    slots = [np.append(s[telling[s]], SLOTS) for s in slots]
    order = np.random.default_rng(5).permutation(n)
    step = 0
    for _ in range(rounds):
        for start in range(0, n, 512):
            batch = order[start:start + 512]
            held = np.concatenate([slots[i] for i in batch])
            row = np.repeat(np.arange(len(batch)), [len(slots[i]) for i in batch])
            odds = np.bincount(row, weights[held], minlength=len(batch))
            miss = 1 / (1 + np.exp(-np.clip(odds, -30, 30))) - target[batch]
            touched, place = np.unique(held, return_inverse=True)
            slope = np.bincount(place, miss[row]) / len(batch) + penalty / 10 * weights[touched]
            step += 1
            moment[touched] = 0.9 * moment[touched] + 0.1 * slope
            square[touched] = 0.99 * square[touched] + 0.01 * slope**2
            weights[touched] -= rate / (1 + 0.01 * step) ** 0.5 * moment[touched] / (np.sqrt(square[touched]) + 1e-6)
    return weights[:SLOTS].astype(np.float32), float(weights[SLOTS])


def train(docs: DataFrame, labels: DataFrame, most_labelled: int = MAX_LABELLED) -> tuple[np.ndarray, float]:
    ids = write_stage(labelled_ids(labels, most_labelled), "toxicity-labelled")
    slots, said, label = sample(docs, ids)
    if not len(slots):
        return np.zeros(SLOTS, dtype=np.float32), 0.0
    entries = choose_lexicon(slots, label)
    counts = write_stage(vote_counts(docs, ids, entries), "toxicity-votes")
    model = fit_label_model(counts, len(entries) + N_PATTERNS)
    votes = np.concatenate([np.array([np.isin(entries, s) for s in slots]).reshape(len(slots), -1), said], axis=1)
    return fit_classifier(slots, model.posterior(votes.astype(float), label))


def _scorer(learned):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights, intercept = learned.value
        slots, known = WordSlots(), {}
        for texts in batches:
            out = np.empty(len(texts))
            for i, text in enumerate(texts):
                # Distinct slots, as in training; words whose slots all weigh nothing are skipped at once.
                held: set[int] = set()
                for word in text_words(text):
                    mine = known.get(word)
                    if mine is None:
                        if len(known) >= _CACHED_WORDS:
                            known.clear()
                        mine = known[word] = tuple(s for s in slots[word] if weights[s])
                    held.update(mine)
                out[i] = intercept + (float(weights[np.fromiter(held, dtype=np.int64, count=len(held))].sum(dtype=np.float64)) if held else 0.0)
            yield pd.Series(1 / (1 + np.exp(-np.clip(out, -30, 30))))

    return run


def with_scores(docs: DataFrame, learned: tuple[np.ndarray, float]) -> DataFrame:
    """``docs`` with ``score``, higher where a toxic label is likelier."""
    sent = docs.sparkSession.sparkContext.broadcast(learned)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from _scorer(sent)(batches)

    return docs.withColumn("score", score("text"))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    scored = with_scores(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted")
    )
