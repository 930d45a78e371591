"""Gated recurrent language model with a class-factored output, and its score of whole documents.

Words are counted over all training documents by Spark. The ``HEAD`` most frequent words have places of their own in
the model; all other words, seen or not, belong to a few classes by their shape, and within such a class a word has its
add-one share of the class. The recurrent network gives the class of the next word, and within a class of frequent words
the word, each by a softmax of its own, so a step costs about the root of the vocabulary. It is trained by truncated
backpropagation in numpy on all training documents, each in one of the rounds. In a round the tasks that read the
documents learn side by side, so there are as many as the input has splits, and their parameters are averaged; the number
of rounds grows with the logarithm of the tokens. In learning, a document of more than ``SEGMENT`` tokens is learnt from
in parts of that length side by side, each from an empty state. In scoring, documents run side by side in lanes and the
state is carried from window to window, so a score is the log-likelihood of the complete document, however long. Texts
are turned into the model's tokens once, in a written table that learning and scoring read.

Counts of the ``KNOWN`` most frequent words travel to the scoring tasks (some 30 MB at most); counts of all others are
joined. Parameters are averaged as whole numbers, so the order in which tasks end does not matter.

Null and empty texts are the end token alone. Rows with a null doc_id are scored and not learned from. Repeated rows
count as often as they occur and get equal scores. Words of equal counts are numbered in their own order. Without training
documents only the uniform base is left and both scores are that. A table without rows gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratescope.llm.common import utf8, write_stage

HEAD = 1024
KNOWN = 300_000
HIDDEN = 24
WINDOW = 16
LANES = 256
#: Rounds that deal all training documents out among themselves, at least; one more with every doubling of the tokens beyond.
ROUNDS = 3
ROUND_TOKENS = 15_000_000
#: Tokens of the documents that a task holds side by side.
PORTION = 4_000_000
#: Tokens of a document that are learnt from in one lane.
SEGMENT = 2_048
#: Classes of words beyond the head: letters only or not, ASCII or not, four lengths.
SHAPES = 16

_COUNTS = "word binary, n bigint"
#: Tokens are numbers of 16 bits, which holds some 30,000 words of the head.
_NUMBERED = (
    "row bigint, doc_id bigint, n_tokens bigint, n_known bigint, base double, share double, tokens binary, rare array<struct<word: binary, n: int>>"
)
_PIECE = "piece int, tokens bigint, values array<bigint>"
_PIECE_SIZE = 4096
#: Parameters times tokens are summed in steps of one over this.
_FINE = 1 << 16


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def token_words(text) -> list[bytes]:
    return utf8(text).lower().split()


def shape(word: bytes) -> int:
    """Class of a word beyond the head, from its letters and length."""
    ascii_ = word.isascii()
    letters = word.isalpha() if ascii_ else word.decode("utf-8", "replace").isalpha()
    n = len(word)
    return (not ascii_) * 8 + letters * 4 + (0 if n <= 4 else 1 if n <= 7 else 2 if n <= 10 else 3)


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: Counter = Counter()
    for batch in batches:
        for text in batch["text"]:
            held.update(token_words(text))
        if len(held) > 400_000:
            yield pd.DataFrame({"word": list(held.keys()), "n": list(held.values())})
            held = Counter()
    if held:
        yield pd.DataFrame({"word": list(held.keys()), "n": list(held.values())})


@dataclass
class Vocabulary:
    """Frequent words and what is known of the classes of all others.

    ``places`` numbers the known words, the head first; ``known_tokens`` and ``known_logs`` hold the model's token and
    the log10 of count + 1 under that number.
    """

    places: dict[bytes, int]
    known_tokens: np.ndarray
    known_logs: np.ndarray
    n_head: int
    n_docs: int
    tokens: int
    types: int
    shape_tokens: np.ndarray
    shape_types: np.ndarray
    head_counts: np.ndarray


def word_counts(training: DataFrame) -> DataFrame:
    counted = training.select("text").mapInPandas(_count, _COUNTS).groupBy("word").agg(F.sum("n").alias("n"))
    return write_stage(counted, "word-counts")


def _shape_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    tokens, types = np.zeros(SHAPES, dtype=np.int64), np.zeros(SHAPES, dtype=np.int64)
    for batch in batches:
        at = np.fromiter((shape(bytes(w)) for w in batch["word"]), dtype=np.int64, count=len(batch))
        tokens += np.bincount(at, batch["n"], minlength=SHAPES).astype(np.int64)
        types += np.bincount(at, minlength=SHAPES)
    yield pd.DataFrame({"shape": np.arange(SHAPES), "tokens": tokens, "types": types})


def vocabulary(counts: DataFrame, n_docs: int, head: int = HEAD, known: int = KNOWN) -> Vocabulary:
    total = counts.agg(F.sum("n"), F.count("*")).first()
    tokens, types = int(total[0] or 0) + n_docs, int(total[1]) + (1 if n_docs else 0)
    top = counts.orderBy(F.col("n").desc(), "word").limit(known).toArrow()
    words = [bytes(w) for w in top.column("word").to_pylist()]
    numbers = top.column("n").to_numpy().astype(np.int64)
    sums = counts.mapInPandas(_shape_sums, "shape int, tokens bigint, types bigint").groupBy("shape").agg(F.sum("tokens"), F.sum("types")).collect()
    shape_tokens, shape_types = np.zeros(SHAPES), np.zeros(SHAPES)
    for at, n, kinds in sums:
        shape_tokens[at], shape_types[at] = n, kinds
    for word, n in zip(words[:head], numbers[:head]):
        shape_tokens[shape(word)] -= n
        shape_types[shape(word)] -= 1
    at = np.array([i if i < head else min(head, len(words)) + shape(w) for i, w in enumerate(words)], dtype=np.int32)
    return Vocabulary(
        {w: i for i, w in enumerate(words)}, at, np.log10(numbers + 1.0), min(head, len(words)), n_docs, tokens, types,
        shape_tokens, shape_types, numbers[:head].astype(float),
    )


def run_sums(rows: np.ndarray, starts: np.ndarray, long: int = 8) -> np.ndarray:
    """Sums of the runs of rows that begin at ``starts``: a long run as a product with ones, short ones row by row side by side."""
    n = np.diff(starts, append=len(rows))
    out = rows[starts]
    for i in np.flatnonzero(n >= long).tolist():
        out[i] = np.ones(n[i], rows.dtype) @ rows[starts[i]:starts[i] + n[i]]
    short = np.flatnonzero(n < long)
    for place in range(1, long - 1):
        short = short[n[short] > place]
        out[short] += rows[starts[short] + place]
    return out


class Network:
    """One gated recurrent layer. Outputs: head classes, then shapes, then the end; then the word within a head class."""

    NAMES = ("inputs", "loop", "bias", "to_class", "class_bias", "to_word", "word_bias")

    def __init__(self, head_counts: np.ndarray, shape_tokens: np.ndarray, n_docs: int, hidden: int = HIDDEN):
        self.n_head = len(head_counts)
        self.width = max(1, math.isqrt(max(1, self.n_head)))
        self.classes = -(-self.n_head // self.width)
        self.end = self.classes + SHAPES
        self.hidden = hidden
        #: Tokens learned from.
        self.seen = 0
        # Head words are numbered by frequency, so a class is a run of similar frequencies. One more input starts a text.
        rng = np.random.default_rng(9)
        n_inputs = self.n_head + SHAPES + 1
        small = lambda *shape_: rng.normal(0, 0.15, shape_).astype(np.float32)
        padded = np.zeros(self.classes * self.width)
        padded[: self.n_head] = head_counts
        by_class = padded.reshape(self.classes, self.width) if self.classes else padded.reshape(0, self.width)
        start = np.concatenate([by_class.sum(axis=1), shape_tokens, [n_docs]]) + 0.5
        word_start = np.log(by_class + 0.5)
        word_start[by_class == 0] = -30
        self.inputs, self.loop = small(n_inputs, 3 * hidden), small(hidden, 3 * hidden)
        self.bias = np.zeros(3 * hidden, dtype=np.float32)
        self.to_class = small(hidden, self.end + 1) / 3
        self.class_bias = (np.log(start) - np.log(start.sum())).astype(np.float32)
        self.to_word = small(self.classes, hidden, self.width) / 3
        self.word_bias = (word_start - np.log(np.exp(word_start).sum(axis=1, keepdims=True) + 1e-30)).astype(np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES])

    def load(self, values: np.ndarray) -> None:
        at = 0
        for name in self.NAMES:
            old = getattr(self, name)
            setattr(self, name, values[at:at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size

    def by_gate(self, values: np.ndarray) -> np.ndarray:
        """The last axis cut by gate, gates first, so that what belongs to a gate lies together."""
        return np.ascontiguousarray(np.moveaxis(values.reshape(*values.shape[:-1], 3, self.hidden), -2, 0))

    def step(self, h: np.ndarray, given: np.ndarray) -> tuple:
        """New state and the gates it came from; ``given`` is what the inputs contribute."""
        return self.gated(h, self.by_gate(given), self.by_gate(self.loop))

    @staticmethod
    def gated(h: np.ndarray, given: np.ndarray, loop: np.ndarray) -> tuple:
        """The same with ``given`` and ``loop`` by gate."""
        looped = np.matmul(h, loop)
        gates = looped[:2] + given[:2]
        np.negative(gates, out=gates)
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        reset, keep = gates
        fresh = reset * looped[2]
        fresh += given[2]
        np.tanh(fresh, out=fresh)
        new = h - fresh
        new *= keep
        new += fresh
        return new, reset, keep, fresh, looped[2]

    def targets(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class and place within it (-1 outside the head); tokens: head word, n_head + shape, or n_head + SHAPES for the end."""
        in_head = tokens < self.n_head
        which = np.where(in_head, tokens // self.width, tokens - self.n_head + self.classes)
        return which, np.where(in_head, tokens % self.width, -1)

    @staticmethod
    def _powers(logits: np.ndarray, ones: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Powers of the logits and their sums; without ``ones`` each row against its largest, so that nothing overflows."""
        if ones is None:
            logits -= logits.max(axis=1, keepdims=True)
            powers = np.exp(logits)
            return powers, powers.sum(axis=1)
        powers = np.exp(logits)
        return powers, powers @ ones[: logits.shape[1]]

    def _log_share(self, logits: np.ndarray, chosen: np.ndarray, ones: np.ndarray | None) -> np.ndarray:
        """Natural log of the softmax at one place per row."""
        _, sums = self._powers(logits, ones)
        return logits[np.arange(len(chosen)), chosen] - np.log(sums)

    def _miss(self, logits: np.ndarray, chosen: np.ndarray, ones: np.ndarray | None) -> np.ndarray:
        """Softmax, less one at the chosen place."""
        powers, sums = self._powers(logits, ones)
        powers *= np.reciprocal(sums)[:, None]
        powers[np.arange(len(chosen)), chosen] -= 1
        return powers

    def _ones(self, like: np.ndarray) -> np.ndarray:
        return np.ones(max(self.end + 1, self.width), dtype=like.dtype)

    def log_likelihood(self, states: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """Natural log of the probability of each token after its state."""
        with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
            out = self._log_likelihood(states, tokens, self._ones(states))
        return out if np.isfinite(out).all() else self._log_likelihood(states, tokens, None)

    def _log_likelihood(self, states: np.ndarray, tokens: np.ndarray, ones: np.ndarray | None) -> np.ndarray:
        which, place = self.targets(tokens)
        order, cuts = self._by_class(which, place)
        held = self._with_one(states, order)
        likely = self._log_share(held @ np.concatenate([self.to_class, self.class_bias[None]]), which[order], ones)
        inner = self._inner_logits(held, cuts)
        likely[: len(inner)] += self._log_share(inner, place[order[: len(inner)]], ones)
        out = np.empty_like(likely)
        out[order] = likely
        return out

    def _by_class(self, which: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """Rows in the order of their head class, those without a place last, and where each class begins and the last ends."""
        kind = np.where(place >= 0, which, self.classes).astype(np.int16)
        order = np.argsort(kind, kind="stable")
        return order, np.searchsorted(kind[order], np.arange(self.classes + 1)).tolist()

    @staticmethod
    def _with_one(states: np.ndarray, order: np.ndarray) -> np.ndarray:
        """States in order, each with a one behind it that takes the bias in."""
        held = np.ones((len(order), states.shape[1] + 1), states.dtype)
        held[:, :-1] = states.take(order, axis=0)
        return held

    def _inner_logits(self, held: np.ndarray, cuts: list[int]) -> np.ndarray:
        """Logits of the words within their class, for the rows that lie in a head class."""
        words = np.concatenate([self.to_word, self.word_bias[:, None]], axis=1)
        logits = np.empty((cuts[-1], self.width), np.result_type(held, words))
        for c, (start, end) in enumerate(zip(cuts, cuts[1:])):
            if start < end:
                np.matmul(held[start:end], words[c], out=logits[start:end])
        return logits

    def gradients(self, states: np.ndarray, tokens: np.ndarray, used: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the outputs, and with respect to the states; ``used`` marks the rows that hold a token."""
        with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
            grads, back = self._gradients(states, tokens, used, self._ones(states))
        return (grads, back) if np.isfinite(back).all() else self._gradients(states, tokens, used, None)

    def _gradients(self, states: np.ndarray, tokens: np.ndarray, used: np.ndarray, ones: np.ndarray | None) -> tuple[dict, np.ndarray]:
        which, place = self.targets(tokens)
        order, cuts = self._by_class(which, np.where(used, place, -1))
        share = 1.0 / max(1, used.sum())
        held = self._with_one(states, order)
        slope = self._miss(held @ np.concatenate([self.to_class, self.class_bias[None]]), which[order], ones)
        slope *= (used[order] * share).astype(slope.dtype)[:, None]
        classes = held.T @ slope
        back = slope @ self.to_class.T
        inner = self._inner_logits(held, cuts)
        inner = self._miss(inner, place[order[: len(inner)]], ones)
        inner *= share
        words = np.zeros((self.classes, self.hidden + 1, self.width), inner.dtype)
        for c, (start, end) in enumerate(zip(cuts, cuts[1:])):
            if start < end:
                np.matmul(held[start:end].T, inner[start:end], out=words[c])
                back[start:end] += inner[start:end] @ self.to_word[c].T
        grads = {"to_class": classes[:-1], "class_bias": classes[-1], "to_word": words[:, :-1], "word_bias": words[:, -1]}
        placed = np.empty_like(back)
        placed[order] = back
        return grads, placed

    def window_gradients(self, h: np.ndarray, inputs: np.ndarray, tokens: np.ndarray, used: np.ndarray, fresh: np.ndarray) -> tuple[dict, np.ndarray, np.ndarray]:
        """Gradients of the mean loss over a window (steps x lanes), the rows of ``inputs`` they belong to, and the last state.

        ``h`` is the state before the window, through which nothing goes back; where ``fresh`` is set a document begins and
        the state before it is nothing.
        """
        k, (steps, lanes) = self.hidden, inputs.shape
        flat_inputs = inputs.ravel()
        given = self.by_gate(self.inputs + self.bias).take(flat_inputs, axis=1).reshape(3, steps, lanes, k)
        loop, kind = self.by_gate(self.loop), given.dtype
        before, states = np.empty((steps, lanes, k), kind), np.empty((steps, lanes, k), kind)
        parts = []
        begins = fresh.any(axis=1)
        for t in range(steps):
            before[t] = h
            if begins[t]:
                before[t][fresh[t]] = 0
            h, *part = self.gated(before[t], given[:, t], loop)
            states[t] = h
            parts.append(part)
        grads, back = self.gradients(states.reshape(-1, k), tokens.ravel(), used.ravel())
        back = back.reshape(steps, lanes, k)
        slopes = np.empty((steps, 3, lanes, k), kind)  # with respect to what the inputs give
        through = np.empty((steps, 3, lanes, k), kind)  # with respect to what the loop gives
        later = np.zeros((lanes, k), kind)
        looped_back = loop.transpose(0, 2, 1)
        for t in range(steps - 1, -1, -1):
            reset, keep, new_part, looped = parts[t]
            to_reset, to_keep, to_fresh = slopes[t]
            slope = back[t]
            slope += later
            rest = 1 - keep
            np.multiply(new_part, new_part, out=to_fresh)
            np.subtract(1, to_fresh, out=to_fresh)
            to_fresh *= rest
            to_fresh *= slope
            np.subtract(1, reset, out=to_reset)
            to_reset *= reset
            to_reset *= looped
            to_reset *= to_fresh
            np.subtract(before[t], new_part, out=to_keep)
            to_keep *= keep
            to_keep *= rest
            to_keep *= slope
            through[t, :2] = slopes[t, :2]
            np.multiply(to_fresh, reset, out=through[t, 2])
            slope *= keep
            later = np.matmul(through[t], looped_back).sum(axis=0)
            later += slope
            if begins[t]:
                later[fresh[t]] = 0
        order = np.argsort(flat_inputs.astype(np.int16), kind="stable")
        sorted_ = flat_inputs[order]
        starts = np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1]])
        rows = np.ascontiguousarray(slopes.transpose(0, 2, 1, 3)).reshape(-1, 3 * k).take(order, axis=0)
        by_input = run_sums(rows, starts)
        by_loop = np.matmul(before.transpose(0, 2, 1)[:, None], through).sum(axis=0)
        grads |= {
            "loop": np.moveaxis(by_loop, 0, 1).reshape(k, 3 * k), "bias": by_input.sum(axis=0), "inputs": by_input,
        }
        return grads, sorted_[starts], h


class Lanes:
    """Documents side by side, several after one another in a lane; longer lanes first, so those that go on are a prefix."""

    def __init__(self, tokens: np.ndarray, lengths: np.ndarray, start_input: int, lanes: int = LANES):
        lanes = min(lanes, max(1, len(lengths)))
        loads = [(0, lane) for lane in range(lanes)]
        lane_of, begin = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        for i in np.argsort(-lengths, kind="stable").tolist():
            load, lane = loads[0]
            lane_of[i], begin[i] = lane, load
            heapq.heapreplace(loads, (load + int(lengths[i]), lane))
        size = np.zeros(lanes, np.int64)
        for load, lane in loads:
            size[lane] = load
        rank = np.empty(lanes, np.int64)
        rank[np.argsort(-size, kind="stable")] = np.arange(lanes)
        self.sizes, lane_of = np.sort(size)[::-1], rank[lane_of]
        shape_ = (int(self.sizes[0]), lanes)
        self.tokens, self.owners = np.zeros(shape_, np.int32), np.full(shape_, -1, np.int32)
        self.inputs, self.fresh = np.full(shape_, start_input, np.int32), np.zeros(shape_, bool)
        starts = np.cumsum(lengths) - lengths
        within = np.arange(len(tokens)) - np.repeat(starts, lengths)
        row, column = np.repeat(begin, lengths) + within, np.repeat(lane_of, lengths)
        self.tokens[row, column] = tokens
        self.owners[row, column] = np.repeat(np.arange(len(lengths)), lengths)
        self.inputs[1:] = self.tokens[:-1]
        self.inputs[begin, lane_of] = start_input
        self.fresh[begin, lane_of] = True

    def windows(self, size: int) -> Iterator[tuple]:
        """How many lanes go on, and inputs, tokens, owners (-1: idle) and beginnings of the next ``size`` steps."""
        for at in range(0, len(self.tokens), size):
            n = int(np.searchsorted(-self.sizes, -at, side="left"))
            yield n, *(m[at:at + size, :n] for m in (self.inputs, self.tokens, self.owners, self.fresh))


@dataclass
class Portion:
    """Texts as the model's tokens, one after another: lengths, numbers of the words (-1: not known), unknown words by text."""

    tokens: np.ndarray
    lengths: np.ndarray
    numbers: np.ndarray
    unknown: list[list[bytes]]


def portions(texts, vocabulary: Vocabulary, shapes: dict, most: int = PORTION) -> Iterator[Portion]:
    """Texts in turn, together some ``most`` tokens at a time; a longer text is a portion of its own."""
    get, held, unknown, n = vocabulary.places.get, [], [], 0

    def portion() -> Portion:
        numbers = np.concatenate(held)
        lengths = np.fromiter(map(len, held), np.int64, len(held))
        tokens = vocabulary.known_tokens[numbers] if len(vocabulary.known_tokens) else np.zeros(len(numbers), np.int32)
        beyond = numbers < 0
        beyond[np.cumsum(lengths) - 1] = False
        tokens[beyond] = [_shape_token(w, vocabulary.n_head, shapes) for words in unknown for w in words]
        tokens[np.cumsum(lengths) - 1] = vocabulary.n_head + SHAPES
        return Portion(tokens, lengths, numbers, unknown)

    for text in texts:
        words = token_words(text)
        if held and n + len(words) >= most:
            yield portion()
            held, unknown, n = [], [], 0
        found = [get(w, -1) for w in words]
        found.append(-1)  # the end
        numbers = np.array(found, dtype=np.int32)
        held.append(numbers)
        unknown.append([words[i] for i in np.flatnonzero(numbers[:-1] < 0).tolist()])
        n += len(numbers)
    if held:
        yield portion()


def _shape_token(word: bytes, n_head: int, shapes: dict) -> int:
    kind = shapes.get(word)
    if kind is None:
        if len(shapes) > 300_000:
            shapes.clear()
        kind = shapes[word] = n_head + shape(word)
    return kind


def learn(network: Network, tokens: np.ndarray, lengths: np.ndarray, moments: dict, rate: float, window: int = WINDOW, lanes: int = LANES) -> int:
    """Truncated backpropagation by Adam through all documents; the state goes on from window to window.

    Few tokens make narrow windows, so that there are some hundred of them to learn by. A window that is partly idle, as
    those are in which only the longest documents go on, moves the parameters by its share of a full one.
    """
    seen = 0
    lanes = min(lanes, max(8, len(tokens) // (window * LANES)))
    running = Lanes(tokens, lengths, network.n_head + SHAPES, lanes)
    h = np.zeros((running.tokens.shape[1], network.hidden), dtype=np.float32)
    full = rate / (window * lanes)
    for n, inputs, wanted, owners, fresh in running.windows(window):
        used = owners >= 0
        rate = full * int(used.sum())
        grads, rows, h = network.window_gradients(h[:n], inputs, wanted, used, fresh)
        moments["step"] += 1
        for name, g in grads.items():
            _adam(getattr(network, name), g, moments, name, rows if name == "inputs" else slice(None), rate)
        seen += int(used.sum())
    return seen


def _adam(values: np.ndarray, slope: np.ndarray, moments: dict, name: str, rows, rate: float) -> None:
    if name not in moments:
        moments[name] = (np.zeros_like(values), np.zeros_like(values))
    first, second = moments[name]
    slope = np.clip(slope, -1, 1)
    mean, square = first[rows], second[rows]
    mean = mean * 0.9
    mean += 0.1 * slope
    first[rows] = mean
    slope *= slope
    slope *= 0.02
    square = square * 0.98
    square += slope
    second[rows] = square
    steps = moments["step"]
    square *= 1 / (1 - 0.98**steps)
    np.sqrt(square, out=square)
    square += 1e-6
    mean *= rate / (1 - 0.9**steps)
    mean /= square
    values[rows] -= mean


def _number(sent):
    """Texts as tokens, with what the counts say of them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary: Vocabulary = sent.value
        shapes: dict = {}
        log_base = math.log10(vocabulary.tokens + vocabulary.types + 1)
        end_log, n_head = math.log10(vocabulary.n_docs + 1), vocabulary.n_head
        rest = np.append(np.log10(vocabulary.shape_tokens + vocabulary.shape_types + 1), 0.0)
        for batch in batches:
            begin = 0
            for p in portions(batch["text"], vocabulary, shapes):
                n = len(p.lengths)
                of = np.repeat(np.arange(n), p.lengths)
                held, apart = p.numbers >= 0, p.tokens >= n_head
                logs = np.zeros(len(of))
                logs[held] = vocabulary.known_logs[p.numbers[held]]
                # A word beyond the head has its share of its class.
                share = np.bincount(of[apart], logs[apart] - rest[p.tokens[apart] - n_head], minlength=n)
                rows, begin = batch.iloc[begin:begin + n], begin + n
                yield pd.DataFrame({
                    "row": rows["row"].to_numpy(), "doc_id": rows["doc_id"].astype("Int64").array, "n_tokens": p.lengths,
                    "n_known": np.bincount(of[held], minlength=n) + int(vocabulary.n_docs > 0),
                    "base": end_log + np.bincount(of, logs, minlength=n) - p.lengths * log_base, "share": share,
                    "tokens": [t.tobytes() for t in np.split(p.tokens.astype(np.int16), np.cumsum(p.lengths)[:-1])],
                    "rare": [[{"word": w, "n": c} for w, c in Counter(words).items()] for words in p.unknown],
                })

    return run


def numbered(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id and text as tokens. A written row keeps its number, so rows that repeat a doc_id stay apart."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return write_stage(rows.mapInPandas(_number(sent), _NUMBERED), "numbered-documents")


def _held_tokens(each, most: int = PORTION) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Tokens and lengths of documents, together some ``most`` tokens at a time."""
    held, n = [], 0
    for document in each:
        tokens = np.frombuffer(document, np.int16)
        if held and n + len(tokens) > most:
            yield np.concatenate(held), np.fromiter(map(len, held), np.int64, len(held))
            held, n = [], 0
        held.append(tokens)
        n += len(tokens)
    if held:
        yield np.concatenate(held), np.fromiter(map(len, held), np.int64, len(held))


def in_segments(lengths: np.ndarray, most: int = SEGMENT) -> np.ndarray:
    """Lengths of the parts that documents are cut into."""
    parts = -(-lengths // most)
    out = np.full(int(parts.sum()), most, np.int64)
    out[np.cumsum(parts) - 1] = lengths - (parts - 1) * most
    return out


def _trainer(sent, rate: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        network: Network = sent.value
        moments, seen = {"step": 0}, 0
        for tokens, lengths in _held_tokens(t for batch in batches for t in batch["tokens"]):
            seen += learn(network, tokens, in_segments(lengths), moments, rate)
        if seen:
            values = np.rint(network.flat().astype(np.float64) * seen * _FINE).astype(np.int64)
            starts = range(0, len(values), _PIECE_SIZE)
            yield pd.DataFrame({
                "piece": np.arange(len(starts), dtype=np.int32), "tokens": seen, "values": [values[s:s + _PIECE_SIZE] for s in starts],
            })

    return run


def _summed_pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: dict[int, list] = {}
    for batch in batches:
        for piece, tokens, values in zip(batch["piece"], batch["tokens"], batch["values"]):
            before = held.setdefault(piece, [0, 0])
            held[piece] = [before[0] + tokens, before[1] + values]
    if held:
        yield pd.DataFrame({"piece": list(held), "tokens": [n for n, _ in held.values()], "values": [v for _, v in held.values()]})


def train(training: DataFrame, vocabulary: Vocabulary, rounds: int | None = None) -> Network:
    """Each round learns from other documents, side by side where they are read; together they learn from all of ``training``."""
    spark = training.sparkSession
    network = Network(vocabulary.head_counts, vocabulary.shape_tokens, vocabulary.n_docs)
    rounds = rounds or max(ROUNDS, math.ceil(math.log2(max(1.0, vocabulary.tokens / ROUND_TOKENS))))
    turn = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(rounds))
    pieces = -(-len(network.flat()) // _PIECE_SIZE)
    for at in range(rounds):
        sent = spark.sparkContext.broadcast(network)
        parts = training.where(turn == at).select("tokens").mapInPandas(_trainer(sent, 0.01 / (1 + at)), _PIECE)
        # A task adds the pieces of its numbers up as they come, so it holds a sum or two, however many trainers there are.
        got = parts.repartition(pieces, "piece").mapInPandas(_summed_pieces, _PIECE).toPandas().sort_values("piece")
        if len(got):
            tokens = int(got["tokens"].iloc[0])
            network.load(np.concatenate(got["values"].tolist()) / (float(tokens) * _FINE))
            network.seen += tokens
    return network


def score_documents(network: Network, tokens: np.ndarray, lengths: np.ndarray, window: int = 32, lanes: int = LANES) -> np.ndarray:
    """Natural log-likelihood of each document over classes and head words."""
    out = np.zeros(len(lengths))
    running = Lanes(tokens, lengths, network.n_head + SHAPES, lanes)
    k = network.hidden
    h = np.zeros((running.tokens.shape[1], k), dtype=np.float32)
    by_gate, loop = network.by_gate(network.inputs + network.bias), network.by_gate(network.loop)
    for n, inputs, wanted, owners, fresh in running.windows(window):
        given = by_gate.take(inputs.ravel(), axis=1).reshape(3, len(inputs), n, k)
        states = np.empty((len(inputs), n, k), np.float32)
        begins = fresh.any(axis=1)
        h = h[:n]
        for t in range(len(inputs)):
            if begins[t]:
                h = np.where(fresh[t][:, None], np.float32(0), h)
            h = states[t] = network.gated(h, given[:, t], loop)[0]
        states, wanted, owners = states.reshape(-1, k), wanted.ravel(), owners.ravel()
        used = owners >= 0
        if not used.all():
            states, wanted, owners = states[used], wanted[used], owners[used]
        out += np.bincount(owners, network.log_likelihood(states, wanted), minlength=len(out))
    return out


def report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    learns = F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    training = docs.select("doc_id", "text").where(learns)
    counts = word_counts(training)
    known = vocabulary(counts, training.count())
    tokens = numbered(docs, known)
    network = train(tokens.where(learns), known) if known.n_docs else Network(known.head_counts, known.shape_tokens, 0)
    sent = docs.sparkSession.sparkContext.broadcast(network)

    @F.pandas_udf("double")
    def likelihood(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            found = [score_documents(sent.value, t, n) / math.log(10) for t, n in _held_tokens(batch)]
            yield pd.Series(np.concatenate(found) if found else np.empty(0))

    seen = tokens.select("row", F.inline("rare")).join(counts.toDF("_word", "count"), F.col("word") == F.col("_word"))
    gains = seen.groupBy(F.col("row").alias("_row")).agg(
        F.sum(F.col("n") * F.log10(F.col("count") + 1)).alias("gain"), F.sum("n").alias("hits")
    )
    gain = F.coalesce("gain", F.lit(0.0))
    scored = tokens.select("row", "doc_id", "n_tokens", "n_known", "base", "share", likelihood("tokens").alias("likely"))
    model = F.col("likely") + F.col("share") if known.n_docs else F.col("base")
    return scored.join(gains, F.col("row") == F.col("_row"), "left").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("hits", F.lit(0))).alias("n_known"), F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + gain).alias("base_score"), (model + gain).alias("score"),
    )
