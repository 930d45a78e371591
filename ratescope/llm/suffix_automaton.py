"""Suffix automaton over word sequences, and the streaming of documents through it."""

from __future__ import annotations

import numpy as np


class SuffixAutomaton:
    """Suffix automaton over the word sequences of many items, with the items each passage belongs to."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.word_ids: dict[bytes, int] = {}
        self.go: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        sequences = []
        for name, words in items:
            if words:
                sequences.append((name, [self.word_ids.setdefault(w, len(self.word_ids)) for w in words]))
        self.shortest = min((min(len(s), window) for _, s in sequences), default=window)
        for _, sequence in sequences:
            last = 0
            for word in sequence:
                last = self._extend(last, word)
        self.names = sorted({name for name, _ in sequences})
        self._mark(sequences)

    def _extend(self, last: int, word: int) -> int:
        known = self.go[last].get(word)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, word, known)
        new = self._state(self.length[last] + 1, {})
        at = last
        while at >= 0 and word not in self.go[at]:
            self.go[at][word] = new
            at = self.link[at]
        if at < 0:
            self.link[new] = 0
        else:
            other = self.go[at][word]
            self.link[new] = other if self.length[other] == self.length[at] + 1 else self._split(at, word, other)
        return new

    def _state(self, length: int, go: dict[int, int]) -> int:
        self.go.append(go)
        self.length.append(length)
        self.link.append(0)
        return len(self.go) - 1

    def _split(self, at: int, word: int, other: int) -> int:
        """A shorter twin of ``other`` for the passages that end in more places."""
        twin = self._state(self.length[at] + 1, dict(self.go[other]))
        self.link[twin] = self.link[other]
        self.link[other] = twin
        while at >= 0 and self.go[at].get(word) == other:
            self.go[at][word] = twin
            at = self.link[at]
        return twin

    def _mark(self, sequences) -> None:
        """Which items hold the passages of a state, and which short items end there."""
        self.holders: dict[int, set[str]] = {}
        self.short: dict[int, list[tuple[int, str]]] = {}
        for name, sequence in sequences:
            at = 0
            for word in sequence:
                at = self.go[at][word]
                up = at
                while up > 0 and self.length[up] >= self.window:
                    held = self.holders.setdefault(up, set())
                    if name in held:
                        break
                    held.add(name)
                    up = self.link[up]
            if len(sequence) < self.window:
                while self.length[self.link[at]] >= len(sequence):
                    at = self.link[at]
                ending = self.short.setdefault(at, [])
                if (len(sequence), name) not in ending:
                    ending.append((len(sequence), name))

    def _at_window(self, state: int) -> int:
        """The state of the last ``window`` words of a longer match."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def _runs(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Stretches of item words long enough to hold a window; nothing else can match."""
        known = np.concatenate(([0], (ids >= 0).view(np.int8), [0]))
        edge = np.flatnonzero(np.diff(known))
        starts, ends = edge[::2], edge[1::2]
        long = ends - starts >= self.shortest
        return list(zip(starts[long].tolist(), ends[long].tolist()))

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], list[str]]:
        """Maximal runs of hit words as [start, end), and the names of the items hit."""
        if not self.word_ids or len(words) < self.shortest:
            return [], []
        get = self.word_ids.get
        ids = np.array([get(w, -1) for w in words], dtype=np.int32)
        spans: list[list[int]] = []
        names: set[str] = set()
        for begin, end in self._runs(ids):
            state, matched = 0, 0
            for place, word in enumerate(ids[begin:end].tolist(), begin):
                while state > 0 and word not in self.go[state]:
                    state = self.link[state]
                    matched = self.length[state]
                if word in self.go[state]:
                    state = self.go[state][word]
                    matched += 1
                reach = 0
                if matched >= self.window:
                    reach = self.window
                    names |= self.holders[self._at_window(state)]
                if self.short:
                    up = state
                    while up > 0:
                        for size, name in self.short.get(up, ()):
                            if size <= matched:
                                reach = max(reach, size)
                                names.add(name)
                        up = self.link[up]
                if reach:
                    first = place + 1 - reach
                    while spans and spans[-1][1] >= first:
                        first = min(first, spans.pop()[0])
                    spans.append([first, place + 1])
        return [(a, b) for a, b in spans], sorted(names)
