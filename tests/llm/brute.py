"""Plain Python versions of the corpus contracts, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def crc(doc) -> int:
    return zlib.crc32(str(doc).encode())


def substring_dedup(docs, window=50):
    first: dict = {}
    words = [(i, WORD.findall(t or "")) for i, t in docs]
    for i, w in words:
        if i is not None:
            for s in range(len(w) - window + 1):
                k = tuple(w[s:s + window])
                first[k] = min(first.get(k, i), i)
    out = []
    for i, w in words:
        gone = set()
        for s in range(len(w) - window + 1):
            if i is not None and first[tuple(w[s:s + window])] < i:
                gone.update(range(s, s + window))
        out.append((i, len(w), len(gone), sha(" ".join(x for n, x in enumerate(w) if n not in gone))))
    return out


def decontamination(docs, items, window=10):
    held = defaultdict(set)
    for i, t in items:
        w = TOKEN.findall((t or "").translate(SMALL))
        if w:
            for s in range(max(1, len(w) - window + 1)):
                held[tuple(w[s:s + window])].add("" if i is None else str(i))
    sizes = {len(k) for k in held}
    out = []
    for i, t in docs:
        w = TOKEN.findall((t or "").translate(SMALL))
        hit, found = set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if (k := tuple(w[s:s + n])) in held:
                    hit.update(range(s, s + n))
                    found |= held[k]
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def quality_base(docs):
    out = []
    for i, t in docs:
        t = t or ""
        w = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        windows = Counter(tuple(w[s:s + 8]) for s in range(len(w) - 7))
        covered = set()
        for s in range(len(w) - 7):
            if windows[tuple(w[s:s + 8])] > 1:
                covered.update(range(s, s + 8))
        failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
        out.append((i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered), failed))
    return out


def near_components(docs, similar=85):
    sets, root = defaultdict(list), {}
    for i, t in docs:
        w = WORD.findall((t or "").translate(SMALL))
        sets[i].append({tuple(w[s:s + 5]) for s in range(max(1, len(w) - 4))} if w else set())
        root[i] = i

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    known = [(i, s) for i in sorted(x for x in sets if x is not None) for s in sets[i] if s]
    for n, (i, a) in enumerate(known):
        for j, b in known[:n]:
            both = len(a & b)
            if 100 * both >= similar * (len(a) + len(b) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (None if i is None else find(i)) for i in sets}, {i: [len(s) for s in v] for i, v in sets.items()}


def line_dedup(docs, chars=40, least=5):
    strip = " \t\n\x0b\x0c\r"
    held = defaultdict(set)
    for n, (i, t) in enumerate(docs):
        if i is not None:
            for line in (t or "").split("\n"):
                k = line.strip(strip).translate(SMALL)
                if len(k) >= chars:
                    held[k].add((i, n))
    out = []
    for i, t in docs:
        lines, kept = (t or "").split("\n"), []
        for line in lines:
            k = line.strip(strip).translate(SMALL)
            crowded = i is not None and len(k) >= chars and len(held[k]) >= least and i != max(held[k])[0]
            if not crowded:
                kept.append(line)
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def _whole(vector, dims=None) -> bool:
    return vector is not None and (dims is None or len(vector) == dims) and all(x is not None and math.isfinite(x) for x in vector)


def integers(vector) -> list[int]:
    most = 1 << 24
    return [math.floor(max(-most, min(most, 256 * x))) for x in vector]


def clustering(rows, k=40, rounds=5, dims=64) -> list[tuple]:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of rows (vec_id, vector)."""
    kept = [(i, integers(v)) for i, v in rows if _whole(v, dims)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [q for _, q in order[:k]]

    def nearest(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c)), n) for n, c in enumerate(centroids))

    for at in range(rounds + 1):
        placed = [(i, q, *nearest(q)) for i, q in kept]
        if at < rounds:
            for c in range(len(centroids)):
                mine = [q for _, q, _, n in placed if n == c]
                if mine:
                    centroids[c] = [sum(x) // len(mine) for x in zip(*mine)]
    inertia = Counter()
    for _, _, d, n in placed:
        inertia[n] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, n, d, inertia[n], sum(inertia.values()), digest[n]) for i, _, d, n in placed]


def hard_negatives(rows, every=50) -> list[tuple]:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of rows (vec_id, vector, label)."""
    part = [(i, integers(v), lab) for i, v, lab in rows if lab is not None and _whole(v)]
    last = lambda i: (i is None, i or 0)
    out = []
    for a, q, lab in part:
        if a is None or a % every:
            continue
        scored = [(i, sum(x * y for x, y in zip(q, p)), other == lab) for i, p, other in part]
        best = sorted([s for s in scored if s[2] and s[0] != a], key=lambda s: (-s[1], last(s[0])))[:5]
        for i, ps, _ in best:
            fitting = sorted([s for s in scored if not s[2] and 50 * ps <= 100 * s[1] <= 95 * ps], key=lambda s: (-s[1], last(s[0])))
            out += [(a, i, n + 1, s[0], ps, s[1]) for n, s in enumerate(fitting[:3])]
    return out


def url_rules(urls, rules) -> list[tuple]:
    """(host, path, rule, verdict) of each URL."""
    out = []
    small = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for url in urls:
        _, sep, rest = (url or "").partition("://")
        whole = re.split(r"[?#]", rest)[0] if sep else ""
        host, slash, path = whole.partition("/")
        host, path = host.translate(small), slash + path
        fit = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        out.append((host, path, *(max(fit)[2:] if fit else (None, "allow"))))
    return out
