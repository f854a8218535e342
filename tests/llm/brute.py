"""Plain versions of the operators' results, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def repeats(docs: dict[int, str | None], window: int) -> dict[int, tuple[int, int, str]]:
    """n_words, n_removed, sha256 of every document, by comparing all windows."""
    starts: dict[tuple, int] = {}
    for i in sorted(docs):
        w = words(docs[i])
        for p in range(len(w) - window + 1):
            starts.setdefault(tuple(w[p:p + window]), i)
    out = {}
    for i, text in docs.items():
        w = words(text)
        gone = set()
        for p in range(len(w) - window + 1):
            if starts[tuple(w[p:p + window])] < i:
                gone |= set(range(p, p + window))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out[i] = (len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


def bag(text: str | None, n: int = 5) -> Counter:
    w = words(text)
    if not w:
        return Counter()
    return Counter(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else Counter([tuple(w)])


def classes(docs: dict[int, str | None], similarity: float = 0.8) -> dict[int, int]:
    """Smallest doc_id of each document's class, by comparing all pairs."""
    bags, up = {i: bag(t) for i, t in docs.items()}, {i: i for i in docs}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(docs)
    for a in ids:
        for b in ids:
            if a < b and bags[a] and bags[b]:
                o = sum((bags[a] & bags[b]).values())
                if o >= similarity * (sum(bags[a].values()) + sum(bags[b].values()) - o) - 1e-9:
                    x, y = root(a), root(b)
                    up[max(x, y)] = min(x, y)
    return {i: root(i) for i in docs}


def components(edges: list[tuple]) -> dict:
    up: dict = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return {x: root(x) for x in list(up)}


def targets(sizes: dict[str | None, int], weights=(1, 2, 3), most=3) -> dict[str | None, float]:
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, full = float(sum(sizes.values())), set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        weight = sum(w[s] for s in order if s not in full)
        t = {s: most * sizes[s] if s in full else left * w[s] / weight for s in order}
        above = {s for s in order if s not in full and t[s] > most * sizes[s]}
        if not above:
            return t
        full |= above
