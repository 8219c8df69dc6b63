"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text: str | None, width: int = 5) -> frozenset:
    words = WORD.findall((text or "").translate(UPPER))
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def near_components(rows: list[tuple[int, str | None]]) -> list[tuple[int, int, int]]:
    sets = [shingle_set(t) for _, t in rows]
    parent = {d: d for d, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((root(rows[i][0]), root(rows[j][0])))
                parent[y] = x
    return sorted((d, len(s), root(d)) for (d, _), s in zip(rows, sets, strict=True))


SPLIT = re.compile(r"[\W_]+")


def leaks(docs: list[tuple[int, str | None]], items: list[tuple[int, str | None]]) -> set[tuple[int, int, int, int]]:
    def words(text):
        return [w for w in SPLIT.split((text or "").lower()) if w]

    def runs(w, k):
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}

    out = {}
    for item_id, text in items:
        w = words(text)
        if not w or item_id is None:
            continue
        k = min(5, len(w))
        want = runs(w, k)
        for doc_id, doc in docs:
            both = len(want & runs(words(doc), k))
            if doc_id is not None and 100 * both >= 80 * len(want):
                out[doc_id, item_id] = max(both, out.get((doc_id, item_id), (0, 0))[0]), len(want)
    return {(d, i, q, n) for (d, i), (n, q) in out.items()}


BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 32),
)


def base_secrets(text: str | None) -> tuple[dict[str, int], str]:
    found = []
    for order, (kind, pattern, group, least) in enumerate(BASE):
        found += [(m.start(), order, kind, m.end()) for m in pattern.finditer(text or "") if len(m.group(group)) >= least]
    listed = ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(found))
    return dict(Counter(f[2] for f in found)), hashlib.sha256(listed.encode()).hexdigest()
