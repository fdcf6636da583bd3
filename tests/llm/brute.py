"""Plain versions of the operators for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

SPACE = r"[\x20\x09-\x0D]+"


def lowered(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", lowered(text or ""))


def shingle_set(text: str | None, size: int = 5) -> frozenset:
    w = words(text)
    if len(w) < size:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def component_of(nodes, edges) -> dict:
    root = {n: n for n in nodes}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def removed(texts: list[str | None], length: int) -> list[tuple[int, int, int, str]]:
    """(bytes, removed, spans, sha256 of the rest) per text."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        rest = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(rest).hexdigest()))
    return out
