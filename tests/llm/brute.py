"""Plain versions of what the operators compute, over lists, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import xxhash


def components(nodes, edges) -> dict:
    """The least node reachable from each node."""
    least = {n: n for n in nodes}
    beside = defaultdict(set)
    for a, b in edges:
        beside[a].add(b)
        beside[b].add(a)
    for start in sorted(least):
        if least[start] != start:
            continue
        todo = [start]
        while todo:
            for other in beside[todo.pop()]:
                if least[other] > start:
                    least[other] = start
                    todo.append(other)
    return least


def cosine_links(vectors: dict, threshold: float = 0.9) -> list:
    def good(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    ids = sorted(i for i, v in vectors.items() if good(v))
    found = []
    for k, i in enumerate(ids):
        a = np.array(vectors[i], float)
        for j in ids[k + 1 :]:
            b = np.array(vectors[j], float)
            if len(a) == len(b) and a @ b / math.sqrt((a @ a) * (b @ b)) >= threshold:
                found.append((i, j))
    return found


def words(text: str | None) -> list[str]:
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def fingerprint(text: str | None) -> int:
    w = words(text)
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def near_fingerprints(prints: dict) -> list:
    ids = sorted(prints)
    return [(i, j) for k, i in enumerate(ids) for j in ids[k + 1 :] if (prints[i] ^ prints[j]).bit_count() <= 3]


BASE = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)


def secrets(text: str | None):
    """Counts by kind and the digest of base spans."""
    spans = [
        (m.start(), rank, kind, m.end())
        for rank, (kind, pattern, group, least) in enumerate(BASE)
        for m in re.finditer(pattern, text or "")
        if len(m[group]) >= least
    ]
    joined = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(spans))
    counts = Counter(s[2] for s in spans)
    return *(counts[k] for k, *_ in BASE), hashlib.sha256(joined.encode()).hexdigest()


def entropy(chars: str) -> float:
    return -sum(c / len(chars) * math.log2(c / len(chars)) for c in Counter(chars).values())


def base_scores(rows: list[tuple[int, str | None]]) -> dict:
    """``(n_tokens, n_known, N, base_score)`` by id."""
    end = object()
    tokens = {i: [*words(t), end] for i, t in rows}
    counts = Counter(t for i, ts in tokens.items() if crc32(str(i).encode()) % 7 != 2 for t in ts)
    n, v = sum(counts.values()), len(counts)
    return {
        i: (len(ts), sum(t in counts for t in ts), n, sum(math.log10((counts[t] + 1) / (n + 1 * (v + 1))) for t in ts))
        for i, ts in tokens.items()
    }


def bigram_scores(rows: list[tuple[int, str | None]], discount: float) -> dict:
    """log10 probability of each text by the bigram model with absolute discounting, without quantising."""
    tokens = {i: [*words(t), "</s>"] for i, t in rows}
    learnt = [ts for i, ts in tokens.items() if crc32(str(i).encode()) % 7 != 2]
    one = Counter(t for ts in learnt for t in ts)
    two = Counter(p for ts in learnt for p in zip(["<s>", *ts], ts))
    before, after = Counter(), Counter()
    for (u, _), c in two.items():
        before[u] += c
        after[u] += 1
    n, v = sum(one.values()), len(one)

    def p(u, w):
        p1 = (one[w] + 1) / (n + v + 1)
        if not before[u]:
            return p1
        return max(two[u, w] - discount, 0) / before[u] + discount * after[u] / before[u] * p1

    return {i: sum(math.log10(p(u, w)) for u, w in zip(["<s>", *ts], ts)) for i, ts in tokens.items()}


def literal_matches(docs: list, items: list, width: int = 13, shortest: int = 8) -> dict:
    """Pairs of equal windows for each document and item; a very short item is a whole document or nothing."""

    def split(t):
        return [w for w in re.findall(r"[^\W_]+(?:[.,][0-9]+)*", (t or "").lower())]

    def grams(w, n):
        return [tuple(w[i : i + n]) for i in range(len(w) - n + 1)]

    found = Counter()
    of = {d: split(t) for d, t in docs}
    for item, text in items:
        w = split(text)
        n = min(width, len(w))
        if n < shortest:
            found.update({(d, item): 1 for d, dw in of.items() if n and dw == w})
            continue
        mine = Counter(grams(w, n))
        for d, dw in of.items():
            if same := sum(mine[g] for g in grams(dw, n)):
                found[d, item] += same
    return dict(found)
