"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import re
from collections import Counter

SPACES = re.compile(r"[\x20\x09-\x0D]+")


def words(text, lower=False):
    out = [w for w in SPACES.split(text or "") if w]
    if lower:
        out = [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in out]
    return out


def components(nodes, pairs):
    label = {n: n for n in nodes}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, n=5):
    w = words(text, lower=True)
    if not w:
        return set()
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))}


def near_duplicates(docs, percent=85):
    """docs: (doc_id, text) -> {doc_id: (n_shingles, component_id)}."""
    sets = {d: shingles(t) for d, t in docs}
    ids = sorted(sets)
    pairs = []
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    pairs.append((a, b))
    label = components(ids, pairs)
    return {d: (len(sets[d]), label[d]) for d in ids}


def line_removals(docs, percent=90):
    """docs: (doc_id, text) -> {doc_id: removed line numbers}."""
    lines = [(d, i, frozenset(words(line, lower=True))) for d, t in sorted(docs, key=lambda x: x[0]) if t is not None
             for i, line in enumerate(t.split("\n"))]
    out = {d: [] for d, _ in docs}
    earlier = {}
    for d, i, s in lines:
        if not s:
            continue
        if s in earlier or any(100 * len(s & e) >= percent * len(s | e) for e in earlier):
            out[d].append(i)
        earlier.setdefault(s)
    return out


def statistics(text):
    w = words(text)
    t = text or ""
    windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    repeated = {k for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for k in range(i, i + 3)}
    lines = [x for x in t.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(repeated))


def top_k(vectors, every=100, k=10):
    """vectors: {vec_id: list of ints} -> [(query_id, rank, vec_id, score)]."""
    out = []
    for q in (v for v in vectors if v % every == 0):
        found = sorted(((-sum(a * b for a, b in zip(vectors[q], vectors[x])), x) for x in vectors if x != q))[:k]
        out += [(q, r, x, -s) for r, (s, x) in enumerate(found, 1)]
    return out


def runs(w, shortest=6, periods=4):
    """Words -> sorted (start, length, period): every stretch is extended by hand, smallest period wins."""
    found = {}
    for q in range(1, len(w) // periods + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            size = j + q - i
            if size >= max(shortest, periods * q):
                found[i, size] = min(q, found.get((i, size), q))
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def hard_negatives(rows, positives=5, negatives=10):
    """rows: (vec_id, label, ints) with distinct ids -> set of result rows; anchors are divisible by 100."""
    out = set()
    for a, label, x in rows:
        if a % 100:
            continue
        every = sorted((-sum(p * q for p, q in zip(x, y)), v, same) for v, other, y in rows if v != a
                       for same in (other == label,))
        for s, p, _ in [r for r in every if r[2]][:positives]:
            fit = [r for r in every if not r[2] and 30 * -s <= 100 * -r[0] <= 90 * -s][:negatives]
            out |= {(a, p, i, v, -s, -t) for i, (t, v, _) in enumerate(fit, 1)}
    return out


def jaccard_components(docs, percent=85, n=4):
    """docs: (doc_id, text) with distinct ids -> {doc_id: (n_shingles, component_id)}."""
    sets = {d: shingles(t, n) for d, t in docs}
    ids = sorted(sets)
    pairs = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    label = components(ids, pairs)
    return {d: (len(sets[d]), label[d]) for d in ids}
