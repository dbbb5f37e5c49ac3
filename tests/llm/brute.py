"""Plain-Python versions of the operators' definitions, for small inputs."""

from __future__ import annotations

import collections
import re

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
SPACE = " \t\n\x0b\x0c\r"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text, n):
    w = words(text)
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def near_dups(docs, n, num, den):
    """{doc_id: (size, component)} of [(doc_id, text)] with distinct ids."""
    sets = {d: shingles(t, n) for d, t in docs}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(d for d in sets if sets[d])
    by = collections.defaultdict(set)
    for d in ids:
        for s in sets[d]:
            by[s].add(d)
    for a in ids:
        for b in {b for s in sets[a] for b in by[s] if b > a}:
            both = len(sets[a] & sets[b])
            if den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


def line_dedup(docs, min_words):
    """{doc_id: (text, n_lines, n_removed)} of [(doc_id, text)], distinct ids."""
    seen, kept = {}, []
    for doc, text in sorted(docs, key=lambda r: (r[0] is not None, r[0])):
        lines = text.split("\n")
        idx = [(i, l.strip(SPACE)) for i, l in enumerate(lines) if l.strip(SPACE)]
        size = [len(re.split(f"[{SPACE}]+", l)) for _, l in idx]
        windows = set()
        for a in range(len(idx)):
            for step in (1, -1):
                n, b = 0, a
                while 0 <= b < len(idx):
                    n += size[b]
                    if n >= min_words:
                        windows.add((min(a, b), max(a, b)))
                        break
                    b += step
        kept.append((doc, lines, idx, windows))
        for a, b in windows:
            key, place = tuple(l for _, l in idx[a:b + 1]), (doc is not None, doc, idx[a][0])
            seen[key] = min(seen.get(key, place), place)
    out = {}
    for doc, lines, idx, windows in kept:
        gone = set()
        for a, b in windows:
            if (doc is not None, doc, idx[a][0]) > seen[tuple(l for _, l in idx[a:b + 1])]:
                gone.update(range(idx[a][0], idx[b][0] + 1))
        out[doc] = ("\n".join(l for i, l in enumerate(lines) if i not in gone), len(lines), len(gone))
    return out


def contained(docs, items, n=5, num=80, den=100):
    out = {}
    sets = [(i, shingles(t, n)) for i, t in items if shingles(t, n)]
    for d, t in docs:
        mine = shingles(t, n)
        for i, s in sets:
            both = len(s & mine)
            if den * both >= num * len(s):
                out[d, i] = (both, len(s))
    return out


def best_segments(scores):
    """Maximal scoring segments by their definition: recursively the leftmost
    best segment of what is left (shortest on ties), if positive."""
    out = []

    def go(lo, hi):
        best, at = 0, None
        for a in range(lo, hi):
            total = 0
            for b in range(a, hi):
                total += scores[b]
                if total > best + 1e-12:
                    best, at = total, (a, b + 1)
        if at:
            go(lo, at[0])
            out.append((*at, best))
            go(at[1], hi)

    go(0, len(scores))
    return out
