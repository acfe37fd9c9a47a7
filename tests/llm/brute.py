"""Plain versions of the text operators for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

SPACE_WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(t):
    return t.translate({i: i + 32 for i in range(65, 91)})


def groups(nodes, linked):
    """Least member of each node's component."""
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n
    for a, b in linked:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingle_sets(docs, k):
    out = {}
    for d, t in docs:
        w = SPACE_WORDS.findall(ascii_lower(t or ""))
        out[d] = {tuple(w)} if 0 < len(w) < k else set(zip(*(w[i:] for i in range(k))))
    return out


def near_groups(docs, k, percent):
    sets = shingle_sets(docs, k)
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:]
             if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return {d: len(sets[d]) for d in ids}, groups(ids, links)


def repeats(docs, length=50):
    """Per id: bytes, removed bytes, spans and the digest of what stays."""
    seen, out = {}, {}
    for d, t in sorted(docs):
        b = (t or "").encode()
        off = [False] * len(b)
        for s in range(len(b) - length + 1):
            w = b[s:s + length]
            if seen.setdefault(w, d) < d:
                off[s:s + length] = [True] * length
        kept = bytes(x for x, o in zip(b, off) if not o)
        spans = sum(o and not (i and off[i - 1]) for i, o in enumerate(off))
        out[d] = (len(b), sum(off), spans, hashlib.sha256(kept).hexdigest())
    return out


def held(doc, folds):
    return zlib.crc32(str(doc).encode()) % folds == 0


def bigram_scores(docs, mu):
    tokens = {d: SPACE_WORDS.findall(ascii_lower(t or "")) + [None] for d, t in docs}
    one, two, starts = Counter(), Counter(), 0
    for d, w in tokens.items():
        if not held(d, 10):
            one.update(w)
            two.update(zip([0, *w], w))
            starts += 1
    n, v, out = sum(one.values()), len(one), {}
    for d, w in tokens.items():
        base = score = 0.0
        for a, b in zip([0, *w], w):
            p = (one[b] + 0.1) / (n + 0.1 * (v + 1))
            c = starts if a == 0 else one[a]
            base += math.log10(p)
            score += math.log10((two[a, b] + mu * p) / (c + mu))
        out[d] = (held(d, 10), len(w), sum(one[b] > 0 for b in w), n, base, score)
    return out


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def normalised(line):
    return re.sub(r"[\W_]+", " ", line.lower()).strip()


def lines_kept(docs, similarity=0.8):
    """Per id the text without the lines that repeat, exactly or nearly, an earlier one's group."""
    place = defaultdict(list)
    for d, t in sorted(docs):
        for i, line in enumerate((t or "").split("\n")):
            if normalised(line):
                place[normalised(line)].append((d, i))
    names = sorted(place)
    links = [(a, b) for i, a in enumerate(names) for b in names[i + 1:]
             if min(len(a), len(b)) >= similarity * max(len(a), len(b))
             and edit_distance(a, b) <= (1 - similarity) * max(len(a), len(b)) + 1e-9]
    first = {}
    for n, g in groups(names, links).items():
        first[g] = min([*place[n], *([first[g]] if g in first else [])])
    keep = set(first.values())
    return {d: "\n".join(x for i, x in enumerate((t or "").split("\n")) if not normalised(x) or (d, i) in keep)
            for d, t in docs}


def contained(docs, items, percent=80):
    def shingles(t):
        w = [x for x in re.split(r"[\W_]+", (t or "").lower()) if x]
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    want = {i: shingles(t) for i, t in items}
    return {(d, i): len(s & shingles(t)) for d, t in docs for i, s in want.items()
            if s and 100 * len(s & shingles(t)) >= percent * len(s)}
