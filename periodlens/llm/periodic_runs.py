"""Runs of words that repeat with a period, found with suffix trees of a text and of its reversal.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) and a length of at least
``max(LEAST, COPIES * q)`` that no neighbouring word extends.  By the runs theorem every run is the extension of a
Lyndon word: for one of the two orders of the words the run holds a place whose longest Lyndon word is its root.

For each text, in one task:

1. Stretches that can hold runs.  In a run every three successive words stand a second time no more than q words away,
   and q is at most ``1 / COPIES`` of the stretch; places without such a second time split the text, again and again, until
   nothing changes.  This is exact: no run crosses such a place.
2. Ukkonen's suffix tree of the stretches, and of their reversal; the stretches are joined by words of their own.
3. An Euler tour of each tree with the nodes' string depths: the least depth between two leaves is the length of
   their longest common extension, got from a table of minima over powers of two, level by level for all candidates.
4. The order of the leaves is that of the suffixes; the next smaller suffix ends the longest Lyndon word of a place.  Each
   Lyndon word, in both orders, is extended to the left and to the right; those that are long enough are the runs.

A text is judged alone, so rows are not shuffled and a task holds one text (and its trees) at a time; memory is
in proportion to the longest text's stretches.

Words are ``[^\\x20\\x09-\\x0D]+``.  Defined results: a null or blank text has no words and no runs, its collapsed text is
empty; repeated rows give repeated results; an empty table gives an empty one; other columns are passed by.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST, COPIES = 6, 4
GRAM = 3                      # at most LEAST - 2 for periods of 1 and 2 * period for all others
WORD = r"[^\x20\x09-\x0D]+"
ROWS = 256                    # texts that are Python objects at once
_END = -1


class SuffixTree:
    """Ukkonen's tree of a list of numbers from 0, and of an end that is less than all of them."""

    def __init__(self, symbols: list[int]):
        s = [*symbols, _END]
        n = len(s)
        begin, end, link, suffix = [0], [0], [0], [-1]
        kids: list[dict | None] = [{}]
        node = edge = length = todo = 0
        for i, c in enumerate(s):
            inner, todo = 0, todo + 1          # inner: the node of this step that has no link yet
            while todo:
                if not length:
                    edge = i
                at = kids[node]
                k = at.get(s[edge])
                if k is None:
                    at[s[edge]] = len(begin)
                    begin.append(i), end.append(n), link.append(0), kids.append(None), suffix.append(i - todo + 1)
                    if inner:
                        link[inner], inner = node, 0
                else:
                    b = begin[k]
                    span = end[k] - b
                    if length >= span:
                        edge, length, node = edge + span, length - span, k
                        continue
                    if s[b + length] == c:
                        if inner:
                            link[inner] = node
                        length += 1
                        break
                    new = len(begin)           # the edge to k is split
                    at[s[edge]] = new
                    begin.append(b), end.append(b + length), link.append(0), suffix.append(-1)
                    begin[k] = b + length
                    kids.append({s[b + length]: k, c: new + 1})
                    begin.append(i), end.append(n), link.append(0), kids.append(None), suffix.append(i - todo + 1)
                    if inner:
                        link[inner] = new
                    inner = new
                todo -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - todo + 1
        self.n, self._kids, self._suffix, self._begin, self._end = n, kids, suffix, begin, end
        self._tour()

    def _tour(self) -> None:
        """Euler tour: the string depths in the order of the visits, and each suffix's first visit."""
        kids, suffix, begin, end = self._kids, self._suffix, self._begin, self._end
        tour, first, depth, stack = [], [0] * self.n, [0] * len(kids), [0]
        while stack:
            v = stack.pop()
            if v < 0:                          # back from a child
                tour.append(depth[~v])
                continue
            down = kids[v]
            if down is None:
                first[suffix[v]] = len(tour)
            else:
                d = depth[v]
                for c in sorted(down, reverse=True):
                    k = down[c]
                    depth[k] = d + end[k] - begin[k]
                    stack += (~v, k)
            tour.append(depth[v])
        self._depths, self.first = np.array(tour, np.int32), np.array(first, np.int64)

    def ranks(self, falling: bool = False) -> list[int]:
        """Each suffix's place in the order of the suffixes; ``falling``: with the numbers' order reversed, the end still least."""
        if not falling:                        # the tour visits the leaves in this order
            out = np.empty(self.n, np.int64)
            out[np.argsort(self.first)] = np.arange(self.n)
            return out.tolist()
        out, at, stack = [0] * self.n, 0, [0]
        while stack:
            v = stack.pop()
            down = self._kids[v]
            if down is None:
                out[self._suffix[v]] = at
                at += 1
            else:
                stack += [down[c] for c in sorted(down) if c != _END]
                if _END in down:
                    stack.append(down[_END])
        return out

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common extension of the suffixes i and j (never equal)."""
        a, b = self.first[i], self.first[j]
        a, b = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((b - a + 1).astype(float))[1] - 1
        out, least = np.empty(len(a), np.int64), self._depths
        for k in range(int(level.max(initial=-1)) + 1):
            if k:
                least = np.minimum(least[:-(1 << k - 1)], least[1 << k - 1:])
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(least[a[at]], least[b[at] - (1 << k) + 1])
        return out


def lyndon_ends(ranks: list[int]) -> list[int]:
    """Where the longest Lyndon word of each place ends: at the next smaller suffix."""
    out, stack = [0] * len(ranks), []
    for j, r in enumerate(ranks):
        while stack and ranks[stack[-1]] > r:
            out[stack.pop()] = j
        stack.append(j)
    return out[:-1]


def runs_of(symbols: list[int], least: int = LEAST, copies: int = COPIES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period."""
    n = len(symbols)
    if n < least:
        return []
    tree, back = SuffixTree(symbols), SuffixTree(symbols[::-1])
    found = set()
    for falling in (False, True):
        ends = np.array(lyndon_ends(tree.ranks(falling)), np.int64)
        i = np.arange(n)
        p = ends - i
        i, p = i[p * copies <= n], p[p * copies <= n]
        left = back.common(n - i, n - i - p)
        size = left + p + tree.common(i, i + p)
        keep = (size >= least) & (size >= copies * p)
        found.update(zip((i - left)[keep].tolist(), size[keep].tolist(), p[keep].tolist()))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _grams(w: np.ndarray) -> np.ndarray:
    """A number for each three successive words, equal for equal ones."""
    most = int(w.max()) + 1
    pair = w[:-1] * most + w[1:]
    if most > 1 << 20:
        pair = np.unique(pair, return_inverse=True)[1]
    return pair[:-1] * most + w[2:]


def stretches(w: np.ndarray, least: int = LEAST, copies: int = COPIES) -> list[tuple[int, int]]:
    """(begin, end) of the stretches that can hold runs."""
    out, todo = [], [(0, len(w))]
    while todo:
        begin, end = todo.pop()
        if end - begin < least:
            continue
        g = _grams(w[begin:end])
        order = np.argsort(g, kind="stable")
        gap = np.where(g[order[1:]] == g[order[:-1]], order[1:] - order[:-1], len(w))
        near = np.empty(len(g), np.int64)
        near[order] = np.minimum(np.concatenate((gap, [len(w)])), np.concatenate(([len(w)], gap)))
        ok = np.concatenate(([False], near <= (end - begin) // copies, [False]))
        turns = np.flatnonzero(ok[1:] != ok[:-1])
        parts = [(begin + a, begin + b + GRAM - 1) for a, b in zip(turns[::2].tolist(), turns[1::2].tolist())]
        if parts == [(begin, end)]:
            out += parts
        else:
            todo += parts
    return sorted(out)


def text_runs(words: list, least: int = LEAST, copies: int = COPIES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a list of words, by start, then period."""
    if len(words) < least:
        return []
    number: dict = {}
    w = np.array([number.setdefault(x, len(number)) for x in words], np.int64)
    parts = stretches(w, least, copies)
    if not parts:
        return []
    joined, starts, at = [], [], []
    for k, (a, b) in enumerate(parts):
        at.append(len(joined))
        starts.append(a)
        joined += w[a:b].tolist()
        joined.append(len(number) + k)         # a word of its own ends the stretch
    k = np.searchsorted(at, [r[0] for r in found], "right") - 1 if (found := runs_of(joined[:-1], least, copies)) else []
    return [(s - at[i] + starts[i], n, p) for i, (s, n, p) in zip(k, found)]


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words that stay: of each run its first ``period`` words, and what no run holds after them."""
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    gone = np.cumsum(change[:-1]) > 0
    return [x for x, g in zip(words, gone.tolist()) if not g]


def _judge(text: bytes | None, least: int, copies: int) -> tuple[int, list[dict], bytes]:
    words = (text or b"").split()              # bytes split at [\x20\x09-\x0D] only
    runs = text_runs(words, least, copies)
    kept = collapse(words, runs) if runs else words
    return len(words), [{"start": int(s), "length": int(n), "period": int(p)} for s, n, p in runs], b" ".join(kept)


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def find_runs(docs: DataFrame, text_col: str = "text", words_col: str = "n_words", runs_col: str = "runs",
              collapsed_col: str = "collapsed", least: int = LEAST, copies: int = COPIES) -> DataFrame:
    """The rows of ``docs`` (but for the text) with their number of words, runs (start, length, period; by start, then
    period) and the collapsed text.

    A word is left out of the collapsed text if any run holds it after the run's first ``period`` words; the words that
    stay are joined by one space.  Result columns must not clash with those of ``docs``; pick their names.
    ``least`` must be 6 or more and ``copies`` 4 or more: the stretches of step 1 rest on it.
    """
    if least < LEAST or copies < COPIES:
        raise ValueError(f"runs need at least {LEAST} words and {COPIES} copies")
    others = [c for c in docs.columns if c != text_col]
    clash = {c.lower() for c in others} & {words_col.lower(), runs_col.lower(), collapsed_col.lower()}
    if clash:
        raise ValueError(f"result columns are in the table already: {sorted(clash)}")
    kinds = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in others), f"`{words_col}` bigint",
                       f"`{runs_col}` array<struct<start:bigint,length:bigint,period:bigint>>", f"`{collapsed_col}` string"])
    names = [*others, words_col, runs_col, collapsed_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                n, runs, kept = zip(*[_judge(t, least, copies) for t in part.column(len(others)).to_pylist()])
                made = [pa.array(n, pa.int64()), pa.array(runs, _RUNS), pa.array(kept, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([*part.columns[:len(others)], *made], names=names)

    return docs.select(*others, F.col(text_col).cast("binary")).mapInArrow(run, kinds)


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length / period (ties: the first of the list); null if there is none."""
    better = lambda m, r: m.isNull() | (r["length"] * m["period"] > m["length"] * r["period"])
    return F.aggregate(runs, F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"),
                       lambda m, r: F.when(better(m, r), r).otherwise(m))
