"""Language-model scores from a bigram trie in Elias-Fano levels, built and queried by shards.

The model interpolates a bigram with the unigram base: ``p(w | v) = c(v w) / (c(v) + MU) +
MU / (c(v) + MU) * p1(w)`` with ``p1(w) = (c(w) + 0.1) / (N + 0.1 (V + 1))``, which sums to one over the
vocabulary and one unknown word.  Counts are those of the training rows, all of them.

A shard's trie has three levels: the contexts (sorted hashes), one pointer a context to the
begin of its successors, and the successors, as ranks in the shard's sorted vocabulary.  Pointers
are monotone; successors are made so by adding the context's number times the vocabulary's size.  Each
level is an Elias-Fano sequence (low bits packed, high bits in unary) and each successor has its discounted log
probability as a 16-bit code.  The levels are written to one file of the task, which is mapped into memory and
removed with the task; ``fit`` keeps the tries as rows in the checkpoint folder, and ``Model.score`` maps them again
to score other tables.  A lookup finds the context, then searches among its successors only.

Documents are dealt to blocks, and each block sends its distinct words and bigrams, with their training counts,
to the shards of the words and of the contexts, and gets one code for each back, in the same order: so
a frequent bigram is one row a block.  The contexts with a share of all words of at least ``1 / HOT_SHARE`` (so at most
``HOT_SHARE`` of them) are the only thing that is broadcast; their successors are spread over ``SALTS``
shards.  Both the counts and the answers grow with the corpus and stay on the cluster.

Defined results: a null or empty text is its end token alone; a null id is kept, and trains if ``held_out``
is not true; rows with equal ids are separate documents; an empty table gives an empty one; without a
training row every word is unknown.
"""

from __future__ import annotations

import json
import os
import tempfile
from collections import Counter
from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodlens.llm.chosen_path import WordHashes, mix
from periodlens.llm.common import stored

MU = 20.0
HOT_SHARE = 500
SALTS = 32
HOT_SAMPLE = 8                # of so many texts one is looked at for hot contexts
START, END = 1, 2             # hashes that stand for a text's begin and end
ABSENT = 65535
STEP = 2048                   # codes a decade
_U = np.uint64
_ID = _U((1 << 40) - 1)
_SALTED = np.arange(SALTS, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)


# --- Elias-Fano levels ---------------------------------------------------------------------

class EliasFano:
    """A non-decreasing sequence: low bits in an array, the high bits' gaps in unary."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        self.ones = np.flatnonzero(np.unpackbits(high, bitorder="little"))[:n]        # select directory

    @staticmethod
    def encode(values: np.ndarray) -> list[np.ndarray]:
        """(header, low, high) of a sequence."""
        values = values.astype(np.uint64)
        n, top = len(values), int(values[-1]) + 1 if len(values) else 1
        low_bits = max(0, int(top // max(n, 1)).bit_length() - 1)
        high = (values >> _U(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(-(-(int(high[-1]) + 1 if n else 0) // 8) * 8, np.uint8)
        bits[high] = 1
        width = 4 if low_bits <= 32 else 8
        low = (values & _U((1 << low_bits) - 1)).astype(f"<u{width}")
        planes = low.view(np.uint8).reshape(n, width)[:, :-(-low_bits // 8)]          # only the bytes in use
        return [np.array([n, low_bits], "<i8"), np.ascontiguousarray(planes).reshape(-1), np.packbits(bits, bitorder="little")]

    @classmethod
    def decode(cls, header, low, high):
        return cls(int(header[0]), int(header[1]), low, high)

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        value = (self.ones[at] - at).astype(np.uint64) << _U(self.low_bits)
        width = -(-self.low_bits // 8)
        for i in range(width):
            value |= self.low[at * width + i].astype(np.uint64) << _U(8 * i)
        return value


class Trie:
    """Contexts, pointers, successors and codes of a shard, mapped from one file."""

    def __init__(self, path: str, sizes: list[tuple[str, int]]):
        raw, at, parts = np.memmap(path, np.uint8, "r"), 0, []
        for kind, size in sizes:
            parts.append(raw[at:at + size].view(kind))
            at += size
        self.contexts, self.pointers, self.words, self.successors = (
            EliasFano.decode(*parts[i:i + 3]) for i in range(0, 12, 3))
        self.codes = parts[12]

    @staticmethod
    def write(path: str, v: np.ndarray, w: np.ndarray, codes: np.ndarray) -> list[tuple[str, int]]:
        """Write the trie of bigrams that are sorted by (v, w); returns the layout."""
        contexts, begin, rank_v = np.unique(v, return_index=True, return_inverse=True)
        words, rank_w = np.unique(w, return_inverse=True)
        levels = [*EliasFano.encode(contexts), *EliasFano.encode(np.concatenate((begin, [len(v)]))),
                  *EliasFano.encode(words), *EliasFano.encode(rank_v.astype(np.uint64) * _U(len(words)) + rank_w.astype(np.uint64)),
                  codes.astype("<u2")]
        sizes = []
        with open(path, "wb") as f:
            for x in levels:
                raw = x.tobytes()
                pad = -len(raw) % 8
                f.write(raw + bytes(pad))
                sizes.append((x.dtype.str, len(raw), pad))
        # padding belongs to the part before; views only take whole items
        return [(k, n + p) if k == "|u1" else (k, n + p - (n + p) % np.dtype(k).itemsize) for k, n, p in sizes]

    @staticmethod
    def _find(level: EliasFano, lo: np.ndarray, hi: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Place of each value between lo and hi of a level, or -1."""
        lo, end = lo.copy(), hi
        hi = hi.copy()
        while (open_ := lo < hi).any():
            mid = (lo + hi) >> 1
            less = np.zeros(len(lo), bool)
            less[open_] = level[mid[open_]] < value[open_]
            lo, hi = np.where(open_ & less, mid + 1, lo), np.where(open_ & ~less, mid, hi)
        found = np.full(len(lo), -1)
        ok = np.flatnonzero(lo < end)
        ok = ok[level[lo[ok]] == value[ok]]
        found[ok] = lo[ok]
        return found

    def _place(self, level: EliasFano, values: np.ndarray) -> np.ndarray:
        """Place of each value in a whole level, or -1; each distinct value is searched once."""
        distinct, inverse = np.unique(values, return_inverse=True)
        zero = np.zeros(len(distinct), np.int64)
        return self._find(level, zero, zero + level.n, distinct)[inverse]

    def lookup(self, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Code of each bigram, ABSENT where it has none."""
        out = np.full(len(v), ABSENT, np.uint16)
        if not self.contexts.n:
            return out
        c, r = self._place(self.contexts, v), self._place(self.words, w)
        ask = np.flatnonzero((c >= 0) & (r >= 0))
        lo, hi = self.pointers[c[ask]].astype(np.int64), self.pointers[c[ask] + 1].astype(np.int64)
        value = c[ask].astype(np.uint64) * _U(self.words.n) + r[ask].astype(np.uint64)
        at = self._find(self.successors, lo, hi, value)
        out[ask[at >= 0]] = self.codes[at[at >= 0]]
        return out


# --- messages ------------------------------------------------------------------------------

def _pack(*arrays: np.ndarray, level: int = 1) -> bytes:
    sizes = np.asarray([a.nbytes for a in arrays], "<i8")
    return zstandard.ZstdCompressor(level=level).compress(b"".join([sizes.tobytes(), *[a.tobytes() for a in arrays]]))


def _unpack(raw: bytes, *kinds) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(raw)
    ends = np.cumsum(np.concatenate(([8 * len(kinds)], np.frombuffer(raw, "<i8", len(kinds)))))
    return [np.frombuffer(raw[a:b], k) for a, b, k in zip(ends, ends[1:], kinds)]


def _planes(x: np.ndarray, width: int) -> np.ndarray:
    """The low bytes of 64-bit integers, byte by byte."""
    if len(x) and int(x.max()) >> (8 * width):
        raise OverflowError(f"a number of a block does not fit into {width} bytes: use more shuffle partitions")
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(len(x), 8)[:, :width].T)


def _merge(planes: np.ndarray, width: int) -> np.ndarray:
    n = len(planes) // width
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = planes.reshape(width, n).T
    return out.reshape(-1).view("<u8")


_SCHEMA = "share int, kind int, peer int, raw binary"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [[], [], [], []]
    return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int32()) for c in cols[:3]], pa.array(cols[3], pa.binary())],
                                      names=["share", "kind", "peer", "raw"])


def _by_share(batches) -> Iterator[tuple[int, list[tuple]]]:
    rows = ((s, k, p, r.as_py()) for b in batches for s, k, p, r in
            zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3)))
    for share, group in groupby(rows, key=lambda r: r[0]):
        yield share, [r[1:] for r in group]


def _send_texts(blocks: int):
    """Texts by block: rows (row number in the message, fold, text)."""
    def texts_by_block(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 2000):
                part = b.slice(lo, 2000)
                ids = part.column(0).to_pylist()
                texts = [t or b"" for t in part.column(1).cast(pa.binary()).to_pylist()]
                held = np.array(part.column(2).to_pylist(), np.uint8)
                block = np.array([xxhash.xxh64_intdigest(t, (i or 0) & 0xFFFFFFFF) % blocks for i, t in zip(ids, texts)])
                order, out = np.argsort(block, kind="stable"), []
                for s, e in _cuts(block[order]):
                    mine = order[s:e]
                    known = np.array([ids[i] is not None for i in mine], np.uint8)
                    out.append((int(block[mine[0]]), 2, 0, _pack(
                        np.array([ids[i] or 0 for i in mine], "<i8"), known, held[mine],
                        np.array([len(texts[i]) for i in mine], "<i8"),
                        np.frombuffer(b"".join(texts[i] for i in mine), np.uint8), level=3)))
                yield _batch(out)
    return texts_by_block


def _cuts(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """Begin and end of the runs of equal keys in a sorted array."""
    if len(keys):
        at = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))
        yield from zip(at[:-1].tolist(), at[1:].tolist())


class Block:
    """The documents of a block as word hashes, and its distinct words and bigrams in their shards' order."""

    def __init__(self, rows: list[tuple], shares: int, hot: np.ndarray, cache: dict):
        ids, known, held, words = [], [], [], []
        for kind, _, raw in rows:
            if kind == 2:
                i, k, h, sizes, body = _unpack(raw, "<i8", np.uint8, np.uint8, "<i8", np.uint8)
                body, ends = body.tobytes(), np.cumsum(sizes)
                ids.append(i), known.append(k), held.append(h)
                for e, n in zip(ends.tolist(), sizes.tolist()):
                    split = body[e - n:e].lower().split()
                    w = np.empty(len(split) + 2, np.uint64)
                    w[0], w[-1] = START, END
                    w[1:-1] = np.fromiter(map(cache.__getitem__, split), np.uint64, len(split))
                    words.append(w)
        self.ids, self.known, self.held = (np.concatenate(x) for x in (ids, known, held))
        self.sizes = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.concatenate(words)
        self.ends = np.cumsum(self.sizes)
        train = np.repeat(self.held == 0, self.sizes)
        # distinct words by shard, then hash
        self.words, self.word_of = np.unique(mix(flat), return_inverse=True)     # mixed: the high bits pick the shard
        self.word_counts = np.bincount(self.word_of, train, len(self.words)).astype(np.int64)
        self.word_share = (self.words >> _U(32)) * _U(shares) >> _U(32)
        inner = np.ones(len(flat), bool)
        inner[self.ends - self.sizes] = False
        at = np.flatnonzero(inner)                                               # every token but the begins
        v, w = self.word_of[at - 1], self.word_of[at]
        pair = v.astype(np.int64) * len(self.words) + w
        pairs, self.pair_of = np.unique(pair, return_inverse=True)
        counts = np.bincount(self.pair_of, train[at], len(pairs)).astype(np.int64)
        v, w = pairs // len(self.words), pairs % len(self.words)
        is_hot = np.isin(self.words, hot)
        salt = np.where(is_hot[v], self.words[w] % _U(SALTS), 0).astype(np.int64)
        share = ((mix(self.words[v] + _SALTED[salt]) >> _U(32)) * _U(shares) >> _U(32)).astype(np.int64)
        order = np.lexsort((w, v, share))
        self.v, self.w, self.pair_counts, self.pair_share = v[order], w[order], counts[order], share[order]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.pair_of = place[self.pair_of]
        self.tokens, self.hot = at, np.flatnonzero(is_hot)
        self.shares = shares

    def messages(self, block: int) -> Iterator[tuple]:
        for s, e in _cuts(self.word_share):
            yield int(self.word_share[s]), 0, block, _pack(
                _planes(np.diff(self.words[s:e], prepend=_U(0)), 8), _planes(self.word_counts[s:e], 4))
        # every shard of a hot context hears its count
        h = mix((self.words[self.hot][:, None] + _SALTED).ravel())
        to = ((h >> _U(32)) * _U(self.shares) >> _U(32)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        heard = np.repeat(self.hot, SALTS)[order]
        by_share = {int(to[order[s]]): np.unique(heard[s:e]) for s, e in _cuts(to[order])}
        spans = {int(self.pair_share[s]): (s, e) for s, e in _cuts(self.pair_share)}
        for share in sorted(spans.keys() | by_share.keys()):
            s, e = spans.get(share, (0, 0))
            contexts, runs = np.unique(self.v[s:e], return_counts=True)
            extra = np.setdiff1d(by_share.get(share, np.zeros(0, np.int64)), contexts)
            both = np.concatenate((contexts, extra))
            yield share, 1, block, _pack(
                _planes(np.diff(self.words[contexts] & _ID, prepend=_U(0)), 8), _planes(self.words[extra] & _ID, 5),
                _planes(self.word_counts[both], 4), _planes(runs, 3),
                _planes(self.words[self.w[s:e]] & _ID, 5), _planes(self.pair_counts[s:e], 4))


def _send_counts(shares: int, hot: np.ndarray):
    def counts_by_shard(batches):
        cache = WordHashes()
        for block, rows in _by_share(batches):
            out = []
            for m in Block(rows, shares, hot, cache).messages(block):
                out.append(m)
                if len(out) >= 500:
                    yield _batch(out)
                    out = []
            yield _batch(out)
    return counts_by_shard


def _words_of(rows: list[tuple]) -> tuple[list[int], list[np.ndarray], np.ndarray]:
    """Of a shard's word messages: their blocks, their words, and all training counts."""
    words = [(peer, _unpack(raw, np.uint8, np.uint8)) for kind, peer, raw in rows if kind == 0]
    keys = [np.cumsum(_merge(k, 8), dtype=np.uint64) for _, (k, _) in words]
    counts = [_merge(c, 4).astype(np.int64) for _, (_, c) in words]
    return [peer for peer, _ in words], keys, np.concatenate(counts) if counts else np.zeros(0, np.int64)


def answers_by_block(keep: bool = False):
    """Per shard: totals of its words for every block, and the codes of its bigrams from its trie.

    With ``keep`` also the shard's part of the model: rows of kind 4 (words and totals) and 5 (the trie's file).
    """
    def answers(batches):
        for share, rows in _by_share(batches):
            peers, keys, counts = _words_of(rows)
            if peers:
                distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
                total = np.bincount(inverse, counts, len(distinct)).astype(np.int64)
                real = distinct != mix(np.array([START], np.uint64))[0]
                yield _batch([(-1, 3, share, np.array([total[real].sum(), (total[real] > 0).sum()], "<i8").tobytes())])
                ends = np.cumsum([len(k) for k in keys])
                yield _batch([(peer, 0, share, _pack(_planes(total[inverse[e - len(k):e]], 6)))
                              for peer, k, e in zip(peers, keys, ends)])
                if keep:
                    seen = total > 0
                    yield _batch([(share, 4, 0, _pack(distinct[seen], total[seen]))])
            pairs = [(peer, _unpack(raw, *[np.uint8] * 6)) for kind, peer, raw in rows if kind == 1]
            if pairs:
                yield from _answer_pairs(share, pairs, keep)
    return answers


def _pairs_of(pairs) -> tuple[list[np.ndarray], ...]:
    """Of bigram messages: contexts and their counts, first words, second words and counts of the bigrams."""
    contexts, context_counts, vs, ws, counts = [], [], [], [], []
    for _, (c, extra, cc, runs, w, n) in pairs:
        c = np.cumsum(_merge(c, 8), dtype=np.uint64)
        contexts.append(np.concatenate((c, _merge(extra, 5))))
        context_counts.append(_merge(cc, 4).astype(np.float64))
        vs.append(np.repeat(c, _merge(runs, 3).astype(np.int64)))
        ws.append(_merge(w, 5))
        counts.append(_merge(n, 4).astype(np.float64))
    return contexts, context_counts, vs, ws, counts


def _looked_up(path: str, layout: list, v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Codes of bigrams from a trie's file; each distinct bigram is looked up once, for all blocks that ask for it."""
    order = np.lexsort((w, v))
    vo, wo = v[order], w[order]
    first = np.flatnonzero(np.concatenate(([True], (vo[1:] != vo[:-1]) | (wo[1:] != wo[:-1]))))[:len(vo)]
    answer = np.empty(len(v), np.uint16)
    answer[order] = np.repeat(Trie(path, layout).lookup(vo[first], wo[first]), np.diff(np.concatenate((first, [len(vo)]))))
    return answer


def _by_peer(share: int, pairs, vs, answer: np.ndarray) -> list[tuple]:
    at, out = 0, []
    for (peer, _), v in zip(pairs, vs):
        out.append((peer, 1, share, _pack(answer[at:at + len(v)])))
        at += len(v)
    return out


def _answer_pairs(share: int, pairs, keep: bool) -> Iterator[pa.RecordBatch]:
    contexts, context_counts, vs, ws, counts = _pairs_of(pairs)
    v, w, n = np.concatenate(vs), np.concatenate(ws), np.concatenate(counts)
    context, inverse = np.unique(np.concatenate(contexts), return_inverse=True)
    context_total = np.bincount(inverse, np.concatenate(context_counts), len(context))
    order = np.lexsort((w, v))
    vo, wo = v[order], w[order]
    first = np.flatnonzero(np.concatenate(([True], (vo[1:] != vo[:-1]) | (wo[1:] != wo[:-1]))))[:len(vo)]
    total = np.add.reduceat(n[order], first) if len(first) else np.zeros(0)
    seen = total > 0
    kv, kw, total = vo[first][seen], wo[first][seen], total[seen]
    p = total / (context_total[np.searchsorted(context, kv)] + MU)
    codes = np.minimum(np.round(-np.log10(p) * STEP), ABSENT - 1)
    fd, path = tempfile.mkstemp(prefix="trie-")
    os.close(fd)
    try:
        layout = Trie.write(path, kv, kw, codes)
        answer = _looked_up(path, layout, v, w)
        if keep:
            with open(path, "rb") as f:
                yield _batch([(share, 5, 0, _file_row(layout, f.read()))])
    finally:
        os.unlink(path)
    yield _batch(_by_peer(share, pairs, vs, answer))


def _file_row(layout: list, raw: bytes) -> bytes:
    head = json.dumps(layout).encode()
    return len(head).to_bytes(8, "little") + head + raw


def answers_of_model(batches):
    """Per shard: the model's totals and codes for the words and bigrams that the blocks ask for."""
    for share, rows in _by_share(batches):
        by_kind = {k: [(p, r) for kind, p, r in rows if kind == k] for k in (1, 4, 5)}
        peers, keys, _ = _words_of(rows)
        if peers:
            known, total = _unpack(by_kind[4][0][1], "<u8", "<i8") if by_kind[4] else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            out = []
            for peer, k in zip(peers, keys):
                n = np.zeros(len(k), np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, k), len(known) - 1)
                    n = np.where(known[at] == k, total[at], 0)
                out.append((peer, 0, share, _pack(_planes(n, 6))))
            yield _batch(out)
        pairs = [(peer, _unpack(raw, *[np.uint8] * 6)) for peer, raw in by_kind[1]]
        if not pairs:
            continue
        _, _, vs, ws, _ = _pairs_of(pairs)
        v, w = np.concatenate(vs), np.concatenate(ws)
        answer = np.full(len(v), ABSENT, np.uint16)
        if by_kind[5]:
            raw = by_kind[5][0][1]
            size = int.from_bytes(raw[:8], "little")
            fd, path = tempfile.mkstemp(prefix="trie-")
            try:
                with os.fdopen(fd, "wb") as f:
                    f.write(raw[8 + size:])
                answer = _looked_up(path, json.loads(raw[8:8 + size]), v, w)
            finally:
                os.unlink(path)
        yield _batch(_by_peer(share, pairs, vs, answer))


def _score(shares: int, hot: np.ndarray, n_train: int, v_train: int, id_col: str):
    """Per block: its documents' scores from the answers to its messages."""
    names = [id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def score_block(batches):
        cache = WordHashes()
        for _, rows in _by_share(batches):
            if not any(kind == 2 for kind, *_ in rows):
                continue
            block = Block(rows, shares, hot, cache)
            count = np.zeros(len(block.words), np.int64)
            code = np.full(len(block.v), ABSENT, np.uint16)
            words = {int(block.word_share[s]): (s, e) for s, e in _cuts(block.word_share)}
            spans = {int(block.pair_share[s]): (s, e) for s, e in _cuts(block.pair_share)}
            for kind, peer, raw in rows:
                if kind == 0:
                    s, e = words[peer]
                    count[s:e] = _merge(_unpack(raw, np.uint8)[0], 6).astype(np.int64)
                elif kind == 1 and peer in spans:
                    s, e = spans[peer]
                    code[s:e] = _unpack(raw, "<u2")[0]
            base = (count + 0.1) / (n_train + 0.1 * (v_train + 1))
            alpha = np.where(code == ABSENT, 0.0, 10.0 ** (-code.astype(np.float64) / STEP))
            back = MU / (count[block.v] + MU)
            pair = np.log10(alpha + back * base[block.w])
            at, owner = block.tokens, np.repeat(np.arange(len(block.sizes)), block.sizes - 1)
            w = block.word_of[at]
            n = len(block.sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.ids, mask=block.known == 0), pa.array(block.held == 1), pa.array(block.sizes - 1),
                 pa.array(np.bincount(owner, count[w] > 0, n).astype(np.int64)), pa.array(np.full(n, n_train, np.int64)),
                 pa.array(np.bincount(owner, np.log10(base)[w], n)), pa.array(np.bincount(owner, pair[block.pair_of], n))],
                names=names)
    return score_block


def hot_words(docs: DataFrame, text_col: str) -> np.ndarray:
    """Mixed hashes of the contexts with at least a share of 1 / HOT_SHARE of all words.

    They only decide which shard a bigram goes to, never a count, so a hash sample of the texts serves.
    """
    def run(batches):
        seen, total = Counter(), 0
        for b in batches:
            for t in b.column(0).cast(pa.binary()):
                words = (t.as_py() or b"").lower().split()
                seen.update(words)
                total += len(words) + 1
                if len(seen) > 500_000:               # rare words can't be hot
                    seen = Counter({w: n for w, n in seen.items() if n > total / (8 * HOT_SHARE)})
        keep = [(w, n) for w, n in seen.items() if n > total / (4 * HOT_SHARE)] + [(b" ", total)]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in keep], pa.binary()),
                                          pa.array([n for _, n in keep], pa.int64())], names=["w", "n"])

    rows = docs.where(F.pmod(F.xxhash64(text_col), F.lit(HOT_SAMPLE)) == 0).select(text_col)
    rows = rows.mapInArrow(run, "w binary, n long").groupBy("w").agg(F.sum("n").alias("n"))
    total = rows.where(F.col("w") == F.lit(b" ")).first()
    if total is None:
        return np.zeros(0, np.uint64)
    # at most HOT_SHARE words have such a share, so no more come to the driver
    top = rows.where((F.col("w") != F.lit(b" ")) & (F.col("n") * HOT_SHARE >= total["n"])).collect()
    ids = [xxhash.xxh64_intdigest(bytes(r["w"])) for r in top]
    return mix(np.array([START, *sorted(ids)], np.uint64))


def _rows(docs: DataFrame, held_out, id_col: str, text_col: str) -> DataFrame:
    return docs.select(docs[id_col].cast("long").alias("i"), docs[text_col].alias("t"),
                       F.coalesce(held_out, F.lit(False)).cast("int").alias("h"))


def _dealt(df: DataFrame, parts: int) -> DataFrame:
    return df.repartition(parts, "share").sortWithinPartitions("share", "kind", "peer")


def _totals(answers: DataFrame) -> tuple[int, int]:
    """Training tokens and distinct ones, summed over the shards."""
    stats = [np.frombuffer(r["raw"], "<i8") for r in answers.where("kind = 3").select("raw").collect()]
    n_train, v_train = (int(x) for x in np.sum(stats, axis=0)) if stats else (0, 0)
    return n_train, v_train


def _scores(answers: DataFrame, texts: DataFrame, shares: int, hot: np.ndarray, n_train: int, v_train: int, id_col: str) -> DataFrame:
    schema = (f"`{id_col}` long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
              "score double")
    return (_dealt(answers.unionByName(texts), shares).mapInArrow(_score(shares, hot, n_train, v_train, id_col), schema))


def _counted(rows: DataFrame, shares: int, hot: np.ndarray) -> tuple[DataFrame, DataFrame]:
    """The blocks' texts, and their messages to the shards."""
    texts = rows.mapInArrow(_send_texts(2 * shares), _SCHEMA)
    return texts, _dealt(texts, shares).mapInArrow(_send_counts(shares, hot), _SCHEMA)


def score_documents(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    shares = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = _rows(docs, held_out, id_col, text_col)
    hot = hot_words(rows, "t")
    texts, counts = _counted(rows, shares, hot)
    answers = stored(_dealt(counts, shares).mapInArrow(answers_by_block(), _SCHEMA), "answers")
    n_train, v_train = _totals(answers)
    return _scores(answers.where("kind <> 3"), texts, shares, hot, n_train, v_train, id_col)


class Model(NamedTuple):
    """A trained model: a written table of the shards' words and tries, and what its scoring needs besides."""
    parts: DataFrame
    shares: int
    hot: np.ndarray
    n_train: int
    v_train: int

    def score(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """The columns of ``score_documents`` for a table that the model did not learn from (all of it held out)."""
        texts, asked = _counted(_rows(docs, F.lit(True), id_col, text_col), self.shares, self.hot)
        answers = stored(_dealt(asked.unionByName(self.parts), self.shares).mapInArrow(answers_of_model, _SCHEMA), "answers")
        return _scores(answers, texts, self.shares, self.hot, self.n_train, self.v_train, id_col)


def fit(docs: DataFrame, held_out=None, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn from the rows that are not held out; the tries stay in the shared checkpoint folder."""
    shares = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = _rows(docs, F.lit(False) if held_out is None else held_out, id_col, text_col)
    hot = hot_words(rows, "t")
    _, counts = _counted(rows, shares, hot)
    kept = stored(_dealt(counts, shares).mapInArrow(answers_by_block(keep=True), _SCHEMA).where("kind >= 3"), "model")
    return Model(kept.where("kind > 3"), shares, hot, *_totals(kept))
