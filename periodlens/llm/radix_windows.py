"""Removal of repeated 50-byte strings by a depth-limited radix sort of suffixes.

The texts' suffixes are sorted through their first ``LENGTH`` bytes only, most significant digit
first (a digit's order is that of the hash of its bytes); equal groups at that depth are exactly the repeated windows.  A byte goes if a window that covers it also
starts in a document with a smaller id.

Two digits of 25 bytes (64-bit hashes of their bytes) order the suffixes; a digit before them deals the
suffixes to tasks, and spares most of them the sort.  It is the window's anchor: the least ``GRAM``-byte
gram (by hash, leftmost) inside the window.  Equal windows have equal anchors at equal places, and the windows
of an anchor are consecutive (15 on average), so they travel as one run of bytes:

1. every anchor gram's 48-bit hash is dealt to buckets, once for each document, with the hash that names the document's block;
   grams of one document only are dropped, the others are told to the blocks that hold them;
2. each block sends the runs of its remaining anchors to the grams' buckets; equal runs of a block are one,
   with its least document;
3. each bucket sorts its suffixes by the two digits, and marks in each run the windows whose group has a
   smaller document;
4. each block marks its documents' bytes: all windows of a run if the run's least document is smaller, else
   the marked ones.

Blocks and buckets are hash shares of the data (two and one for each shuffle partition), held one at a time.
A block sends one row to a bucket, so messages are as many as the pieces of a shuffle.  A
passage in a third of all documents is one run a block, so its bucket gets at most one a block.  Documents, runs
and hashes travel zstd-packed.  Nothing is collected, sampled or stored; each step is a map between two shuffles.

Defined results: a null text is empty; texts shorter than the window stay; a null id neither repeats
others nor is repeated by them; rows with equal ids never repeat each other; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from periodlens.llm.chosen_path import mix

LENGTH = 50
GRAM = 20
SEGMENT = 1 << 19             # bytes that are scanned at once; at most 2**24
HELD = 1 << 18                # anchors that step 1 holds before it sends them
SUBS = 16                     # parts of a bucket that are sorted one after the other
_PLACE = np.uint64((1 << 24) - 1)
_C = np.uint64(0x9E3779B97F4A7C15)
_TABLE = mix(np.arange(1, 257, dtype=np.uint64))
_U = np.uint64


def _pack(*arrays: np.ndarray) -> bytes:
    sizes = np.asarray([a.nbytes for a in arrays], "<i8")
    return zstandard.ZstdCompressor(level=1).compress(b"".join([sizes.tobytes(), *[a.tobytes() for a in arrays]]))


def _unpack(raw: bytes, *kinds) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(raw)
    ends = np.cumsum(np.concatenate(([8 * len(kinds)], np.frombuffer(raw, "<i8", len(kinds)))))
    return [np.frombuffer(raw[a:b], k) for a, b, k in zip(ends, ends[1:], kinds)]


def _rolling(buf: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k bytes that begin at each place, by doubling."""
    with np.errstate(over="ignore"):
        by, have, out, at = _TABLE[buf], 1, None, 0
        while True:
            if k & have:
                if out is None:
                    out = by
                else:
                    n = len(buf) - at - have + 1
                    out = out[:n] * _U((int(_C) * (2 * have + 1)) & (2**64 - 1) | 1) + by[at:at + n]
                at += have
            if 2 * have > k:
                return mix(out[:len(buf) - k + 1])
            by = by[:len(by) - have] * _U((int(_C) ^ (have * 0x1D8E4E27C47D124F)) & (2**64 - 1) | 1) + by[have:]
            have *= 2


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while 2 * have <= width:
        x, have = np.minimum(x[:len(x) - have], x[have:]), 2 * have
    return np.minimum(x[:len(x) - (width - have)], x[width - have:]) if width > have else x


def _frames(texts: list[bytes]) -> Iterator[tuple[np.ndarray, list[tuple[int, int, int, int]]]]:
    """Buffers of at most about SEGMENT bytes with their parts (text, offset in it, begin, end)."""
    parts, held, size = [], [], 0
    for i, t in enumerate(texts):
        for at in range(0, max(len(t) - LENGTH + 1, 0), SEGMENT):
            piece = t[at:at + SEGMENT + LENGTH - 1]
            if size and size + len(piece) > SEGMENT:
                yield np.frombuffer(b"".join(held), np.uint8), parts
                parts, held, size = [], [], 0
            parts.append((i, at, size, size + len(piece)))
            held.append(piece)
            size += len(piece)
    if held:
        yield np.frombuffer(b"".join(held), np.uint8), parts


def _runs(buf: np.ndarray, parts) -> tuple[np.ndarray, ...]:
    """Per anchor: its gram's 48-bit hash, the first of its windows, how many, and the part's number."""
    h = _rolling(buf, GRAM)
    least = _sliding_min((h & ~_PLACE) | np.arange(len(h), dtype=np.uint64), LENGTH - GRAM + 1)
    begins, ends = np.array([p[2] for p in parts]), np.array([p[3] for p in parts])
    windows = ends - begins - LENGTH + 1
    part = np.repeat(np.arange(len(parts)), windows)
    s = np.arange(len(part)) + np.repeat(begins - (np.cumsum(windows) - windows), windows)
    anchor = (least[s] & _PLACE).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1]))))
    count = np.diff(np.concatenate((new, [len(s)])))
    # anchors are least hashes, so they are mixed once more for an even spread over the buckets
    return mix(h[anchor[new]]) >> _U(16), s[new], count, part[new]


def _doc_hash(doc: np.ndarray) -> np.ndarray:
    return (mix(doc.astype(np.int64).view(np.uint64)) >> _U(32)).astype(np.uint32)


def _share(gram: np.ndarray, n: int) -> np.ndarray:
    """The bucket of a gram; rising in the gram."""
    return ((gram >> _U(16)) * _U(n) >> _U(32)).astype(np.int64)


def _slices(keys: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of equal keys in a sorted array."""
    if len(keys):
        at = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))
        for a, b in zip(at[:-1], at[1:]):
            yield int(keys[a]), slice(a, b)


def _pack_grams(gram: np.ndarray, *more: np.ndarray) -> bytes:
    high = (gram >> _U(16)).astype("<u4")
    return _pack(np.diff(high, prepend=np.uint32(0)), (gram & _U(0xFFFF)).astype("<u2"), *more)


def _unpack_grams(raw: bytes, *kinds) -> list[np.ndarray]:
    high, low, *more = _unpack(raw, "<u4", "<u2", *kinds)
    return [(np.cumsum(high, dtype=np.uint32).astype(np.uint64) << _U(16)) | low, *more]


def _rows(rows, names) -> pa.RecordBatch:
    types = {"share": pa.int32(), "kind": pa.int32(), "raw": pa.binary()}
    cols = list(zip(*rows)) or [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, types[n]) for c, n in zip(cols, names)], names=names)


_OUT = ["share", "kind", "raw"]
_SCHEMA = "share int, kind int, raw binary"


def _texts(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Ids and texts of some rows with an id and a text that has a window."""
    for at in range(0, b.num_rows, 1000):
        part = b.slice(at, 1000)
        keep = [(d, t) for d, t in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist())
                if d is not None and t and len(t) >= LENGTH]
        yield np.array([d for d, _ in keep], np.int64), [t for _, t in keep]


def _send_grams(blocks: int, buckets: int):
    """Step 1, map: anchors' grams by bucket, each with a hash of its document."""
    def flush(grams, docs):
        # a row for each gram and document: two of them are two documents, even if their hashes are equal
        g, d = np.concatenate(grams), np.concatenate(docs)
        order = np.lexsort((d, g))
        g, d = g[order], d[order]
        new = np.concatenate(([True], (g[1:] != g[:-1]) | (d[1:] != d[:-1])))
        g, d = g[new], _doc_hash(d[new])
        # of a gram's documents in one block two are enough, so a frequent gram sends little
        begin = np.concatenate(([True], g[1:] != g[:-1]))
        first = np.flatnonzero(begin)
        size = np.diff(np.concatenate((first, [len(g)])))
        keep = np.ones(len(g), bool)
        for f, n in zip(first[size > 2 * blocks], size[size > 2 * blocks]):
            block = d[f:f + n] % blocks
            o = np.argsort(block, kind="stable")
            third = np.concatenate(([False] * 2, block[o][2:] == block[o][:-2]))
            keep[f:f + n][o[third]] = False
        g, d = g[keep], d[keep]
        return _rows([(k, 0, _pack_grams(g[s], d[s])) for k, s in _slices(_share(g, buckets))], _OUT)

    def grams_by_bucket(batches):
        grams, docs, held = [], [], 0
        for b in batches:
            for ids, texts in _texts(b):
                for buf, parts in _frames(texts):
                    g, _, _, part = _runs(buf, parts)
                    grams.append(g)
                    docs.append(ids[np.array([p[0] for p in parts])][part])
                    held += len(g)
                if held > HELD:
                    yield flush(grams, docs)
                    grams, docs, held = [], [], 0
        if held:
            yield flush(grams, docs)
    return grams_by_bucket


def _by_share(batches) -> Iterator[tuple[int, Iterator[tuple[int, bytes]]]]:
    """Rows (kind, raw) of each share of a task's sorted rows."""
    rows = ((s, k, r) for b in batches for s, k, r in
            zip(b.column(0).to_pylist(), b.column(1).to_pylist(), (x.as_py() for x in b.column(2))))
    for share, group in groupby(rows, key=lambda r: r[0]):
        yield share, ((k, r) for _, k, r in group)


def _repeated_grams(blocks: int):
    """Step 1, reduce: grams of at least two documents, by the blocks that hold them.

    A task sends a document's grams at once, so two rows of a gram are two documents (or two rows with one id, which step 3
    tells apart).
    """
    def repeated_grams_by_block(batches):
        for _, rows in _by_share(batches):
            got = [_unpack_grams(r, "<u4") for _, r in rows]
            g, d = np.concatenate([x[0] for x in got]), np.concatenate([x[1] for x in got])
            order = np.lexsort((d, g))
            g, d = g[order], d[order]
            first = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
            last = np.concatenate((first[1:], [len(g)])) - 1
            keep = np.repeat(last > first, last - first + 1)
            g, block = g[keep], (d[keep] % blocks).astype(np.int64)
            order = np.lexsort((g, block))
            yield _rows([(k, 0, _pack_grams(g[order][s])) for k, s in _slices(block[order])], _OUT)
    return repeated_grams_by_block


def _send_texts(blocks: int):
    """Texts by block, packed."""
    def texts_by_block(batches):
        for b in batches:
            for ids, texts in _texts(b):
                block = (_doc_hash(ids) % blocks).astype(np.int64)
                order = np.argsort(block, kind="stable")
                out = []
                for k, s in _slices(block[order]):
                    mine = [texts[i] for i in order[s]]
                    out.append((k, 1, _pack(ids[order[s]], np.array([len(t) for t in mine], "<i8"),
                                            np.frombuffer(b"".join(mine), np.uint8))))
                yield _rows(out, _OUT)
    return texts_by_block


def _unpack_texts(raw: bytes) -> tuple[np.ndarray, list[bytes]]:
    ids, sizes, body = _unpack(raw, "<i8", "<i8", np.uint8)
    body, ends = body.tobytes(), np.cumsum(sizes)
    return ids, [body[e - n:e] for e, n in zip(ends, sizes)]


_POWER: list[np.ndarray] = []


def _powers() -> list[np.ndarray]:
    """Powers of an odd constant and of its inverse, for hashes of any stretch of a buffer."""
    if not _POWER:
        n = SEGMENT + 2 * LENGTH
        c, inverse = int(_C), pow(int(_C), -1, 1 << 64)
        with np.errstate(over="ignore"):
            for x in (c, inverse):
                steps = np.full(n, x, np.uint64)
                steps[0] = 1
                _POWER.append(np.multiply.accumulate(steps))
    return _POWER


def _stretch_hash(buf: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each run: count windows from start."""
    power, inverse = _powers()
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_TABLE[buf] * power[:len(buf)], dtype=np.uint64)))
        return mix((sums[start + count + (LENGTH - 1)] - sums[start]) * inverse[start] + mix(count.astype(np.uint64)))


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places starts[i], ..., starts[i] + sizes[i] - 1 of every i in turn."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _send_runs(buckets: int):
    """Step 2: the distinct runs of a block whose gram is repeated, by bucket."""
    def runs_by_bucket(batches):
        for block, rows in _by_share(batches):
            grams, found = [np.zeros(0, np.uint64)], []
            for kind, raw in rows:
                if kind == 0:
                    grams.append(_unpack_grams(raw)[0])
                    continue
                if len(grams) > 1:
                    grams = [np.unique(np.concatenate(grams))]
                known = grams[0]
                if not len(known):
                    continue
                ids, texts = _unpack_texts(raw)
                for buf, parts in _frames(texts):
                    g, start, count, part = _runs(buf, parts)
                    at = np.searchsorted(known, g)
                    at[at == len(known)] = 0
                    hit = np.flatnonzero(known[at] == g)
                    g, start, count, part = g[hit], start[hit], count[hit], part[hit]
                    doc = ids[np.array([p[0] for p in parts])][part]
                    key = _stretch_hash(buf, start, count)
                    # one of each run in this buffer, with its least document and whether it has more
                    order = np.lexsort((doc, key))
                    first = order[np.concatenate(([True], key[order][1:] != key[order][:-1]))] if len(order) else order
                    low, high = _low_high(key[order], doc[order])
                    size = count[first] + LENGTH - 1
                    found.append((g[first], key[first], low, high, count[first].astype(np.uint8),
                                  buf[_ragged(start[first], size)]))
            if not found:
                continue
            g, key, low, high, count = (np.concatenate([f[i] for f in found]) for i in range(5))
            body = np.concatenate([f[5] for f in found])
            size = count.astype(np.int64) + LENGTH - 1
            begin = np.cumsum(size) - size
            order = np.lexsort((low, key, g))
            new = np.concatenate(([True], key[order][1:] != key[order][:-1]))
            first = order[new]
            many = np.maximum.reduceat(high[order], np.flatnonzero(new)) > low[first]
            out = []
            for k, s in _slices(_share(g[first], buckets)):
                f = first[s]
                f_sub = (g[f] % _U(SUBS)).astype(np.uint8)
                by_sub = np.argsort(f_sub, kind="stable")
                f, m = f[by_sub], many[s][by_sub]
                out.append((k, 0, _pack(np.full(1, block, "<i8"), f_sub[by_sub], key[f], low[f], m.astype(np.uint8),
                                        count[f], body[_ragged(begin[f], size[f])])))
            yield _rows(out, _OUT)
    return runs_by_bucket


def _low_high(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest document of each key, of rows in the order of key and document."""
    if not len(key):
        return doc, doc
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return doc[first], doc[np.concatenate((first[1:], [len(key)])) - 1]


def _sort_suffixes(body: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes that are in a group of several, and their groups, after a pass for each digit."""
    digit = _rolling(body, LENGTH // 2)
    alive, group = np.arange(len(start)), np.zeros(len(start), np.int64)
    for depth in range(0, LENGTH, LENGTH // 2):
        d = digit[start[alive] + depth]
        order = np.argsort(d, kind="stable") if depth == 0 else np.lexsort((d, group))
        alive, group, d = alive[order], group[order], d[order]
        new = np.concatenate(([True], (group[1:] != group[:-1]) | (d[1:] != d[:-1])))
        at = np.flatnonzero(new)
        size = np.diff(np.concatenate((at, [len(new)])))
        keep = np.repeat(size > 1, size)
        group = (np.cumsum(new) - 1)[keep]
        alive = alive[keep]
        if not len(alive):
            break
    return alive, group


def _mark():
    """Step 3: for each run of a bucket the windows that a smaller document has, by block."""
    def marks_by_block(batches):
        for _, rows in _by_share(batches):
            got = [_unpack(r, "<i8", np.uint8, "<u8", "<i8", np.uint8, np.uint8, np.uint8) for _, r in rows]
            marks = [_mark_part([_part(x, sub) for x in got]) for sub in range(SUBS)]
            block, key, mask, low = (np.concatenate([m[i] for m in marks]) for i in range(4))
            order = np.argsort(block, kind="stable")
            yield _rows([(k, 0, _pack(key[order[s]], mask[order[s]].astype("<u4"), low[order[s]]))
                         for k, s in _slices(block[order])], _OUT)
    return marks_by_block


def _part(message: list[np.ndarray], sub: int) -> tuple[np.ndarray, ...]:
    """Block, keys, least documents, many and counts, and the bytes, of a message's runs of one part."""
    block, subs, key, low, many, count, body = message
    lo, hi = np.searchsorted(subs, [sub, sub + 1])
    size = np.concatenate(([0], np.cumsum(count.astype(np.int64) + LENGTH - 1)))
    return (np.full(hi - lo, block[0]), key[lo:hi], low[lo:hi], many[lo:hi], count[lo:hi], body[size[lo]:size[hi]])


def _mark_part(got: list[tuple]) -> tuple[np.ndarray, ...]:
    """Block, key, mask and least document of the runs of which some document of theirs loses a window."""
    block, key, low, many, count, body = (np.concatenate([x[i] for x in got]) for i in range(6))
    mask = np.zeros(len(key), np.uint64)
    if not len(key):
        return block, key, mask, low
    count = count.astype(np.int64)
    size = count + LENGTH - 1
    begin = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(key)), count)
    place = _ragged(np.zeros(len(key), np.int64), count)
    alive, group = _sort_suffixes(body, begin[owner] + place)
    if len(alive):
        doc = low[owner[alive]]
        at = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        least = np.repeat(np.minimum.reduceat(doc, at), np.diff(np.concatenate((at, [len(group)]))))
        hit = alive[least < doc]
        np.bitwise_or.at(mask, owner[hit], _U(1) << place[hit].astype(np.uint64))
    keep = np.flatnonzero((mask > 0) | (many > 0))
    return block[keep], key[keep], mask[keep], low[keep]


def _cut(id_col: str, with_text: bool):
    """Step 4: the ranges of bytes to remove of a block's texts."""
    def cut_texts(batches):
        for _, rows in _by_share(batches):
            marks, known = [], None
            for kind, raw in rows:
                if kind == 0:
                    marks.append(_unpack(raw, "<u8", "<u4", "<i8"))
                    continue
                if known is None:
                    cols = [np.concatenate([m[i] for m in marks]) if marks else np.zeros(0, k)
                            for i, k in enumerate(("<u8", "<u4", "<i8"))]
                    order = np.argsort(cols[0])
                    known, mask, low = (c[order] for c in cols)
                ids, texts = _unpack_texts(raw)
                gone = [np.zeros(len(t) + 1, np.int32) for t in texts]
                if len(known):
                    for buf, parts in _frames(texts):
                        _, start, count, part = _runs(buf, parts)
                        key = _stretch_hash(buf, start, count)
                        at = np.searchsorted(known, key)
                        at[at == len(known)] = 0
                        hit = np.flatnonzero(known[at] == key)
                        m = mask[at[hit]].astype(np.uint64)
                        doc = ids[np.array([p[0] for p in parts])][part[hit]]
                        every = (_U(1) << count[hit].astype(np.uint64)) - _U(1)
                        m = np.where(low[at[hit]] < doc, every, m)
                        for bit in range(int(count.max()) if len(count) else 0):
                            on = hit[(m >> _U(bit)) & _U(1) == 1]
                            for p, s in _slices(part[on]):
                                i, offset, begin, _ = parts[p]
                                w = start[on[s]] + bit - begin + offset
                                np.add.at(gone[i], w, 1)
                                np.add.at(gone[i], w + LENGTH, -1)
                yield pa.RecordBatch.from_arrays([pa.array(ids), *_report(texts, gone, with_text)], names=_names(id_col, with_text))
    return cut_texts


def _names(id_col: str, with_text: bool) -> list[str]:
    return [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if with_text else [])]


def _report(texts: list[bytes], gone: list[np.ndarray | None], with_text: bool) -> list[pa.Array]:
    n, removed, spans, kept = [], [], [], []
    for t, g in zip(texts, gone):
        n.append(len(t))
        if g is None:
            removed.append(0), spans.append(0), kept.append(t)
            continue
        off = np.cumsum(g[:-1]) > 0
        removed.append(int(off.sum()))
        spans.append(int((off & ~np.concatenate(([False], off[:-1]))).sum()))
        kept.append(np.frombuffer(t, np.uint8)[~off].tobytes() if removed[-1] else t)
    return [pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
            pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            *([pa.array(kept, pa.binary())] if with_text else [])]


def _untouched(with_text: bool):
    """Rows that have no window or no id."""
    def untouched_texts(batches):
        for b in batches:
            rows = [(d, t or b"") for d, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist())
                    if d is None or not t or len(t) < LENGTH]
            yield pa.RecordBatch.from_arrays(
                [pa.array([d for d, _ in rows], pa.int64()), *_report([t for _, t in rows], [None] * len(rows), with_text)],
                names=_names(b.schema.names[0], with_text))
    return untouched_texts


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256 and (``with_text``) kept, the bytes that stay, of every row."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks, buckets = 2 * parts, parts
    rows = docs.selectExpr(f"cast(`{id_col}` as bigint) as `{id_col}`", f"`{text_col}`")
    schema = f"`{id_col}` long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text

    def dealt(df):
        return df.repartition(parts, "share").sortWithinPartitions("share", "kind")

    grams = dealt(rows.mapInArrow(_send_grams(blocks, buckets), _SCHEMA)).mapInArrow(_repeated_grams(blocks), _SCHEMA)
    texts = rows.mapInArrow(_send_texts(blocks), _SCHEMA)
    runs = dealt(grams.unionByName(texts)).mapInArrow(_send_runs(buckets), _SCHEMA)
    marks = dealt(runs).mapInArrow(_mark(), _SCHEMA)
    cut = dealt(marks.unionByName(texts)).mapInArrow(_cut(id_col, with_text), schema)
    return cut.unionByName(rows.mapInArrow(_untouched(with_text), schema))
