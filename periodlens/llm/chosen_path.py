"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its distinct word shingles (A-Z lower-cased; words are runs of anything
but ASCII white space; a text of fewer words than a shingle is one shingle as a whole).  Documents
with equal sets are one node, which has ``TOKENS`` min-hash tokens.

In a tree, every node of the recursion picks one or, a quarter of the time, two of the token places (a
hash of the path decides, so no state is shared) and sends each of its sets down the branch named by its
token there: 1.25 branches on average, the inverse of the threshold, which keeps pairs at the threshold alive
in expectation.  The sets of each path of level ``FIRST`` meet.  A pair at 0.8 lives to this level with probability
0.55 a tree, so the ``TREES`` independent trees find it with more than 0.998; pairs above are likelier.

Pairs are confirmed on the full sets (48-bit hashes of the shingles) unless their sizes or token
sketches (four bits a token) rule the threshold out, in rounds: first each set with the hub of its paths
that meets most sets and the hub that it shares most paths with, next the sets that are left out of a large path's largest group
with two of its members, then every pair that met and that the components of these leave
apart.  So a large group of copies costs a few comparisons a member: its paths lie in one component, or hold few others, and
the pairs between components are few.  The sets of paths with more than ``EACH`` such pairs a set are compared by an exact prefix join
of their full sets: two sets at the threshold share one of the few shingles that come first when each set is ordered from rare to
frequent, so near copies of one text meet by what they share beyond that text, not each with each.

Shuffled work is done by Spark; the Python parts are Arrow-batched maps over rows.  A frequent text is merged
map-side (minimum id a set).  Pairs and components never leave the cluster.

Defined results: a null or empty text, or one without words, has size 0, is linked with nothing and kept; a
null id is on its own (its component is null, and it is kept); equal texts with different ids are linked;
rows with equal ids are separate documents that carry that id; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodlens.llm.common import stored
from periodlens.llm.components import components

WORDS, PERCENT = 5, 80
TOKENS, TREES = 64, 8
FIRST = 5
EACH = 12                     # pairs between components for each set of a path, up to which the path's pairs are listed
SMALL = 2 * EACH              # paths of so many sets never have more
SEEN, FREQUENT = 500, 20_000  # sets whose shingles are counted for the order of the prefixes, and the most shingles of them that are remembered
SLACK = 0.15                  # how far below the threshold a sketch may estimate a pair
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    with np.errstate(over="ignore"):
        x = (x + _M1) & np.uint64(0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * _M2
        x = (x ^ (x >> np.uint64(27))) * _M3
        return x ^ (x >> np.uint64(31))


_SEEDS = mix(np.arange(1, TOKENS + 1, dtype=np.uint64)) | np.uint64(1)


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def shingle_set(text: bytes | None, words: int, cache: dict) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    split = (text or b"").lower().split()
    if not split:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(cache.__getitem__, split), np.uint64, len(split))
    k = min(words, len(h))
    with np.errstate(over="ignore"):
        out = mix(np.full(len(h) - k + 1, k, np.uint64))
        for j in range(k):
            out = out * _M2 + h[j:len(h) - k + 1 + j] * _M1
            out ^= out >> np.uint64(29)
    return np.unique(mix(out))


def _tokens(s: np.ndarray) -> np.ndarray:
    best = np.full(TOKENS, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(s), 1024):
            best = np.minimum(best, (s[at:at + 1024, None] * _SEEDS).min(axis=0))
    return (mix(best) >> np.uint64(32)).astype(np.uint32)


_NIBBLE = np.arange(16, dtype=np.uint64) * np.uint64(4)


def profiles(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(doc, th, n, x, sig, k0..k3): text hash, set size, set hash, tokens and their four-bit sketch."""
    schema = f"doc {docs.schema[id_col].dataType.simpleString()}, th long, n long, x long, sig binary, " + \
        ", ".join(f"k{i} long" for i in range(4))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                n, x, sig, ks = [], [], [], []
                for t in part.column(1).cast(pa.binary()):
                    s = shingle_set(t.as_py(), words, cache)
                    n.append(len(s))
                    if not len(s):
                        x.append(None), sig.append(None), ks.append((None,) * 4)
                        continue
                    tokens = _tokens(s)
                    x.append(xxhash.xxh64_intdigest(s.tobytes(), 1) - (1 << 63))
                    sig.append(tokens.tobytes())
                    low = (tokens & np.uint32(15)).astype(np.uint64).reshape(4, 16)
                    ks.append(np.bitwise_or.reduce(low << _NIBBLE, axis=1).view(np.int64).tolist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(n, pa.int64()), pa.array(x, pa.int64()), pa.array(sig, pa.binary()),
                     *[pa.array([k[i] for k in ks], pa.int64()) for i in range(4)]],
                    names=["doc", "th", "n", "x", "sig", "k0", "k1", "k2", "k3"])

    return docs.select(id_col, text_col, F.xxhash64(text_col).alias("_th")).mapInArrow(run, schema)


def branch(keys: np.ndarray, sig: np.ndarray, rows: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """Paths and rows after some more levels: keys[i] is a path of the set whose tokens are sig[rows[i]]."""
    with np.errstate(over="ignore"):
        for _ in range(levels):
            coin = mix(keys ^ _M2)
            first = (coin % np.uint64(TOKENS)).astype(np.int64)
            second = ((coin >> np.uint64(16)) % np.uint64(TOKENS - 1)).astype(np.int64)
            second = (first + 1 + second) % TOKENS
            two = np.flatnonzero((coin >> np.uint64(40)) & np.uint64(3) == 0)
            at = np.concatenate((first, second[two]))
            parent = np.concatenate((keys, keys[two]))
            rows = np.concatenate((rows, rows[two]))
            keys = mix(parent * _M3 + at.astype(np.uint64) * _M1 + sig[rows, at].astype(np.uint64))
    return keys, rows


def _descend(rows: DataFrame, levels: int) -> DataFrame:
    """(key, x) after some levels of every tree."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 5000):
                part = b.slice(lo, 5000)
                x = part.column(0).to_numpy(zero_copy_only=False)
                sig = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint32).reshape(len(x), TOKENS)
                for tree in range(TREES):
                    keys, at = branch(mix(np.full(len(x), 1000 + tree, np.uint64)), sig, np.arange(len(x)), levels)
                    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(x[at])], names=["key", "x"])

    return rows.mapInArrow(run, "key long, x long")


def _differ(a: str, b: str) -> str:
    """SQL for the number of token places in which two sketches differ."""
    def one(i):
        d = f"({a}.k{i} ^ {b}.k{i})"
        d = f"({d} | shiftrightunsigned({d}, 1))"
        return f"bit_count(({d} | shiftrightunsigned({d}, 2)) & 1229782938247303441L)"
    return " + ".join(one(i) for i in range(4))


def paths(sets: DataFrame) -> DataFrame:
    """(key, x, n): the sets of every path of level ``FIRST`` with company, and how many they are."""
    rows = stored(_descend(sets.select("x", "sig"), FIRST), "paths")
    return rows.join(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "key")


def star_pairs(nodes: DataFrame) -> DataFrame:
    """Each set with two hubs of its paths: that with most company, and that which it shares most paths with.

    A path's hub is the set that meets most others, over all its paths: of near copies likely the text that they were made from.
    """
    ranked = nodes.select("key", "x").join(nodes.groupBy("x").agg(F.sum("n").alias("met")), "x")
    hubs = ranked.groupBy("key").agg(F.max(F.struct("met", F.col("x").alias("y"))).alias("hub"))
    met = ranked.join(hubs, "key").where("x <> hub.y").groupBy("x", "hub").agg(F.count("*").alias("k"))
    return (met.groupBy("x").agg(F.max("hub").alias("top"), F.max_by("hub", "k").alias("most"))
            .select("x", F.explode(F.array("top.y", "most.y")).alias("y"))
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())


def crowd_pairs(nodes: DataFrame, groups: DataFrame) -> DataFrame:
    """In large paths, each set outside the path's largest group with two members of that group, by a hash of path and set."""
    of = groups.select(F.col("node").alias("x"), F.col("component").alias("c"))
    rows = nodes.where(F.col("n") > SMALL).select("key", "x").join(of, "x", "left").withColumn("c", F.coalesce("c", "x"))
    order = F.struct(F.xxhash64("key", "x"), F.col("x").alias("x"))
    units = rows.groupBy("key", "c").agg(F.count("*").alias("m"), F.min(order).alias("lo"), F.max(order).alias("hi"))
    largest = units.groupBy("key").agg(F.count("*").alias("k"), F.max(F.struct("m", "c", "lo.x", F.col("hi.x").alias("y"))).alias("g")).where("k > 1")
    return (rows.join(largest, "key").where("c <> g.c").select("x", F.explode(F.array("g.x", "g.y")).alias("y"))
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())


def met_pairs(nodes: DataFrame, fetch: Callable[[DataFrame], DataFrame], groups: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) that met in a path and that the groups (node, component) leave apart.

    Of paths with many such pairs only those that are similar enough; ``fetch`` gives the full sets (x, s) of given sets (x).
    """
    of = groups.select(F.col("node").alias("x"), F.col("component").alias("c"))
    rows = nodes.select("key", "x").join(of, "x", "left").withColumn("c", F.coalesce("c", "x"))
    # a path all of whose sets are in one group has nothing to add
    keys = (rows.groupBy("key", "c").agg(F.count("*").alias("m")).groupBy("key")
            .agg(F.sum("m").alias("n"), F.expr("sum(m) * sum(m) - sum(m * m)").alias("twice"))
            .where("twice > 0").withColumn("crowded", F.col("twice") > 2 * EACH * F.col("n")))
    met = stored(rows.join(keys.drop("twice"), "key"), "met")
    small = met.where(f"n <= {SMALL}").select("key", "x", "c")
    left, right = small.alias("l"), small.alias("r")
    pairs = left.join(right, F.expr("l.key = r.key and l.x < r.x and l.c <> r.c")).select(
        F.col("l.x").alias("a"), F.col("r.x").alias("b"))
    # in larger paths the groups are paired first, so that the sets of one group don't meet
    large = met.where(f"not crowded and n > {SMALL}").select("key", "x", "c")
    units = large.select("key", "c").distinct()
    both = units.join(units.select("key", F.col("c").alias("d")), "key").where("c < d")
    across = (both.join(large.select("key", "c", F.col("x").alias("a")), ["key", "c"])
              .join(large.select("key", F.col("c").alias("d"), F.col("x").alias("b")), ["key", "d"]).select("a", "b"))
    pairs = pairs.unionByName(across)
    crowd = stored(met.where("crowded").select("x", "c").distinct(), "crowd")
    if not crowd.isEmpty():
        full = stored(fetch(crowd.select("x")), "crowd-sets")
        pairs = pairs.unionByName(confirm(prefix_pairs(crowd, full, percent), full, percent))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def frequent_shingles(crowd: DataFrame, full: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles (ascending) that several of ``SEEN`` sets of a crowd have, and in how many.  A bounded number is collected."""
    some = crowd.select("x").orderBy(F.xxhash64("x"), "x").limit(SEEN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h, n = np.unique(np.concatenate([_unpack(s.as_py()) for s in b.column(0)] or [np.zeros(0, np.uint64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.astype(np.int64)), pa.array(n.astype(np.int64))], names=["h", "n"])

    found = (full.join(some, "x").select("s").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
             .where("n > 1").orderBy(F.desc("n"), "h").limit(FREQUENT).collect())
    found.sort()
    return np.array([r["h"] for r in found], np.uint64), np.array([r["n"] for r in found], np.int64)


def prefix_pairs(crowd: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of sets (x, s) in different groups (x, c) that share a prefix; none that is similar enough is missed.

    Each set is ordered from rare to frequent shingles.  The order is the same for all sets; any would do, this one
    makes frequent shingles come late.  Of two sets that are similar enough the smaller has their first common shingle in its
    short prefix, the larger in its long one, and enough shingles follow it.
    """
    known, times = frequent_shingles(crowd, full)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = []
            for x, c, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                u = _unpack(s.as_py())
                n, rank = len(u), np.zeros(len(u), np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, u), len(known) - 1)
                    rank = np.where(known[at] == u, times[at], 0)
                h = u[np.lexsort((u, rank))][:n + percent * n // -100 + 1]
                short = n + 2 * percent * n // -(100 + percent) + 1
                i = np.arange(len(h))
                parts.append((np.full(len(h), x), np.full(len(h), c), np.full(len(h), n), i, h.astype(np.int64), i < short))
            cols = [np.concatenate(p) for p in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 5 + [np.zeros(0, bool)]
            yield pa.RecordBatch.from_arrays([pa.array(p) for p in cols], names=["x", "c", "n", "i", "h", "short"])

    rows = stored(crowd.join(full, "x").select("x", "c", "s")
                  .mapInArrow(run, "x long, c long, n long, i long, h long, short boolean"), "prefixes")
    left, right = rows.where("short").alias("l"), rows.alias("r")
    follows = f"{100 + percent} * least(l.n - l.i, r.n - r.i) >= {percent} * (l.n + r.n)"
    return (left.join(right, F.expr(f"""l.h = r.h and l.c <> r.c and (l.n < r.n or l.n = r.n and l.x < r.x)
                                        and 100 * l.n >= {percent} * r.n and {follows}"""))
            .select(F.least("l.x", "r.x").alias("a"), F.greatest("l.x", "r.x").alias("b")).distinct())


def likely(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sizes and sketches don't rule the similarity out."""
    most = int(TOKENS * (1 - ((percent / 100 - SLACK) * 15 / 16 + 1 / 16)))
    sketch = sets.select("x", F.struct("n", "k0", "k1", "k2", "k3").alias("s"))
    return (pairs.join(sketch.select(F.col("x").alias("a"), F.col("s").alias("p")), "a")
            .join(sketch.select(F.col("x").alias("b"), F.col("s").alias("q")), "b")
            .where(f"100 * least(p.n, q.n) >= {percent} * greatest(p.n, q.n) and {_differ('p', 'q')} <= {most}")
            .select("a", "b"))


def _full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(x, s): the shingles of the wanted sets (x, doc, th), 48 bits each, sorted."""
    source = (docs.select(F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("t"))
              .join(wanted, ["doc", "th"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                xs, out = [], []
                for x, t in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary())):
                    s = shingle_set(t.as_py(), words, cache)
                    if len(s) and xxhash.xxh64_intdigest(s.tobytes(), 1) - (1 << 63) == x:   # ids may repeat
                        xs.append(x)
                        out.append((s >> np.uint64(32)).astype(np.uint32).tobytes() +
                                   ((s >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.uint16).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(xs, pa.int64()), pa.array(out, pa.binary())], names=["x", "s"])

    return source.select("x", "t").mapInArrow(run, "x long, s binary")


def _unpack(raw: bytes) -> np.ndarray:
    n = len(raw) // 6
    return (np.frombuffer(raw, np.uint32, n).astype(np.uint64) << np.uint64(16)) | np.frombuffer(raw, np.uint16, n, 4 * n)


def confirm(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    joined = (pairs.select("a", "b").join(full.select(F.col("x").alias("a"), F.col("s").alias("p")), "a")
              .join(full.select(F.col("x").alias("b"), F.col("s").alias("q")), "b").select("a", "b", "p", "q"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for p, q in zip(b.column(2), b.column(3)):
                p, q = _unpack(p.as_py()), _unpack(q.as_py())
                both = np.concatenate((p, q))
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= percent * (len(p) + len(q) - shared))
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                    percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id, kept, group, text_hash) of every row of ``docs``.

    group is a hash that the rows of a component share (null for rows without words or id), and
    text_hash is Spark's xxhash64 of the text.
    """
    rows = stored(profiles(docs, id_col, text_col, words), "profiles")
    sets = stored(rows.where("doc is not null and x is not null").groupBy("x")
                  .agg(F.min("doc").alias("doc"), F.min_by("th", "doc").alias("th"), *[F.first(c).alias(c) for c in ("n", "sig", "k0", "k1", "k2", "k3")]),
                  "sets")
    nodes = stored(paths(sets), "nodes")

    def fetch(wanted):
        return _full_sets(docs, wanted.join(sets.select("x", "doc", "th"), "x"), id_col, text_col, words).dropDuplicates(["x"])

    def links(pairs):
        pairs = stored(likely(pairs, sets, percent), "pairs")
        full = stored(fetch(pairs.select(F.explode(F.array("a", "b")).alias("x")).distinct()), "full-sets")
        return stored(confirm(pairs, full, percent), "links")

    def joined(groups, more):
        tree = groups.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
        return components(tree.unionByName(more))

    groups = stored(components(links(star_pairs(nodes))), "groups")
    groups = stored(joined(groups, links(crowd_pairs(nodes, groups))), "groups")
    groups = joined(groups, links(met_pairs(nodes, fetch, groups, percent)))
    least = (sets.select("x", "doc").join(groups, F.col("x") == F.col("node"), "left")
             .select("x", "doc", F.coalesce("component", "x").alias("c")))
    low = least.groupBy("c").agg(F.min("doc").alias("component_id"))
    ids = least.join(low, "c").select(F.col("x").alias("y"), "component_id", "c")
    kept = F.coalesce(F.col("doc") == F.col("component_id"), F.lit(True))
    return (rows.select("doc", "th", "n", "x").join(ids, F.col("x") == F.col("y"), "left")
            .withColumn("component_id", F.when(F.col("doc").isNotNull(), F.coalesce("component_id", "doc")))
            .select(F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"),
                    F.when(F.col("doc").isNotNull(), F.col("c")).alias("group"), F.col("th").alias("text_hash")))
