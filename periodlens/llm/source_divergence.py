"""How far the sources of a language differ in their words: late materialization of strings.

Terms are runs of letters (``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+``, A-Z lower-cased).  A language keeps the terms
that at least ``MIN_DOCS`` of its documents have.  A group (language, source) gives each kept term the smoothed share
``p = 1 + floor(10^9 (count + 5) / (N + 5 V))``; so does the whole language.

1. A map counts terms where the texts are read, for each (language, source) of its task.  Only fixed-width rows leave it: a
   number for the language and the group, a 64-bit digest of the term, occurrences and documents, which Spark sums.
   The numbers are hashes with a seed for which all languages and groups have different ones.
2. Most terms are rare and are dropped here, as digests.  For those left the texts are read once more, and the
   least and the greatest string of each digest are taken.  Where they differ, terms collide: such digests are
   split, their terms being counted by their strings instead (a digest that is not kept has no kept terms).
3. Shares, distances and ranks are computed on digests.  A term's string is joined back for the kept outputs only: terms
   that no more than 50 others of their group beat.

A pair's distance is the sum of ``abs(p - q)`` over all kept terms.  Only terms that occur in both sources are joined;
terms of one source are summed by their counts (few different ones), and those of neither have a fixed difference.

The arithmetic is exact (decimals and integral division).  Sides that are small by nature (languages, groups) are joined
as Spark sees fit.

Defined results: null text, language or source is the empty string; a group without terms takes part with all counts 0; a
language without kept terms has distances 0; equal values are ranked by the item's UTF-8 bytes; a repeated row is a document
of its own; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from periodlens.llm.common import BROADCAST_BYTES, stored
from periodlens.session import materialize

MIN_DOCS, SMOOTH, SCALE, TOP = 30, 5, 1_000_000_000, 50
HELD = 400_000                # different terms that a task holds before it sends its counts
ROWS = 500                    # texts that are Python objects at once
# A-Z become a-z; all ASCII characters that are no letters become blanks.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text in order."""
    return (text or b"").translate(_FOLD).split()


def digests(found: list[bytes], bits: int = 64) -> np.ndarray:
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    return (h & np.uint64((1 << bits) - 1)).view(np.int64)


def numbered(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> tuple[DataFrame, DataFrame]:
    """(l, g, text) of the documents, and the groups: l, g, lang, source (one row each, written)."""
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (lang_col, source_col)]
    groups = stored(docs.select(names[0].alias("lang"), names[1].alias("source")).distinct(), "groups")
    for seed in range(100):
        l, g = F.xxhash64(F.lit(seed), "lang"), F.xxhash64(F.lit(seed), "lang", "source")  # noqa: E741
        n = groups.agg(F.countDistinct("lang") == F.countDistinct(l), F.count("*") == F.countDistinct(g)).first()
        if all(n):
            break
    else:
        raise RuntimeError("no seed tells the groups apart")
    rows = docs.select(F.xxhash64(F.lit(seed), names[0]).alias("l"), F.xxhash64(F.lit(seed), *names).alias("g"),
                       F.col(text_col).cast("binary").alias("text"))
    return rows, stored(groups.select(l.alias("l"), g.alias("g"), "lang", "source"), "groups")


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[bytes]]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            for lang, group, text in zip(*(c.to_pylist() for c in batch.slice(at, ROWS).columns)):
                yield lang, group, terms(text)


def _among(h: np.ndarray, wanted: np.ndarray | None) -> np.ndarray:
    return np.ones(len(h), bool) if wanted is None else np.isin(h, wanted)


def _counts(rows: DataFrame, bits: int, wanted=None, strings: bool = False) -> DataFrame:
    """(l, g, h, n, n_docs): occurrences and documents of each digest; with ``strings`` of each (h, term).

    ``wanted`` is a broadcast sorted array of digests to keep, or None for all.
    """
    names = ["l", "g", "h", *["term"] * strings, "n", "n_docs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = wanted.value if wanted is not None else None
        groups: dict = {}

        def send():
            for (lang, group), (n, n_docs) in groups.items():
                found = list(n)
                h = digests(found, bits)
                keep = np.flatnonzero(_among(h, only))
                text = [pa.array([found[i] for i in keep], pa.binary()).cast(pa.string())] if strings else []
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(np.full(len(keep), x, np.int64)) for x in (lang, group)), pa.array(h[keep]), *text,
                     pa.array(np.fromiter(n.values(), np.int64, len(n))[keep]),
                     pa.array(np.fromiter(map(n_docs.__getitem__, found), np.int64, len(found))[keep])], names=names)
            groups.clear()
        held = 0
        for lang, group, t in _texts(batches):
            n, n_docs = groups.setdefault((lang, group), (Counter(), Counter()))
            held -= len(n)
            n.update(t)
            n_docs.update(set(t))
            held += len(n)
            if held > HELD:
                yield from send()
                held = 0
        yield from send()

    schema = ", ".join(f"{c} {'string' if c == 'term' else 'long'}" for c in names)
    return rows.mapInArrow(run, schema).groupBy(*names[:-2]).agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def _strings(rows: DataFrame, bits: int, wanted=None) -> DataFrame:
    """(h, term) of the terms of each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = wanted.value if wanted is not None else None
        seen: set = set()

        def send():
            found = list(seen)
            h = digests(found, bits)
            keep = np.flatnonzero(_among(h, only))
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array(h[keep]), pa.array([found[i] for i in keep], pa.binary()).cast(pa.string())],
                                              names=["h", "term"])
        for _, _, t in _texts(batches):
            seen.update(t)
            if len(seen) > HELD:
                yield send()
        yield send()

    return rows.mapInArrow(run, "h long, term string")


def _only(rows: DataFrame, digests_: DataFrame, n: int):
    """The digests as a broadcast array, if they are few enough; None otherwise (the map's rows are joined with them)."""
    if n * 8 > BROADCAST_BYTES:
        return None
    held = np.sort(np.array([r["h"] for r in digests_.collect()], np.int64))
    return rows.sparkSession.sparkContext.broadcast(held)


def _kept(counts: DataFrame, key: str, min_docs: int) -> DataFrame:
    return (counts.groupBy("l", key).agg(F.sum("n").alias("lang_n"), F.sum("n_docs").alias("lang_docs"))
            .where(F.col("lang_docs") >= min_docs).select("l", key, "lang_n"))


def kept_counts(rows: DataFrame, min_docs: int = MIN_DOCS, bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """Counts of the kept terms, and the terms' strings.

    Returns (l, g, h, k, n, lang_n) and (h, k, term): (h, k) names a term, k being 0 unless digests collide.
    """
    counts = stored(_counts(rows, bits), "term-counts")
    kept = stored(_kept(counts, "h", min_docs), "kept-digests")
    wanted, n = materialize(kept.select("h").distinct(), "wanted-digests", with_count=True)
    seen = _strings(rows, bits, _only(rows, wanted, n)).join(wanted, "h", "left_semi")
    ends = stored(seen.groupBy("h").agg(F.min("term").alias("low"), F.max("term").alias("high")), "term-strings")
    clashing, n_clashes = materialize(ends.where("low <> high").select("h"), "clashing-digests", with_count=True)
    names = ends.where("low = high").select("h", F.lit(0).alias("k"), F.col("low").alias("term"))
    good = counts.drop("n_docs").join(kept, ["l", "h"]).select("l", "g", "h", F.lit(0).alias("k"), "n", "lang_n")
    if n_clashes:
        split, split_names = _split(rows, clashing, n_clashes, min_docs, bits)
        good = good.join(clashing, "h", "left_anti").unionByName(split)
        names = names.unionByName(split_names)
    return stored(good, "kept-counts"), names


def _split(rows: DataFrame, clashing: DataFrame, n: int, min_docs: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """The kept terms of digests that several terms have, counted by their strings."""
    counts = _counts(rows, bits, _only(rows, clashing, n), strings=True).join(clashing, "h", "left_semi")
    counts = stored(counts, "clashing-counts")
    kept = _kept(counts.select("l", F.struct("h", "term").alias("key"), "n", "n_docs"), "key", min_docs)
    kept = kept.select("l", "key.h", "key.term", "lang_n")
    number = F.row_number().over(Window.partitionBy("h").orderBy("term"))
    names = stored(kept.select("h", "term").distinct().select("h", number.alias("k"), "term"), "clashing-names")
    split = counts.drop("n_docs").join(kept, ["l", "h", "term"]).join(names, ["h", "term"])
    return split.select("l", "g", "h", "k", "n", "lang_n"), names


def _share(n: Column, total: Column, v: Column) -> Column:
    """1 + floor(SCALE (n + SMOOTH) / (total + SMOOTH v)), exactly; null if there is no kept term."""
    up, down = (n + SMOOTH).cast("long"), (total + SMOOTH * v).cast("long")
    small = F.call_function("div", up * SCALE, down)
    large = F.call_function("div", up.cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)"), down.cast("decimal(21,0)"))
    return F.when(v == 0, F.lit(None)).when(up < (1 << 63) // SCALE, small).otherwise(large) + 1


def group_shares(groups: DataFrame, counts: DataFrame) -> DataFrame:
    """The groups with v (kept terms of the language), total, present (those in the group), p0 (share of an absent term),
    lang_total."""
    per_group = counts.groupBy("g").agg(F.sum("n").alias("total"), F.count("*").alias("present"))
    per_lang = (counts.groupBy("l", "h", "k").agg(F.max("lang_n").alias("lang_n"))
                .groupBy("l").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total")))
    rows = groups.join(per_group, "g", "left").join(per_lang, "l", "left").na.fill(0)
    return stored(rows.withColumn("p0", _share(F.lit(0), F.col("total"), F.col("v"))), "group-shares")


def term_shares(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """The counts with p (share in the group) and q (share in the language)."""
    sums = groups.select("g", "total", "v", "lang_total")
    return stored(counts.join(sums, "g").select(
        "l", "g", "h", "k", "n", _share(F.col("n"), F.col("total"), F.col("v")).alias("p"),
        _share(F.col("lang_n"), F.col("lang_total"), F.col("v")).alias("q")), "term-shares")


def pair_distances(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for each ordered pair of sources of a language."""
    a = groups.select("l", "lang", "source", "v", *[F.col(c).alias(f"a_{c}") for c in ("g", "present", "p0")])
    b = groups.select("l", F.col("source").alias("item"), *[F.col(c).alias(f"b_{c}") for c in ("g", "present", "p0")])
    pairs = a.join(b, "l").where("a_g <> b_g")
    # terms of the one source, of which few have different counts, against the other's share of an absent term
    histogram = shares.groupBy("g", "p").agg(F.count("*").alias("terms"))
    alone = (pairs.select("a_g", "b_g", "b_p0").join(histogram, F.col("a_g") == F.col("g")).groupBy("a_g", "b_g")
             .agg(F.sum(F.col("terms") * F.abs(F.col("p") - F.col("b_p0"))).alias("alone")))
    # what terms of both sources change in that
    p0 = groups.select("g", "p0")
    one = shares.join(p0, "g").select("l", "h", "k", F.col("g").alias("a_g"), F.col("p").alias("ap"), F.col("p0").alias("ap0"))
    two = one.select("l", "h", "k", F.col("a_g").alias("b_g"), F.col("ap").alias("bp"), F.col("ap0").alias("bp0"))
    change = F.abs(F.col("ap") - F.col("bp")) - F.abs(F.col("ap") - F.col("bp0")) - F.abs(F.col("bp") - F.col("ap0"))
    both = (one.join(two, ["l", "h", "k"]).where("a_g < b_g").groupBy("a_g", "b_g")
            .agg(F.sum(change).alias("change"), F.count("*").alias("common")))
    both = both.unionByName(both.select(F.col("a_g").alias("b_g"), F.col("b_g").alias("a_g"), "change", "common"))
    other = alone.select(F.col("a_g").alias("b_g"), F.col("b_g").alias("a_g"), F.col("alone").alias("other"))
    on = ["a_g", "b_g"]
    zero = F.lit(0)
    neither = F.col("v") - F.col("a_present") - F.col("b_present") + F.coalesce("common", zero)
    value = (F.coalesce("alone", zero) + F.coalesce("other", zero) + F.coalesce("change", zero)
             + F.coalesce(neither * F.abs(F.col("a_p0") - F.col("b_p0")), zero))
    return (pairs.join(alone, on, "left").join(other, on, "left").join(both, on, "left")
            .select("lang", "source", "item", value.alias("value")))


def leading_terms(shares: DataFrame, groups: DataFrame, names: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, source, item, value, rank): the terms with the greatest excess of the group's share over the language's."""
    more = shares.select("g", "h", "k", (F.col("p") - F.col("q")).alias("value")).where("value > 0")
    group = Window.partitionBy("g")
    # by digests: those that fewer than ``top`` others beat, ties included
    near = more.withColumn("at", F.rank().over(group.orderBy(F.desc("value")))).where(F.col("at") <= top).drop("at")
    named = near.join(names, ["h", "k"]).select("g", F.col("term").alias("item"), "value")
    rank = F.row_number().over(group.orderBy(F.desc("value"), "item"))
    ranked = named.withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.join(groups.select("g", "lang", "source"), "g").select("lang", "source", "item", "value", "rank")


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          min_docs: int = MIN_DOCS, top: int = TOP, bits: int = 64) -> DataFrame:
    """Rows lang, source, part, item, value, rank.

    Part ``pair``: the other sources of the language by distance.  Part ``term``: the ``top`` terms that are more
    frequent in the group than in the language.  Ranks begin at 1 in each group and part.
    """
    rows, groups = numbered(docs, text_col, lang_col, source_col)
    counts, names = kept_counts(rows, min_docs, bits)
    groups = group_shares(groups, counts)
    shares = term_shares(counts, groups)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pair_distances(shares, groups).withColumn("rank", F.row_number().over(order))
    out = [d.select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long").alias("value"),
                    F.col("rank").cast("int").alias("rank"))
           for part, d in (("pair", pairs), ("term", leading_terms(shares, groups, names, top)))]
    return out[0].unionByName(out[1])
