"""Benchmark decontamination: size-partitioned MinHash containment search, then exact shingles.

Items and documents are sets of hashed five-word shingles (letters and digits, lower-cased).  A document
holds an item if it has at least ``percent`` of the item's shingles, wherever in the document.

An item of one to four words is one shingle of its own length.  Its words, and the documents' words that it is
looked up in, are single characters in scripts without blanks (Han, kana, Thai, Lao, Khmer, Burmese): if these are
five or more, its shingles are of five.  Such shingles are looked up whole, and only made if there are such items.

Items are partitioned by size (powers of two).  An item's sketch is its shingles with the least
hashes; of a partition's greatest size U it has ``U - ceil(U * percent) + 1`` of them, so a document
that holds the item misses too few shingles to miss the whole sketch: the search loses nothing,
however long the document.  A document sends the shingles below the greatest hash of any sketch, and
only if it has enough shingles for the smallest partition.  Documents that share a sketch shingle with an
item are candidates; their whole shingle sets are then intersected with the item's.

DataFrame functions only.  Sketches and item sets are broadcast while their counted size is below
``BROADCAST_BYTES``, else they are joined by shuffle (the document side can be split if a shingle
is hot).  A document's shingles stay in its row; only hits and candidates' texts travel.

Defined results: null texts and texts without words are in no pair; repeated items each count; rows with
equal ids are searched each by its own text; an empty table gives an empty result; a null id is matched as a
value of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodlens.llm.common import BROADCAST_BYTES

WORDS = 5
PERCENT = 80
UNSPACED = r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}])"


def _none() -> Column:
    return F.array().cast("array<bigint>")


def words_of(text: Column) -> Column:
    """Array of a text's words: runs of letters and digits, lower-cased."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def fine_words(text: Column) -> Column:
    """Array of a text's words, of which those in scripts without blanks are cut into characters."""
    return words_of(F.regexp_replace(text, UNSPACED, " $1 "))


def word_hashes(text: Column) -> Column:
    """Array of the hashes of a text's words."""
    return F.transform(words_of(text), lambda w: F.xxhash64(w))


def shingles(text: Column, least: int = 1) -> Column:
    """Array of a text's shingle hashes, repeated ones included; null if it has fewer than ``least``.

    The word hashes are bound by a one-element transform: as a column of their own they would be
    computed again for every shingle once a filter on the result is pushed below them.
    """
    def of_words(h):
        hashes = F.transform(F.sequence(F.lit(0), F.size(h) - WORDS),
                             lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(WORDS)]))
        return F.when(F.size(h) >= WORDS + max(least, 1) - 1, hashes)
    return F.get(F.transform(F.array(word_hashes(text)), of_words), F.lit(0))


def short_shingles(text: Column, k: Column) -> Column:
    """Array of the hashes of the runs of ``k`` of a text's fine words, repeated ones included."""
    def of_words(w):
        runs = F.transform(F.sequence(F.lit(0), F.size(w) - k), lambda i: F.xxhash64(k, F.slice(w, i + 1, k)))
        return F.when(F.size(w) >= k, runs).otherwise(_none())
    return F.get(F.transform(F.array(fine_words(text)), of_words), F.lit(0))


def _small(df: DataFrame, n_bytes: int) -> DataFrame:
    return F.broadcast(df) if n_bytes <= BROADCAST_BYTES else df


def _found(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_id: str, item_text: str,
           percent: int) -> DataFrame:
    """(id, th, item_id, n_shared, n_shingles) of every document and item it holds; th is the hash of its text."""
    text = F.col(item_text)
    run = F.when(F.size(words_of(text)).between(1, WORDS - 1), F.least(F.size(fine_words(text)), F.lit(WORDS)))
    item_sets = (items.select(F.col(item_id).alias("item_id"), text.alias("t"), run.alias("run"))
                 .select("item_id", "run", F.array_sort(F.array_distinct(
                     F.when(F.col("run").isNull(), shingles(F.col("t"))).otherwise(short_shingles(F.col("t"), F.col("run"))))).alias("s"))
                 .where("s is not null").withColumn("n", F.size("s")))
    need = F.expr(f"cast(({percent} * n + 99) div 100 as int)")
    part = F.floor(F.log2("n")).cast("int")
    upper = F.expr("cast(shiftleft(1, p + 1) - 1 as int)")
    sketched = (item_sets.withColumn("need", need).withColumn("p", part).withColumn("u", upper)
                .withColumn("k", F.expr(f"if(run is null, least(n, u - cast(({percent} * u + 99) div 100 as int) + 1), n)"))
                .withColumn("sketch", F.slice("s", 1, F.col("k"))))
    long = F.col("run").isNull()
    facts = sketched.agg(F.sum("k").alias("k"), F.sum("n").alias("all"),
                         F.max(F.when(long, F.element_at("sketch", -1))).alias("top"), F.min(F.when(long, F.col("need"))).alias("need"),
                         F.collect_set("run").alias("runs")).first()
    sketch_bytes, set_bytes, least = (facts["k"] or 0) * 40, (facts["all"] or 0) * 16, facts["need"] or 0
    top = F.lit(facts["top"]).cast("long")
    short = [short_shingles(F.col("t"), F.lit(k)) for k in sorted(facts["runs"])]        # of at most five lengths

    def with_short(x: Column) -> Column:
        return F.concat(*[F.coalesce(y, _none()) for y in (x, *short)]) if short else x

    sketches = sketched.select("item_id", F.explode("sketch").alias("x"))
    ids = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("t"))
    # the outer form keeps Spark from computing the array once more for a filter on its size
    sent = ids.select("id", "th", F.explode_outer(with_short(
        F.filter(shingles(F.col("t"), least), lambda x: x <= top))).alias("x"))
    hits = sent.join(_small(sketches, sketch_bytes), "x").select("id", "th", "item_id")
    candidates = (hits.groupBy("id", "th").agg(F.collect_set("item_id").alias("items"))
                  .select(F.col("id").alias("c_id"), F.col("th").alias("c_th"), "items"))
    held = (ids.join(candidates, ids["id"].eqNullSafe(candidates["c_id"]) & (ids["th"] == candidates["c_th"]))
            .select("id", "th", F.array_distinct(with_short(shingles(F.col("t")))).alias("d"), "items")
            .select("id", "th", "d", F.explode_outer("items").alias("item_id"))
            .join(_small(item_sets, set_bytes), "item_id")
            .select("id", "th", "item_id", F.size(F.array_intersect("s", "d")).alias("n_shared"), F.col("n").alias("n_shingles")))
    return held.where(F.col("n_shared") * 100 >= F.col("n_shingles") * percent)


def find_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_id: str = "item_id", item_text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(id, item_id, n_shared, n_shingles, containment) of every document and item it holds."""
    return (_found(docs, items, id_col, text_col, item_id, item_text, percent)
            .select(F.col("id").alias(id_col), F.col("item_id").alias(item_id), "n_shared", "n_shingles",
                    F.round(F.col("n_shared") / F.col("n_shingles"), 6).alias("containment")))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      item_id: str = "item_id", item_text: str = "text", percent: int = PERCENT,
                      by_row: bool = False) -> DataFrame:
    """``docs`` without the ids that hold an item; with ``by_row`` only the rows whose own text does go.

    A row without an id is always judged by its own text.
    """
    found = _found(docs, items, id_col, text_col, item_id, item_text, percent)

    def own(id_, hash_):
        return hash_ if by_row else F.when(id_.isNull(), hash_)
    found = found.select(F.col("id").alias("_found"), own(F.col("id"), F.col("th")).alias("_th")).distinct()
    same = docs[id_col].eqNullSafe(found["_found"]) & own(docs[id_col], F.xxhash64(docs[text_col])).eqNullSafe(found["_th"])
    return docs.join(found, same, "left_anti")
