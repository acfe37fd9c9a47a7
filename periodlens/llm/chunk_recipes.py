"""Exact deduplication by recipes of content-defined chunks.

A text is compared without its white space (``[\\x20\\x09-\\x0D]``).  What is left is read as bytes and cut into chunks
where its content says so: after at least ``MIN_CHUNK`` bytes, at the first four bytes that fall into four fixed
classes; after ``MAX_CHUNK`` bytes in any case.  Equal texts have equal chunks, and texts that share long passages share
chunks.

1. Each distinct chunk gets an identifier: the hash of its bytes.  Chunks are deduplicated by hash *and* bytes (partly
   where they are read, so a chunk of many copies travels once a task).  If a hash has several chunks, they are numbered
   in the order of their bytes, so that (hash, number) names exactly one chunk.
2. A text's recipe is the ordered list of its chunks' identifiers: one long for about a thousand bytes, and the
   numbers of those few chunks whose hash is not unique.  Two texts are equal exactly if their recipes are.
3. Rows are grouped by recipe.  From here on no text moves: a row is its id, length, digest and recipe.

DataFrame functions only.  A group is never gathered: its size and the row that stays are aggregates, combined before the
shuffle, and come back by a join in which Spark may split a large group.  Groups of one row are not joined at all.

Defined results: a null text is empty; all texts without other characters are equal to the empty one.  Of equal texts the
row with the most code points stays, then that with the least id (a null id is after all others); of rows that
tie in both, exactly one stays.  An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from periodlens.llm.common import stored
from periodlens.session import materialize

BLANKS = r"[\x20\x09-\x0D]+"
MIN_CHUNK, MAX_CHUNK = 256, 4096
# A boundary is where four successive bytes fall into these residue classes (about one place in a thousand of prose).
BOUNDARY = ((8, 1), (8, 4), (4, 1), (8, 6))
HASH_BITS = 64


def _class(modulus: int, rest: int) -> str:
    return "[" + "".join(f"\\x{b:02x}" for b in range(256) if b % modulus == rest) + "]"


def chunk_pattern(least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> str:
    """Pattern of one chunk of bytes (as Latin-1 characters)."""
    ends = "".join(_class(m, r) for m, r in BOUNDARY)
    n = len(BOUNDARY)
    return f"(?s).{{{max(least - n, 0)},{max(most - n, 0)}}}?{ends}|.{{1,{most}}}"


def without_blanks(text: Column) -> Column:
    """The text without white space; null is the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, "")


def chunks(text: Column, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> Column:
    """Content-defined chunks of a text's UTF-8 bytes, each byte as a Latin-1 character."""
    return F.regexp_extract_all(F.decode(text.cast("binary"), "ISO-8859-1"), F.lit(chunk_pattern(least, most)), F.lit(0))


def chunk_hash(chunk: Column, bits: int = HASH_BITS) -> Column:
    h = F.xxhash64(chunk)
    return h if bits >= 64 else F.pmod(h, F.lit(1 << bits))


def numbered_chunks(texts: DataFrame, bits: int = HASH_BITS, least: int = MIN_CHUNK,
                    most: int = MAX_CHUNK) -> DataFrame | None:
    """Chunks whose hash has an earlier chunk too: (h, chunk, number from 1), written; None if no hash has two chunks.

    ``texts`` has a column ``norm``.  All distinct chunks are compared.
    """
    distinct = (texts.select(F.explode(chunks(F.col("norm"), least, most)).alias("chunk"))
                .select(chunk_hash(F.col("chunk"), bits).alias("h"), "chunk").distinct())
    several, n = materialize(distinct.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"),
                             "chunk-hashes", with_count=True)
    if not n:
        return None
    number = F.row_number().over(Window.partitionBy("h").orderBy("chunk")) - 1
    return stored(distinct.join(several, "h").select("h", "chunk", number.alias("number")).where("number > 0"),
                  "chunk-numbers")


def recipes(docs: DataFrame, id_col: str, text_col: str, bits: int = HASH_BITS, least: int = MIN_CHUNK,
            most: int = MAX_CHUNK) -> DataFrame:
    """A written row for each document: row, id, n_chars, text_sha256, recipe, numbers (null if all are the first)."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.char_length(text_col), F.lit(0)).cast("long").alias("n_chars"),
                       without_blanks(F.col(text_col)).alias("norm"))
    numbered = numbered_chunks(rows, bits, least, most)
    made = rows.select(F.monotonically_increasing_id().alias("row"), "id", "n_chars",
                       F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
                       F.transform(chunks(F.col("norm"), least, most), lambda c: chunk_hash(c, bits)).alias("recipe"),
                       *([] if numbered is None else ["norm"]))
    made = stored(made, "recipes")
    if numbered is None:       # every hash has one chunk: it is the identifier
        return made.withColumn("numbers", F.lit(None).cast("array<struct<at:int,number:int>>"))
    placed = made.select("row", F.posexplode(chunks(F.col("norm"), least, most)).alias("at", "chunk"))
    placed = placed.withColumn("h", chunk_hash(F.col("chunk"), bits)).join(numbered, ["h", "chunk"])
    numbers = placed.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("at", "number"))).alias("numbers"))
    return stored(made.drop("norm").join(numbers, "row", "left"), "recipes")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = HASH_BITS,
                 least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> DataFrame:
    """A row for each document: its id, keep_id (the id of the row that stays), group_size, kept, text_sha256.

    Other columns of ``docs`` are not read, whatever their names.
    """
    rows = recipes(docs, id_col, text_col, bits, least, most)
    key = ["recipe", "numbers"]
    best = F.min(F.struct((-F.col("n_chars")).alias("short"), F.col("id").isNull().alias("no_id"), F.col("id").alias("id"),
                          F.col("row").alias("row")))
    groups = (rows.groupBy(*key).agg(F.count("*").alias("size"), best.alias("best")).where("size > 1")
              .select(*[F.col(k).alias(f"g_{k}") for k in key], "size", F.col("best.id").alias("best_id"),
                      F.col("best.row").alias("best_row")))
    groups = stored(groups, "recipe-groups")
    same = [F.col(k).eqNullSafe(F.col(f"g_{k}")) if k == "numbers" else F.col(k) == F.col(f"g_{k}") for k in key]
    alone = F.col("best_row").isNull()
    return (rows.join(groups, same, "left")
            .select(F.col("id").alias(id_col), F.when(alone, F.col("id")).otherwise(F.col("best_id")).alias("keep_id"),
                    F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
                    (alone | (F.col("best_row") == F.col("row"))).alias("kept"), "text_sha256"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ids of the rows that stay (one of each group of equal texts)."""
    return exact_groups(docs, id_col, text_col).where("kept").select(id_col)
