"""Document fingerprints: a homomorphic hash of a text's multiset of paragraphs.

A paragraph is a line, or a sentence of one (a blank after ``.``, ``!`` or ``?`` ends it); empty ones do
not count.  Its hash is a vector of 64 lanes, the hexadecimal digits of its SHA-256.  A text's fingerprint
is the number of its paragraphs (modulo 2^32) and the sum of their vectors, each lane modulo 2^16.  So the order
of paragraphs does not matter, and a paragraph is inserted or removed by adding or subtracting its vector
(``add``, ``subtract``), without the rest of the text.

The digits are small next to the modulus, so the difference of two fingerprints also tells how
many paragraphs differ: its variance over the lanes is that number times 85/4 (the variance of a
uniform digit).  ``likeness`` turns this into the estimated Jaccard similarity of the multisets.

DataFrame functions only.  Paragraphs are summed where the text is read (map-side), so only
vectors travel; nothing is gathered per paragraph, so a frequent paragraph makes no hot key.

Defined results: a null text is the empty text; the empty text has the zero vector; two empty
texts have likeness 1; repeated rows give repeated results; a null id sorts before all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LANES = 64
_CHUNKS = [(1, 15), (16, 15), (31, 15), (46, 15), (61, 4)]     # digits of the hash that fit a long
MAX_RANGES = 4096


def paragraphs(text: Column) -> Column:
    """Array of the non-empty paragraphs of a text."""
    lines = F.split(F.regexp_replace(text, r"([.!?])[ \t]+", "$1\n"), "\n")
    return F.filter(lines, lambda p: p != "")


def sum_paragraphs(rows: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """One fingerprint for each key: ``keys``, ``n`` and ``v`` (array of lane sums, reduced)."""
    digits = [f"cast(conv(substring(_h, {at}, {n}), 16, 10) as bigint) as _c{i}" for i, (at, n) in enumerate(_CHUNKS)]
    hashed = (rows.select(*keys, F.explode_outer(paragraphs(F.col(text_col))).alias("_p"))
              .select(*keys, F.sha2(F.col("_p").cast("binary"), 256).alias("_h"))
              .selectExpr(*[f"`{k}`" for k in keys], "if(_h is null, 0, 1) as _one", *digits))
    lanes = [F.coalesce(F.sum(F.expr(f"shiftright(_c{i}, {4 * (n - 1 - j)}) & 15")), F.lit(0)).alias(f"_l{at - 1 + j}")
             for i, (at, n) in enumerate(_CHUNKS) for j in range(n)]
    summed = hashed.groupBy(*keys).agg(F.sum("_one").alias("_n"), *lanes)
    return summed.select(*keys, F.pmod("_n", F.lit(1 << 32)).alias("n"),
                         F.array(*[F.pmod(F.col(f"_l{i}"), F.lit(1 << 16)).cast("int") for i in range(LANES)]).alias("v"))


def add(a: Column, b: Column) -> Column:
    """The vector of both multisets together."""
    return F.zip_with(a, b, lambda x, y: F.pmod(x + y, F.lit(1 << 16)))


def subtract(a: Column, b: Column) -> Column:
    """The vector of the first multiset without the second."""
    return F.zip_with(a, b, lambda x, y: F.pmod(x - y, F.lit(1 << 16)))


def as_text(n: Column, v: Column) -> Column:
    """A fingerprint as lower-case hexadecimal digits: the count, then the lanes."""
    return F.lower(F.concat(F.lpad(F.hex(n), 8, "0"),
                            F.array_join(F.transform(v, lambda x: F.lpad(F.hex(x), 4, "0")), "")))


def likeness(n_a: Column, a: Column, n_b: Column, b: Column) -> Column:
    """Estimated Jaccard similarity (0 to 1) of two multisets of paragraphs from their fingerprints."""
    shift = (n_a - n_b).cast("double") * 7.5
    diff = F.zip_with(a, b, lambda x, y: (F.pmod(x - y + 32768, F.lit(65536)) - 32768).cast("double") - shift)
    spread = F.aggregate(diff, F.lit(0.0), lambda s, d: s + d * d) / (LANES * 21.25)
    total = (n_a + n_b).cast("double")
    differ = F.least(F.greatest(spread, F.abs(n_a - n_b).cast("double")), total)
    common = (total - differ) / 2
    return (F.when((n_a == n_b) & (a == b), 1.0)
            .otherwise(F.round(common / F.greatest(total - common, F.lit(1.0)), 6)))


def _ranges(docs: DataFrame, id_col: str, n: int) -> list[int]:
    """Ids at which the ranges of about equal numbers of rows begin; the first is the least id."""
    share = F.array(*[F.lit(i / n) for i in range(1, n)])
    got = docs.agg(F.min(id_col).alias("least"), F.percentile_approx(id_col, share).alias("at")).first()
    return sorted({got["least"], *(got["at"] or [])} - {None})


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows by ranges of ids with each row's successor (after the last: the first).

    Returns range_no, seq (the row's place in its range), ghost, id, text, next_text.  A range ends with a
    ghost: a copy of the first row of the next range, so that no range waits for another.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = min(MAX_RANGES, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    begins = _ranges(rows, "id", n)
    if not begins:
        begins = [0]
    steps, p = [], 1 << (len(begins).bit_length() - 1)
    while p:
        steps.append(p)
        p >>= 1
    bounds = "array(" + ",".join(f"{b}L" if b > -(1 << 63) else "cast(-9223372036854775808 as bigint)" for b in begins) + ")"
    search = (f"aggregate(array({','.join(map(str, steps))}), 0, (at, p) -> "
              f"if(at + p <= {len(begins)} and get({bounds}, at + p - 1) <= id, at + p, at))")
    placed = rows.withColumn("range_no", F.expr(search)).withColumn("ghost", F.lit(0))
    last = len(begins)
    ghosts = (rows.where(F.col("id").isin(begins)).groupBy("id").agg(F.min("text").alias("text"))
              .withColumn("at", F.expr(search))
              .withColumn("range_no", F.when(F.col("at") == 1, F.lit(last)).otherwise(F.col("at") - 1))
              .withColumn("ghost", F.lit(1)).select(*placed.columns))
    w = Window.partitionBy("range_no").orderBy("ghost", "id", "text")
    return (placed.unionByName(ghosts)
            .select("range_no", F.row_number().over(w).alias("seq"), "ghost", "id", "text",
                    F.lead("text").over(w).alias("next_text")))


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint every text and its edited form, with the likeness of the first to the edited and the next.

    The edited text ends with as many code points of the next text's beginning (or all of it) as
    half of the text (rounded down) has, in the place of its last ones.
    """
    size = F.char_length("text")
    half = F.floor(size / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), size - half), F.substring("next_text", F.lit(1), half))
    rows = (with_next(docs, id_col, text_col)
            .select("range_no", "seq", "ghost", "id", size.cast("long").alias("n_chars"), "text",
                    F.when(F.col("ghost") == 0, edited).alias("edited")))
    both = (rows.select("range_no", "seq", "ghost", "id", "n_chars",
                        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                        F.explode(F.array(F.struct(F.lit(0).alias("k"), F.col("text").alias("t")),
                                          F.struct(F.lit(1).alias("k"), F.col("edited").alias("t")))).alias("x"))
            .select("range_no", "seq", "ghost", "id", "n_chars", "edited_sha256", "x.k", "x.t"))
    keys = ["range_no", "seq", "ghost", "id", "n_chars", "edited_sha256", "k"]
    sums = sum_paragraphs(both, keys, "t")
    pick = [F.max(F.when(F.col("k") == k, F.col(c))).alias(f"{c}{k}") for k in (0, 1) for c in ("n", "v")]
    w = Window.partitionBy("range_no").orderBy("seq")
    prints = (sums.groupBy("range_no", "seq", "ghost", "id", "n_chars", "edited_sha256").agg(*pick)
              .withColumn("n2", F.lead("n0").over(w)).withColumn("v2", F.lead("v0").over(w)).where("ghost = 0"))
    c = F.col
    return prints.select(
        F.when(c("id") > -(1 << 63), c("id")).alias(id_col), "n_chars", "edited_sha256",
        as_text(c("n0"), c("v0")).alias("fingerprint"), as_text(c("n1"), c("v1")).alias("edited_fingerprint"),
        likeness(c("n0"), c("v0"), c("n1"), c("v1")).alias("near_edited"),
        likeness(c("n0"), c("v0"), c("n2"), c("v2")).alias("near_next"))
