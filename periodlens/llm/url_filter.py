"""URL filter: a blocked Bloom filter over a list of canonical URL prefixes, then an exact join.

Each listed entry is a canonical (host, path prefix).  A URL is looked up under every suffix of
its host (whole labels) combined with every prefix of its path that has the length of some listed
path.  A Bloom block (512 bits: eight 64-bit words, one bit set in each) is picked by one hash and
its bits by another, so that a lookup reads a single row of the filter.  Probes that the filter
lets through go on to an exact join with the list, which removes the false positives.

DataFrame functions only.  The filter takes about two bytes an entry and is broadcast while it is
below ``BROADCAST_BYTES`` (the list is counted first); a larger one is joined on (block, salt) with
the filter repeated once per salt, because a few suffixes (``net/``) are probed by a large share
of all URLs.  The exact join treats the list in the same way.

Defined results: a null URL, or one without ``://``, has an empty host and path and no rule; an empty
table gives an empty result; repeated rows and repeated ids each keep their own row; a null entry in
the list matches nothing; of entries that are equally long the greatest rule text wins; columns of
the input that are not named in the output are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodlens.llm.common import BROADCAST_BYTES, ascii_lower

WORDS = 8                     # 64-bit words in a block
ENTRIES_PER_BLOCK = 32        # 16 bits an entry
SALTS = 16


def url_parts(url):
    """(host, path) of a URL column: see the module's contract."""
    text = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(text, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(text, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def _key_hashes(host, path):
    key = F.concat_ws("\u0001", host, path)
    return F.xxhash64(key, F.lit(1)), F.xxhash64(key, F.lit(2))


def _masks(h2):
    """One bit in each word: six bits of the second hash, taken at a different place each time."""
    return [F.expr(f"shiftleft(1L, cast(shiftrightunsigned(_h2, {7 * i}) & 63 as int))").alias(f"m{i}")
            for i in range(WORDS)]


def bloom_blocks(listed: DataFrame, n_blocks: int) -> DataFrame:
    """The filter: one row (block, w0..w7) for every block with an entry."""
    h1, h2 = _key_hashes(F.col("host"), F.col("path"))
    rows = (listed.where("host is not null and path is not null")
            .select(F.pmod(h1, F.lit(n_blocks)).alias("block"), h2.alias("_h2"))
            .select("block", *_masks(F.col("_h2"))))
    return rows.groupBy("block").agg(*[F.bit_or(f"m{i}").alias(f"w{i}") for i in range(WORDS)])


def _lookup(left: DataFrame, right: DataFrame, on: list[str], small: bool) -> DataFrame:
    """Inner join of probes with a table that has one row a key."""
    if small:
        return left.join(F.broadcast(right), on)
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    left = left.withColumn("_salt", F.pmod(F.hash("rid"), F.lit(SALTS)))
    right = right.withColumn("_salt", salts)
    return left.join(right, [*on, "_salt"]).drop("_salt")


def filter_urls(pages: DataFrame, listed: DataFrame, id_col: str = "page_id", url_col: str = "url",
                default: str = "allow") -> DataFrame:
    """Verdict for every URL of ``pages`` by the longest listed entry that fits it.

    ``listed`` has host, path, rule and verdict.  Returns id_col, host, path, rule, verdict; URLs
    that no entry fits get ``default``.
    """
    listed = listed.select("host", "path", "rule", "verdict").where("host is not null and path is not null")
    # The list's size and the distinct lengths of its paths (at most the longest path's length).
    facts = listed.agg(F.count("*").alias("n"), F.collect_set(F.length("path")).alias("lengths"),
                       F.sum(F.length("rule") + F.length("path") + F.length("host") + 64).alias("bytes")).first()
    lengths = sorted(facts["lengths"])
    n_blocks = max(1, -(-facts["n"] // ENTRIES_PER_BLOCK))
    host, path = url_parts(F.col(url_col))
    urls = pages.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias(id_col),
                        host.alias("host"), path.alias("path"))
    labels = F.split("host", r"\.")
    suffixes = F.expr("transform(sequence(1, size(labels)), i -> array_join(slice(labels, i, size(labels)), '.'))")
    prefixes = F.expr("transform(filter(array(" + ", ".join(map(str, lengths)) + "), n -> n <= length(path)), "
                      "n -> substring(path, 1, n))") if lengths else F.expr("cast(array() as array<string>)")
    h1, h2 = _key_hashes(F.col("p_host"), F.col("p_path"))
    probes = (urls.withColumn("labels", labels)
              .select("rid", suffixes.alias("hosts"), prefixes.alias("paths"))
              .select("rid", F.explode("hosts").alias("p_host"), "paths")
              .select("rid", "p_host", F.explode("paths").alias("p_path"))
              .select("rid", "p_host", "p_path", F.pmod(h1, F.lit(n_blocks)).alias("block"), h2.alias("_h2")))
    passed = (_lookup(probes, bloom_blocks(listed, n_blocks), ["block"], n_blocks * 80 <= BROADCAST_BYTES)
              .select("rid", "p_host", "p_path", *[F.col(f"w{i}") for i in range(WORDS)], *_masks(F.col("_h2")))
              .where(" and ".join(f"(w{i} & m{i}) = m{i}" for i in range(WORDS)))
              .select("rid", F.col("p_host").alias("host"), F.col("p_path").alias("path")))
    best = F.struct(F.length("rule").alias("n"), "rule", "verdict")
    hits = (_lookup(passed, listed, ["host", "path"], (facts["bytes"] or 0) <= BROADCAST_BYTES)
            .select("rid", best.alias("best")))
    none = F.lit(None).cast(hits.schema["best"].dataType)
    rows = (urls.select("rid", F.struct(id_col, "host", "path").alias("page"), none.alias("best"))
            .unionByName(hits.select("rid", F.lit(None).cast(
                urls.select(F.struct(id_col, "host", "path").alias("page")).schema["page"].dataType).alias("page"),
                "best")))
    return (rows.groupBy("rid").agg(F.first("page", ignorenulls=True).alias("page"), F.max("best").alias("best"))
            .select("page.*", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))
