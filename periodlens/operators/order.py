"""Ordering helpers: domain order, specials last, known-first, numeric-aware, sampling.

Each returns sort keys (Columns) or a ranked DataFrame.  Ranks are given by ``rank_codes`` (tables with one row for
each code); pass ``rank=with_position`` for tables of any size.  A head comes from a top-k.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodlens.functions.common import as_col
from periodlens.operators.position import down, up, rank_codes

# --- fixed values -----------------------------------------------------------
# Age band order (plus the two special labels, in order).
AGE_ORDER = ("Less than 20", "20-24", "25-29", "30-34", "35-39", "40-44", "45-49",
             "50-54", "55-59", "60-64", "65 or more", "Unspecified", "REDACTED")
# Education labels from least to most education, then the special labels.
EDUCATION_ORDER = (
    "NO FORMAL EDUCATION OR SOME ELEMENTARY SCHOOL - DID NOT COMPLETE",
    "ELEMENTARY SCHOOL COMPLETED - NO HIGH SCHOOL",
    "SOME HIGH SCHOOL - DID NOT COMPLETE",
    "HIGH SCHOOL GRADUATE OR CERTIFICATE OF EQUIVALENCY",
    "TERMINAL OCCUPATIONAL PROGRAM - DID NOT COMPLETE",
    "TERMINAL OCCUPATIONAL PROGRAM - CERTIFICATE OF COMPLETION, DIPLOMA OR EQUIVALENT",
    "SOME COLLEGE - LESS THAN ONE YEAR",
    "ONE YEAR COLLEGE",
    "TWO YEARS COLLEGE",
    "ASSOCIATE DEGREE",
    "THREE YEARS COLLEGE",
    "FOUR YEARS COLLEGE",
    "BACHELOR'S DEGREE",
    "POST-BACHELOR'S",
    "MASTER'S DEGREE",
    "POST-MASTER'S",
    "SIXTH-YEAR DEGREE",
    "POST-SIXTH YEAR",
    "FIRST PROFESSIONAL",
    "POST-FIRST PROFESSIONAL",
    "DOCTORATE DEGREE",
    "POST-DOCTORATE",
    "Invalid",
    "No Data Reported",
    "REDACTED",
)
# Characters ignored when reading a display value as a number.
NUMERIC_NOISE = r"[,+%]"
# ----------------------------------------------------------------------------


def domain_rank(c, labels) -> Column:
    """Position of the label in ``labels`` (0-based), the number of labels when absent."""
    labels = list(labels)
    if not labels:
        return F.lit(0)
    m = F.create_map(*[x for i, lab in enumerate(labels) for x in (F.lit(lab), F.lit(i))])
    return F.coalesce(m[as_col(c)], F.lit(len(labels)))


def specials_rank(c, specials=("REDACTED", "TOTAL")) -> Column:
    """0 for ordinary labels, 1.. for the listed special labels in order (sorts them last)."""
    expr = F.lit(0)
    for i, s in reversed(list(enumerate(specials, start=1))):
        expr = F.when(as_col(c) == s, F.lit(i)).otherwise(expr)
    return expr


def numeric_text(c) -> Column:
    """Display text read as a number after removing ',', '+', '%'; null if not numeric."""
    return F.regexp_replace(as_col(c).cast("string"), NUMERIC_NOISE, "").try_cast("double")


def rank_domain(df: DataFrame, col: str, labels, tie=None, name: str = "rank", rank=rank_codes) -> DataFrame:
    """Rank rows by a fixed label order, unknown labels after it, ties by ``tie`` (O2)."""
    tie = [col] if tie is None else ([tie] if isinstance(tie, str) else list(tie))
    d = df.withColumn("__dom", domain_rank(col, labels))
    return rank(d, ["__dom", *tie], name).drop("__dom")


def rank_known_first(df: DataFrame, col: str, known, name: str = "rank", rank=rank_codes) -> DataFrame:
    """Listed labels first in list order, then the rest alphabetically."""
    d = df.withColumn("__dom", domain_rank(col, known))
    return rank(d, ["__dom", col], name).drop("__dom")


def rank_specials_last(df: DataFrame, col: str, measure: str, name: str = "rank",
                       specials=("REDACTED", "TOTAL"), rank=rank_codes) -> DataFrame:
    """Measure descending, then the special labels in order (O3)."""
    d = df.withColumn("__sp", specials_rank(col, specials))
    return rank(d, ["__sp", down(measure), col], name).drop("__sp")


def rank_numeric_aware(df: DataFrame, col: str, descending: bool = False, tie=None,
                       name: str = "rank", rank=rank_codes) -> DataFrame:
    """Numeric order when the value parses as a number, text order otherwise.

    Numbers sort before text; ``descending`` reverses both.
    """
    tie = [] if tie is None else ([tie] if isinstance(tie, str) else list(tie))
    d = df.withColumn("__num", numeric_text(col)).withColumn("__isnum", F.col("__num").isNotNull())
    if descending:
        keys = [down("__isnum"), down("__num"), down(col)]
    else:
        keys = [down("__isnum"), up("__num", nulls_last=True), up(col, nulls_last=True)]
    return rank(d, keys + tie, name).drop("__num", "__isnum")


def sample_rows(df: DataFrame, n: int, seed: int, keys) -> DataFrame:
    """A repeatable pseudo-random sample of ``n`` rows: the smallest hashes of ``keys``.

    A distributed top-k on the MD5 of the keys and the seed, which other engines spell the same way;
    the same input always gives the same rows.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys], F.lit(str(seed)))
    return df.orderBy(F.md5(text), *keys).limit(n)
