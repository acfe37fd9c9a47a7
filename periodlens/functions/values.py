"""Sentinel-aware numeric expressions over text-typed measures.

Snapshot measures (``employment``, ``salary``, ``los``) arrive as text and carry
several "no value" states.  Everything here returns a ``Column`` so it stays
inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from periodlens.functions.common import as_col

# --- fixed values -----------------------------------------------------------
# Marker written into suppressed cells.
REDACTED = "REDACTED"
# Strings that mean "missing" in a text measure (null is missing too).
MISSING_MARKERS = ("", "nan", "*****")
# Every non-value state of a measure cell: missing markers plus the redaction marker.
SENTINELS = MISSING_MARKERS + (REDACTED,)
# Decimal number text accepted by the numeric parse: optional sign, digits with an
# optional point (12, 12., .5), optional exponent.  inf, nan, 1_000, 1.5d are not numbers.
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
# Plain non-negative integer text (digits only).
DIGITS_PATTERN = r"^[0-9]+$"
# ----------------------------------------------------------------------------

# Policies for text; a partial aggregate's column is a number already, which the policy ``SUMMED`` takes as it is.
COUNT_POLICIES = ("skip", "impute_one", "digits_else_zero", "coerce_zero")
SUMMED = "summed"


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sql_strip(x: str) -> str:
    return f"regexp_replace({x}, {_lit(r'(?U)^\s+|\s+$')}, '')"


def _sql_missing(x: str, markers=MISSING_MARKERS) -> str:
    return f"({x} IS NULL OR {x} IN ({', '.join(_lit(m) for m in markers)}))"


def _sql_number(x: str) -> str:
    t = _sql_strip(x)
    return f"CASE WHEN {t} RLIKE {_lit(NUMBER_PATTERN)} THEN try_cast({t} AS DOUBLE) END"


def _sql_safe_int(x: str) -> str:
    return (f"CASE WHEN NOT {_sql_missing(x)} THEN coalesce(try_cast({x} AS BIGINT), "
            f"try_cast({_sql_number(x)} AS BIGINT)) END")


def _sql_count_value(x: str, policy: str) -> str:
    if policy == "skip":
        return f"CASE WHEN NOT {_sql_missing(x, SENTINELS)} THEN {_sql_safe_int(x)} END"
    if policy == "impute_one":
        return f"coalesce(CAST(try_cast({x} AS BIGINT) AS DOUBLE), {_sql_number(x)}, 1.0D)"
    if policy == "digits_else_zero":
        return f"coalesce(CASE WHEN {x} RLIKE {_lit(DIGITS_PATTERN)} THEN try_cast({x} AS BIGINT) END, 0L)"
    if policy == "coerce_zero":
        return f"coalesce(CAST(try_cast({x} AS BIGINT) AS DOUBLE), {_sql_number(x)}, 0.0D)"
    if policy == SUMMED:
        return x
    raise ValueError(f"unknown count policy {policy!r}; expected one of {(*COUNT_POLICIES, SUMMED)}")


def strip_ws(c) -> Column:
    """Strip leading/trailing whitespace, Unicode-aware (like Python ``str.strip``)."""
    return F.regexp_replace(as_col(c), r"(?U)^\s+|\s+$", "")


def is_missing(c) -> Column:
    """True for null and the missing markers ('' / 'nan' / '*****')."""
    c = as_col(c)
    return c.isNull() | c.isin(*MISSING_MARKERS)


def is_sentinel(c) -> Column:
    """True for null, the missing markers and REDACTED."""
    c = as_col(c)
    return c.isNull() | c.isin(*SENTINELS)


def parse_number(c) -> Column:
    """Text → double, or null when the text is not a plain decimal number."""
    if isinstance(c, str):
        return F.expr(_sql_number(_ident(c)))
    t = strip_ws(c)
    return F.when(t.rlike(NUMBER_PATTERN), t.try_cast("double"))


def _int_text(c) -> Column:
    """Fast path: plain integer text (optional sign, surrounding ASCII blanks) → bigint, else null.

    Spark's string→bigint cast accepts exactly that form, so the regular expression in
    ``parse_number`` only runs for the rare non-integer cells.
    """
    return as_col(c).try_cast("bigint")


def safe_int(c) -> Column:
    """Sentinel-aware integer parse: missing → null, else int(float(x)) truncating to 0.

    Non-numbers (including REDACTED) → null, as are values outside the bigint range.
    """
    if isinstance(c, str):      # one SQL expression: parsed JVM-side in a single call
        return F.expr(_sql_safe_int(_ident(c)))
    return F.when(~is_missing(c), F.coalesce(_int_text(c), parse_number(c).try_cast("bigint")))


def count_value(c, policy: str) -> Column:
    """Per-row numeric value of a text count under one of the coercion policies.

    skip             sentinels and non-numbers are ignored (null)
    impute_one       sentinels and non-numbers count as 1 (double)
    digits_else_zero digit-only text is its integer, everything else 0
    coerce_zero      numbers are their value, everything else 0 (double)
    summed           a number already: the sum of a partial aggregate
    """
    if isinstance(c, str):
        return F.expr(_sql_count_value(_ident(c), policy))
    if policy == "skip":
        return F.when(~is_sentinel(c), safe_int(c))
    if policy == "impute_one":
        return F.coalesce(_int_text(c).cast("double"), parse_number(c), F.lit(1.0))
    if policy == "digits_else_zero":
        c = as_col(c)
        return F.coalesce(F.when(c.rlike(DIGITS_PATTERN), c.try_cast("bigint")), F.lit(0).cast("bigint"))
    if policy == "coerce_zero":
        return F.coalesce(_int_text(c).cast("double"), parse_number(c), F.lit(0.0))
    if policy == SUMMED:
        return as_col(c)
    raise ValueError(f"unknown count policy {policy!r}; expected one of {(*COUNT_POLICIES, SUMMED)}")


def count_sum(c, policy: str) -> Column:
    """Aggregate: the group total of a text count under ``policy``, as bigint.

    Fractional totals (impute_one / coerce_zero) are rounded half-to-even, as numpy does.
    An all-skipped group sums to 0, not null.
    """
    v = count_value(c, policy)
    if policy in ("impute_one", "coerce_zero"):
        return F.bround(F.sum(v), 0).cast("bigint")
    return F.coalesce(F.sum(v), F.lit(0)).cast("bigint")


def count_if_equal(c, value: str) -> Column:
    """Aggregate: number of rows where the cell equals ``value`` (nulls never match)."""
    return F.count_if(F.coalesce(as_col(c) == F.lit(value), F.lit(False)))
