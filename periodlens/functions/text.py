"""Text expressions for codes and descriptions (all JVM-side Column builders)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from periodlens.functions.common import as_col
from periodlens.functions.values import REDACTED, strip_ws

# --- fixed values -----------------------------------------------------------
# Generic code prefix on descriptions, e.g. 'VATA-' or '0610-'.
GENERIC_PREFIX = r"^[A-Z0-9]+-"
# Numeric code prefix (1-2 digits) and the '**-' prefix, removed in that order.
NUMERIC_PREFIX = r"^\d{1,2}-"
STARS_PREFIX = r"^\*\*-"
# Description columns whose labels carry numeric prefixes only; the generic rule
# would damage labels such as '20-24' or "POST-BACHELOR'S".
NUMERIC_PREFIX_COLUMNS = ("edlvlt", "toat")
# Appointment class words, tested in this order.
NONPERMANENT = "NONPERMANENT"
PERMANENT = "PERMANENT"
# Main agency names by words of a sub-agency label, tested in this order, and the agency code with a name of its own.
FORCE_PREFIX = "AF"
AGENCY_WORDS = (("AIR FORCE", "AIR FORCE"), ("ARMY", "ARMY"), ("NAVAL", "NAVY"), ("NAVY", "NAVY"))
AGENCY_CODES = {"DD": "DEPARTMENT OF DEFENSE"}
# Placeholder for a missing description in a code label.
UNKNOWN_LABEL = "Unknown"
# ----------------------------------------------------------------------------


def trim_all(c) -> Column:
    """Strip surrounding whitespace (Unicode-aware); null stays null."""
    return strip_ws(c)


def zero_pad(c, width: int = 2) -> Column:
    """Left-pad with zeros to ``width``; never shortens longer values; null stays null."""
    c = as_col(c)
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def strip_generic_prefix(c) -> Column:
    return F.regexp_replace(as_col(c), GENERIC_PREFIX, "")


def strip_numeric_prefix(c) -> Column:
    return F.regexp_replace(F.regexp_replace(as_col(c), NUMERIC_PREFIX, ""), STARS_PREFIX, "")


def clean_category(c, column_name: str | None = None) -> Column:
    """Prefix clean dispatched by column name: numeric rule for ``edlvlt``/``toat``, else generic."""
    name = column_name if column_name is not None else (c if isinstance(c, str) else "")
    if name in NUMERIC_PREFIX_COLUMNS:
        return strip_numeric_prefix(c)
    return strip_generic_prefix(c)


def _nonempty(c: Column) -> Column:
    return F.when(c != "", c)


def pay_plan(c) -> Column:
    """Letters part of a plan/grade code such as 'GS-4' → 'GS' (null if none)."""
    s = F.regexp_replace(as_col(c), "-", "")
    return _nonempty(F.regexp_extract(s, "([A-Z]+)", 1))


def pay_grade(c) -> Column:
    """Digits part of a plan/grade code such as 'GS-4' → '4' (null if none)."""
    s = F.regexp_replace(as_col(c), "-", "")
    return _nonempty(F.regexp_extract(s, "([0-9]+)", 1))


def compose_key(left, right, width: int = 2) -> Column:
    """``left + '-' + zero_pad(right)``; null if either part is null."""
    return F.concat(as_col(left), F.lit("-"), zero_pad(right, width))


def plan_grade(c) -> Column:
    """Standardised plan-grade category: 'GS4' / 'GS-4' → 'GS-04'."""
    return compose_key(pay_plan(c), pay_grade(c))


def appointment_class(c) -> Column:
    """'Nonpermanent' / 'Permanent' / 'Other' from an appointment description (case-insensitive)."""
    u = F.upper(F.coalesce(as_col(c).cast("string"), F.lit("")))
    return (F.when(u.contains(NONPERMANENT), F.lit("Nonpermanent"))
            .when(u.contains(PERMANENT), F.lit("Permanent"))
            .otherwise(F.lit("Other")))


def code_label(code, desc) -> Column:
    """``'<code>: <desc>'`` with 'Unknown' for a null or empty description."""
    d = as_col(desc)
    return F.concat(as_col(code), F.lit(": "),
                    F.when(d.isNull() | (d == ""), F.lit(UNKNOWN_LABEL)).otherwise(d))


def agency_display_name(code, name) -> Column:
    """Main agency name from a sub-agency label, by ordered rules.

    A label with the force prefix gives the first two words after its dash; else the first of ``AGENCY_WORDS``
    that it contains decides, then ``AGENCY_CODES``, then the label itself; a null label falls back to the code.
    """
    code, name = as_col(code), as_col(name)
    after_dash = F.split(name, "-", 2).getItem(1)
    two_words = F.array_join(F.slice(F.split(after_dash, " "), 1, 2), " ")
    out = F.when(name.isNull(), code).when(name.startswith(FORCE_PREFIX) & name.contains("-"), two_words)
    for word, main in AGENCY_WORDS:
        out = out.when(name.contains(word), F.lit(main))
    for known, main in AGENCY_CODES.items():
        out = out.when(code == known, F.lit(main))
    return out.otherwise(name)


def agency_label(code, name) -> Column:
    """``'<code> (<main agency name>)'``."""
    return F.concat(as_col(code), F.lit(" ("), agency_display_name(code, name), F.lit(")"))


def row_contains(columns, term: str) -> Column:
    """Case-insensitive substring match of ``term`` over the space-joined row text."""
    text = F.lower(F.concat_ws(" ", *[as_col(c).cast("string") for c in columns]))
    return text.contains(term.lower())


def row_has_value(columns, value: str = REDACTED) -> Column:
    """True when any of ``columns`` equals ``value`` (nulls never match)."""
    columns = list(columns)
    if columns and all(isinstance(c, str) for c in columns):   # one SQL expression for wide rows
        v = "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return F.expr(" OR ".join("coalesce(`" + c.replace("`", "``") + f"` = {v}, false)" for c in columns))
    tests = [F.coalesce(as_col(c) == F.lit(value), F.lit(False)) for c in columns]
    return reduce(lambda a, b: a | b, tests) if tests else F.lit(False)
