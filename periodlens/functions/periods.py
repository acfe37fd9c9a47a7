"""Period (snapshot date) expressions: from file names, labels, sort keys, change ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from periodlens.functions.common import as_col

# --- fixed values -----------------------------------------------------------
# Snapshot months, in calendar order, with their file-name abbreviations.
QUARTER_MONTHS = ("March", "June", "September", "December")
MONTH_ABBREVIATIONS = {"MAR": "March", "JUN": "June", "SEP": "September", "DEC": "December"}
MONTH_NUMBERS = {"March": 3, "June": 6, "September": 9, "December": 12}
# File pattern FACTDATA_<MON><YYYY> (tested on the upper-cased name) and directory
# pattern <Month>_<YYYY>.
ABBREVIATED_PATTERN = r"([A-Z]{3})(\d{4})"
NAMED_PATTERN = r"(March|June|September|December)_(\d{4})"
# ----------------------------------------------------------------------------


def _month_map(mapping: dict) -> Column:
    keys, values = zip(*mapping.items())
    return F.map_from_arrays(F.array(*[F.lit(k) for k in keys]), F.array(*[F.lit(v) for v in values]))


def _parse_segment(seg: Column):
    """(matched, quarter, year) for one path segment: the abbreviated form on the upper-cased
    segment first, then the <Month>_<YYYY> form."""
    up = F.upper(seg)
    abbr = F.regexp_extract(up, ABBREVIATED_PATTERN, 1)
    abbr_year = F.regexp_extract(up, ABBREVIATED_PATTERN, 2)
    named = F.regexp_extract(seg, NAMED_PATTERN, 1)
    named_year = F.regexp_extract(seg, NAMED_PATTERN, 2)
    has_abbr, has_named = abbr != "", named != ""
    quarter = F.when(has_abbr, _month_map(MONTH_ABBREVIATIONS)[abbr]).when(has_named, named)
    year = F.when(has_abbr, abbr_year.cast("int")).when(has_named, named_year.cast("int"))
    return F.coalesce(has_abbr | has_named, F.lit(False)), quarter, year


def period_from_path(path, segments=(1, 2, 3)) -> Column:
    """struct(quarter STRING, year INT) from a file path; nulls when no segment matches.

    ``segments`` counts from the end (1 = file name, 2 = its directory, 3 = the one above) and
    is tried in order: by default the file name first, then the directories.  Files written by
    Spark itself carry generated names, so their period is read from the directory only
    (``segments=(2,)``).

    An unknown three-letter month gives a null quarter with the year (the row is rejected
    downstream) instead of inventing a month.  Higher path segments are never parsed, so a
    random temp or bucket name cannot be mistaken for a period.
    """
    segs = F.split(as_col(path), "/")
    n = F.size(segs)
    tried = F.array(*[F.coalesce(F.when(n >= k, F.element_at(segs, -k)), F.lit("")) for k in segments])

    def parsed(seg: Column) -> Column:
        matched, quarter, year = _parse_segment(seg)
        return F.struct(matched.alias("matched"), quarter.alias("quarter"), year.alias("year"))
    # a lambda is evaluated as it is, not unfolded into the generated code of the scan, which was too long to be compiled
    found = F.get(F.filter(F.transform(tried, parsed), lambda s: s["matched"]), F.lit(0))
    return F.get(F.transform(F.array(found), lambda s: F.struct(s["quarter"].alias("quarter"), s["year"].alias("year"))), F.lit(0))


def month_number(quarter) -> Column:
    return _month_map(MONTH_NUMBERS)[as_col(quarter)]


def quarter_name_from_month(month) -> Column:
    """3/6/9/12 → March/June/September/December."""
    inv = {v: k for k, v in MONTH_NUMBERS.items()}
    return _month_map(inv)[as_col(month)]


def dataset_key(year, quarter) -> Column:
    """``'<YYYY>_<Month>'`` — one form for every period."""
    return F.concat(as_col(year).cast("string"), F.lit("_"), as_col(quarter))


def datecode(year, quarter) -> Column:
    """``YYYYMM`` as text (e.g. '202409')."""
    return (as_col(year) * 100 + month_number(quarter)).cast("string")


def period_label(quarter, year) -> Column:
    """``'<Month> <YYYY>'``."""
    return F.concat_ws(" ", as_col(quarter), as_col(year).cast("string"))


def period_sort_key(year, quarter) -> Column:
    """Chronological key ``year*10 + quarter index (1..4)``."""
    idx = _month_map({m: i + 1 for i, m in enumerate(QUARTER_MONTHS)})[as_col(quarter)]
    return as_col(year) * 10 + idx


def pct_change(before, after) -> Column:
    """Percent change; before=0 gives 100 when after>0 else 0 (never divides by zero)."""
    b, a = as_col(before), as_col(after)
    return (F.when(b > 0, (a - b).cast("double") / b * 100.0)
            .when(a > 0, F.lit(100.0))
            .otherwise(F.lit(0.0)))
