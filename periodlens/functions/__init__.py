"""Column expressions (scalar functions) — all built-in Spark functions, no UDFs."""

from periodlens.functions.common import as_col, string_columns
from periodlens.functions.periods import (
    dataset_key, datecode, month_number, pct_change, period_from_path, period_label,
    period_sort_key, quarter_name_from_month,
)
from periodlens.functions.text import (
    agency_display_name, agency_label, appointment_class, clean_category, code_label,
    compose_key, pay_grade, pay_plan, plan_grade, row_contains, row_has_value,
    strip_generic_prefix, strip_numeric_prefix, trim_all, zero_pad,
)
from periodlens.functions.values import (
    MISSING_MARKERS, REDACTED, SENTINELS, count_if_equal, count_sum, count_value,
    is_missing, is_sentinel, parse_number, safe_int, strip_ws,
)

__all__ = [n for n in dir() if not n.startswith("_")]
