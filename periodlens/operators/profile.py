"""Profiles of a snapshot: head counts, means, frequencies, numeric summaries,
redaction profiles, first values and de-duplication.

Every group aggregate here is decomposable (sum/count/min_by/count_if), so Spark runs a
partial aggregate per task before the shuffle; a key holding a third of all rows costs one
partial row per task.  Shares of "all rows" use a scalar subquery, not a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodlens.functions.common import string_columns
from periodlens.functions.values import REDACTED, count_sum, safe_int
from periodlens.operators.position import down, exact_median, rank_codes, top_n, up


def _mean(c: Column) -> Column:
    """Exact mean of an integer column: integer sum / count (no floating accumulation)."""
    return F.sum(c).cast("double") / F.count(c)


def headcount_top(df: DataFrame, group: str, n: int = 10, measure: str = "employment",
                  policy: str = "skip") -> DataFrame:
    """Top ``n`` groups by head count (A1): rank, group, headcount."""
    agg = (df.where(F.col(group).isNotNull()).groupBy(group)
           .agg(count_sum(measure, policy).alias("headcount")))
    return top_n(agg, [down("headcount"), up(group)], n).select("rank", group, "headcount")


def headcount_by(df: DataFrame, keys, measure: str = "employment", policy: str = "skip") -> DataFrame:
    """Head count per key combination (A3), null keys dropped."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    rows = df
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    return rows.groupBy(*keys).agg(count_sum(measure, policy).alias("headcount"))


def mean_by_group(df: DataFrame, group: str, value: str = "salary", n: int = 5) -> DataFrame:
    """Mean of a sentinel-aware integer measure by group, top ``n`` by mean (A2).

    Also carries the coverage of the measure: valid rows and their percent of all rows.
    Output: rank, group, mean_value, n_valid, n_rows (all rows of the group), valid_records, valid_pct,
    overall_mean.
    """
    num = safe_int(value)
    per = (df.select(F.col(group), num.alias("__v")).groupBy(group)
           .agg(F.count(F.lit(1)).alias("__rows"), F.count("__v").alias("n_valid"), F.sum("__v").alias("__sum")))
    # Coverage totals are sums over the per-group rows (the null group included), so the big
    # input is aggregated once; the scalar subquery reads the same shuffle output.
    totals = per.select(F.struct(F.sum("__rows").alias("rows"), F.sum("n_valid").alias("valid"),
                                 F.sum("__sum").alias("total"))).scalar()
    # No filter between the aggregate and the ranking: the null group and groups without a
    # valid value sort after every real group and are dropped from the (at most n) ranked rows,
    # so the aggregate stays identical to the one under the totals subquery and its shuffle is
    # reused instead of scanning the input twice.
    agg = per.select(group, F.round(F.col("__sum").cast("double") / F.col("n_valid"), 4).alias("mean_value"),
                     "n_valid", F.col("__rows").alias("n_rows"))
    top = top_n(agg, [F.col(group).isNull(), down("mean_value"), up(group)], n)
    top = top.where(F.col(group).isNotNull() & (F.col("n_valid") > 0)).withColumn("__tot", totals)
    return top.select("rank", group, "mean_value", "n_valid", "n_rows",
                      F.col("__tot.valid").cast("bigint").alias("valid_records"),
                      F.round(F.col("__tot.valid").cast("double") / F.col("__tot.rows") * 100.0, 4)
                      .alias("valid_pct"),
                      F.round(F.col("__tot.total").cast("double") / F.col("__tot.valid"), 4).alias("overall_mean"))


def frequency_share(df: DataFrame, col: str, n: int | None = None, by_label: bool = False) -> DataFrame:
    """Value counts of ``col`` (nulls dropped) with the share of all rows (A4): value, n, share_pct.

    ``n`` keeps the top-n by count (with a rank); ``by_label`` ranks by the value instead.
    """
    per = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    # all rows = the sum over every group, the null group included (one pass over the input)
    total = per.select(F.sum("n")).scalar()
    vc = per.where(F.coalesce(F.col(col).isNotNull() & (F.col("n") > 0), F.lit(False)))
    vc = vc.withColumn("share_pct", F.round(F.col("n").cast("double") / total * 100.0, 4))
    if n is not None:
        return top_n(vc, [down("n"), up(col)], n)
    if by_label:
        return rank_codes(vc, [col], "rank")
    return vc


def numeric_summary(df: DataFrame, value: str = "salary", by=None) -> DataFrame:
    """count, mean, exact median, min, max and sample std of a sentinel-aware integer measure (A5)."""
    by = [] if by is None else ([by] if isinstance(by, str) else list(by))
    rows = df.select(*by, safe_int(value).alias("__v")).where(F.col("__v").isNotNull())
    stats = rows.groupBy(*by).agg(
        F.count("__v").alias("n_valid"),
        F.round(_mean(F.col("__v")), 4).alias("mean_value"),
        F.min("__v").alias("min_value"),
        F.max("__v").alias("max_value"),
        F.round(F.stddev_samp("__v"), 4).alias("std_value"))
    return (_with_median(stats, rows, by, "median_value")
            .select(*by, "n_valid", "mean_value", "median_value", "min_value", "max_value", "std_value"))


def _with_median(stats: DataFrame, rows: DataFrame, by: list, name: str) -> DataFrame:
    """``stats`` (a row per ``by``) with the exact median of ``__v`` rounded to 4 places."""
    med = exact_median(rows, "__v", by, "__med")
    if not by:
        return stats.withColumn(name, F.round(med.select("__med").scalar(), 4))
    med = med.select(*[F.col(b).alias(f"__m{i}") for i, b in enumerate(by)], "__med")
    same = F.lit(True)
    for i, b in enumerate(by):
        same = same & F.col(b).eqNullSafe(F.col(f"__m{i}"))
    return stats.join(med, same, "left").withColumn(name, F.round("__med", 4))


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _is_red_sql(c: str) -> str:
    return f"coalesce({_q(c)} = '{REDACTED}', false)"


def _redaction_counts(df: DataFrame, columns, flags: dict) -> DataFrame:
    """One wide aggregate: per flag (period) the row count and REDACTED count of every column.

    Aggregates are written as SQL text (one expression per call) since the list is wide.
    """
    df = df.withColumns({f"__flag_{tag}": flag for tag, flag in flags.items()})
    aggs = []
    for tag in flags:
        aggs.append(F.expr(f"count_if(__flag_{tag})").alias(f"__rows_{tag}"))
        aggs += [F.expr(f"count_if(__flag_{tag} AND {_is_red_sql(c)})").alias(f"{c}__{tag}") for c in columns]
    return df.groupBy().agg(*aggs)


def _inline(fields) -> Column:
    """``inline(array(struct(...), ...))`` from rows of (alias, SQL expression) pairs."""
    rows = ", ".join("struct(" + ", ".join(f"{expr} AS {alias}" for alias, expr in row) + ")" for row in fields)
    return F.expr(f"inline(array({rows}))")


def _str(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def redaction_profile(df: DataFrame, before: Column, after: Column, columns=None) -> DataFrame:
    """REDACTED count and percent per column in two periods, columns with any.

    Output: rank (newer count desc, column asc), column_name, before_count, before_pct,
    after_count, after_pct.  One pass over the data; the 1-row result is unpivoted.
    """
    columns = list(columns) if columns is not None else string_columns(df)
    wide = _redaction_counts(df.where(before | after), columns, {"b": before, "a": after})
    long = wide.select(_inline([[("column_name", _str(c)), ("before_count", _q(f"{c}__b")),
                                  ("after_count", _q(f"{c}__a")), ("rows_b", "__rows_b"), ("rows_a", "__rows_a")]
                                 for c in columns]))
    long = long.where((F.col("before_count") > 0) | (F.col("after_count") > 0))
    long = long.select(
        "column_name", "before_count",
        F.round(F.when(F.col("rows_b") > 0, F.col("before_count") / F.col("rows_b") * 100.0)
                .otherwise(0.0), 4).alias("before_pct"),
        "after_count",
        F.round(F.when(F.col("rows_a") > 0, F.col("after_count") / F.col("rows_a") * 100.0)
                .otherwise(0.0), 4).alias("after_pct"))
    # at most one row per profiled column
    return rank_codes(long, [down("after_count"), "column_name"])


# --- fixed values -----------------------------------------------------------
# Description fields of a snapshot and their display names, in schema order.
DESCRIPTION_FIELDS = {
    "agelvlt": "Age Level", "agysubt": "Agency Sub-Agency", "edlvlt": "Education Level", "loct": "Location",
    "loslvlt": "Length of Service Level", "occfamt": "Occupation Family", "occt": "Occupation",
    "occtypt": "Occupation Type", "patcot": "PATCO Category", "ppt": "Pay Period", "payplant": "Pay Plan",
    "pptypt": "Pay Plan Type", "ppgroupt": "Pay Plan Group", "ppgrdt": "Pay Plan Grade", "sallvlt": "Salary Level",
    "stemocct": "STEM Occupation", "supervist": "Supervisory Status", "toat": "Type of Appointment",
    "wrkscht": "Work Schedule", "wstypt": "Work Schedule Type", "wkstatt": "Work Status",
}
# Measures of the overview and their display names.
MEASURE_FIELDS = {"salary": "Salary", "employment": "Employment", "los": "Los"}
# ----------------------------------------------------------------------------


def redaction_overview(df: DataFrame, description_only: bool = False) -> DataFrame:
    """REDACTED share per string field of one frame, fields with any.

    ``description_only`` keeps the description fields and measures alone; a field without a display name shows
    its own.

    Output: rank (pct desc, field asc), field, display_name, redacted_count, total_records, redaction_pct.
    """
    labels = {**DESCRIPTION_FIELDS, **MEASURE_FIELDS}
    fields = {c: labels.get(c, c) for c in string_columns(df) if c in labels or not description_only}
    wide = _redaction_counts(df, list(fields), {"x": F.lit(True)})
    long = wide.select(_inline([[("field", _str(c)), ("display_name", _str(name)),
                                  ("redacted_count", _q(f"{c}__x")), ("total_records", "__rows_x")]
                                 for c, name in fields.items()])).where(F.col("redacted_count") > 0)
    long = long.withColumn("redaction_pct", F.round(F.col("redacted_count") / F.col("total_records") * 100.0, 4))
    return rank_codes(long, [down("redaction_pct"), "field"])


def cell_redaction(df: DataFrame, by: str = "dataset_key", columns=None) -> DataFrame:
    """Share of REDACTED cells among all cells, per file/period (A8): by, rows, redacted_cells, cell_pct."""
    columns = list(columns) if columns is not None else [c for c in string_columns(df) if c != by]
    per_row = F.expr(" + ".join(f"CAST({_is_red_sql(c)} AS INT)" for c in columns) or "0")
    agg = df.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), F.sum(per_row).cast("bigint").alias("redacted_cells"))
    return agg.withColumn("cell_pct", F.round(F.col("redacted_cells") / (F.col("rows") * len(columns)) * 100.0, 4))


def distinct_count(df: DataFrame, col: str, by: str = "dataset_key") -> DataFrame:
    """Distinct non-null values of ``col`` per ``by``."""
    return df.groupBy(by).agg(F.countDistinct(col).alias(f"n_distinct_{col}"))


def first_texts(df: DataFrame, keys, text, orders: dict) -> DataFrame:
    """Per key the first text by each of several orders: ``keys`` and one column per entry of ``orders``.

    ``orders`` maps an output column to the order of its candidates (null: not a candidate).  Rows are
    first hash-aggregated to the least order of every (key, text), so only that small table is sorted.
    """
    least = (df.groupBy(*keys, text.alias("__text"))
             .agg(*[F.min(o).alias(name) for name, o in orders.items()]))
    return least.groupBy(*keys).agg(*[
        F.min_by(F.col("__text"), F.when(F.col("__text").isNotNull(), F.col(name))).alias(name) for name in orders])


def first_non_null(df: DataFrame, key: str, value: str, line: str = "line_no") -> DataFrame:
    """First non-null ``value`` per ``key`` in line order."""
    order = F.col(line) if line and line in df.columns else F.col(value)
    return first_texts(df.where(F.col(key).isNotNull()), [key], F.col(value), {f"first_{value}": order})


def keep_first(df: DataFrame, keys, order: str) -> DataFrame:
    """One row per key, the first in ``order`` (A22); null keys are a key.

    The least order of each key is hash-aggregated and joined back, so no key's rows are gathered or
    sorted.  ``order`` numbers the rows: no two rows of a key share it.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    first = df.groupBy(*[F.col(k).alias(f"__f{i}") for i, k in enumerate(keys)]).agg(F.min(order).alias("__first"))
    same = F.col(order).eqNullSafe(F.col("__first"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__f{i}"))
    return df.join(first, same, "left_semi")


def duplicate_report(df: DataFrame, keys, order: str) -> DataFrame:
    """Every row of a key that occurs more than once, flagged kept (first in ``order``) or
    discarded, with the key's record count (A23)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    stats = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_records"), F.min(order).alias("__first"))
             .where(F.col("n_records") > 1))
    rows = df.join(stats, on=keys, how="inner")
    return rows.withColumn("kept", F.col(order) == F.col("__first")).drop("__first")


def snapshot_profile(df: DataFrame, by: str = "dataset_key", value: str = "salary") -> DataFrame:
    """Per snapshot: rows, valid salary count, mean and exact median of non-redacted salary."""
    rows = df.select(by, safe_int(value).alias("__v"))
    stats = rows.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), F.count("__v").alias("salary_valid"),
                                 F.round(_mean(F.col("__v")), 4).alias("salary_mean"))
    return (_with_median(stats, rows, [by], "salary_median")
            .select(by, "rows", "salary_valid", "salary_mean", "salary_median"))


def high_redaction_columns(df: DataFrame, by: str = "dataset_key", threshold_pct: float = 90.0,
                           columns=None) -> DataFrame:
    """(by, column) pairs whose REDACTED share exceeds ``threshold_pct`` (part of A25)."""
    columns = list(columns) if columns is not None else [c for c in string_columns(df) if c != by]
    aggs = [F.count(F.lit(1)).alias("__rows")] + [
        F.expr(f"count_if({_is_red_sql(c)})").alias(c) for c in columns]
    wide = df.groupBy(by).agg(*aggs)
    long = wide.select(by, "__rows", _inline([[("column_name", _str(c)), ("redacted", _q(c))] for c in columns]))
    # the test is on the counts; only the shown percentage is rounded
    hit = F.col("redacted") * 100.0 > F.col("__rows") * F.lit(float(threshold_pct))
    pct = F.round(F.col("redacted") / F.col("__rows") * 100.0, 4)
    return long.where(hit).select(by, "column_name", pct.alias("redacted_pct"))
