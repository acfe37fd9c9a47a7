"""Two-period comparison operators.

All comparisons are one conditional aggregation over the rows of both periods
(a category present in either period appears once, missing side = 0), which is the
full-outer-join semantics without joining two aggregates.  Partial aggregation runs
map-side, so a category holding a third of all rows still shuffles one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodlens.functions.common import as_col
from periodlens.functions.periods import pct_change
from periodlens.functions.text import clean_category
from periodlens.functions.values import MISSING_MARKERS, REDACTED, count_value
from periodlens.operators.order import domain_rank
from periodlens.operators.position import down, up, rank_codes

# --- fixed values -----------------------------------------------------------
TOTAL = "TOTAL"
# Names that never win the code → name precedence.
INVALID_NAMES = (REDACTED, "", "nan")
# Availability table rows, in display order.
AVAILABILITY_ROWS = ("Total Records", "Salary Available", "Salary Redacted", "Salary Missing/Blank")
# ----------------------------------------------------------------------------


def _side_total(flag: Column, value: Column, fractional: bool) -> Column:
    s = F.sum(F.when(flag, value))
    if fractional:
        s = F.bround(s, 0)
    return F.coalesce(s, F.lit(0)).cast("bigint")


def _fractional(policy: str) -> bool:
    return policy in ("impute_one", "coerce_zero")


def compare_full(df: DataFrame, category, before: Column, after: Column,
                 measure="employment", policy: str = "coerce_zero",
                 category_name: str = "category") -> DataFrame:
    """Category totals of two periods side by side (J2): category, before, after, change, pct_change.

    Categories present in one period only get 0 on the other side; null categories are dropped.
    """
    cat = as_col(category).alias(category_name)
    v = count_value(measure, policy)
    frac = _fractional(policy)
    agg = (df.where(before | after)
           .select(cat, before.alias("__b"), after.alias("__a"), v.alias("__v"))
           .where(F.col(category_name).isNotNull())
           .groupBy(category_name)
           .agg(_side_total(F.col("__b"), F.col("__v"), frac).alias("before"),
                _side_total(F.col("__a"), F.col("__v"), frac).alias("after")))
    return (agg.withColumn("change", F.col("after") - F.col("before"))
            .withColumn("pct_change", pct_change("before", "after")))


def _valid_name(c: Column) -> Column:
    return c.isNotNull() & ~c.isin(*INVALID_NAMES)


def name_precedence(new_name: Column, old_name: Column, code: Column) -> Column:
    """Newer period's name unless invalid, else older period's, else the code itself."""
    return (F.when(_valid_name(new_name), new_name)
            .when(_valid_name(old_name), old_name)
            .otherwise(code.cast("string")))


def _line(df: DataFrame, line: str | None, text) -> Column:
    """File-order column when the frame has one; otherwise the value itself (first = smallest),
    since row order in a snapshot table carries no meaning."""
    return F.col(line) if line and line in df.columns else as_col(text)


def name_map(df: DataFrame, code, text, before: Column, after: Column,
             line: str = "line_no", clean_before: bool = False) -> DataFrame:
    """Code → display name (J7): first name of the newer period, else the older one, else the code."""
    code_c = as_col(code)
    old_text = clean_category(text, text if isinstance(text, str) else None) if clean_before else as_col(text)
    line_c = _line(df, line, text)
    rows = (df.where(before | after).where(code_c.isNotNull())
            .select(code_c.alias("code"), as_col(text).alias("__t"), old_text.alias("__o"),
                    F.when(after, line_c).alias("__a"), F.when(before, line_c).alias("__b")))
    # hash-aggregate to the least line of each (code, text), then pick the first on that small table
    least = rows.groupBy("code", "__t", "__o").agg(F.min("__a").alias("__a"), F.min("__b").alias("__b"))
    agg = least.groupBy("code").agg(_first("__t", "__a").alias("__new"), _first("__o", "__b").alias("__old"))
    return agg.select("code", name_precedence(F.col("__new"), F.col("__old"), F.col("code")).alias("name"))


def _first(text: str, order: str) -> Column:
    """Aggregate: the non-null text of the least order."""
    return F.min_by(F.col(text), F.when(F.col(text).isNotNull(), F.col(order)))


def name_by_preference(df: DataFrame, code, text, period: str, preferred, order=None,
                       line: str = "line_no") -> DataFrame:
    """Code → description where one period is preferred (J7 variant): the preferred period's
    first description when it has one, otherwise the first description of the earliest period
    in ``order`` (default: ascending period value).  Output: code, name (null when none).

    Rows are hash-aggregated to the least line of each (code, text, period) first.
    """
    code_c, text_c = as_col(code), as_col(text)
    least = (df.where(code_c.isNotNull())
             .groupBy(code_c.alias("code"), text_c.alias("__t"), F.col(period).alias("__p"))
             .agg(F.min(_line(df, line, text)).alias("__l")))
    if order is not None:
        ranks = F.create_map(*[x for i, p in enumerate(order) for x in (F.lit(p), F.lit(i))])
        period_key = F.coalesce(ranks[F.col("__p")], F.lit(len(order)))
    else:
        period_key = F.col("__p")
    ordering = F.struct(F.when(F.col("__p") == F.lit(preferred), F.lit(0)).otherwise(F.lit(1)).alias("p"),
                        period_key.alias("k"), F.col("__l").alias("l"))
    return least.groupBy("code").agg(F.min_by(F.col("__t"), F.when(F.col("__t").isNotNull(), ordering)).alias("name"))


def comparison_table(df: DataFrame, code, before: Column, after: Column, *,
                     measure="employment", policy: str = "impute_one", text=None,
                     clean_names: bool = False, order: str = "specials_last",
                     domain=None, line: str = "line_no", exclude=None) -> DataFrame:
    """The category comparison report (R3): per-category totals of two periods, REDACTED and
    TOTAL rows, change and percent change, and a display ``rank``.

    ``order='specials_last'`` sorts by the newer period descending, then REDACTED, then TOTAL;
    ``order='domain'`` follows the ``domain`` label list (unknown labels after it), TOTAL last.
    ``exclude=(group, field)`` leaves out every ``group`` that has a REDACTED ``field`` in the
    newer period (J5 + A11) in the same pass: rows are first aggregated per (group, code) —
    a small table — the flagged groups are read off it and dropped, then codes are summed.
    Output: rank, code, category, before, after, change, pct_change.
    """
    if exclude is not None:
        per_code = _per_code_excluding(df, code, before, after, measure, policy, text, clean_names,
                                       line, exclude)
        return _finish_comparison(per_code, text is not None, order, domain)
    code_name = code if isinstance(code, str) else "code"
    code_c = clean_category(code, code_name) if clean_names else as_col(code)
    v = count_value(measure, policy)
    rows = (df.where(before | after)
            .select(code_c.alias("code"), before.alias("__b"), after.alias("__a"), v.alias("__v"),
                    *([as_col(text).alias("__t_new"),
                       (clean_category(text, text) if clean_names else as_col(text)).alias("__t_old"),
                       _line(df, line, text).alias("__line")] if text is not None else []))
            .where(F.col("code").isNotNull()))
    texts = ["__t_new", "__t_old"] if text is not None else []
    return _finish_comparison(_sum_codes(_partials(rows, ["code", *texts]), bool(texts), policy),
                              text is not None, order, domain)


def _partials(rows: DataFrame, keys) -> DataFrame:
    """Sums per side, and the least line per side, of each key: a hash aggregation (no text is compared)."""
    aggs = [F.sum(F.when(F.col("__b"), F.col("__v"))).alias("__sb"),
            F.sum(F.when(F.col("__a"), F.col("__v"))).alias("__sa")]
    if "__line" in rows.columns:
        aggs += [F.min(F.when(F.col("__a"), F.col("__line"))).alias("__la"),
                 F.min(F.when(F.col("__b"), F.col("__line"))).alias("__lb")]
    if "__hit" in rows.columns:
        aggs.append(F.max("__hit").alias("__hit"))
    return rows.groupBy(*keys).agg(*aggs)


def _sum_codes(partial: DataFrame, has_text: bool, policy: str) -> DataFrame:
    """One row per code from its partials: both sides' totals and first names."""
    def side(c):
        t = F.sum(c)
        if _fractional(policy):
            t = F.bround(t, 0)
        return F.coalesce(t, F.lit(0)).cast("bigint")

    final = [side("__sb").alias("before"), side("__sa").alias("after")]
    if has_text:
        final += [_first("__t_new", "__la").alias("__new"), _first("__t_old", "__lb").alias("__old")]
    return partial.groupBy("code").agg(*final)


def _per_code_excluding(df, code, before, after, measure, policy, text, clean_names, line, exclude):
    """Per-code partial sums and first names with flagged groups removed, from one scan."""
    group, field = exclude
    code_name = code if isinstance(code, str) else "code"
    code_c = clean_category(code, code_name) if clean_names else as_col(code)
    v = count_value(measure, policy)
    hit = after & F.coalesce(F.col(field) == REDACTED, F.lit(False))
    cols = [F.col(group).alias("__g"), code_c.alias("code"), before.alias("__b"), after.alias("__a"),
            v.alias("__v"), hit.alias("__hit")]
    if text is not None:
        cols += [as_col(text).alias("__t_new"),
                 (clean_category(text, text) if clean_names else as_col(text)).alias("__t_old"),
                 _line(df, line, text).alias("__line")]
    rows = df.where(before | after).select(*cols)
    # (group, code) partials over every row, null codes included, so a group's flag sees all rows
    partial = _partials(rows, ["__g", "code", *(["__t_new", "__t_old"] if text is not None else [])])
    flagged = partial.where(F.col("__hit") & F.col("__g").isNotNull()).select("__g").distinct()
    kept = partial.join(flagged, on="__g", how="left_anti").where(F.col("code").isNotNull())
    return _sum_codes(kept, text is not None, policy)


def _finish_comparison(per_code: DataFrame, has_text: bool, order: str, domain) -> DataFrame:
    """Names, change columns, the TOTAL row and the display ranking of a per-code table."""
    if has_text:
        name = name_precedence(F.col("__new"), F.col("__old"), F.col("code"))
    else:
        name = F.col("code")
    per_code = per_code.select(
        "code", name.alias("category"), "before", "after",
        (F.col("after") - F.col("before")).alias("change"),
        pct_change("before", "after").alias("pct_change"))
    # TOTAL is the sum of the category rows (re-uses the same shuffle output).
    total = per_code.groupBy().agg(F.sum("before").alias("before"), F.sum("after").alias("after"))
    total = total.select(
        F.lit(TOTAL).alias("code"), F.lit(TOTAL).alias("category"),
        F.coalesce("before", F.lit(0)).cast("bigint").alias("before"),
        F.coalesce("after", F.lit(0)).cast("bigint").alias("after"))
    total = total.select(
        "code", "category", "before", "after", (F.col("after") - F.col("before")).alias("change"),
        F.when(F.col("before") > 0, (F.col("after") - F.col("before")).cast("double") / F.col("before") * 100.0)
        .otherwise(F.lit(0.0)).alias("pct_change"))
    table = per_code.unionByName(total)
    is_total = (F.col("code") == TOTAL) & (F.col("category") == TOTAL)
    is_redacted = ((F.col("code") == REDACTED) | (F.col("category") == REDACTED)) & ~is_total
    table = table.withColumn("__special", F.when(is_total, 2).when(is_redacted, 1).otherwise(0))
    if order == "domain":
        labels = list(domain or [])
        table = table.withColumn("__dom", domain_rank("category", labels))
        keys = [F.col("__special") == 2, "__dom", F.col("__special") == 1, "code"]
        table = table.withColumn("__k0", keys[0]).withColumn("__k2", keys[2])
        ranked = rank_codes(table, ["__k0", "__dom", "__k2", "code"], "rank")
        ranked = ranked.drop("__dom", "__k0", "__k2")
    else:
        ranked = rank_codes(table, ["__special", down("after"), "code"], "rank")
    return ranked.select("rank", "code", "category", "before", "after", "change", "pct_change")


def compare_left(status: DataFrame, datecode: str, current: str, prior: str,
                 metrics=("EMPCOUNT", "AVGSAL", "AVGLOS"), count_metric: str = "EMPCOUNT",
                 line: str | None = None, how: str = "left") -> DataFrame:
    """Current-period rows matched to prior-period rows on every non-metric column.

    ``how='left'``: prior-only rows are dropped (dashboard behaviour); ``how='full'`` keeps them
    with a current count of 0 and their key columns.  A duplicated prior key keeps its last row
    (by ``line``).  Adds prior_count, current_count, change, pct_change and a rank by current count.
    """
    metrics = [m for m in metrics if m in status.columns]
    keys = [c for c in status.columns if c not in (datecode, line, *metrics)]
    cur = status.where(F.col(datecode) == current)
    pri = status.where(F.col(datecode) == prior)
    cnt = lambda c: F.coalesce(F.col(c).try_cast("bigint"), F.lit(0)).cast("bigint")
    if line is not None:
        pri = pri.groupBy(*keys).agg(F.max_by(cnt(count_metric), F.col(line)).alias("prior_count"))
    else:
        pri = pri.groupBy(*keys).agg(F.max(cnt(count_metric)).alias("prior_count"))
    pri = pri.select([F.col(k).alias(f"__p_{k}") for k in keys] + ["prior_count"])
    cond = None
    for k in keys:
        e = F.col(k).eqNullSafe(F.col(f"__p_{k}"))
        cond = e if cond is None else cond & e
    joined = cur.join(pri, on=cond, how="full" if how == "full" else "left")
    if how == "full":   # prior-only rows take their key values from the prior side
        joined = joined.withColumns({k: F.coalesce(F.col(k), F.col(f"__p_{k}")) for k in keys})
    joined = joined.drop(*[f"__p_{k}" for k in keys])
    out = (joined.withColumn("current_count", cnt(count_metric))
           .withColumn("prior_count", F.coalesce(F.col("prior_count"), F.lit(0)).cast("bigint"))
           .withColumn("change", F.col("current_count") - F.col("prior_count"))
           .withColumn("pct_change", pct_change("prior_count", "current_count")))
    order = [down("current_count")] + [up(k) for k in keys]
    out = rank_codes(out, order, "rank")
    return out.drop(*([line] if line else []))


def availability(df: DataFrame, field: str, before: Column, after: Column, exclude=None) -> DataFrame:
    """Value availability of a text measure in two periods (A10).

    Rows: total, available (not redacted, not missing), redacted, missing/blank
    (null, '', 'nan', '*****'); change and percent change, where a zero base gives 100 for
    the redacted row and 0 otherwise.  ``exclude=(group, flag_field)`` leaves out every group
    with a REDACTED flag field in the newer period, in the same scan (counts per group first).
    Output: row_order, status, before, after, change, pct_change.
    """
    c = F.col(field)
    red = F.coalesce(c == REDACTED, F.lit(False))
    miss = c.isNull() | c.isin(*MISSING_MARKERS)
    cols = [before.alias("b"), after.alias("a"), red.alias("r"), miss.alias("m")]
    if exclude is not None:
        group, flag_field = exclude
        cols += [F.col(group).alias("__g"),
                 (after & F.coalesce(F.col(flag_field) == REDACTED, F.lit(False))).alias("__hit")]
    stats = df.where(before | after).select(*cols)
    counters = [F.count_if("b").alias("tb"), F.count_if("a").alias("ta"),
                F.count_if(F.col("b") & F.col("r")).alias("rb"), F.count_if(F.col("a") & F.col("r")).alias("ra"),
                F.count_if(F.col("b") & F.col("m")).alias("mb"), F.count_if(F.col("a") & F.col("m")).alias("ma")]
    if exclude is None:
        agg = stats.groupBy().agg(*counters)
    else:
        per_group = stats.groupBy("__g").agg(*counters, F.max("__hit").alias("__hit"))
        kept = per_group.where(~(F.coalesce(F.col("__hit"), F.lit(False)) & F.col("__g").isNotNull()))
        agg = kept.groupBy().agg(*[F.coalesce(F.sum(k), F.lit(0)).cast("bigint").alias(k)
                                   for k in ("tb", "ta", "rb", "ra", "mb", "ma")])
    entries = [
        (1, AVAILABILITY_ROWS[0], F.col("tb"), F.col("ta"), 0.0),
        (2, AVAILABILITY_ROWS[1], F.col("tb") - F.col("rb") - F.col("mb"), F.col("ta") - F.col("ra") - F.col("ma"), 0.0),
        (3, AVAILABILITY_ROWS[2], F.col("rb"), F.col("ra"), 100.0),
        (4, AVAILABILITY_ROWS[3], F.col("mb"), F.col("ma"), 0.0),
    ]
    structs = [F.struct(F.lit(i).alias("row_order"), F.lit(name).alias("status"),
                        b.cast("bigint").alias("before"), a.cast("bigint").alias("after"),
                        F.lit(zero_base).alias("zero_base")) for i, name, b, a, zero_base in entries]
    rows = agg.select(F.inline(F.array(*structs)))
    return rows.select(
        "row_order", "status", "before", "after", (F.col("after") - F.col("before")).alias("change"),
        F.when(F.col("before") > 0, (F.col("after") - F.col("before")).cast("double") / F.col("before") * 100.0)
        .otherwise(F.col("zero_base")).alias("pct_change"))


def flagged_groups(df: DataFrame, group: str, field: str, value: str = REDACTED) -> DataFrame:
    """Distinct ``group`` values having at least one row where ``field`` equals ``value``."""
    return df.where(F.col(field) == value).where(F.col(group).isNotNull()).select(group).distinct()

