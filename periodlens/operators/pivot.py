"""Multi-period pivots, trends and period totals.

Pivots always receive their value list (no extra distinct job) and aggregate to unique
keys before pivoting, so "mean of duplicates" can never replace a sum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodlens.functions.periods import pct_change, period_label, period_sort_key
from periodlens.functions.text import NONPERMANENT
from periodlens.functions.values import count_sum, count_value
from periodlens.operators.position import down, top_n, up, rank_codes


def multi_period_sql(spark: SparkSession, df: DataFrame, view: str = "employment",
                     group: str = "agysubt", measure: str = "TRY_CAST(employment AS INT)") -> DataFrame:
    """Yearly head count per group through Spark SQL on a temp view."""
    df.createOrReplaceTempView(view)
    return spark.sql(f"""
        SELECT year, {group} AS agency_sub, SUM({measure}) AS employees
        FROM {view}
        GROUP BY year, {group}
    """)


def pivot_years(df: DataFrame, group: str, years, n: int = 10, measure: str = "employment",
                policy: str = "skip") -> DataFrame:
    """Group × year head count matrix, top ``n`` by the latest year.

    Columns ``y<year>``; a group absent in a year is null.  Sorted by the latest year, then the
    one before, descending with nulls last, then the group.
    """
    years = sorted(int(y) for y in years)
    rows = df.where(F.col(group).isNotNull()).where(F.col("year").isin(years))
    wide = (rows.groupBy(group).pivot("year", years)
            .agg(F.sum(count_value(measure, policy)).cast("bigint")))
    wide = wide.select(group, *[F.col(str(y)).alias(f"y{y}") for y in years])
    order = [down(f"y{y}") for y in reversed(years)] + [up(group)]
    return top_n(wide, order, n).select("rank", group, *[f"y{y}" for y in years])


def transition_matrix(df: DataFrame, category, transitions, measure: str = "employment",
                      policy: str = "skip", period_col: str = "year",
                      pct_decimals: int = 1) -> DataFrame:
    """Category × transition × {before, after, change, pct} with 0 fill.

    ``transitions`` is a list of (label, before_period, after_period).  One aggregation
    pivots the category totals per period; each transition is then column arithmetic.
    Change is whole, pct is rounded half-to-even to ``pct_decimals``.
    """
    periods = sorted({p for _, b, a in transitions for p in (b, a)})
    cat = category if isinstance(category, str) else "category"
    rows = df.withColumn("__cat", F.col(category) if isinstance(category, str) else category)
    rows = rows.where(F.col("__cat").isNotNull()).where(F.col(period_col).isin(periods))
    wide = (rows.groupBy("__cat").pivot(period_col, periods)
            .agg(F.sum(count_value(measure, policy)).cast("bigint")))
    cols = [F.col("__cat").alias(cat)]
    for label, b, a in transitions:
        bc = F.coalesce(F.col(str(b)), F.lit(0)).cast("bigint")
        ac = F.coalesce(F.col(str(a)), F.lit(0)).cast("bigint")
        cols += [bc.alias(f"{label}_before"), ac.alias(f"{label}_after"),
                 (ac - bc).alias(f"{label}_change"),
                 F.bround(pct_change(bc, ac), pct_decimals).alias(f"{label}_pct")]
    return wide.select(*cols)


def period_trend(df: DataFrame, measure: str = "employment", policy: str = "digits_else_zero",
                 extra_keys=()) -> DataFrame:
    """Head count per period in chronological order (A16; with ``extra_keys`` A17).

    Output: period, year, quarter, sort_key, [extra keys], employment.  Null extra keys dropped.
    """
    rows = df
    for k in extra_keys:
        rows = rows.where(F.col(k).isNotNull())
    agg = rows.groupBy("year", "quarter", *extra_keys).agg(count_sum(measure, policy).alias("employment"))
    return agg.select(period_label("quarter", "year").alias("period"), "year", "quarter",
                      period_sort_key("year", "quarter").alias("sort_key"), *extra_keys, "employment")


def class_trend(df: DataFrame, text: str = "toat", measure: str = "employment",
                policy: str = "digits_else_zero") -> DataFrame:
    """Per period: nonpermanent head count, everything else, and total."""
    nonperm = F.coalesce(F.upper(F.col(text)).contains(NONPERMANENT), F.lit(False))
    v = count_value(measure, policy)
    agg = df.groupBy("year", "quarter").agg(
        F.sum(F.when(nonperm, v).otherwise(0)).cast("bigint").alias("nonpermanent"),
        F.sum(F.when(~nonperm, v).otherwise(0)).cast("bigint").alias("not_nonpermanent"))
    return agg.select(period_label("quarter", "year").alias("period"),
                      period_sort_key("year", "quarter").alias("sort_key"),
                      "nonpermanent", "not_nonpermanent",
                      (F.col("nonpermanent") + F.col("not_nonpermanent")).alias("total"))


def subtotals(df: DataFrame, keys, sets=None, measure: str = "employment", policy: str = "skip", total: str = "TOTAL") -> DataFrame:
    """Head counts for each combination of ``keys`` and their subtotals, in one aggregation.

    ``sets`` are the combinations wanted (tuples of key names; default: every prefix of ``keys``, down to the grand total).
    A key that a row sums over shows ``total``; a null key stays null.  ``level`` is the number of keys summed over.
    """
    keys = list(keys)
    sets = [tuple(s) for s in sets] if sets is not None else [tuple(keys[:n]) for n in range(len(keys), -1, -1)]
    rows = df.select(*[F.col(k).cast("string").alias(k) for k in keys], count_value(measure, policy).alias("__v"))
    out = rows.groupingSets([[F.col(k) for k in s] for s in sets], *[F.col(k) for k in keys]).agg(
        F.coalesce(F.sum("__v"), F.lit(0)).cast("bigint").alias("headcount"), *[F.grouping(k).alias(f"__{i}") for i, k in enumerate(keys)])
    summed = [F.col(f"__{i}") for i in range(len(keys))]
    level = summed[0].cast("int")
    for s in summed[1:]:
        level = level + s.cast("int")
    return out.select(*[F.when(s == 1, F.lit(total)).otherwise(F.col(k)).alias(k) for s, k in zip(summed, keys)], level.alias("level"), "headcount")


def period_totals(df: DataFrame, transitions, measure: str = "employment", policy: str = "skip",
                  period_col: str = "year") -> DataFrame:
    """Total before/after per named transition with change and pct."""
    periods = sorted({p for _, b, a in transitions for p in (b, a)})
    per = (df.where(F.col(period_col).isin(periods)).groupBy()
           .pivot(period_col, periods).agg(F.sum(count_value(measure, policy)).cast("bigint")))
    structs = []
    for label, b, a in transitions:
        bc = F.coalesce(F.col(str(b)), F.lit(0)).cast("bigint")
        ac = F.coalesce(F.col(str(a)), F.lit(0)).cast("bigint")
        structs.append(F.struct(F.lit(label).alias("period"), bc.alias("before"), ac.alias("after")))
    long = per.select(F.inline(F.array(*structs)))
    return long.select("period", "before", "after", (F.col("after") - F.col("before")).alias("change"),
                       pct_change("before", "after").alias("pct_change"))


def top_split(df: DataFrame, category, transitions, n: int = 50, measure: str = "employment",
              policy: str = "skip", period_col: str = "year") -> DataFrame:
    """Rank categories by the sum of their 'before' totals over all transitions and mark the
    top ``n`` (A24): rank, category, total_before, is_top."""
    cat = category if isinstance(category, str) else "category"
    befores = [b for _, b, _ in transitions]
    weight = None
    for b in befores:   # a period used as 'before' k times counts k times
        w = F.when(F.col(period_col) == b, 1).otherwise(0)
        weight = w if weight is None else weight + w
    rows = df.withColumn("__cat", F.col(category) if isinstance(category, str) else category)
    rows = rows.where(F.col("__cat").isNotNull()).where(F.col(period_col).isin(sorted(set(befores))))
    v = count_value(measure, policy)
    agg = rows.groupBy(F.col("__cat").alias(cat)).agg(
        F.coalesce(F.sum(v * weight), F.lit(0)).cast("bigint").alias("total_before"))
    ranked = rank_codes(agg, [down("total_before"), cat], "rank")
    return ranked.withColumn("is_top", F.col("rank") <= n).select("rank", cat, "total_before", "is_top")


def daily_trend(df: DataFrame, ts: str, value: str | None = None) -> DataFrame:
    """A16 with calendar days as periods: rows (and the total of ``value``) per day, with a
    chronological ``sort_key`` (yyyymmdd).  One partial aggregation; no ordering pass needed."""
    day = F.to_date(F.col(ts))
    aggs = [F.count(F.lit(1)).alias("events")]
    if value is not None:
        aggs.append(F.round(F.sum(F.col(value).cast("decimal(28,8)")).cast("double"), 4).alias("value_total"))
    out = df.where(F.col(ts).isNotNull()).groupBy(day.alias("__day")).agg(*aggs)
    return out.select(F.date_format("__day", "yyyy-MM-dd").alias("day"),
                      F.date_format("__day", "yyyyMMdd").cast("int").alias("sort_key"),
                      *[a for a in ("events", "value_total") if value is not None or a == "events"])


def period_matrix(long: DataFrame, keys, period: str = "period", sort_key: str = "sort_key",
                  value: str = "employment", latest_first: bool = True) -> DataFrame:
    """Keys × period matrix of an already aggregated long table (A14 single measure), 0-filled,
    periods as columns in chronological order, rows ranked by the most recent period.

    The period list is read from the data (one row per period: a bounded, metadata-sized list)
    so the pivot gets explicit values and column order.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    periods = [r[0] for r in long.select(period, sort_key).distinct().orderBy(sort_key).collect()]
    wide = long.groupBy(*keys).pivot(period, periods).agg(F.sum(value))
    wide = wide.select(*keys, *[F.coalesce(F.col(f"`{p}`"), F.lit(0)).cast("bigint").alias(p) for p in periods])
    if not periods:
        return wide
    order = [down(f"`{periods[-1]}`") if latest_first else up(f"`{periods[-1]}`")] + list(keys)
    return rank_codes(wide, order, "rank")
