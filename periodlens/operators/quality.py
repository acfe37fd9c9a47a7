"""Snapshot quality checks (validation run) and the positional pairing check.

Checks are computed per period in one pass each and reported as rows with a severity
(info / warn / error / invalid) instead of log lines; the overall verdict is a
``bool_and`` over periods.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodlens.operators.position import with_position
from periodlens.operators.profile import _inline, _q, _str

# --- fixed values -----------------------------------------------------------
REQUIRED_COLUMNS = ("dataset_key", "quarter", "year", "employment")
KEY_FIELDS = ("dataset_key", "quarter", "year", "agelvlt", "patcot", "occt", "loct")
LOOKUP_FIELDS = ("agelvlt", "agysubt", "edlvlt", "loslvlt", "loct", "occfamt", "occt",
                 "occtypt", "patcot", "payplant", "ppgrdt", "ppgroupt", "sallvlt",
                 "stemocct", "supervist", "toat", "wkstatt", "wrkscht", "wstypt")
# Null percentage above which a lookup field is a warning.
NULL_WARN_PCT = 10.0
# Fields that must be empty before the pay-plan era began, and that year.
ERA_FIELDS = ("payplant", "ppgrdt", "ppgroupt")
ERA_START_YEAR = 2016
# Publication calendar: (first year, last year, months published).
CALENDAR_RULE = ((1998, 2008, ("September",)), (2009, 2009, ("September", "December")),
                 (2010, 2023, ("March", "June", "September", "December")),
                 (2024, 2024, ("March", "June", "September")), (2025, 2025, ("March",)))
# Accepted rows per snapshot.
ROW_RANGE = (1_500_000, 2_500_000)
# ----------------------------------------------------------------------------


def _periods(df: DataFrame, by: str) -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("rows"))


def required_columns(df: DataFrame, by: str = "dataset_key", required=REQUIRED_COLUMNS,
                     key_fields=KEY_FIELDS) -> DataFrame:
    """Per period × expected column: present flag and severity (Q1).

    A missing required column makes the snapshot invalid, a missing key field is a warning.
    """
    present = set(df.columns)
    expected = [(c, "required") for c in required] + [(c, "key") for c in key_fields if c not in required]
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(kind).alias("kind"),
                                 F.lit(c in present).alias("present")) for c, kind in expected])
    per = _periods(df, by).select(by, F.inline(entries))
    sev = (F.when(F.col("present"), F.lit("ok"))
           .when(F.col("kind") == "required", F.lit("invalid")).otherwise(F.lit("warn")))
    return per.withColumn("severity", sev)


def constant_measure(df: DataFrame, by: str = "dataset_key", measure: str = "employment",
                     expected: str = "1") -> DataFrame:
    """Rows whose measure is not exactly ``expected`` (nulls count), per period (Q2)."""
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.col(measure).eqNullSafe(expected)).alias("non_constant"),
    ).withColumn("severity", F.when(F.col("non_constant") > 0, "error").otherwise("ok"))


def null_rates(df: DataFrame, by: str = "dataset_key", fields=LOOKUP_FIELDS) -> DataFrame:
    """Null and blank percentage of each lookup description field per period (Q3).

    Severity: > 10% warn, > 0 info, else ok.  Output: by, field, rows, null_count, null_pct, blank_pct, severity.
    """
    fields = [f for f in fields if f in df.columns]
    if not fields:
        return df.where(F.lit(False)).select(
            by, F.lit(None).cast("string").alias("field"), F.lit(0).cast("bigint").alias("rows"),
            F.lit(0).cast("bigint").alias("null_count"),
            F.lit(0.0).alias("null_pct"), F.lit(0.0).alias("blank_pct"), F.lit("ok").alias("severity"))
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for f in fields:
        aggs += [F.expr(f"count_if({_q(f)} IS NULL)").alias(f"{f}__n"),
                 F.expr(f"count_if({_q(f)} = '')").alias(f"{f}__e")]
    wide = df.groupBy(by).agg(*aggs)
    long = wide.select(by, F.col("__rows").alias("rows"),
                       _inline([[("field", _str(f)), ("null_count", _q(f"{f}__n")),
                                 ("blank_count", _q(f"{f}__e"))] for f in fields]))
    # severities are tested on the counts; only the shown percentages are rounded
    sev = (F.when(_high_null("null_count", "rows"), "warn").when(F.col("null_count") > 0, "info").otherwise("ok"))
    return long.select(by, "field", "rows", "null_count",
                       F.round(F.col("null_count") / F.col("rows") * 100.0, 4).alias("null_pct"),
                       F.round(F.col("blank_count") / F.col("rows") * 100.0, 4).alias("blank_pct"), sev.alias("severity"))


def _high_null(nulls, rows):
    """More nulls than NULL_WARN_PCT percent of the rows, exactly."""
    return F.col(nulls) * 100.0 > F.col(rows) * NULL_WARN_PCT


def merge_failures(df: DataFrame, by: str = "dataset_key", fields=LOOKUP_FIELDS) -> DataFrame:
    """Description fields that are entirely null in a period (Q4) — the snapshot is invalid."""
    return null_rates(df, by, fields).where((F.col("rows") > 0) & (F.col("null_count") == F.col("rows"))).select(
        by, "field", F.lit("invalid").alias("severity"))


def era_rule(df: DataFrame, by: str = "dataset_key", fields=ERA_FIELDS,
             start_year: int = ERA_START_YEAR) -> DataFrame:
    """Non-null values of era-bound fields in periods before ``start_year`` (Q5)."""
    fields = [f for f in fields if f in df.columns]
    if not fields:      # none of the era-bound fields exist: nothing can violate the rule
        return df.where(F.lit(False)).select(by, F.lit(None).cast("string").alias("field"),
                                             F.lit(0).cast("bigint").alias("non_null"), F.lit("ok").alias("severity"))
    early = df.where(F.col("year") < start_year)
    wide = early.groupBy(by).agg(*[F.count(F.col(f)).alias(f) for f in fields])
    long = wide.select(by, F.inline(F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f).alias("non_null")) for f in fields])))
    return long.withColumn("severity", F.when(F.col("non_null") > 0, "error").otherwise("ok"))


def calendar_gaps(df: DataFrame, months=("March", "June", "September", "December"),
                  expected: DataFrame | None = None) -> DataFrame:
    """Expected (year, quarter) periods with no rows (Q6).

    By default the expected calendar is every listed month of every year between the first
    and last year present; pass ``expected`` (year, quarter) for an explicit calendar.
    """
    actual = df.select("year", "quarter").distinct()
    if expected is None:
        bounds = actual.agg(F.min("year").alias("lo"), F.max("year").alias("hi"))
        expected = (bounds.select(F.explode(F.sequence("lo", "hi")).alias("year"))
                    .select("year", F.explode(F.array(*map(F.lit, months))).alias("quarter")))
    return expected.join(actual, on=["year", "quarter"], how="left_anti")


def expected_calendar(spark, first_year: int = CALENDAR_RULE[0][0], last_year: int = CALENDAR_RULE[-1][1]):
    """The publication calendar as (year, quarter) rows, built from ``CALENDAR_RULE`` in Spark."""
    years = spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("year"))
    months = F.array().cast("array<string>")
    for lo, hi, listed in reversed(CALENDAR_RULE):
        months = F.when(F.col("year").between(lo, hi), F.array(*map(F.lit, listed))).otherwise(months)
    return years.select("year", F.explode(months).alias("quarter"))


def row_range(df: DataFrame, by: str = "dataset_key", lo: int = ROW_RANGE[0], hi: int = ROW_RANGE[1]) -> DataFrame:
    """Row count per period and whether it lies within [lo, hi] (Q7)."""
    return _periods(df, by).withColumn("in_range", F.col("rows").between(lo, hi))


def dim_coverage(df: DataFrame, dims, by: str = "dataset_key") -> DataFrame:
    """Per period × (code, description) pair: how many coded rows got a description (Q9).

    status: absent (column missing), none (no coded rows), full, partial, failed.
    """
    present = set(df.columns)
    entries, aggs = [], [F.count(F.lit(1)).alias("__rows")]
    for code, desc in dims:
        if code in present and desc in present:
            aggs += [F.count(F.col(code)).alias(f"{code}__c"),
                     F.count_if(F.col(code).isNotNull() & F.col(desc).isNotNull()).alias(f"{code}__m")]
            entries.append(F.struct(F.lit(code).alias("code"), F.lit(desc).alias("description"),
                                    F.lit(True).alias("present"), F.col(f"{code}__c").alias("coded"),
                                    F.col(f"{code}__m").alias("matched")))
        else:
            entries.append(F.struct(F.lit(code).alias("code"), F.lit(desc).alias("description"),
                                    F.lit(False).alias("present"), F.lit(0).cast("bigint").alias("coded"),
                                    F.lit(0).cast("bigint").alias("matched")))
    long = df.groupBy(by).agg(*aggs).select(by, F.inline(F.array(*entries)))
    rate = F.when(F.col("coded") > 0, F.round(F.col("matched") / F.col("coded") * 100.0, 4))
    status = (F.when(~F.col("present"), "absent").when(F.col("coded") == 0, "none")
              .when(F.col("matched") == F.col("coded"), "full")
              .when(F.col("matched") == 0, "failed").otherwise("partial"))
    return long.select(by, "code", "description", "present", "coded", "matched",
                       rate.alias("match_pct"), status.alias("status"))


def verdict(df: DataFrame, by: str = "dataset_key", fields=LOOKUP_FIELDS,
            required=REQUIRED_COLUMNS) -> DataFrame:
    """Validation run (R15 / Q8): per period the high-null fields, fully-null fields, measure
    issues and a validity flag; invalid = a required column missing or a field wholly null.

    Output: by, rows, high_null_fields, null_fields, non_constant, valid.
    """
    missing_required = [c for c in required if c not in df.columns]
    fields = [f for f in fields if f in df.columns]
    # one aggregation per period: row count, measure check and every field's null count
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs.append(F.count_if(~F.col("employment").eqNullSafe("1")).alias("non_constant")
                if "employment" in df.columns else F.lit(None).cast("bigint").alias("non_constant"))
    aggs += [F.expr(f"count_if({_q(f)} IS NULL)").alias(f"{f}__n") for f in fields]
    wide = df.groupBy(by).agg(*aggs)
    high = sum((F.when(_high_null(f"{f}__n", "rows"), 1).otherwise(0) for f in fields), F.lit(0))
    full = sum((F.when(F.col(f"{f}__n") == F.col("rows"), 1).otherwise(0) for f in fields), F.lit(0))
    out = wide.select(by, "rows", high.cast("bigint").alias("high_null_fields"),
                      full.cast("bigint").alias("null_fields"), "non_constant")
    return out.withColumn("valid", F.lit(not missing_required) & (F.col("null_fields") == 0))


def overall_ok(verdicts: DataFrame) -> DataFrame:
    """One row: all snapshots valid."""
    return verdicts.agg(F.bool_and("valid").alias("all_valid"), F.count(F.lit(1)).alias("snapshots"))


def pair_order(status: DataFrame, datecode: str, first: str, second: str, keys, order) -> DataFrame:
    """Positional pairing check (J8): rows of two periods paired by position in ``order``.

    Output (one row): n_first, n_second, mismatches (paired rows whose keys differ), result
    ('ok' / 'count mismatch' / 'mismatch').  Positions come from a distributed sort.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    rows = status.where(F.col(datecode).isin(first, second))
    pos = with_position(rows, order, "__pos", partition_by=datecode)
    a = pos.where(F.col(datecode) == first).select(
        "__pos", F.lit(True).alias("__a"), *[F.col(k).alias(f"a_{k}") for k in keys])
    b = pos.where(F.col(datecode) == second).select(
        "__pos", F.lit(True).alias("__b"), *[F.col(k).alias(f"b_{k}") for k in keys])
    paired = a.join(b, on="__pos", how="full")
    differs = None
    for k in keys:
        d = ~F.col(f"a_{k}").eqNullSafe(F.col(f"b_{k}"))
        differs = d if differs is None else differs | d
    in_a = F.coalesce(F.col("__a"), F.lit(False))
    in_b = F.coalesce(F.col("__b"), F.lit(False))
    res = paired.agg(F.count_if(in_a).alias("n_first"), F.count_if(in_b).alias("n_second"),
                     F.count_if(in_a & in_b & differs).alias("mismatches"))
    return res.withColumn("result", F.when(F.col("n_first") != F.col("n_second"), "count mismatch")
                          .when(F.col("mismatches") > 0, "mismatch").otherwise("ok"))
