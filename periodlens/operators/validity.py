"""Descriptions over time: intervals of validity and as-of lookups.

A code's description changes over the years.  ``intervals`` turns the descriptions of all periods into maximal stretches of
consecutive periods with one description (gaps and islands); ``as_of`` names a code at any period: by the interval that
holds the period, else by the last one before it, else by the first one after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_texts(df: DataFrame, code: str, text: str, period: str, line: str) -> DataFrame:
    """The first non-null text (by ``line``) of each code in each period: code, period, name."""
    rows = df.where(F.col(code).isNotNull() & F.col(text).isNotNull() & F.col(period).isNotNull())
    return rows.groupBy(F.col(code).alias("code"), F.col(period).alias("period")).agg(F.min_by(text, line).alias("name"))


def intervals(names: DataFrame, periods: DataFrame) -> DataFrame:
    """Maximal stretches of consecutive periods with one name: code, name, first_period, last_period, n_periods.

    ``names`` has code, period, name (one row for each code and period); ``periods`` has every period that counts, once,
    in a column ``period`` that sorts in time.  Periods are numbered in one task: they are few.
    """
    numbered = periods.select("period").distinct().withColumn("no", F.row_number().over(Window.orderBy("period")))
    rows = names.join(F.broadcast(numbered), "period")
    run = F.col("no") - F.row_number().over(Window.partitionBy("code", "name").orderBy("no"))
    return (rows.withColumn("run", run).groupBy("code", "name", "run")
            .agg(F.min("period").alias("first_period"), F.max("period").alias("last_period"), F.count(F.lit(1)).alias("n_periods"))
            .drop("run"))


def as_of(points: DataFrame, spans: DataFrame) -> DataFrame:
    """Name the code of each row of ``points`` (columns code, period, and others) at its period: adds name and how.

    ``how`` is ``current`` (the interval holds the period), ``carried`` (the last one before), ``later`` (the first one
    after) or ``unknown`` (the code has no interval; name is null).  Each distinct (code, period) meets its code's
    intervals once; the rows themselves are joined with the answers.
    """
    asked = points.select("code", "period").distinct()
    met = asked.join(spans, "code", "left")
    how = (F.when(F.col("name").isNull(), "unknown").when(F.col("period") < F.col("first_period"), "later")
           .when(F.col("period") > F.col("last_period"), "carried").otherwise("current"))
    # current first, then the nearest before, then the nearest after; the name settles ties of overlapping intervals
    best = F.struct(F.when(how == "current", 0).when(how == "carried", 1).otherwise(2).alias("step"),
                    F.when(how == "later", F.col("first_period")).otherwise(-F.col("last_period")).alias("far"), F.col("name").alias("name"))
    answers = (met.withColumn("how", how).groupBy("code", "period")
               .agg(F.min_by(F.struct("name", "how"), best).alias("a"))
               .select(F.col("code").alias("a_code"), F.col("period").alias("a_period"), "a.name", "a.how"))
    return points.join(answers, points["code"].eqNullSafe(F.col("a_code")) & points["period"].eqNullSafe(F.col("a_period")), "left").drop(
        "a_code", "a_period")
