"""Partial aggregates of a published store, kept per period and merged by the reports.

For each period of a store the facts are summed once over ``GRAIN``: rows, the head count under each policy, the sum
and number of valid salaries, and a theta sketch of the agencies.  The partials are a published store of their own
beside the facts; a list of the fact version each of them was made from is written with every state.  ``refresh`` compares
that list with the facts' manifest: only periods with another version are read again, and periods that are gone go.

Reports over any number of periods merge partials instead of reading facts: a partial head count is a column of sums, which
the count functions take under the policy ``summed`` (``trend(partials, measure="emp_digits", policy="summed")``).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodlens.functions.values import count_value, safe_int
from periodlens.sources import store as ST

GRAIN = ("agy", "agysub", "agysubt", "toa", "toat", "loct", "agelvlt")
# Head count columns of a partial and the policy each follows.
POLICIES = {"emp_skip": "skip", "emp_digits": "digits_else_zero", "emp_impute": "impute_one", "emp_coerce": "coerce_zero"}
PERIOD = ("year", "quarter")
_MADE_FROM = "year int, quarter string, version string"


def period_partials(facts: DataFrame, grain: Iterable[str] = GRAIN, measure: str = "employment", value: str = "salary",
                    parts=PERIOD) -> DataFrame:
    """One row for each period and combination of ``grain``: rows, the policies' sums, emp_int, value_sum, value_valid."""
    v = safe_int(value)
    sums = [F.sum(count_value(measure, policy)).alias(name) for name, policy in POLICIES.items()]
    return facts.groupBy(*parts, *[g for g in grain if g in facts.columns]).agg(
        F.count(F.lit(1)).alias("rows"), *sums, F.sum(F.col(measure).try_cast("int")).alias("emp_int"),
        F.sum(v).alias("value_sum"), F.count(v).alias("value_valid"))


def _made_from(spark: SparkSession, path: str) -> dict:
    """Period → fact version of the newest state of the partials."""
    seq, _ = ST.current(spark, path)
    if not seq:
        return {}
    rows = spark.read.schema(_MADE_FROM).parquet(f"{path}/made_from/seq={seq}").collect()      # a row a period
    return {(r["year"], r["quarter"]): r["version"] for r in rows}


def refresh(spark: SparkSession, store: str, grain: Iterable[str] = GRAIN, measure: str = "employment", value: str = "salary",
            path: str | None = None) -> list[tuple]:
    """Bring the partials of a published store up to date; the periods that were computed again."""
    path = path or f"{store}/partials"
    want = {(r["year"], r["quarter"]): r["version"] for r in ST.current(spark, store)[1]}
    have = _made_from(spark, path)
    todo = {p for p, version in want.items() if have.get(p) != version}
    gone = have.keys() - want.keys()
    if not todo and not gone:
        return []
    facts = ST.read_published(spark, store, keep=(lambda r: (r["year"], r["quarter"]) in todo) if todo else None)
    made = period_partials(facts if todo else facts.limit(0), grain, measure, value)

    def remember(seq: int) -> None:
        spark.createDataFrame([(*p, v) for p, v in want.items()], _MADE_FROM).coalesce(1).write.mode("overwrite").parquet(
            f"{path}/made_from/seq={seq}")
    ST.publish(made, path, remove=gone, before_manifest=remember)
    return sorted(todo)


def read_partials(spark: SparkSession, store: str, path: str | None = None) -> DataFrame:
    """The partials of the store's periods as of the last ``refresh``."""
    return ST.read_published(spark, path or f"{store}/partials")


def mean_value(partials: DataFrame, keys) -> DataFrame:
    """Mean of the value over the rows of each key: the partial sums over the partial counts (A2 over periods)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return partials.groupBy(*keys).agg(
        F.sum("rows").alias("rows"), F.sum("value_valid").alias("n_valid"),
        F.round(F.sum("value_sum").cast("double") / F.sum("value_valid"), 4).alias("mean_value"))


# --- distinct values over any set of periods (A9, A11) -----------------------------------------

LG_ENTRIES = 12                # 4,096 entries a sketch: exact below, relative standard error 1 / 64 above


def period_sketches(facts: DataFrame, fields: Iterable[str], parts=PERIOD, lg_entries: int = LG_ENTRIES) -> DataFrame:
    """A theta sketch of the distinct non-null values of each field in each period: period columns, field, sketch.

    A sketch has a bounded size whatever the number of values, so all periods together are as small as their number.
    """
    fields = list(fields)
    wide = facts.groupBy(*parts).agg(*[F.theta_sketch_agg(F.col(f).cast("string"), lg_entries).alias(f) for f in fields])
    entries = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("sketch")) for f in fields])
    return wide.select(*parts, F.inline(entries))


def distinct_over(sketches: DataFrame, keys) -> DataFrame:
    """Estimated distinct values of the union of the periods of each key: keys, field, sketch, n_estimated."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    union = sketches.groupBy(*keys, "field").agg(F.theta_union_agg("sketch").alias("sketch"))
    return union.withColumn("n_estimated", F.theta_sketch_estimate("sketch"))


def vanished(before: DataFrame, after: DataFrame, on) -> DataFrame:
    """Estimated values of ``before`` that ``after`` no longer has: ``on`` columns and n_vanished.

    Both are results of ``distinct_over``; rows of ``before`` without a partner lose all their values.
    """
    on = [on] if isinstance(on, str) else list(on)
    later = after.select(*on, F.col("sketch").alias("__later"))
    gone = F.theta_sketch_estimate(F.theta_difference("sketch", "__later"))
    return before.join(later, on, "left").select(*on, F.coalesce(gone, F.theta_sketch_estimate("sketch")).alias("n_vanished"))


def relative_error(lg_entries: int = LG_ENTRIES) -> float:
    """Three standard errors of an estimate, as a share of the true number."""
    return 3 / 2 ** (lg_entries / 2)
