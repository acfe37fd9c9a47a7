"""Consecutive row positions, running totals and medians without funnelling rows through one task.

A window with no PARTITION BY sends every row to a single task.  Here the rows are first cut into ordered
ranges by bounds that are a function of the data alone (no sampled or physical partitions, which may differ
when a task is repeated): the sort keys of the rows with the least hashes, put in order, and of these each ``PER_BOUND``-th.  A hash of the whole row is
the last sort key, so the bounds are distinct, and a key with very many rows is cut into several ranges.  A row finds its
range by binary search, rows are numbered within their range, and the sizes of the ranges before it (at most
``RANGES`` + 1 rows a group) are added.  One path for every size, and lazy: nothing runs or is written before
the result is asked for.

Tables with one row for each code of a code table (comparisons, shares, trends) are numbered by ``rank_codes``, in one task.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGES = 255
# Keys picked for each bound: the more, the more even the ranges (24: none above twice the mean).
PER_BOUND = 24
# Rank error of the quantile sketch that brackets a median, as a share of the rows.
ACCURACY = 10_000


class Key(NamedTuple):
    """A sort key: an expression, its direction, and whether nulls come last."""
    expr: Column
    descending: bool
    nulls_last: bool

    def sort(self) -> Column:
        if self.descending:
            return self.expr.desc_nulls_last() if self.nulls_last else self.expr.desc_nulls_first()
        return self.expr.asc_nulls_last() if self.nulls_last else self.expr.asc_nulls_first()


def up(c, nulls_last: bool = False) -> Key:
    """Ascending key (nulls first by default)."""
    return Key(F.col(c) if isinstance(c, str) else c, False, nulls_last)


def down(c, nulls_last: bool = True) -> Key:
    """Descending key (nulls last by default)."""
    return Key(F.col(c) if isinstance(c, str) else c, True, nulls_last)


def _keys(order_by) -> list[Key]:
    order_by = [order_by] if isinstance(order_by, (str, Key, Column)) else list(order_by)
    return [k if isinstance(k, Key) else up(k) for k in order_by]


def _precedes(a: Column, b: Column, keys: list[Key]) -> Column:
    """Whether the key struct ``a`` sorts before ``b``."""
    out = F.lit(False)
    for i, key in reversed(list(enumerate(keys))):
        x, y = a[f"k{i}"], b[f"k{i}"]
        less = F.coalesce((x > y) if key.descending else (x < y), F.lit(False))
        null = (x.isNotNull() & y.isNull()) if key.nulls_last else (x.isNull() & y.isNotNull())
        out = less | null | (x.eqNullSafe(y) & out)
    return out


def in_ranges(df: DataFrame, order_by, weight: Column, partition_by=()) -> tuple[DataFrame, list[Key]]:
    """The rows with the number of their range: row, key (struct), weight, p0.. (the groups), range; and the keys.

    Ranges follow the order of the keys over all groups; the last key is a hash of the row.
    """
    keys = [*_keys(order_by), up(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))]
    key = F.struct(*[k.expr.alias(f"k{i}") for i, k in enumerate(keys)])
    rows = df.select(F.struct(*df.columns).alias("row"), key.alias("key"), weight.cast("bigint").alias("weight"),
                     *[F.col(p).alias(f"p{i}") for i, p in enumerate(partition_by)])
    picked = rows.select("key").orderBy(F.xxhash64("key", F.lit(RANGES)), "key").limit(RANGES * PER_BOUND)
    in_order = F.array_sort(F.collect_list("key"), lambda a, b: F.when(_precedes(a, b, keys), -1)
                            .when(_precedes(b, a, keys), 1).otherwise(0))
    # of the picked keys, in order, each PER_BOUND-th is a bound
    bounds = F.filter(in_order, lambda _, i: (i + 1) % PER_BOUND == 0)
    rows = rows.withColumn("bounds", picked.agg(bounds).scalar())
    steps = F.array(*[F.lit(1 << i) for i in range(RANGES.bit_length() - 1, -1, -1)])

    def step(at, p):
        ahead = F.get(F.col("bounds"), at + p - 1)
        return F.when((at + p <= F.size("bounds")) & ~_precedes(F.col("key"), ahead, keys), at + p).otherwise(at)

    found = F.aggregate(steps, F.lit(0), step).alias("range")
    return rows.select("row", "key", "weight", *[f"p{i}" for i in range(len(partition_by))], found), keys


def running_total(df: DataFrame, order_by, weight: Column, name: str, partition_by=()) -> DataFrame:
    """Add the sum (bigint) of ``weight`` over the rows up to and with each row in ``order_by`` order.

    ``order_by`` are column names, Columns (ascending) or ``up``/``down`` keys; a total order makes
    the totals deterministic; rows that tie in it are in the order of a hash of their values.  Totals restart per
    ``partition_by``; a null is a group of its own.
    """
    parts = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    groups = [f"p{i}" for i in range(len(parts))]
    rows, keys = in_ranges(df, order_by, weight, parts)
    sums = rows.groupBy(*groups, "range").agg(F.sum("weight").alias("s"))
    before = Window.partitionBy(*groups).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*[F.col(g).alias(f"s_{g}") for g in groups], F.col("range").alias("s_range"),
                       F.coalesce(F.sum("s").over(before), F.lit(0)).alias("offset"))
    if not groups:
        sums = F.broadcast(sums)                  # at most RANGES + 1 rows
    same = F.col("range") == F.col("s_range")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"s_{g}"))
    within = (Window.partitionBy(*groups, "range").orderBy(*[_named(k, i) for i, k in enumerate(keys)])
              .rowsBetween(Window.unboundedPreceding, 0))
    total = (F.col("offset") + F.sum("weight").over(within)).cast("bigint")
    return rows.join(sums, same).select("row", total.alias("total")).select(
        *[F.col("row")[c].alias(c) for c in df.columns], F.col("total").alias(name))


def _named(key: Key, i: int) -> Column:
    return Key(F.col(f"key.k{i}"), key.descending, key.nulls_last).sort()


def with_position(df: DataFrame, order_by, name: str = "rank", partition_by=()) -> DataFrame:
    """Add a 1-based consecutive position (bigint) in ``order_by`` order, restarting per ``partition_by``."""
    return running_total(df, order_by, F.lit(1), name, partition_by)


def exact_median(df: DataFrame, value: str, by=(), name: str = "median") -> DataFrame:
    """The exact median of the non-null numeric values of each group: ``by`` columns and ``name`` (double).

    A quantile sketch (a bounded aggregate) brackets the median: its ranks are off by less than ``1 / ACCURACY`` of the rows, and
    the bracket is twice that on both sides.  The values inside it are counted per distinct value, those below in one
    number, and the middle values are read off the running counts: at most 8 of ``ACCURACY`` rows of a group, besides ties,
    meet in a task.
    """
    by = [by] if isinstance(by, str) else list(by)
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).alias("__x"))
    share = F.array(*[F.lit(0.5 + side * 3.0 / ACCURACY) for side in (-1, 1)])
    ends = rows.groupBy(*by).agg(F.percentile_approx("__x", share, ACCURACY).alias("__ends"))
    if by:
        names = {b: f"__b{i}" for i, b in enumerate(by)}
        same = F.lit(True)
        for b, alias in names.items():
            same = same & F.col(b).eqNullSafe(F.col(alias))
        rows = rows.join(ends.withColumnsRenamed(names), same).drop(*names.values())
    else:
        rows = rows.withColumn("__ends", ends.select("__ends").scalar())
    x, low_end, high_end = F.col("__x"), F.col("__ends")[0], F.col("__ends")[1]
    zone = F.when(x < low_end, -1).when(x > high_end, 1).otherwise(0)
    counts = (rows.select(*by, zone.alias("__zone"), F.when(zone == 0, x).alias("__x")).groupBy(*by, "__zone", "__x")
              .agg(F.count(F.lit(1)).alias("__n")))
    group = Window.partitionBy(*by)
    upto = group.orderBy("__zone", "__x").rowsBetween(Window.unboundedPreceding, 0)
    run = counts.withColumns({"__upto": F.sum("__n").over(upto), "__size": F.sum("__n").over(group)})
    low = F.min(F.when(F.col("__upto") * 2 >= F.col("__size"), x))
    high = F.min(F.when(F.col("__upto") * 2 > F.col("__size"), x))
    return run.groupBy(*by).agg(((low.cast("double") + high.cast("double")) / 2).alias(name))


def top_n(df: DataFrame, order_by, n: int, name: str = "rank") -> DataFrame:
    """The first ``n`` rows in ``order_by`` order with their rank.

    ``orderBy().limit()`` plans as a distributed partial top-k (TakeOrderedAndProject);
    the rank window then runs on at most ``n`` rows.
    """
    cols = [k.sort() for k in _keys(order_by)]
    head = df.orderBy(*cols).limit(n)
    return head.withColumn(name, F.row_number().over(Window.orderBy(*cols)).cast("bigint"))


def rank_codes(df: DataFrame, order_by, name: str = "rank") -> DataFrame:
    """Number a table that has one row for each code of a code table (or each column of a schema): one task does it.

    ``with_position`` numbers tables of any size.
    """
    return df.withColumn(name, F.row_number().over(Window.orderBy(*[k.sort() for k in _keys(order_by)])).cast("bigint"))
