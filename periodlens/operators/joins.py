"""Join building blocks: group exclusion/keeping and enrichment.

No side is hinted: Catalyst broadcasts a side whose size in bytes is below its threshold, and AQE
switches at run time when a side turns out small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exclude_groups(df: DataFrame, groups: DataFrame, keys) -> DataFrame:
    """Rows of ``df`` whose key is not among ``groups`` (left anti join).

    Unlike ``~isin`` a null key is kept, since it matches no excluded group.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.join(groups.select(*keys).distinct(), on=keys, how="left_anti")


def keep_groups(df: DataFrame, groups: DataFrame, keys) -> DataFrame:
    """Rows of ``df`` whose key is among ``groups`` (left semi join)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.join(groups.select(*keys).distinct(), on=keys, how="left_semi")


def aggregate_kept_groups(df: DataFrame, group: str, hit: Column, by, aggs) -> DataFrame:
    """Aggregates by ``group`` and ``by`` of the groups with a row that ``hit`` is true for, in one scan.

    The rows are aggregated first; the flag is read off that table (a row for each group and combination of ``by``), so the
    rows are never joined with the flagged groups.  A null group is never kept.
    """
    by = [by] if isinstance(by, str) else list(by)
    per = df.where(F.col(group).isNotNull()).groupBy(group, *by).agg(*aggs, F.max(F.coalesce(hit, F.lit(False))).alias("__hit"))
    return per.withColumn("__any", F.max("__hit").over(Window.partitionBy(group))).where("__any").drop("__hit", "__any")


def enrich_coalesce(df: DataFrame, descriptions: DataFrame, key: str, value: str, out: str,
                    fallback: str) -> DataFrame:
    """Left join a code → full description table and keep ``coalesce(full, fallback)``.

    ``descriptions`` is reduced to one row per code first (smallest description), so the
    join never multiplies rows.
    """
    d = descriptions.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(value).alias("__full"))
    return df.join(d, on=key, how="left").withColumn(
        out, F.coalesce(F.col("__full"), F.col(fallback))).drop("__full")
