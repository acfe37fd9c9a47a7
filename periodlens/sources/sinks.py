"""Sinks: partitioned parquet snapshots with a read-back check, CSV result tables, and the
ingest manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Tasks that the rows of one period are split over when they are written.
WRITE_SALTS = 8


def write_snapshots(df: DataFrame, path: str, partition_by=("year", "quarter"),
                    compression: str = "zstd") -> DataFrame:
    """Write snapshots as parquet partitioned by period, replacing only the periods written
    (dynamic partition overwrite), then read back the row count per period (S10).

    Rows are hash-partitioned by period and a few salts before the write (few files a period, and a
    period holding a third of all rows is split over several tasks).  The number of rows written is
    observed during the write itself (one pass over the source); the read-back counts only the
    written files.  Returns (partition columns..., rows_read, rows_written_total, complete).
    """
    import uuid
    from pyspark.sql import Observation
    spark = df.sparkSession
    parts = list(partition_by)
    obs = Observation(f"written-{uuid.uuid4().hex}")
    # the written period keys (one per partition directory: a bounded, metadata-sized set) are
    # observed with the row count, so the read-back prunes to exactly those directories
    (cluster_for_write(df, parts)
     .observe(obs, F.count(F.lit(1)).alias("rows"), F.collect_set(F.struct(*parts)).alias("periods"))
     .write.mode("overwrite").partitionBy(*parts).option("partitionOverwriteMode", "dynamic")
     .option("compression", compression).parquet(path))
    metrics = obs.get
    written = int(metrics["rows"])
    keys = [tuple(r[p] for p in parts) for r in metrics["periods"]]
    cond = F.lit(False)
    for key in keys:
        one = F.lit(True)
        for p, v in zip(parts, key):
            one = one & (F.col(p).isNull() if v is None else (F.col(p) == F.lit(v)))
        cond = cond | one
    back = (spark.read.parquet(path).where(cond)
            .groupBy(*parts).agg(F.count(F.lit(1)).alias("rows_read")))
    total = back.agg(F.sum("rows_read")).scalar()
    return back.select(*parts, "rows_read", F.lit(written).cast("bigint").alias("rows_written_total"),
                       (total == F.lit(written)).alias("complete"))


def cluster_for_write(df: DataFrame, parts) -> DataFrame:
    """Bring the rows of a period together for a write, in tasks of a bounded size.

    Rows are dealt by the partition columns and a few salts of the whole row, and rebalanced: adaptive execution joins small
    tasks and splits those larger than its advisory size, so that no task's sort grows with the input.  Without it a
    period's rows meet in at most ``WRITE_SALTS`` tasks.  (A range partitioning would compute the source twice, once
    for its sample.)
    """
    name = "__salt"
    while name in df.columns:
        name += "_"
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(WRITE_SALTS))
    return df.withColumn(name, salt).hint("rebalance", *[F.col(p) for p in parts], F.col(name)).drop(name)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Write a result table as CSV with a header.

    ``single_file`` is meant for small report tables only; large outputs stay distributed.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def manifest(df: DataFrame, by: str = "dataset_key") -> DataFrame:
    """Per period and source file: records, malformed records and size in MB."""
    bad = F.count("corrupt_record") if "corrupt_record" in df.columns else F.lit(0).cast("bigint")
    return (df.groupBy(by, "source_file", "source_size").agg(F.count(F.lit(1)).alias("records"), bad.alias("bad_records"))
            .withColumn("size_mb", F.round(F.col("source_size") / (1024.0 * 1024.0), 2)))


def manifest_totals(man: DataFrame) -> DataFrame:
    """Totals over a manifest: datasets, records, MB and average records per dataset."""
    return man.agg(F.countDistinct("dataset_key").alias("datasets"),
                   F.sum("records").alias("total_records"),
                   F.round(F.sum("size_mb"), 2).alias("total_mb"),
                   F.round(F.sum("records") / F.countDistinct("dataset_key"), 2).alias("avg_records"))


def rejected_files(df: DataFrame) -> DataFrame:
    """Source files whose period could not be parsed (reported instead of silently dropped)."""
    return df.where(F.col("year").isNull() | F.col("quarter").isNull()).groupBy("source_file").agg(
        F.count(F.lit(1)).alias("records"))

