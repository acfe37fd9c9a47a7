"""Benchmark: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is executed to completion with the no-op sink (no driver collection), once to
warm up and then $BENCH_REPS times; the per-query figure is the median.  ``store_build`` is the
scan, join and write behind the snapshot store that most queries read, and ``*_plain`` are two-period
queries over the source tables, without that store.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from periodlens.operators import compare as C  # noqa: E402
from periodlens.operators import profile as P  # noqa: E402
from periodlens.plans.catalog import AFTER, BEFORE, QUERIES  # noqa: E402
from periodlens.session import local_session, scratch_path  # noqa: E402
from periodlens.sources.sinks import cluster_for_write  # noqa: E402
from periodlens.sources.tables import snapshot_facts  # noqa: E402

HEADLINE = (
    "compare_total", "headcount_top", "mean_by_group", "numeric_summary", "denormalize",
    "redaction_profile", "availability", "exclude_groups", "specials_last", "compare_left",
    "pivot_multi", "pivot_year", "trend", "cell_redaction", "null_rates", "verdict",
    "duplicate_report", "dedupe_first", "name_map", "top_split",
)


def plain(spark, sf_dir):
    """Facts of the two periods straight from the source tables."""
    return snapshot_facts(spark, sf_dir, [BEFORE, AFTER], store=False)


def compare_total_plain(spark, sf_dir):
    return C.comparison_table(plain(spark, sf_dir), "agelvlt", F.col("year") == BEFORE, F.col("year") == AFTER)


def redaction_profile_plain(spark, sf_dir):
    return P.redaction_profile(plain(spark, sf_dir), F.col("year") == BEFORE, F.col("year") == AFTER)


def availability_plain(spark, sf_dir):
    return C.availability(plain(spark, sf_dir), "salary", F.col("year") == BEFORE, F.col("year") == AFTER)


PLAIN = {f.__name__: f for f in (compare_total_plain, redaction_profile_plain, availability_plain)}


def store_build(spark, sf_dir) -> None:
    (cluster_for_write(snapshot_facts(spark, sf_dir, store=False), ["year", "quarter"]).write.mode("overwrite")
     .partitionBy("year", "quarter").option("compression", "zstd").parquet(scratch_path(spark, "bench-store")))


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else ["store_build", *HEADLINE, *PLAIN]
    spark = local_session(cores=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE", "16")),
                          driver_memory=os.environ.get("BENCH_MEM", "16g"))
    times = {}
    for name in names:
        query = {**QUERIES, **PLAIN}.get(name)
        once = (lambda: store_build(spark, sf_dir)) if name == "store_build" else (lambda q=query: run(q(spark, sf_dir)))
        once()                                     # warm-up
        samples = []
        for _ in range(reps):
            t0 = time.perf_counter()
            once()                                 # plan building + execution
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus, "reps": reps}))
    spark.stop()


if __name__ == "__main__":
    main()
