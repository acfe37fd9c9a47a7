"""Session helpers.

The library never builds its own cluster configuration: it reads what the
session already has and only fills gaps (tests, local runs).  Jobs that need
to cut lineage use the shared folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings a local run gets when the session does not already carry them.
LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "periodlens", driver_memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    for key, value in LOCAL_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster the folder must be named by the session (shared storage every executor and
    the driver can reach); only a local-mode session without one gets a local folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: intermediate tables "
                               "are written there")
        current = tempfile.mkdtemp(prefix="periodlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint dir for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", name)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it, Spark deletes a query's shuffle files when the query ends, not when the driver collects its garbage.

    For writes that cut the lineage: their shuffles are not read again.  The session's own setting is restored.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def materialize(df, name: str = "table", with_count: bool = False):
    """Write ``df`` once to the shared checkpoint folder and return the table read back.

    Used for small derived sides (flagged groups, duplicate keys, offsets) that a query needs
    twice — once to prove their size, once to join — so the source is scanned only once, and
    for cutting lineage so a lost executor re-reads the table instead of recomputing it.
    ``with_count`` also returns the number of rows written, observed during the write itself
    (no extra job).
    """
    import uuid
    from pyspark.sql import Observation
    from pyspark.sql import functions as F
    spark = df.sparkSession
    tag = uuid.uuid4().hex
    path = scratch_path(spark, f"{name}-{tag}")
    obs = Observation(f"rows-{tag}")
    with shuffles_dropped(spark):
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    if with_count:
        return table, int(obs.get["rows"])
    return table
