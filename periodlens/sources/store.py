"""A published snapshot store: versioned period folders, and a manifest that moves last.

    <store>/data/version=<id>/year=.../quarter=.../part-*     written once, never changed
    <store>/manifest/seq=<n>/part-*                            one file: the periods of state n and their folders

``publish`` writes the new rows beside the old ones, reads them back and compares count and checksum per store
and per period; only then the next manifest is written, as one file.  Readers follow the newest manifest.  A write that is
killed, or does not pass its check, leaves folders that no manifest names: the old state stays as it was.  Periods that are not
written again keep their folders.  What is collected is the manifest: a row a period.

One writer at a time: of two that write the same state the second fails.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodlens.sources.sinks import cluster_for_write

PERIOD = ("year", "quarter")


def _read_states(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.option("basePath", path).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):      # nothing published yet
            return None
        raise


def history(spark: SparkSession, store: str) -> DataFrame | None:
    """All states: seq, the period columns, rows, checksum, version, folder.  None if nothing is published."""
    return _read_states(spark, f"{store}/manifest")


def current(spark: SparkSession, store: str, seq: int | None = None) -> tuple[int, list]:
    """The newest state's (or state ``seq``'s) number and its manifest rows; 0 and no rows if there is none."""
    states = history(spark, store)
    if states is None:
        return 0, []
    if seq is None:
        seq = states.agg(F.max("seq")).first()[0]
    return seq, states.where(F.col("seq") == seq).drop("seq").collect()


def _checksum(columns: list) -> F.Column:
    """Sum of the rows' hashes: the same for the same rows in any order."""
    hashable = [F.col(f"`{f.name}`") for f in columns if not isinstance(f.dataType, T.MapType)]
    return F.sum(F.xxhash64(*hashable).cast("decimal(38,0)"))


def publish(df: DataFrame, store: str, partition_by: Iterable[str] = PERIOD, remove: Iterable[tuple] = (),
            verify: Callable[[DataFrame], bool] | None = None, before_manifest: Callable[[int], None] | None = None) -> DataFrame:
    """Write the periods of ``df`` as their new versions and move the manifest.

    ``remove`` names periods (tuples of ``partition_by`` values) that the new state no longer has.  ``verify`` gets the rows
    as they were read back and may refuse them; ``before_manifest`` is told the new state's number first.
    Returns a row for each written period: its columns, rows_read, rows_written_total, complete, published.
    """
    spark, parts = df.sparkSession, list(partition_by)
    seq, held = current(spark, store)
    version = uuid.uuid4().hex
    base = f"{store}/data"
    values = [f for f in df.schema.fields if f.name not in parts]
    obs = Observation(f"publish-{version}")
    (cluster_for_write(df, parts)
     .observe(obs, F.count(F.lit(1)).alias("rows"), _checksum(values).alias("checksum"))
     .write.partitionBy(*parts).parquet(f"{base}/version={version}"))
    written = obs.get
    made, complete = [], int(written["rows"]) == 0
    if not complete:
        back = spark.read.schema(df.schema).parquet(f"{base}/version={version}")
        folder = F.regexp_extract(F.col("_metadata.file_path"), r"(version=.*)/[^/]+$", 1)
        made = (back.groupBy(*parts).agg(F.count(F.lit(1)).alias("rows"), _checksum(values).alias("checksum"),
                                         F.min(folder).alias("folder")).collect())
        complete = (sum(r["rows"] for r in made) == int(written["rows"])
                    and sum(r["checksum"] for r in made) == written["checksum"])
        complete = complete and (verify is None or bool(verify(back)))
    if complete:
        fields = [df.schema[p] for p in parts]
        schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in fields), T.StructField("rows", T.LongType()),
                               T.StructField("checksum", T.DecimalType(38, 0)), T.StructField("version", T.StringType()),
                               T.StructField("folder", T.StringType())])
        gone = {tuple(r[p] for p in parts) for r in made} | {tuple(r) for r in remove}
        rows = [tuple(r[f.name] for f in schema) for r in held if tuple(r[p] for p in parts) not in gone]
        rows += [(*(r[p] for p in parts), r["rows"], r["checksum"], version, unquote(r["folder"])) for r in made]
        if before_manifest:
            before_manifest(seq + 1)
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{store}/manifest/seq={seq + 1}")
    report = T.StructType([*(T.StructField(p, df.schema[p].dataType) for p in parts), T.StructField("rows_read", T.LongType()),
                           T.StructField("rows_written_total", T.LongType()), T.StructField("complete", T.BooleanType()),
                           T.StructField("published", T.BooleanType())])
    return spark.createDataFrame([(*(r[p] for p in parts), r["rows"], int(written["rows"]), complete, complete) for r in made], report)


def read_published(spark: SparkSession, store: str, schema: T.StructType | None = None, seq: int | None = None,
                   keep: Callable[[dict], bool] | None = None) -> DataFrame:
    """The rows of the newest state (or of state ``seq``); ``keep`` picks periods by their manifest rows.

    Only the folders that the manifest names are listed and read.  Without a ``schema`` the columns of all versions are merged.
    """
    seq, rows = current(spark, store, seq)
    folders = [f"{store}/data/{r['folder']}" for r in rows if keep is None or keep(r.asDict())]
    if not folders:
        if schema is None:
            raise ValueError(f"no published period in {store}")
        return spark.createDataFrame([], schema)
    reader = spark.read.option("basePath", f"{store}/data")
    if schema is None:
        return reader.option("mergeSchema", "true").parquet(*folders).drop("version")
    wide = T.StructType([*schema.fields, T.StructField("version", T.StringType())])
    return reader.schema(wide).parquet(*folders).drop("version")
