"""Incremental snapshot builds: only periods whose files changed are built again.

Beside each state of the store its files are listed: path, kind, period, size, time, checksum.  A new build lists the
files without opening them and compares.  A file of another size is changed; one of another time is read for its checksum
first.  A period is built again if any of its fact files or code tables was changed, added or removed; it is removed
if it has no fact file any more.  The list belongs to the manifest's state: it is written before the manifest and counts only
once the manifest has moved.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodlens.functions.periods import period_from_path
from periodlens.plans import reports as R
from periodlens.sources import files as S
from periodlens.sources import store as ST

_STATE = "path string, kind string, year int, quarter string, size long, modified timestamp, checksum decimal(38,0)"


def listed_files(spark: SparkSession, base: str, segments=(1, 2, 3), kind_of=S.file_kind) -> DataFrame:
    """The fact files and code tables under ``base``: path, kind, year, quarter, size, modified.  No file is opened."""
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base)
             .select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified")))
    period = period_from_path(F.col("path"), segments)
    return (found.withColumn("kind", kind_of(F.col("path"))).where("kind is not null").withColumn("p", period)
            .select("path", "kind", F.col("p.year").cast("int").alias("year"), F.col("p.quarter").alias("quarter"), "size", "modified"))


def checksums(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, checksum) of files: the sum of their lines' hashes."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), F.xxhash64("value").alias("h"))
    return lines.groupBy("path").agg(F.sum(F.col("h").cast("decimal(38,0)")).alias("checksum"))


def _states(spark: SparkSession, store: str) -> DataFrame:
    """The files of the store's newest state."""
    seq, _ = ST.current(spark, store)
    if not seq:
        return spark.createDataFrame([], _STATE)
    return spark.read.schema(_STATE).parquet(f"{store}/files/seq={seq}")


def _bare(path: str) -> str:
    """A path without the slashes that its spellings differ in (``file:/a``, ``file:///a``)."""
    return re.sub(r":/+", ":/", path)


def plan_build(spark: SparkSession, base: str, store: str, segments=(1, 2, 3), kind_of=S.file_kind) -> tuple[list, set, set]:
    """Compare the files with the store's: (rows of all files with their checksums, periods to build, periods to remove).

    A row a file is collected, and the content of new and touched files is read, no other.
    """
    old = _states(spark, store).select("path", F.col("size").alias("old_size"), F.col("modified").alias("old_modified"),
                                       F.col("checksum").alias("old_checksum"), F.col("year").alias("old_year"),
                                       F.col("quarter").alias("old_quarter"))
    both = listed_files(spark, base, segments, kind_of).join(old, "path", "full").collect()
    touched = [r["path"] for r in both if r["size"] is not None and (r["old_size"], r["old_modified"]) != (r["size"], r["modified"])]
    sums = {}
    if touched:
        named = {_bare(p): p for p in touched}
        for r in checksums(spark, touched).collect():
            sums[named[_bare(S.plain_path(r["path"]))]] = r["checksum"]
    files, changed = [], set()
    for r in both:
        if r["size"] is None:                          # the file is gone
            changed.add((r["old_year"], r["old_quarter"]))
            continue
        checksum = sums.get(r["path"]) if r["path"] in touched else r["old_checksum"]
        files.append((r["path"], r["kind"], r["year"], r["quarter"], r["size"], r["modified"], checksum))
        if r["path"] in touched and (r["old_size"] != r["size"] or checksum != r["old_checksum"]):
            changed.add((r["year"], r["quarter"]))
    changed = {p for p in changed if None not in p}    # files without a period are reported by ``rejected_files``
    with_facts = {(f[2], f[3]) for f in files if f[1] == "facts"}
    return files, changed & with_facts, changed - with_facts


def build(spark: SparkSession, base: str, store: str, segments=(1, 2, 3), encoding: str = S.LATIN1, verify=None,
          kind_of=S.file_kind) -> DataFrame:
    """Bring the store up to date with the files under ``base``.

    ``kind_of`` tells a file's kind from its path (default: by its fixed name).

    Returns a row a period of the new state and of those removed: year, quarter, action (built, kept, removed), rows.
    """
    files, todo, gone = plan_build(spark, base, store, segments, kind_of)
    _, before = ST.current(spark, store)
    held = {(r["year"], r["quarter"]): r["rows"] for r in before}
    if todo or gone & held.keys():
        snap = changed_snapshots(spark, files, todo, segments, encoding)

        def remember(seq: int) -> None:
            spark.createDataFrame(files, _STATE).coalesce(1).write.mode("overwrite").parquet(f"{store}/files/seq={seq}")
        if snap is None:
            snap = spark.createDataFrame([], "year int, quarter string, dataset_key string")
        ST.publish(snap, store, remove=gone, verify=verify, before_manifest=remember)
    _, after = ST.current(spark, store)
    now = {(r["year"], r["quarter"]): r for r in after}
    versions = {(r["year"], r["quarter"]): r["version"] for r in before}
    rows = [(y, q, "kept" if versions.get((y, q)) == r["version"] else "built", r["rows"]) for (y, q), r in now.items()]
    rows += [(y, q, "removed", 0) for y, q in held.keys() - now.keys()]
    return spark.createDataFrame(rows, "year int, quarter string, action string, rows long")


def changed_snapshots(spark: SparkSession, files: list, periods: set, segments=(1, 2, 3), encoding: str = S.LATIN1) -> DataFrame | None:
    """The denormalised rows of the given periods, from their files alone; None if there is none."""
    mine = [f for f in files if (f[2], f[3]) in periods]
    facts = [f[0] for f in mine if f[1] == "facts"]
    if not facts:
        return None
    kinds = {k: [f[0] for f in mine if f[1] == k] for k in sorted({f[1] for f in mine} - {"facts"})}
    return R.denormalized(spark, facts, kinds, segments, encoding)
