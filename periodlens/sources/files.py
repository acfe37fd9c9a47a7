"""File sources: delimited snapshot files, code tables, status tables, parquet snapshots.

Delimited files from different eras carry different headers, so files are grouped by
their (normalised) header and each group is one CSV scan with an explicit all-string
schema; the groups are then unioned by name.  Headers are read with Spark (one job for all files, which also finds cells with
line breaks), never by opening files on the driver.
"""

from __future__ import annotations

import csv
import io
import re
from collections import OrderedDict
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodlens.sources import records
from periodlens.sources.records import CORRUPT
from periodlens.functions.periods import dataset_key, period_from_path

# --- fixed values -----------------------------------------------------------
# Encoding of the history fact and lookup files.
LATIN1 = "ISO-8859-1"
# Renames for a repeated header name, by occurrence (second OCC column is the family code).
DUPLICATE_HEADER_NAMES = {("occ", 2): "occfam"}
# Cell texts that stand for a missing value after text conversion.
NULL_TEXTS = ("nan", "None")
# Status table numeric columns and their types; every other column is text.
STATUS_TYPES = {"DATECODE": T.IntegerType(), "EMPCOUNT": T.LongType(), "AVGSAL": T.LongType(),
                "AVGLOS": T.DoubleType()}
# ----------------------------------------------------------------------------


def normalize_header(name: str) -> str:
    """Strip, turn spaces and dashes into underscores, lower-case."""
    return re.sub(r"[ \-]", "_", name.strip()).lower()


def normalized_names(raw_names, duplicates=DUPLICATE_HEADER_NAMES) -> list[str]:
    """Normalised header names; repeated names are renamed by occurrence (``occ`` twice →
    ``occ``, ``occfam``), other repeats get ``_<n>``."""
    seen: dict[str, int] = {}
    out = []
    for raw in raw_names:
        n = normalize_header(raw)
        seen[n] = seen.get(n, 0) + 1
        k = seen[n]
        out.append(n if k == 1 else duplicates.get((n, k), f"{n}_{k}"))
    return out


def plain_path(path: str) -> str:
    """A file's path as Spark's readers take it, from its spelling in ``_metadata``."""
    return unquote(path)


def _split_header(line: str, sep: str, quote: str) -> list[str]:
    return next(csv.reader(io.StringIO(line.lstrip("﻿")), delimiter=sep, quotechar=quote))


def read_delimited(spark: SparkSession, paths, sep: str = ",", quote: str = '"',
                   encoding: str = "UTF-8", header_map=None, types: dict | None = None,
                   with_source: bool = True, line_numbers: bool = False) -> DataFrame:
    """All-text scan of delimited files whose headers may differ.

    One job looks at all files: headers, and whether a quoted cell holds a line break (``records.survey``).
    Files are grouped by normalised header; each group is one scan with an explicit schema, or
    is put together from lines if its cells are wrapped; the groups are unioned by name with missing columns as null.
    ``header_map`` turns a raw header list into names (default: ``normalized_names``).
    ``with_source`` adds ``source_file`` / ``source_size``; ``line_numbers`` adds ``line_no``, which rises in file
    order within each file and from file to file by path.  ``corrupt_record`` is the whole text of a record whose cells don't match
    the header (null for the others); its cells may be cut.  Files without a line give no rows.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    header_map = header_map or normalized_names
    types = types or {}
    groups: "OrderedDict[tuple, list]" = OrderedDict()
    for file in records.survey(spark, paths, sep, quote, encoding):
        names = tuple(header_map(_split_header(file["header"], sep, quote)))
        groups.setdefault((names, file["n_open"] > 0), []).append(plain_path(file["source_file"]))
    if not groups:
        raise ValueError("no input files")
    frames = []
    for (names, wrapped), files in groups.items():
        schema = T.StructType([T.StructField(n, types.get(n, T.StringType()), True) for n in names]).add(CORRUPT, T.StringType())
        if wrapped:
            df = records.parsed(records.assembled(spark, files, sep, quote, encoding), schema, sep, quote)
            place = F.struct("source_file", "block", "line")
        else:
            # cells are counted in full, whatever columns are read
            df = (spark.read.schema(schema).option("header", True).option("sep", sep).option("quote", quote)
                  .option("escape", quote).option("encoding", encoding).option("mode", "PERMISSIVE")
                  .option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False)
                  .option("enforceSchema", True).csv(files))
            # Spark refuses to read the corrupt column alone, and converts only cells that are read: it is tied to the
            # first cell and to those with a type
            tied = [names[0], *(n for n in names[1:] if n in types)]
            any_cell = F.length(F.concat_ws("", *[F.col(f"`{n}`").cast("string") for n in tied])) >= 0
            df = df.withColumns({"source_file": F.col("_metadata.file_path"), "source_size": F.col("_metadata.file_size"),
                                 CORRUPT: F.when(any_cell, F.col(CORRUPT))})
            place = F.struct("source_file", F.col("_metadata.file_block_start").alias("block"),
                             F.monotonically_increasing_id().alias("line"))
        extra = ["source_file", "source_size"] if with_source else []
        frames.append(df.select(*schema.names, *extra, *([place.alias("line_no")] if line_numbers else [])))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def bad_records(df: DataFrame) -> DataFrame:
    """Per source file: records, and those whose cells don't match the header."""
    return df.groupBy("source_file").agg(F.count(F.lit(1)).alias("records"), F.count(CORRUPT).alias("bad_records"))


def sound(df: DataFrame) -> DataFrame:
    """The records whose cells match the header; ``bad_records`` counts the others."""
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def null_texts(df: DataFrame, columns=None, texts=NULL_TEXTS) -> DataFrame:
    """Turn 'nan' / 'None' cells into real nulls (the text form of a missing value)."""
    columns = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~F.col(c).isin(*texts), F.col(c)) for c in columns})


def trim_strings(df: DataFrame, columns=None) -> DataFrame:
    """Unicode-aware strip of every string column."""
    from periodlens.functions.text import trim_all
    columns = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: trim_all(c) for c in columns})


def with_period(df: DataFrame, path: Column | str = "source_file", segments=(1, 2, 3)) -> DataFrame:
    """Add ``dataset_key``, ``quarter``, ``year`` parsed from the file path."""
    p = period_from_path(F.col(path) if isinstance(path, str) else path, segments)
    # explode, not a column: the path is parsed once a row; a filter on the period would repeat it inside the scan
    return (df.withColumn("__period", F.explode(F.array(p)))
            .withColumn("quarter", F.col("__period.quarter"))
            .withColumn("year", F.col("__period.year"))
            .withColumn("dataset_key", dataset_key(F.col("year"), F.col("quarter")))
            .drop("__period"))


def file_kind(path: Column) -> Column:
    """``facts`` for a fact file, the kind (``DTloc``) for a code table, null for any other file, by the file's name."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    table = F.regexp_extract(name, r"(?i)^DT(.*)[.]TXT$", 1)
    return (F.when(F.upper(name).startswith("FACTDATA"), F.lit("facts"))
            .when(F.upper(name).rlike(r"^DT.*[.]TXT$"), F.concat(F.lit("DT"), F.lower(table))))


def discover_files(spark: SparkSession, base: str) -> dict:
    """List the fact files and code tables under ``base`` (any depth) by their fixed names:
    {"facts": [...], "DTagelvl": [...], ...}.  No file is opened; a row a file comes to the driver."""
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base).select("path")
              .withColumn("kind", file_kind(F.col("path"))).where("kind is not null").orderBy("path").collect())
    out: dict = {"facts": []}
    for r in listed:
        out.setdefault(r["kind"], []).append(r["path"])
    return out


def read_facts(spark: SparkSession, paths, encoding: str = LATIN1, segments=(1, 2, 3)) -> DataFrame:
    """History fact files: comma, latin-1, header, all text, period from the path."""
    df = read_delimited(spark, paths, ",", '"', encoding)
    return with_period(df, segments=segments)


def read_lookups(spark: SparkSession, paths, encoding: str = LATIN1, segments=(1, 2, 3)) -> DataFrame:
    """One code-table kind across all periods (S2): all text, period from the path, file order."""
    df = read_delimited(spark, paths, ",", '"', encoding, line_numbers=True)
    return with_period(df, segments=segments)


def read_pipe_files(spark: SparkSession, paths) -> DataFrame:
    """Alternate-release files: pipe separated, quoted, upper-case header, all text (S3)."""
    return read_delimited(spark, paths, "|", '"', header_map=lambda raw: [h.strip() for h in raw])


def read_status_table(spark: SparkSession, path, line_numbers: bool = True, with_source: bool = False) -> DataFrame:
    """Tab-separated status table with two DATECODEs (S4); numeric metrics typed, quotes stripped."""
    return read_delimited(spark, path, "\t", '"', header_map=lambda raw: [h.strip() for h in raw],
                          types=STATUS_TYPES, with_source=with_source, line_numbers=line_numbers)


def read_snapshots(spark: SparkSession, paths, view: str | None = None, with_source: bool = False,
                   schema=None) -> DataFrame:
    """Parquet snapshots of any era, merged by column name (S5, S6); optional temp view.

    With an explicit ``schema`` no footer is read to find one.

    ``with_source`` adds the ``source_file`` path of every row (lineage for manifests)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", "true")
    df = reader.parquet(*paths)
    if with_source:
        df = df.withColumn("source_file", F.col("_metadata.file_path"))
    if view:
        df.createOrReplaceTempView(view)
    return df
