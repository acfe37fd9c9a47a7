"""A trigram index of text tables, for searches that read few files.

The index lists which file holds which three successive characters in a row's text (lower-cased): a row for each trigram and file,
written beside the table and partitioned by a hash of the trigram.  A search reads the index rows of its term's trigrams, keeps the files that
have all of them, and reads only those files; the exact ``contains`` is then asked of every row.  So the result is that
of a scan, whatever the index says too much.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from periodlens.functions.text import row_contains

BUCKETS = 64


def trigrams(text: Column) -> Column:
    """The distinct runs of three characters of a text; none if it is shorter."""
    at = F.sequence(F.lit(1), F.char_length(text) - 2)
    return F.when(F.char_length(text) >= 3, F.array_distinct(F.transform(at, lambda i: F.substring(text, i, F.lit(3))))).otherwise(
        F.array().cast("array<string>"))


def _row_text(columns) -> Column:
    """The text that ``row_contains`` searches."""
    return F.lower(F.concat_ws(" ", *[F.col(f"`{c}`").cast("string") for c in columns]))


def build_index(spark: SparkSession, table: str, index: str, columns, buckets: int = BUCKETS) -> None:
    """Index the text columns of the parquet files under ``table`` into ``index``."""
    rows = spark.read.parquet(table)
    found = (rows.select(F.col("_metadata.file_path").alias("file"), F.explode(trigrams(_row_text(columns))).alias("gram")).distinct()
             .withColumn("bucket", F.pmod(F.xxhash64("gram"), F.lit(buckets)).cast("int")))
    found.repartition("bucket").write.partitionBy("bucket").parquet(index)


def candidate_files(spark: SparkSession, index: str, term: str, buckets: int = BUCKETS) -> list[str] | None:
    """Files that hold every trigram of the term; None if the term is too short to tell.  A row a file comes to the driver."""
    term = term.lower()
    grams = sorted({term[i:i + 3] for i in range(len(term) - 2)})
    if not grams:
        return None
    asked = spark.range(1).select(F.explode(F.array(*map(F.lit, grams))).alias("g")).select(
        F.collect_set(F.pmod(F.xxhash64("g"), F.lit(buckets)).cast("int"))).first()[0]
    hits = spark.read.parquet(index).where(F.col("bucket").isin(asked) & F.col("gram").isin(grams))
    full = hits.groupBy("file").agg(F.countDistinct("gram").alias("n")).where(F.col("n") == len(grams))
    return sorted(unquote(r["file"]) for r in full.collect())


def search(spark: SparkSession, table: str, index: str, term: str, columns, buckets: int = BUCKETS) -> DataFrame:
    """Rows whose indexed columns, joined by blanks, contain the term, upper and lower case alike (as ``row_contains``)."""
    files = candidate_files(spark, index, term, buckets)
    schema = spark.read.parquet(table).schema
    if files is not None and not files:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*(files if files is not None else [table]))
    return rows.where(row_contains([F.col(f"`{c}`") for c in columns], term))
