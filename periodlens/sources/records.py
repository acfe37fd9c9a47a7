"""True records of delimited files that Spark reads in splits.

A quoted cell may hold line breaks, so a line of a file need not be a record.  Whether a line begins inside a quoted cell
depends on all lines before it, and a task sees only its split.  But each line (and so each split) maps the
state before it (outside or inside a quoted cell) to the state after it, whatever came before; maps compose, so the
true state of every split follows from one row a split.

``survey`` reads all files in one job: their header lines, and whether any line leaves a quoted cell open.  If none does,
every line is a record, and the plain CSV scan of Spark is right.  ``assembled`` builds the records of the other files: lines get
their state by windows over their split, splits by a window over their file, and the lines of a wrapped record are joined.
A file is never read by one task.

A line break inside a cell becomes ``\\n``.  A quoted cell that is not closed up to the end of its file ends with its
line: the line is a bad record, and those after it are records of their own.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CORRUPT = "corrupt_record"
OUTSIDE, INSIDE = 0, 1


def complete_pattern(sep: str = ",", quote: str = '"') -> str:
    """Pattern of a text that is a whole number of cells: no quoted cell is left open.

    A cell that begins with the quote ends at a single quote (two stand for one) and what follows up to the separator.
    """
    s, q = re.escape(sep), re.escape(quote)
    quoted = f"{q}[^{q}]*+(?:{q}{q}[^{q}]*+)*+{q}(?!{q})[^{s}]*+"
    plain = f"[^{q}{s}][^{s}]*+"
    return f"(?s)^(?:{quoted}|{plain}|)(?:{s}(?:{quoted}|{plain}|))*+\\z"


def scan_lines(spark: SparkSession, paths, sep: str, quote: str, encoding: str) -> DataFrame:
    """Lines of the files: source_file, source_size, block (begin of the split), line (rising within a split), text, and the
    state after the line if it begins outside (from_outside) or inside (from_inside) a quoted cell."""
    raw = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_size").alias("source_size"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"),
        F.decode(F.col("value").cast("binary"), encoding).alias("text"))
    whole, quoted = complete_pattern(sep, quote), F.contains("text", F.lit(quote))
    after = lambda text: F.when(text.rlike(whole), OUTSIDE).otherwise(INSIDE)
    return raw.withColumns({
        "from_outside": F.when(quoted, after(F.col("text"))).otherwise(OUTSIDE),
        # beginning inside is as if the line began with the quote
        "from_inside": F.when(quoted, after(F.concat(F.lit(quote), "text"))).otherwise(INSIDE)})


def survey(spark: SparkSession, paths, sep: str = ",", quote: str = '"', encoding: str = "UTF-8") -> list:
    """A row for each file that has a line: source_file, header (its first line), n_lines, n_open (lines after the header
    that would leave a quoted cell open).  One job for all files; only these rows come to the driver."""
    lines = scan_lines(spark, paths, sep, quote, encoding)
    first = F.expr("min_by(text, line) filter (where block = 0)")
    opens = F.col("from_outside") == INSIDE
    return (lines.groupBy("source_file")
            .agg(first.alias("header"), F.count("*").alias("n_lines"),
                 # the header is one line, whatever its quotes
                 (F.count_if(opens) - F.expr(f"if(min_by(from_outside, line) filter (where block = 0) = {INSIDE}, 1, 0)")).alias("n_open"))
            .orderBy("source_file").collect())


def _before(a: str, b: str, parts: list[str], order: str) -> tuple[Column, Column]:
    """The state before each row if it is outside, or inside, before the first of its part.

    ``a`` and ``b`` are the states after a row that begins outside or inside.  After a row that maps both to one
    state, only the rows that swap the states since then count.
    """
    w = Window.partitionBy(*parts).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    swap = F.when((F.col(a) == INSIDE) & (F.col(b) == OUTSIDE), 1).otherwise(0)
    fixed = F.when(F.col(a) == F.col(b), F.col(a))
    swaps = F.coalesce(F.sum(swap).over(w), F.lit(0))
    # a fixed state together with the parity of the swaps before it
    known = F.last((fixed + F.col("__swaps")) % 2, ignorenulls=True).over(w)
    return swaps, known


def with_state(rows: DataFrame, a: str, b: str, parts: list[str], order: str) -> DataFrame:
    """Add ``if_outside`` and ``if_inside``: the state before each row for both states before its part."""
    swaps, known = _before(a, b, parts, order)
    rows = rows.withColumn("__swaps", swaps).withColumn("__known", known)
    return rows.withColumns({name: ((F.coalesce("__known", F.lit(start)) + F.col("__swaps")) % 2).cast("int")
                             for name, start in (("if_outside", OUTSIDE), ("if_inside", INSIDE))}).drop("__swaps", "__known")


def _after(state: str) -> Column:
    return F.when(F.col(state) == OUTSIDE, F.col("from_outside")).otherwise(F.col("from_inside"))


def assembled(spark: SparkSession, paths, sep: str = ",", quote: str = '"', encoding: str = "UTF-8") -> DataFrame:
    """Records of the files without their header lines: source_file, source_size, block, line (of the record's first
    line), text, open (a quoted cell is not closed).  Lines without any character but blanks are no records, as in Spark's CSV scan."""
    split = ["source_file", "block"]
    lines = scan_lines(spark, paths, sep, quote, encoding)
    in_split = Window.partitionBy(*split).orderBy("line")
    # the header ends outside, whatever it holds
    header = (F.col("block") == 0) & (F.row_number().over(in_split) == 1)
    lines = lines.withColumn("header", header)
    lines = lines.withColumns({c: F.when(F.col("header"), OUTSIDE).otherwise(F.col(c)) for c in ("from_outside", "from_inside")})
    lines = with_state(lines, "from_outside", "from_inside", split, "line")
    begun = in_split.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lines = lines.withColumns({f"n_{s}": F.sum(F.when(F.col(s) == OUTSIDE, 1).otherwise(0)).over(begun)
                               for s in ("if_outside", "if_inside")})
    # a row a split: both end states, and how many records begin in it
    splits = lines.groupBy(*split).agg(
        F.max_by(_after("if_outside"), "line").alias("from_outside"), F.max_by(_after("if_inside"), "line").alias("from_inside"),
        F.max("n_if_outside").alias("n_if_outside"), F.max("n_if_inside").alias("n_if_inside"))
    splits = with_state(splits, "from_outside", "from_inside", ["source_file"], "block").withColumnRenamed("if_outside", "state")
    in_file = Window.partitionBy("source_file").orderBy("block")
    n = F.when(F.col("state") == OUTSIDE, F.col("n_if_outside")).otherwise(F.col("n_if_inside"))
    splits = (splits.withColumn("end", _after("state")).withColumn("n", n)
              .withColumn("earlier", F.sum("n").over(in_file) - F.col("n"))
              .withColumn("file_end", F.last("end").over(in_file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
              .withColumn("n_records", F.sum("n").over(Window.partitionBy("source_file"))))
    splits = splits.select(*[F.col(c).alias(f"s_{c}") for c in split], F.col("state").alias("split_state"), "earlier", "file_end", "n_records")
    lines = lines.join(splits, (F.col("source_file") == F.col("s_source_file")) & (F.col("block") == F.col("s_block")))
    pick = lambda name: F.when(F.col("split_state") == OUTSIDE, F.col(f"{name}_outside")).otherwise(F.col(f"{name}_inside"))
    lines = (lines.withColumn("state", pick("if")).withColumn("record", F.col("earlier") + pick("n_if"))
             .where("not header"))
    # the rest of a file whose last quoted cell is never closed: each line by itself
    loose = (F.col("file_end") == INSIDE) & (F.col("record") == F.col("n_records"))
    single = loose | ((F.col("state") == OUTSIDE) & (F.col("from_outside") == OUTSIDE))
    lines = lines.withColumn("single", single)
    alone = lines.where("single").select("source_file", "source_size", "block", "line", "text",
                                         (F.col("from_outside") == INSIDE).alias("open"))
    parts = F.sort_array(F.collect_list(F.struct("block", "line", "text")))
    wrapped = (lines.where("not single").groupBy("source_file", "source_size", "record").agg(parts.alias("parts"))
               .select("source_file", "source_size", F.col("parts")[0]["block"].alias("block"), F.col("parts")[0]["line"].alias("line"),
                       F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text"), F.lit(False).alias("open")))
    return alone.unionByName(wrapped).where(F.col("text").rlike(r"[^\x00-\x20]"))


def parsed(records: DataFrame, schema, sep: str = ",", quote: str = '"') -> DataFrame:
    """The records' cells by ``schema`` (which has ``corrupt_record``), before them source_file, source_size, block and line.

    A record with a wrong number of cells, a cell of another type or an open quoted cell has its text in ``corrupt_record``.
    """
    options = {"sep": sep, "quote": quote, "escape": quote, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT,
               "maxCharsPerColumn": "-1"}
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    cells = F.from_csv("text", ddl, options)
    out = records.select("source_file", "source_size", "block", "line", "text", "open", cells.alias("cells"))
    names = [f.name for f in schema.fields if f.name != CORRUPT]
    return out.select("source_file", "source_size", "block", "line", *[F.col("cells").getField(n).alias(n) for n in names],
                      F.when(F.col("open"), F.col("text")).otherwise(F.col("cells").getField(CORRUPT)).alias(CORRUPT))
