"""Named queries over published stores, partial aggregates, indexes and malformed files, and the reports with many outputs.

As in ``catalog``: each takes (spark, sf_dir) and works on the whole tables.  Files and stores that a query reads are written by
Spark from the tables first; that part gives rows only, and none of the query's work.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodlens.functions.periods import period_sort_key
from periodlens.operators import compare as C
from periodlens.operators import partials as PA
from periodlens.operators import pivot as PV
from periodlens.operators import textindex as TI
from periodlens.operators import validity as V
from periodlens.plans import incremental as I
from periodlens.plans import reports as R
from periodlens.session import scratch_path
from periodlens.sources import files as S
from periodlens.sources import store as ST
from periodlens.sources.tables import snapshot_facts, table

# --- fixed values (query parameters) -----------------------------------------
CHANGED_YEAR, REFUSED_YEAR = 1997, 1996          # rewritten, and refused by its check
CHANGED_PERIOD = (1997, "March")
SKETCHED = ("agy", "agysub", "agysubt", "ppgrd")
SEARCH_TERM = "build"
# Every so many records of a written file are malformed, or hold line breaks.
WRAP_MOD, EXTRA_MOD, SHORT_MOD = 5, 97, 101
# Status tables: display name → (file column, fact column).
STATUS_VIEWS = {
    "age-level": (("AGELVLT", "agelvlt"),),
    "appointment-type": (("TOA", "toa"), ("TOAT", "toat")),
    "education-level": (("EDLVL", "edlvl"), ("EDLVLT", "edlvlt")),
    "duty-location": (("LOC", "loc"), ("STATET", "loct")),
    "pay-grade": (("PAYPLAN", "payplan"), ("GRD", "grd")),
    "agency-subagency": (("AGY", "agy"), ("AGYSUB", "agysub"), ("AGYSUBT", "agysubt")),
}
# ------------------------------------------------------------------------------


def _fresh(spark, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def _published(spark, d) -> str:
    """A store that got all periods (those of one year in part), then that year in full, then a write its check refused."""
    from periodlens.plans.catalog import _written

    def write():
        store = _fresh(spark, "published")
        f = snapshot_facts(spark, d)
        ST.publish(f.where(~((F.col("year") == CHANGED_YEAR) & (F.col("line_no") % 2 == 0))), store)
        PA.refresh(spark, store)                   # partials of the state that is about to change
        ST.publish(f.where(F.col("year") == CHANGED_YEAR), store)
        ST.publish(f.where((F.col("year") == REFUSED_YEAR) & (F.col("line_no") % 3 == 0)), store, verify=lambda back: False)
        PA.refresh(spark, store)                   # only the changed year is read again
        return store
    return _written(spark, ("published", d), write)


def published_store(spark, d):
    """Rows and head count of each period of the store's newest state, and how many states have the period."""
    store = _published(spark, d)
    now = ST.read_published(spark, store, schema=snapshot_facts(spark, d).schema).groupBy("year", "quarter").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("employment").try_cast("int")).alias("employees"))
    states = ST.history(spark, store).groupBy("year", "quarter").agg(
        F.count(F.lit(1)).alias("n_states"), F.countDistinct("version").alias("n_versions"))
    return now.join(states, ["year", "quarter"])


def trend_partials(spark, d):
    """A16 from partial aggregates."""
    return PV.period_trend(PA.read_partials(spark, _published(spark, d)), measure="emp_digits", policy="summed")


def group_trend_partials(spark, d):
    """A17 from partial aggregates."""
    return PV.period_trend(PA.read_partials(spark, _published(spark, d)), measure="emp_digits", policy="summed", extra_keys=("toa", "toat"))


def class_trend_partials(spark, d):
    """A18 from partial aggregates."""
    return PV.class_trend(PA.read_partials(spark, _published(spark, d)), measure="emp_digits", policy="summed")


def multi_period_partials(spark, d):
    """A12 from partial aggregates."""
    return PV.multi_period_sql(spark, PA.read_partials(spark, _published(spark, d)), view="employment_partials", measure="emp_int")


def subtotals(spark, d):
    """Head counts by year, appointment and age band with all subtotals from one aggregation."""
    return PV.subtotals(snapshot_facts(spark, d), ["year", "toa", "agelvlt"],
                        [("year", "toa", "agelvlt"), ("year", "toa"), ("year", "agelvlt"), ("year",), ()])


def _sketches(spark, d) -> DataFrame:
    from periodlens.plans.catalog import _written

    def write():
        path = _fresh(spark, "sketches")
        PA.period_sketches(snapshot_facts(spark, d), SKETCHED).write.parquet(path)
        return path
    return spark.read.parquet(_written(spark, ("sketches", d), write))


def distinct_periods(spark, d):
    """A9, A11 over sets of periods: distinct values a year and those gone in the next, estimated from the periods' sketches;
    beside them the exact numbers, and whether the estimates are within three standard errors."""
    per_year = PA.distinct_over(_sketches(spark, d), "year")
    after = per_year.select((F.col("year") - 1).cast("int").alias("year"), "field", "sketch")
    gone = PA.vanished(per_year, after, ["year", "field"])
    f = snapshot_facts(spark, d)
    values = f.select("year", F.inline(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("v")) for c in SKETCHED])))
    values = values.where("v is not null").distinct()
    nxt = values.select((F.col("year") - 1).cast("int").alias("year"), "field", "v", F.lit(True).alias("stays"))
    exact = (values.join(nxt, ["year", "field", "v"], "left").groupBy("year", "field")
             .agg(F.count(F.lit(1)).alias("n_exact"), F.count_if(F.col("stays").isNull()).alias("n_vanished_exact")))
    slack = F.col("n_exact") * PA.relative_error()
    return (exact.join(per_year.drop("sketch"), ["year", "field"]).join(gone, ["year", "field"])
            .select("year", "field", "n_exact", "n_vanished_exact",
                    ((F.abs(F.col("n_estimated") - F.col("n_exact")) <= slack)
                     & (F.abs(F.col("n_vanished") - F.col("n_vanished_exact")) <= slack)).alias("within_error")))


def _sorted_facts(spark, d) -> DataFrame:
    return snapshot_facts(spark, d).withColumn("sort_key", period_sort_key("year", "quarter"))


def code_intervals(spark, d):
    """J7 over time: the stretches of consecutive periods in which a code has one description."""
    f = _sorted_facts(spark, d)
    return V.intervals(V.first_texts(f, "toa", "toat", "sort_key", "line_no"), f.select(F.col("sort_key").alias("period")))


def code_names_as_of(spark, d):
    """J7, A20, P24 over time: every sub-agency's codes named at every period of the table, also where they do not occur."""
    f = _sorted_facts(spark, d)
    periods = f.select(F.col("sort_key").alias("period")).distinct()
    some = f.where(F.col("quarter").isin("March", "September"))         # descriptions are known for these only
    spans = V.intervals(V.first_texts(some, "toa", "toat", "sort_key", "line_no"), periods)
    rows = f.groupBy(F.col("toa").alias("code"), F.col("sort_key").alias("period")).agg(F.count(F.lit(1)).alias("n"))
    return V.as_of(rows, spans)


def indexed_search(spark, d):
    """P21 through the trigram index: the rows of the scan, from the files that can hold them."""
    from periodlens.plans.catalog import _written
    columns = table(spark, d, "customer").columns

    def write():
        base = _fresh(spark, "searched")
        table(spark, d, "customer").repartition(16, "c_mktsegment").write.parquet(f"{base}/rows")
        TI.build_index(spark, f"{base}/rows", f"{base}/index", columns)
        return base
    base = _written(spark, ("searched", d), write)
    hits = TI.search(spark, f"{base}/rows", f"{base}/index", SEARCH_TERM, columns)
    return hits.select("c_custkey", "c_name", "c_mktsegment")


# --- files with wrapped and malformed records --------------------------------------------------

def _part_files(spark, d) -> str:
    """Pipe files of the parts: every fifth type has line breaks, quotes and separators in it."""
    from periodlens.plans.catalog import _written

    def write():
        path = _fresh(spark, "wrapped")
        odd = F.concat(F.lit('two\nlines, "quoted" | and '), F.col("p_type"), F.lit("\n"))
        text = F.when(F.col("p_partkey") % WRAP_MOD == 0, odd).otherwise(F.col("p_type"))
        (table(spark, d, "part").select(F.col("p_partkey").alias("PART"), text.alias("TYPE"), F.col("p_brand").alias("BRAND"))
         .write.option("header", True).option("sep", "|").option("quoteAll", True).option("escape", '"')
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
        return path
    return _written(spark, ("wrapped", d), write)


def wrapped_records(spark, d):
    """S3: every cell of files whose cells hold line breaks."""
    df = S.sound(S.read_pipe_files(spark, _part_files(spark, d)))
    return df.select(F.col("PART").cast("bigint").alias("part"), F.col("TYPE").alias("type"), F.col("BRAND").alias("brand"))


def _bad_files(spark, d) -> tuple[str, str]:
    """Fact and code files as plain lines; some records have a cell too many, or too few."""
    from periodlens.plans.catalog import _written

    def write():
        base = _fresh(spark, "malformed")
        p = table(spark, d, "part").select("p_partkey", "p_brand")
        key = F.col("p_partkey")
        line = F.concat_ws(",", F.col("p_brand"), key.cast("string"), F.lit("1"))
        line = F.when(key % EXTRA_MOD == 0, F.concat(line, F.lit(",more"))).when(key % SHORT_MOD == 0, F.col("p_brand")).otherwise(line)
        for name, cells in (("facts", line), ("codes", F.substring_index(line, ",", 2))):
            header = "AGYSUB,LOC,EMPLOYMENT" if name == "facts" else "LOC,LOCT"
            lines = p.select(cells.alias("value"))
            # each file begins with its header: one file a partition
            for part, rows in enumerate(lines.randomSplit([0.5, 0.5], 1)):
                head = spark.range(1).select(F.lit(header).alias("value"), F.lit(0).alias("o"))
                (head.unionByName(rows.withColumn("o", F.lit(1))).repartition(1).sortWithinPartitions("o").select("value")
                 .write.text(f"{base}/{name}/March_1997/part={part}"))
        return base
    base = _written(spark, ("malformed", d), write)
    return f"{base}/facts/March_1997/*", f"{base}/codes/March_1997/*"


def bad_records(spark, d):
    """Records and malformed records of fact files and code tables."""
    facts, codes = _bad_files(spark, d)
    return (R.bad_record_report(spark, [facts], {"codes": [codes]}).groupBy("kind")
            .agg(F.sum("records").alias("records"), F.sum("bad_records").alias("bad_records")))


def incremental_build(spark, d):
    """A second build after the files of one period changed; that period alone is built again."""
    from periodlens.plans.catalog import _written

    def write():
        base, store = _fresh(spark, "release"), _fresh(spark, "release-store")
        f = snapshot_facts(spark, d).select(
            F.concat_ws("_", "quarter", F.col("year").cast("string")).alias("period"), "year", "quarter", "line_no",
            F.concat_ws(",", "agysub", "loc", "employment").alias("value"))
        pick = (F.col("year") == CHANGED_PERIOD[0]) & (F.col("quarter") == CHANGED_PERIOD[1])

        def lines(rows: DataFrame) -> None:
            """A file with a header for each period."""
            head = rows.select("period").distinct().withColumns({"value": F.lit("AGYSUB,LOC,EMPLOYMENT"), "o": F.lit(0)})
            (head.unionByName(rows.select("period", "value").withColumn("o", F.lit(1)))
             .repartition("period").sortWithinPartitions("period", "o").select("period", "value")
             .write.mode("append").partitionBy("period").text(base))
        lines(f.where(~(pick & (F.col("line_no") % 2 == 0))))
        build = lambda: I.build(spark, base, store, segments=(2,), encoding="UTF-8", kind_of=lambda path: F.lit("facts"))
        build()
        lines(f.where(pick & (F.col("line_no") % 2 == 0)))
        path = _fresh(spark, "release-report")
        build().write.parquet(path)
        return path
    return spark.read.parquet(_written(spark, ("release", d), write))


# --- reports with several outputs ----------------------------------------------------------------

def examples_battery(spark, d):
    """All usage examples as one table."""
    f = snapshot_facts(spark, d)
    return R.battery_rows(R.examples_battery(f, F.col("year") == 1996, F.col("year") == 1997))


def validation_run(spark, d):
    """All nine outputs of a validation run as one table."""
    return R.validation_rows(R.validation_run(snapshot_facts(spark, d)))


def _agency(spark, d):
    from periodlens.plans.catalog import TREND_AGYSUB
    return R.agency_trend(snapshot_facts(spark, d), TREND_AGYSUB)


def agency_appointments(spark, d):
    """One sub-agency's appointment mix per period."""
    return _agency(spark, d)[1]


def agency_classes(spark, d):
    """The appointment class of each of its codes."""
    return _agency(spark, d)[2]


def agency_split(spark, d):
    """Its nonpermanent head count per period."""
    return _agency(spark, d)[3]


def excluded_agencies(spark, d):
    """Labels of the agencies that the age comparison leaves out."""
    f = snapshot_facts(spark, d, [1996, 1997])
    return R.age_comparison_excluding(f, F.col("year") == 1996, F.col("year") == 1997)[1]


def compare_left_full(spark, d):
    """J3 with prior-only rows kept: age bands in the one and appointment codes in the other period never meet."""
    from periodlens.plans.catalog import STATUS_CURRENT, STATUS_PRIOR
    f = snapshot_facts(spark, d).where(F.col("datecode").isin(STATUS_CURRENT, STATUS_PRIOR))
    label = F.when((F.col("datecode") == STATUS_PRIOR) & (F.col("toa") == "P"), F.lit("ended")).otherwise(F.col("toa"))
    status = f.groupBy("datecode", label.alias("toa")).agg(F.count(F.lit(1)).alias("EMPCOUNT"))
    out = C.compare_left(status, "datecode", STATUS_CURRENT, STATUS_PRIOR, metrics=("EMPCOUNT",), how="full")
    return out.select("toa", "prior_count", "current_count", "change", F.round("pct_change", 4).alias("pct_change"), "rank")


def alternate_checks(spark, d):
    """R2's checks: largest agencies, fields that are mostly redacted, row count in its range."""
    from periodlens.plans.catalog import _written, _status_period, STATUS_CURRENT, MONTH_QUARTERS
    names = {"agy": "AGY", "agysub": "AGYSUB", "agysubt": "AGYSUBT", "loc": "LOC", "loct": "STATET", "employment": "COUNT", "salary": "SALARY"}

    def write():
        path = _fresh(spark, "pipe-checks")
        f = _status_period(snapshot_facts(spark, d), STATUS_CURRENT)
        # a field that is redacted but for one row in twenty
        f = f.withColumn("loct", F.when(F.col("line_no") % 20 == 0, F.col("loct")).otherwise(F.lit("REDACTED")))
        f.select(*[F.col(c).alias(n) for c, n in names.items()]).write.option("header", True).option("sep", "|").csv(path)
        return path
    snap, _, _ = R.build_alternate(spark, [_written(spark, ("pipe-checks", d), write)], int(STATUS_CURRENT[:4]),
                                   MONTH_QUARTERS[STATUS_CURRENT[4:]])
    checks = R.alternate_checks(snap)
    return reduce_union([
        checks["top_agencies"].select(F.lit("top_agencies").alias("check"), F.col("agysubt").alias("item"), F.col("headcount").cast("double").alias("value")),
        checks["high_redaction"].select(F.lit("high_redaction").alias("check"), F.col("column_name").alias("item"), F.col("redacted_pct").alias("value")),
        checks["row_range"].select(F.lit("row_range").alias("check"), F.when(F.col("in_range"), "in range").otherwise("out of range").alias("item"),
                                   F.col("rows").cast("double").alias("value"))])


def reduce_union(frames) -> DataFrame:
    from functools import reduce
    return reduce(DataFrame.unionByName, frames)


def status_views(spark, d):
    """Six status tables written as files, read, matched to the prior period, cut to their display columns."""
    from periodlens.plans.catalog import MONTH_QUARTERS, STATUS_CURRENT, STATUS_PRIOR, _written
    from periodlens.functions.values import count_sum, safe_int
    v = safe_int("salary")
    out = []
    for name, columns in STATUS_VIEWS.items():
        def write(columns=columns):
            path = _fresh(spark, "status-view")
            f = snapshot_facts(spark, d).where(F.col("datecode").isin(STATUS_CURRENT, STATUS_PRIOR))
            keys = [F.col(c).alias(n) for n, c in columns]
            (f.groupBy(F.col("datecode").alias("DATECODE"), *keys)
             .agg(count_sum("employment", "skip").alias("EMPCOUNT"), F.floor(F.sum(v) / F.count(v)).cast("bigint").alias("AVGSAL"))
             .write.option("header", True).option("sep", "\t").csv(path))
            return path
        path = _written(spark, ("status-view", name, d), write)
        view = R.status_table_view(spark, path, name, STATUS_CURRENT, STATUS_PRIOR, "current", "prior")
        shown = [c for c in view.columns if c not in ("prior", "current", "Change", "% Change", "rank")]
        out.append(view.select(F.lit(name).alias("view"), F.concat_ws(" | ", *[F.col(f"`{c}`") for c in shown]).alias("label"),
                               "prior", "current", F.col("Change").alias("change"), F.round("`% Change`", 4).alias("pct_change"), "rank"))
    return reduce_union(out)


HISTORY_QUERIES = {f.__name__: f for f in (
    published_store, trend_partials, group_trend_partials, class_trend_partials, multi_period_partials, subtotals, distinct_periods, code_intervals,
    code_names_as_of, indexed_search, wrapped_records, bad_records, incremental_build, examples_battery, validation_run, agency_appointments,
    agency_classes, agency_split, excluded_agencies, compare_left_full, alternate_checks, status_views)}
