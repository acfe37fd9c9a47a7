"""Named queries over the driver tables — one per operator of the inventory.

Each entry takes (spark, sf_dir) and returns a lazy DataFrame over the *whole* tables.
Ordering queries carry their display position as a ``rank`` column, because result
comparison ignores row order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodlens.functions import periods as P
from periodlens.functions import text as T
from periodlens.functions.common import string_columns
from periodlens.functions.values import count_sum, safe_int
from periodlens.operators import compare as C
from periodlens.operators import conform as CF
from periodlens.operators import order as O
from periodlens.operators import pivot as PV
from periodlens.operators import profile as PR
from periodlens.operators import quality as Q
from periodlens.operators.denorm import Dim, denormalize
from periodlens.operators.joins import aggregate_kept_groups, enrich_coalesce, keep_groups
from periodlens.operators.position import down
from periodlens.sources.tables import snapshot_facts, table

# --- fixed values (query parameters) -----------------------------------------
BEFORE, AFTER = 1996, 1997
TRANSITIONS = (("t1996_1997", 1996, 1997), ("t1997_1998", 1997, 1998), ("t1998_1999", 1998, 1999))
STATUS_CURRENT, STATUS_PRIOR = "199703", "199612"
MONTH_QUARTERS = {"03": "March", "06": "June", "09": "September", "12": "December"}
FLAG_MEMBERS = ("1", "2", "3")
KNOWN_FIRST = ("NATION_3", "NATION_1")
SEARCH_TERM = "build"
ROW_RANGE = (500, 600)
ERA_FIELDS, ERA_START = ("salary", "agelvlt"), 1997
COVERAGE_DIMS = (("loc", "loct"), ("agelvl", "agelvlt"), ("toa", "toat"), ("occ", "occt"))
QUALITY_FIELDS = Q.LOOKUP_FIELDS + ("salary",)
TREND_AGYSUB = "MA07"
PREFERRED_YEAR = 1997
UNION_TABLES = ("customer", "supplier")
HIGH_REDACTION_PCT = 5.0
ABSENT_LOOKUP_YEAR = 1995
# ------------------------------------------------------------------------------


def _facts(spark, d, years=None) -> DataFrame:
    return snapshot_facts(spark, d, years)


def _ba():
    return F.col("year") == BEFORE, F.col("year") == AFTER


def _r4(df: DataFrame, cols=("pct_change",)) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in cols})


def _status(spark, d, codes=None) -> DataFrame:
    """A status summary table (one row per period × age label) derived from the facts.

    ``codes`` restricts it to some date codes, as (year, quarter) so that other periods' files stay shut.
    """
    f = _facts(spark, d)
    if codes is not None:
        pick = F.lit(False)
        for code in codes:
            pick = pick | ((F.col("year") == int(code[:4])) & (F.col("quarter") == MONTH_QUARTERS[code[4:]]))
        f = f.where(pick)
    v = safe_int("salary")
    return (f.where(F.col("agelvlt").isNotNull()).groupBy("datecode", "agelvlt")
            .agg(count_sum("employment", "skip").alias("EMPCOUNT"),
                 F.floor(F.sum(v) / F.count(v)).cast("bigint").alias("AVGSAL")))


# --- profiles -------------------------------------------------------------------

def headcount_top(spark, d):
    return PR.headcount_top(_facts(spark, d), "loct", 10)


def mean_by_group(spark, d):
    return PR.mean_by_group(_facts(spark, d), "edlvlt", "salary", 5)


def freq_share(spark, d):
    return PR.frequency_share(_facts(spark, d), "agelvlt")


def numeric_summary(spark, d):
    return PR.numeric_summary(_facts(spark, d), "salary")


def count_policies(spark, d):
    f = _facts(spark, d)
    v = safe_int("salary")
    return f.groupBy("dataset_key").agg(
        count_sum("employment", "skip").alias("emp_skip"),
        count_sum("employment", "impute_one").alias("emp_impute_one"),
        count_sum("employment", "digits_else_zero").alias("emp_digits_zero"),
        count_sum("employment", "coerce_zero").alias("emp_coerce_zero"),
        F.coalesce(F.sum(v), F.lit(0)).cast("bigint").alias("salary_sum"),
        F.count(v).alias("salary_valid"))


def headcount_period(spark, d):
    return PR.headcount_by(_facts(spark, d), ["year", "quarter"])


def distinct_count(spark, d):
    return PR.distinct_count(_facts(spark, d), "agysub")


def snapshot_profile(spark, d):
    return PR.snapshot_profile(_facts(spark, d))


def redaction_profile(spark, d):
    b, a = _ba()
    return PR.redaction_profile(_facts(spark, d, [BEFORE, AFTER]), b, a)


def redaction_overview(spark, d):
    return PR.redaction_overview(_facts(spark, d, [AFTER]))


def cell_redaction(spark, d):
    return PR.cell_redaction(_facts(spark, d))


def first_non_null(spark, d):
    return PR.first_non_null(_facts(spark, d), "agy", "agysubt")


def distinct_rows(spark, d):
    return _facts(spark, d).select("toa", "toat").distinct()


def dedupe_first(spark, d):
    return PR.keep_first(table(spark, d, "part"), "p_name", "p_partkey")


def duplicate_report(spark, d):
    return PR.duplicate_report(table(spark, d, "part"), "p_name", "p_partkey")


# --- scalar expressions ------------------------------------------------------

def clean_prefix(spark, d):
    f = _facts(spark, d)
    entries = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("raw"),
                                 T.clean_category(c, c).alias("cleaned"))
                        for c in ("edlvlt", "toat", "agysubt")])
    return (f.select(F.inline(entries)).groupBy("field", "raw", "cleaned")
            .agg(F.count(F.lit(1)).alias("n")))


def zero_pad(spark, d):
    return (_facts(spark, d).groupBy("loc")
            .agg(F.count(F.lit(1)).alias("n")).withColumn("loc_padded", T.zero_pad("loc")))


def grade_parse(spark, d):
    p = table(spark, d, "part")
    return (p.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))
            .select("p_brand", T.pay_plan("p_brand").alias("pay_plan"), T.pay_grade("p_brand").alias("grade"),
                    T.plan_grade("p_brand").alias("plan_grade"), "n"))


def class_rules(spark, d):
    return (_facts(spark, d).groupBy("toat").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("appt_class", T.appointment_class("toat")))


def trim_strings(spark, d):
    # every cell gets blanks, a no-break space and a tab around it first
    p = table(spark, d, "part")
    padded = {c: F.concat(F.lit(" \u00a0"), F.col(c), F.lit("\t ")) for c in ("p_name", "p_brand", "p_type")}
    return p.withColumns(padded).select("p_partkey", *[T.trim_all(c).alias(c) for c in padded])


def compose_key(spark, d):
    f = _facts(spark, d)
    return (f.groupBy(T.compose_key("payplan", "grd").alias("category"))
            .agg(count_sum("employment", "skip").alias("headcount")))


def pct_change(spark, d):
    b, a = _ba()
    return _r4(C.compare_full(_facts(spark, d, [BEFORE, AFTER]), "loct", b, a, policy="skip"))


def period_label(spark, d):
    f = _facts(spark, d)
    return (f.groupBy("dataset_key", "year", "quarter").agg(F.count(F.lit(1)).alias("rows"))
            .select("dataset_key", P.period_label("quarter", "year").alias("label"),
                    P.period_sort_key("year", "quarter").alias("sort_key"), "rows"))


def member_filter(spark, d):
    f = _facts(spark, d)
    return (f.where(F.col("agy").isin(*FLAG_MEMBERS) & (F.col("quarter") == "September"))
            .groupBy("dataset_key", "agy").agg(F.count(F.lit(1)).alias("rows")))


def row_flag(spark, d):
    f = _facts(spark, d)
    flag = T.row_has_value(string_columns(f))
    return f.groupBy("dataset_key").agg(F.count_if(flag).alias("flagged_rows"),
                                        F.count(F.lit(1)).alias("rows"))


def code_label(spark, d):
    return (_facts(spark, d).groupBy("loc", "loct").agg(F.count(F.lit(1)).alias("n"))
            .select("loc", T.code_label("loc", "loct").alias("label"), "n"))


def agency_names(spark, d):
    first = PR.first_non_null(_facts(spark, d), "agy", "agysubt")
    return first.select("agy", "first_agysubt",
                        T.agency_display_name("agy", "first_agysubt").alias("main_name"),
                        T.agency_label("agy", "first_agysubt").alias("label"))


def search_rows(spark, d):
    c = table(spark, d, "customer")
    return c.where(T.row_contains(c.columns, SEARCH_TERM)).select("c_custkey", "c_name", "c_mktsegment")


# --- joins / comparisons -----------------------------------------------------------

def denormalize_q(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    dims = [
        Dim("orders", table(spark, d, "orders"), ("l_orderkey",), ("o_orderkey",),
            ("o_custkey", "o_orderpriority"), unique=True),
        Dim("part", table(spark, d, "part"), ("l_partkey",), ("p_partkey",), ("p_brand", "p_type"), unique=True),
        Dim("supplier", table(spark, d, "supplier"), ("l_suppkey",), ("s_suppkey",),
            ("s_name", "s_nationkey"), unique=True),
        Dim("nation", table(spark, d, "nation"), ("s_nationkey",), ("n_nationkey",),
            ("n_name", "n_regionkey"), unique=True),
        Dim("region", table(spark, d, "region"), ("n_regionkey",), ("r_regionkey",), ("r_name",), unique=True),
    ]
    out = denormalize(li, dims)
    return out.select("l_orderkey", "l_linenumber", "l_quantity", "o_custkey", "o_orderpriority",
                      "p_brand", "p_type", "s_name", "s_nationkey", "n_name", "n_regionkey", "r_name")


def denormalize_periods(spark, d):
    """J1 with lookups per period: repeated codes (the first line wins), padded codes, an absent period."""
    f = _facts(spark, d)
    per = (f.where((F.col("year") != ABSENT_LOOKUP_YEAR) & F.col("toa").isNotNull()).groupBy("dataset_key", "toa")
           .agg(F.min("line_no").alias("lo"), F.max("line_no").alias("hi")))
    lookup = per.select("dataset_key", F.inline(F.array(
        F.struct(F.concat(F.lit(" "), F.col("toa"), F.lit(" ")).alias("code"),
                 F.concat(F.lit("first "), F.col("toa")).alias("text"), F.col("lo").alias("line")),
        F.struct(F.col("toa").alias("code"), F.concat(F.lit("later "), F.col("toa")).alias("text"),
                 (F.col("hi") + 1).alias("line")))))
    dim = Dim("lookup", lookup, ("dataset_key", "toa"), ("dataset_key", "code"), ("text",), order="line")
    out = denormalize(f.select("dataset_key", "toa", "line_no"), [dim])
    return out.groupBy("dataset_key", "toa", "text").agg(F.count(F.lit(1)).alias("n"))


def compare_full(spark, d):
    b, a = _ba()
    return _r4(C.compare_full(_facts(spark, d, [BEFORE, AFTER]), "agelvlt", b, a, policy="coerce_zero"))


def compare_left(spark, d):
    out = C.compare_left(_status(spark, d, (STATUS_CURRENT, STATUS_PRIOR)), "datecode", STATUS_CURRENT, STATUS_PRIOR,
                         metrics=("EMPCOUNT", "AVGSAL"), count_metric="EMPCOUNT")
    return _r4(out)


def compare_total(spark, d):
    b, a = _ba()
    return _r4(C.comparison_table(_facts(spark, d, [BEFORE, AFTER]), "agelvlt", b, a,
                                  policy="impute_one", order="specials_last"))


def name_map(spark, d):
    b, a = _ba()
    return C.name_map(_facts(spark, d, [BEFORE, AFTER]), "agelvl", "agelvlt", b, a)


def flagged_groups(spark, d):
    g = C.flagged_groups(_facts(spark, d), "agy", "agelvlt")
    return O.rank_codes(g, ["agy"], "rank")


def exclude_groups_q(spark, d):
    b, a = _ba()
    f = _facts(spark, d, [BEFORE, AFTER])
    return _r4(C.comparison_table(f, "agelvlt", b, a, policy="impute_one", order="domain",
                                  domain=O.AGE_ORDER, exclude=("agy", "agelvlt")))


def keep_groups_q(spark, d):
    red = F.col("agelvlt") == "REDACTED"
    return aggregate_kept_groups(_facts(spark, d), "agy", red, "year",
                                 [F.count(F.lit(1)).alias("rows"), F.count_if(red).alias("redacted_age")])


def availability(spark, d):
    b, a = _ba()
    return _r4(C.availability(_facts(spark, d, [BEFORE, AFTER]), "salary", b, a))


def enrich_coalesce_q(spark, d):
    f = _facts(spark, d)
    desc = f.select("toa", F.col("toat").alias("toat_full"))
    per = f.groupBy("dataset_key", "toa", "toat").agg(F.count(F.lit(1)).alias("n"))
    out = enrich_coalesce(per, desc, "toa", "toat_full", "toat_display", "toat")
    return out.select("dataset_key", "toa", "toat_display", "n")


# --- pivots / trends -------------------------------------------------------------

def multi_period_sql(spark, d):
    return PV.multi_period_sql(spark, _facts(spark, d), view="employment", group="agysubt")


def pivot_year(spark, d):
    f = _facts(spark, d)
    years = [r["year"] for r in f.select("year").where("year is not null").distinct().collect()]   # a row a year
    return PV.pivot_years(f, "loct", years, 10)


def pivot_multi(spark, d):
    years = sorted({y for _, b, a in TRANSITIONS for y in (b, a)})
    return PV.transition_matrix(_facts(spark, d, years), "agelvlt", TRANSITIONS)


def top_split(spark, d):
    years = sorted({b for _, b, _ in TRANSITIONS})
    f = _facts(spark, d, years).withColumn("category", T.compose_key("payplan", "grd"))
    return PV.top_split(f, "category", TRANSITIONS, 50)


def trend(spark, d):
    return PV.period_trend(_facts(spark, d))


def group_trend(spark, d):
    return PV.period_trend(_facts(spark, d), extra_keys=("toa", "toat"))


def class_trend(spark, d):
    return PV.class_trend(_facts(spark, d))


def period_totals(spark, d):
    years = sorted({y for _, b, a in TRANSITIONS for y in (b, a)})
    return _r4(PV.period_totals(_facts(spark, d, years), TRANSITIONS))


# --- quality -------------------------------------------------------------------------

def required_columns(spark, d):
    return Q.required_columns(_facts(spark, d))


def constant_measure(spark, d):
    return Q.constant_measure(_facts(spark, d))


def null_rates(spark, d):
    return Q.null_rates(_facts(spark, d), fields=QUALITY_FIELDS)


def merge_failure(spark, d):
    return Q.merge_failures(_facts(spark, d), fields=QUALITY_FIELDS)


def era_rule(spark, d):
    return Q.era_rule(_facts(spark, d), fields=ERA_FIELDS, start_year=ERA_START)


def calendar_gaps(spark, d):
    return Q.calendar_gaps(_facts(spark, d))


def row_range(spark, d):
    return Q.row_range(_facts(spark, d), lo=ROW_RANGE[0], hi=ROW_RANGE[1])


def verdict(spark, d):
    return Q.verdict(_facts(spark, d), fields=QUALITY_FIELDS)


def dim_coverage(spark, d):
    return Q.dim_coverage(_facts(spark, d), COVERAGE_DIMS)


def pair_order(spark, d):
    status = _status(spark, d, (STATUS_CURRENT, STATUS_PRIOR))
    return Q.pair_order(status, "datecode", STATUS_PRIOR, STATUS_CURRENT, ["agelvlt"], [down("EMPCOUNT"), "agelvlt"])


# --- conform / set ops / ordering -------------------------------------------------------

def conform_q(spark, d):
    o = table(spark, d, "orders")
    renamed = CF.rename_columns(o, {"o_orderkey": "order_id", "o_custkey": "customer_id",
                                    "o_orderstatus": "status", "o_orderpriority": "priority"})
    return CF.conform(renamed, ["order_id", "customer_id", "status", "priority", "clerk", "comment"],
                      fill="", types={"order_id": "string", "customer_id": "string"})


def union_by_name_q(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), "c_mktsegment")
    b = table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), "s_acctbal")
    return CF.union_by_name([a, b])


def alias_columns(spark, d):
    f = _facts(spark, d).select(F.col("toa").alias("worksch"), F.col("toat").alias("workscht"))
    f = CF.add_aliases(f)
    return f.groupBy("worksch", "wrksch", "wrkscht").agg(F.count(F.lit(1)).alias("n"))


def table_projection(spark, d):
    s = _status(spark, d)
    return CF.project_table(s, drop=("AVGSAL",), rename={"agelvlt": "AGE_LEVEL", "EMPCOUNT": "EMPLOYEES"})


def domain_order(spark, d):
    b, a = _ba()
    return _r4(C.comparison_table(_facts(spark, d, [BEFORE, AFTER]), "agelvlt", b, a,
                                  policy="impute_one", order="domain", domain=O.AGE_ORDER))


def specials_last(spark, d):
    b, a = _ba()
    return _r4(C.comparison_table(_facts(spark, d, [BEFORE, AFTER]), "toa", b, a, text="toat",
                                  clean_names=True, policy="impute_one", order="specials_last"))


def known_first(spark, d):
    hc = PR.headcount_by(_facts(spark, d), "loct")
    return O.rank_known_first(hc, "loct", KNOWN_FIRST)


def numeric_sort(spark, d):
    hc = PR.headcount_by(_facts(spark, d), "agelvlt")
    shown = hc.select("agelvlt", F.when(F.col("agelvlt") == "REDACTED", F.lit("REDACTED"))
                      .otherwise(F.format_number("headcount", 0)).alias("value_text"))
    return O.rank_numeric_aware(shown, "value_text", descending=True, tie="agelvlt")


def sample(spark, d):
    f = _facts(spark, d)
    flagged = C.flagged_groups(f, "agy", "agelvlt")
    rows = keep_groups(f, flagged, "agy")
    flag = T.row_has_value(string_columns(f))
    return O.sample_rows(rows, 5, 42, ["line_no"]).withColumn("has_redaction", flag)


# --- composed reports ---------------------------------------------------------------------

def education_comparison(spark, d):
    from periodlens.plans import reports as R
    b, a = _ba()
    return _r4(R.education_comparison(_facts(spark, d, [BEFORE, AFTER]), b, a))


def location_comparison(spark, d):
    from periodlens.plans import reports as R
    b, a = _ba()
    return _r4(R.location_comparison(_facts(spark, d, [BEFORE, AFTER]), b, a))


def salary_availability(spark, d):
    from periodlens.plans import reports as R
    b, a = _ba()
    return _r4(R.salary_availability(_facts(spark, d, [BEFORE, AFTER]), b, a))


def grade_transitions(spark, d):
    from periodlens.plans import reports as R
    years = sorted({y for _, b, a in TRANSITIONS for y in (b, a)})
    matrix, _, _ = R.transition_analysis(_facts(spark, d, years), TRANSITIONS, kind="grade", period_col="year")
    return matrix


def _transition_table(spark, d, kind, name):
    from periodlens.plans import reports as R
    years = sorted({y for _, b, a in TRANSITIONS for y in (b, a)})
    return R.transition_tables(_facts(spark, d, years), TRANSITIONS, kind=kind, period_col="year")[name]


def transition_age(spark, d):
    return _transition_table(spark, d, "age", "all")


def transition_grade_top(spark, d):
    return _transition_table(spark, d, "grade", "top")


def transition_grade_rest(spark, d):
    return _transition_table(spark, d, "grade", "rest")


def transition_appointment(spark, d):
    return _transition_table(spark, d, "appointment", "all")


def agency_trend(spark, d):
    from periodlens.plans import reports as R
    trend_, _, _, _ = R.agency_trend(_facts(spark, d), TREND_AGYSUB)
    return trend_


def name_preference(spark, d):
    return C.name_by_preference(_facts(spark, d), "agelvl", "agelvlt", "year", PREFERRED_YEAR)


def freq_top(spark, d):
    return PR.frequency_share(_facts(spark, d), "loct", n=5)


def freq_by_label(spark, d):
    return PR.frequency_share(_facts(spark, d), "agelvlt", by_label=True)


def calendar_expected(spark, d):
    return Q.calendar_gaps(_facts(spark, d), expected=Q.expected_calendar(spark))


def high_redaction(spark, d):
    return PR.high_redaction_columns(_facts(spark, d), threshold_pct=HIGH_REDACTION_PCT)


def event_trend(spark, d):
    return PV.daily_trend(table(spark, d, "events"), "ts", "value")


def parquet_union(spark, d):
    """Two parquet tables whose columns differ, read as one merged snapshot view."""
    import os
    from periodlens.sources import files as S
    S.read_snapshots(spark, [os.path.join(d, f"{t}.parquet") for t in UNION_TABLES], view="merged_snapshots",
                     with_source=True)
    return spark.sql("""
        SELECT regexp_extract(source_file, '([a-z]+)[.]parquet$', 1) AS source, count(*) AS rows,
               count(c_custkey) AS customer_keys, count(s_suppkey) AS supplier_keys,
               CAST(sum(coalesce(c_nationkey, s_nationkey)) AS BIGINT) AS nation_key_sum
        FROM merged_snapshots GROUP BY 1""")


# --- file round trips: files Spark derives from the tables, read back by the file sources --------

_WRITTEN: dict = {}


def _written(spark, key, build) -> str:
    k = (id(spark), spark.sparkContext.applicationId) + tuple(key)
    if k not in _WRITTEN:
        _WRITTEN[k] = build()
    return _WRITTEN[k]


# Columns of the derived fact files; the early era has upper-case headers, the later one
# lower-case headers plus a pay-period column (header drift across eras).
FILE_COLUMNS = ("agysub", "loc", "agelvlt", "employment", "salary", "toa")
HEADER_ERA_YEAR = 1998


def _fact_csv_dir(spark, d) -> str:
    import uuid
    from periodlens.session import scratch_path
    f = _facts(spark, d)
    base = scratch_path(spark, f"fact-files-{uuid.uuid4().hex}")
    period = F.concat(F.col("quarter"), F.lit("_"), F.col("year").cast("string")).alias("period")
    early = f.where(F.col("year") < HEADER_ERA_YEAR).select(period, *[F.col(c).alias(c.upper()) for c in FILE_COLUMNS])
    late = f.where(F.col("year") >= HEADER_ERA_YEAR).select(period, *FILE_COLUMNS, F.lit("01").alias("pp"))
    from periodlens.sources.sinks import cluster_for_write
    for part in (early, late):     # a few files per period, a hot period split over several tasks
        (cluster_for_write(part, ["period"]).write.mode("append").partitionBy("period")
         .option("header", True).option("escape", '"').csv(base))
    return base


def delimited_ingest(spark, d):
    from periodlens.sources import files as S
    base = _written(spark, ("fact-files", d), lambda: _fact_csv_dir(spark, d))
    rows = S.read_facts(spark, base, encoding="UTF-8", segments=(2,))
    return rows.groupBy("dataset_key", "year", "quarter").agg(
        F.count(F.lit(1)).alias("records"), count_sum("employment", "skip").alias("headcount"),
        F.count(safe_int("salary")).alias("salary_valid"), F.count("pp").alias("pp_present"))


def _lookup_csv_dir(spark, d) -> str:
    """An appointment code table per period, with padded codes and a later line that must not win."""
    import uuid
    from periodlens.session import scratch_path
    base = scratch_path(spark, f"lookup-files-{uuid.uuid4().hex}")
    per = _facts(spark, d).groupBy("quarter", "year", "toa", "toat").agg(F.lit(0).alias("line"))
    rows = per.unionByName(per.withColumn("toat", F.concat(F.lit("later "), "toat")).withColumn("line", F.lit(1)))
    period = F.concat(F.col("quarter"), F.lit("_"), F.col("year").cast("string"))
    (rows.select(period.alias("period"), F.concat(F.lit(" "), "toa", F.lit(" ")).alias("TOA"), F.col("toat").alias("TOAT"),
                 "line").repartition("period").sortWithinPartitions("period", "line", "TOA").drop("line")
     .write.partitionBy("period").option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(base))
    return base


def snapshot_build(spark, d):
    """Fact and lookup files to a written store, its read-back and manifest."""
    import uuid
    from periodlens.plans import reports as R
    from periodlens.session import scratch_path
    facts = _written(spark, ("fact-files", d), lambda: _fact_csv_dir(spark, d))
    lookup = _written(spark, ("lookup-files", d), lambda: _lookup_csv_dir(spark, d))
    snap, man, check = R.build_snapshots(spark, facts, {"DTtoa": lookup},
                                         scratch_path(spark, f"snapshot-build-{uuid.uuid4().hex}"))
    per = snap.groupBy("dataset_key", "year", "quarter").agg(
        F.count(F.lit(1)).alias("rows"), F.count("toat").alias("described"),
        F.count_if(F.col("toat").startswith("later")).alias("later_wins"))
    sizes = man.groupBy("dataset_key").agg(F.sum("records").alias("records"), F.sum("bad_records").alias("bad_records"))
    return (per.join(sizes, "dataset_key").join(check.select("year", "quarter", "rows_read", "complete"), ["year", "quarter"])
            .select("dataset_key", "rows", "described", "later_wins", "records", "bad_records", "rows_read", "complete"))


def alternate_build(spark, d):
    """S3, R2: pipe files of one period to a conformed snapshot and its profile."""
    import uuid
    from periodlens.plans import reports as R
    from periodlens.session import scratch_path

    def write():
        path = scratch_path(spark, f"pipe-files-{uuid.uuid4().hex}")
        f = _status_period(_facts(spark, d), STATUS_CURRENT)
        names = {"agy": "AGY", "agysub": "AGYSUB", "agysubt": "AGYT", "loc": "LOC", "loct": "STATET", "agelvlt": "AGELVLT",
                 "employment": "COUNT", "salary": "SALARY"}
        (f.select(*[F.col(c).alias(n) for c, n in names.items()]).write.option("header", True).option("sep", "|")
         .option("quoteAll", True).csv(path))
        return path

    path = _written(spark, ("pipe-files", d), write)
    snap, per_file, profile = R.build_alternate(spark, [path], int(STATUS_CURRENT[:4]), MONTH_QUARTERS[STATUS_CURRENT[4:]])
    cells = per_file.agg(F.sum("redacted_cells").alias("redacted_cells"), F.sum("rows").alias("file_rows"))
    locs = snap.agg(F.countDistinct("loc").alias("locations"), F.min(F.length("loc")).alias("shortest_loc"))
    return profile.crossJoin(F.broadcast(cells)).crossJoin(F.broadcast(locs))      # one row each


def csv_sink(spark, d):
    """A comparison written as CSV and read back."""
    import uuid
    from periodlens.session import scratch_path
    from periodlens.sources.sinks import write_csv

    def write():
        path = scratch_path(spark, f"comparison-{uuid.uuid4().hex}")
        write_csv(compare_full(spark, d), path, single_file=True)
        return path

    schema = "category string, before bigint, after bigint, change bigint, pct_change double"
    return spark.read.schema(schema).option("header", True).csv(_written(spark, ("csv-sink", d), write))


def _status_period(f: DataFrame, code: str) -> DataFrame:
    return f.where((F.col("year") == int(code[:4])) & (F.col("quarter") == MONTH_QUARTERS[code[4:]]))


def _status_tsv_dir(spark, d) -> str:
    import uuid
    from periodlens.session import scratch_path
    path = scratch_path(spark, f"status-table-{uuid.uuid4().hex}")
    st = _status(spark, d, (STATUS_CURRENT, STATUS_PRIOR))
    (st.select(F.col("datecode").alias("DATECODE"), F.col("agelvlt").alias("AGELVLT"), "EMPCOUNT", "AVGSAL")
     .write.option("header", True).option("sep", "\t").csv(path))
    return path


def status_round_trip(spark, d):
    from periodlens.plans import reports as R
    path = _written(spark, ("status-table", d), lambda: _status_tsv_dir(spark, d))
    return _r4(R.status_comparison(spark, path, STATUS_CURRENT, STATUS_PRIOR))


QUERIES = {
    "headcount_top": headcount_top,
    "mean_by_group": mean_by_group,
    "freq_share": freq_share,
    "numeric_summary": numeric_summary,
    "count_policies": count_policies,
    "clean_prefix": clean_prefix,
    "zero_pad": zero_pad,
    "grade_parse": grade_parse,
    "class_rules": class_rules,
    "denormalize": denormalize_q,
    "denormalize_periods": denormalize_periods,
    "dedupe_first": dedupe_first,
    "duplicate_report": duplicate_report,
    "compare_full": compare_full,
    "compare_left": compare_left,
    "compare_total": compare_total,
    "name_map": name_map,
    "exclude_groups": exclude_groups_q,
    "keep_groups": keep_groups_q,
    "flagged_groups": flagged_groups,
    "redaction_profile": redaction_profile,
    "availability": availability,
    "cell_redaction": cell_redaction,
    "multi_period_sql": multi_period_sql,
    "pivot_year": pivot_year,
    "pivot_multi": pivot_multi,
    "top_split": top_split,
    "trend": trend,
    "group_trend": group_trend,
    "class_trend": class_trend,
    "period_totals": period_totals,
    "null_rates": null_rates,
    "era_rule": era_rule,
    "calendar_gaps": calendar_gaps,
    "row_range": row_range,
    "pair_order": pair_order,
    "conform": conform_q,
    "union_by_name": union_by_name_q,
    "search_rows": search_rows,
    "domain_order": domain_order,
    "headcount_period": headcount_period,
    "distinct_count": distinct_count,
    "snapshot_profile": snapshot_profile,
    "redaction_overview": redaction_overview,
    "enrich_coalesce": enrich_coalesce_q,
    "code_label": code_label,
    "agency_names": agency_names,
    "trim_strings": trim_strings,
    "compose_key": compose_key,
    "pct_change": pct_change,
    "period_label": period_label,
    "member_filter": member_filter,
    "row_flag": row_flag,
    "table_projection": table_projection,
    "alias_columns": alias_columns,
    "distinct_rows": distinct_rows,
    "first_non_null": first_non_null,
    "specials_last": specials_last,
    "known_first": known_first,
    "numeric_sort": numeric_sort,
    "sample": sample,
    "required_columns": required_columns,
    "constant_measure": constant_measure,
    "merge_failure": merge_failure,
    "verdict": verdict,
    "dim_coverage": dim_coverage,
    "education_comparison": education_comparison,
    "location_comparison": location_comparison,
    "salary_availability": salary_availability,
    "grade_transitions": grade_transitions,
    "agency_trend": agency_trend,
    "name_preference": name_preference,
    "freq_top": freq_top,
    "freq_by_label": freq_by_label,
    "calendar_expected": calendar_expected,
    "high_redaction": high_redaction,
    "event_trend": event_trend,
    "parquet_union": parquet_union,
    "delimited_ingest": delimited_ingest,
    "status_round_trip": status_round_trip,
    "snapshot_build": snapshot_build,
    "alternate_build": alternate_build,
    "csv_sink": csv_sink,
    "transition_age": transition_age,
    "transition_grade_top": transition_grade_top,
    "transition_grade_rest": transition_grade_rest,
    "transition_appointment": transition_appointment,
}

from periodlens.plans.history_catalog import HISTORY_QUERIES  # noqa: E402  (its queries call this module's helpers)

QUERIES.update(HISTORY_QUERIES)
