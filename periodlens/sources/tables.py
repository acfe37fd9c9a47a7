"""Driver tables and the ``snapshot_facts`` adapter.

The engine works on snapshot fact tables (one row per person per period, text
measures with sentinels).  The test tables are TPC-H-like, so one adapter turns
``orders ⟕ customer ⟕ nation`` into a snapshot fact table with periods, codes,
descriptions and sentinels.  The same CASE logic is spelled in DuckDB SQL in
``FACTS_SQL`` so the oracle sees identical rows.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodlens.functions import periods as P
from periodlens.functions.values import REDACTED

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# --- fixed values -----------------------------------------------------------
# Age band labels, youngest first.
AGE_BANDS = ("Less than 20", "20-24", "25-29", "30-34", "35-39", "40-44",
             "45-49", "50-54", "55-59", "60-64", "65 or more")
# Age band codes, one letter per band in the same order.
AGE_CODES = ("A", "B", "C", "D", "E", "F", "G", "H", "I", "J", "K")
# Appointment descriptions per order status (numeric and '**-' prefixes on purpose).
APPOINTMENT_LABELS = {"F": "10-FINAL PERMANENT", "O": "20-OPEN NONPERMANENT"}
APPOINTMENT_OTHER = "**-PENDING OTHER"
# Sentinel rules keyed on the order key: REDACTED / '*****' / null salary; REDACTED count.
SALARY_REDACTED_MOD, SALARY_STARS_MOD, SALARY_NULL_MOD, EMPLOYMENT_REDACTED_MOD = 13, 17, 19, 23
# Age label redaction: nation key multiple of 7 and order key multiple of 5.
AGE_REDACT_NATION_MOD, AGE_REDACT_ORDER_MOD = 7, 5
# Grades per pay plan.
GRADE_MOD = 15
# Education descriptions of some order priorities; the others keep their prefixed text.
EDUCATION_LABELS = {"2-HIGH": "MASTER'S DEGREE", "3-MEDIUM": "BACHELOR'S DEGREE", "4-NOT SPECIFIED": "No Data Reported"}
# Nations whose sub-agency names follow the naming rules of armed forces, and the one with code DD.
FORCE_NAMES = {1: ("AF01", "AIR FORCE COMMAND"), 2: ("", "ARMY DEPOT"), 3: ("", "NAVAL SYSTEMS")}
DEFENSE_NATION = 4
# Location redacted / unnamed, appointment redacted, and the year from which a status has a longer description.
LOCATION_REDACTED_MOD, LOCATION_NULL_MOD, APPOINTMENT_REDACTED_MOD, LONG_LABEL_YEAR = 29, 31, 37, 1998
LONG_LABEL = "10-FINAL PERMANENT (EXTENDED)"
# First year with a work schedule type; the field is wholly null before.
SCHEDULE_TYPE_YEAR = 1997
# ----------------------------------------------------------------------------


# Loaded tables and adapter plans per session: building a plan costs Python/JVM round trips
# (file listing, footers, analysis), and a session running many reports over the same tables
# loads them once, as a Spark user would.  Only lazy plans are kept, never data.
_PLANS: dict = {}


def _memo(spark: SparkSession, key, build):
    k = (id(spark), spark.sparkContext.applicationId) + tuple(key)
    df = _PLANS.get(k)
    if df is None:
        df = build()
        _PLANS[k] = df
    return df


def forget_tables() -> None:
    """Drop the remembered plans (e.g. after the files under a directory were replaced)."""
    _PLANS.clear()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = os.path.join(sf_dir, f"{name}.parquet")
    return _memo(spark, ("table", path), lambda: spark.read.parquet(path))


def year_window(col: str, years) -> F.Column:
    """Range predicate on a timestamp column that the parquet scan can push down."""
    lo, hi = min(years), max(years)
    c = F.col(col)
    return ((c >= F.lit(f"{lo}-01-01 00:00:00").cast("timestamp_ntz"))
            & (c < F.lit(f"{hi + 1}-01-01 00:00:00").cast("timestamp_ntz")))


def snapshot_facts(spark: SparkSession, sf_dir: str, years=None, store: bool = True) -> DataFrame:
    """Snapshot fact table derived from orders ⟕ customer ⟕ nation.

    With ``store`` (default) the derived table is built once per session into a snapshot store
    partitioned by (year, quarter) under the shared checkpoint folder — the build-once /
    report-many layout of the snapshot pipeline — and every report reads that store, so a
    period filter prunes directories and the join is not recomputed per report.
    ``store=False`` returns the plain lazy join (period filters become pushed-down ranges).
    """
    ykey = None if years is None else tuple(sorted(set(int(y) for y in years)))
    if not store:
        return _memo(spark, ("facts-plan", sf_dir, ykey), lambda: _snapshot_facts(spark, sf_dir, ykey))
    full = _memo(spark, ("facts-store", sf_dir), lambda: _store_facts(spark, sf_dir))
    if ykey is None:
        return full
    return _memo(spark, ("facts-store", sf_dir, ykey), lambda: full.where(F.col("year").isin(list(ykey))))


def _store_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build the period-partitioned snapshot store of this session under the shared checkpoint folder."""
    from periodlens.session import scratch_path
    from periodlens.sources.sinks import cluster_for_write
    df = _snapshot_facts(spark, sf_dir)
    path = scratch_path(spark, f"snapshot-facts-{uuid.uuid4().hex}")
    (cluster_for_write(df, ["year", "quarter"]).write
     .partitionBy("year", "quarter").option("compression", "zstd").parquet(path))
    return spark.read.schema(df.schema).parquet(path)


def _snapshot_facts(spark: SparkSession, sf_dir: str, years=None) -> DataFrame:
    """Snapshot fact table derived from orders ⟕ customer ⟕ nation.

    Columns (text unless noted): dataset_key, quarter, year INT, datecode, line_no BIGINT,
    agy, agysub, agysubt, edlvl, edlvlt, toa, toat, loc, loct, agelvl, agelvlt, payplan,
    grd, ppgrd, salary, employment, wstypt.  ``years`` restricts the scan with a pushed-down range.
    """
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    if years is not None:
        years = sorted(set(int(y) for y in years))
        orders = orders.where(year_window("o_orderdate", years)).where(
            F.year("o_orderdate").isin(years))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # orders ⟕ customer is a large-to-large equi join: left to the planner (sort-merge, or a
    # runtime broadcast when AQE sees a small customer side).
    joined = (orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
              .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left"))

    k = F.col("o_orderkey")
    nk = F.col("n_nationkey")
    year = F.year("o_orderdate")
    month = F.quarter("o_orderdate") * 3
    quarter = P.quarter_name_from_month(month)
    band = (k % len(AGE_BANDS) + 1).cast("int")
    seg2 = F.substring("c_mktsegment", 1, 2)
    agysub = F.concat(seg2, F.lpad(nk.cast("string"), 2, "0"))
    agy = F.when(nk == DEFENSE_NATION, F.lit("DD")).otherwise(nk.cast("string"))
    agysubt = F.concat(agysub, F.lit("-"), F.col("c_mktsegment"), F.lit(" OF "), F.col("n_name"))
    for nation_key, (prefix, title) in FORCE_NAMES.items():
        head = F.lit(prefix) if prefix else agysub
        agysubt = F.when(nk == nation_key, F.concat(head, F.lit(f"-{title} OF "), F.col("n_name"))).otherwise(agysubt)
    edlvlt = F.col("o_orderpriority")
    for text, label in EDUCATION_LABELS.items():
        edlvlt = F.when(F.col("o_orderpriority") == text, F.lit(label)).otherwise(edlvlt)
    payplan = F.upper(seg2)
    grd = (F.col("o_custkey") % GRADE_MOD + 1).cast("string")
    toat = F.coalesce(
        F.create_map(*[x for kv in APPOINTMENT_LABELS.items() for x in map(F.lit, kv)])[F.col("o_orderstatus")],
        F.lit(APPOINTMENT_OTHER))
    toat = F.when((F.col("o_orderstatus") == "F") & (year >= LONG_LABEL_YEAR), F.lit(LONG_LABEL)).otherwise(toat)
    no_toa = k % APPOINTMENT_REDACTED_MOD == 0
    loct = (F.when(k % LOCATION_REDACTED_MOD == 0, F.lit(REDACTED))
            .when(k % LOCATION_NULL_MOD == 0, F.lit(None).cast("string")).otherwise(F.col("n_name")))
    salary = (F.when(k % SALARY_REDACTED_MOD == 0, F.lit(REDACTED))
              .when(k % SALARY_STARS_MOD == 0, F.lit("*****"))
              .when(k % SALARY_NULL_MOD == 0, F.lit(None).cast("string"))
              .otherwise(F.floor("o_totalprice").cast("string")))
    employment = F.when(k % EMPLOYMENT_REDACTED_MOD == 0, F.lit(REDACTED)).otherwise(F.lit("1"))
    agelvlt = (F.when((nk % AGE_REDACT_NATION_MOD == 0) & (k % AGE_REDACT_ORDER_MOD == 0), F.lit(REDACTED))
               .otherwise(F.element_at(F.array(*map(F.lit, AGE_BANDS)), band)))
    return joined.select(
        P.dataset_key(year, quarter).alias("dataset_key"),
        quarter.alias("quarter"),
        year.alias("year"),
        (year * 100 + month).cast("string").alias("datecode"),
        k.alias("line_no"),
        agy.alias("agy"),
        agysub.alias("agysub"),
        agysubt.alias("agysubt"),
        F.substring("o_orderpriority", 1, 1).alias("edlvl"),
        edlvlt.alias("edlvlt"),
        F.when(no_toa, F.lit(REDACTED)).otherwise(F.col("o_orderstatus")).alias("toa"),
        F.when(no_toa, F.lit(REDACTED)).otherwise(toat).alias("toat"),
        nk.cast("string").alias("loc"),
        loct.alias("loct"),
        F.element_at(F.array(*map(F.lit, AGE_CODES)), band).alias("agelvl"),
        agelvlt.alias("agelvlt"),
        payplan.alias("payplan"),
        grd.alias("grd"),
        F.concat(payplan, grd).alias("ppgrd"),
        salary.alias("salary"),
        employment.alias("employment"),
        F.when(year >= SCHEDULE_TYPE_YEAR, F.lit("FULL TIME")).alias("wstypt"),
    )


_QUARTER_SQL = ("CASE quarter(o.o_orderdate) WHEN 1 THEN 'March' WHEN 2 THEN 'June' "
                "WHEN 3 THEN 'September' ELSE 'December' END")

# DuckDB spelling of the adapter; used as a CTE named ``facts`` by the oracle queries.  Its values are
# written out, so that a wrong constant above shows.
FACTS_SQL = f"""
facts AS (
  SELECT
    CAST(year(o.o_orderdate) AS INTEGER) || '_' || {_QUARTER_SQL} AS dataset_key,
    {_QUARTER_SQL} AS quarter,
    CAST(year(o.o_orderdate) AS INTEGER) AS year,
    CAST(CAST(year(o.o_orderdate) AS INTEGER) * 100 + quarter(o.o_orderdate) * 3 AS VARCHAR) AS datecode,
    o.o_orderkey AS line_no,
    CASE WHEN n.n_nationkey = 4 THEN 'DD' ELSE CAST(n.n_nationkey AS VARCHAR) END AS agy,
    substr(c.c_mktsegment, 1, 2) || lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0') AS agysub,
    CASE n.n_nationkey WHEN 1 THEN 'AF01-AIR FORCE COMMAND OF ' || n.n_name
      WHEN 2 THEN substr(c.c_mktsegment, 1, 2) || '02-ARMY DEPOT OF ' || n.n_name
      WHEN 3 THEN substr(c.c_mktsegment, 1, 2) || '03-NAVAL SYSTEMS OF ' || n.n_name
      ELSE substr(c.c_mktsegment, 1, 2) || lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0')
        || '-' || c.c_mktsegment || ' OF ' || n.n_name END AS agysubt,
    substr(o.o_orderpriority, 1, 1) AS edlvl,
    CASE o.o_orderpriority WHEN '2-HIGH' THEN 'MASTER''S DEGREE' WHEN '3-MEDIUM' THEN 'BACHELOR''S DEGREE'
      WHEN '4-NOT SPECIFIED' THEN 'No Data Reported' ELSE o.o_orderpriority END AS edlvlt,
    CASE WHEN o.o_orderkey % 37 = 0 THEN 'REDACTED' ELSE o.o_orderstatus END AS toa,
    CASE WHEN o.o_orderkey % 37 = 0 THEN 'REDACTED'
         WHEN o.o_orderstatus = 'F' AND year(o.o_orderdate) >= 1998 THEN '10-FINAL PERMANENT (EXTENDED)'
         WHEN o.o_orderstatus = 'F' THEN '10-FINAL PERMANENT' WHEN o.o_orderstatus = 'O' THEN '20-OPEN NONPERMANENT'
         ELSE '**-PENDING OTHER' END AS toat,
    CAST(n.n_nationkey AS VARCHAR) AS loc,
    CASE WHEN o.o_orderkey % 29 = 0 THEN 'REDACTED' WHEN o.o_orderkey % 31 = 0 THEN NULL ELSE n.n_name END AS loct,
    substr('ABCDEFGHIJK', CAST(o.o_orderkey % 11 AS INTEGER) + 1, 1) AS agelvl,
    CASE WHEN n.n_nationkey % 7 = 0 AND o.o_orderkey % 5 = 0 THEN 'REDACTED'
         ELSE ['Less than 20', '20-24', '25-29', '30-34', '35-39', '40-44', '45-49', '50-54', '55-59', '60-64',
               '65 or more'][CAST(o.o_orderkey % 11 AS INTEGER) + 1] END AS agelvlt,
    upper(substr(c.c_mktsegment, 1, 2)) AS payplan,
    CAST(o.o_custkey % 15 + 1 AS VARCHAR) AS grd,
    upper(substr(c.c_mktsegment, 1, 2)) || CAST(o.o_custkey % 15 + 1 AS VARCHAR) AS ppgrd,
    CASE WHEN o.o_orderkey % 13 = 0 THEN 'REDACTED'
         WHEN o.o_orderkey % 17 = 0 THEN '*****'
         WHEN o.o_orderkey % 19 = 0 THEN NULL
         ELSE CAST(CAST(floor(o.o_totalprice) AS BIGINT) AS VARCHAR) END AS salary,
    CASE WHEN o.o_orderkey % 23 = 0 THEN 'REDACTED' ELSE '1' END AS employment,
    CASE WHEN year(o.o_orderdate) >= 1997 THEN 'FULL TIME' END AS wstypt
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
)
"""
