"""Composed reports over snapshot tables (the workforce field names are the defaults).

Each report is a function of DataFrames (or paths for the builds) returning lazy
DataFrames; nothing is collected except report headers that are schema metadata.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from periodlens.functions.text import appointment_class, plan_grade, row_has_value
from periodlens.functions.common import string_columns
from periodlens.operators import compare as C
from periodlens.operators import conform as CF
from periodlens.operators import order as O
from periodlens.operators import pivot as PV
from periodlens.operators import profile as PR
from periodlens.operators import quality as Q
from periodlens.operators.denorm import Dim, denormalize
from periodlens.operators.joins import enrich_coalesce, keep_groups
from periodlens.operators.position import up, rank_codes
from periodlens.sources import files as S
from periodlens.sources import sinks as K

# --- fixed values -----------------------------------------------------------
# Code tables: (file kind, fact key, carried columns, renames).  Carried columns missing
# from an era's file are skipped; a kind missing from a period leaves its columns null.
WORKFORCE_DIMS = (
    ("DTagelvl", "agelvl", ("agelvlt",), {}),
    ("DTedlvl", "edlvl", ("edlvlt",), {}),
    ("DTgsegrd", "gsegrd", (), {}),
    ("DTloslvl", "loslvl", ("loslvlt",), {}),
    ("DTocc", "occ", ("occt", "occfam", "occfamt", "occtyp", "occtypt"), {}),
    ("DTpatco", "patco", ("patcot",), {}),
    ("DTppgrd", "ppgrd", ("ppgrdt", "pptyp", "pptypt", "ppgroup", "ppgroupt"), {}),
    ("DTsallvl", "sallvl", ("sallvlt",), {}),
    ("DTstemocc", "stemocc", ("stemocct",), {}),
    ("DTsuper", "supervis", ("supervist",), {}),
    ("DTtoa", "toa", ("toat",), {}),
    ("DTwrksch", "worksch", ("workscht", "wstyp", "wstypt"), {"workscht": "wrkscht"}),
    ("DTwkstat", "workstat", ("workstatt",), {"workstatt": "wkstatt"}),
    ("DTagy", "agysub", ("agy", "agysubt", "agyt"), {}),
    ("DTloc", "loc", ("loct",), {}),
    ("DTpp", "pp", ("ppt",), {}),
)
# Status-table views: columns dropped per table (besides DATECODE and the three metrics).
STATUS_TABLE_DROPS = {
    "age-level": ("EMPCOUNT", "AVGSAL", "AVGLOS"),
    "agency-location": ("EMPCOUNT", "AVGSAL", "AVGLOS", "AGY", "AGYSUB", "LOC", "STATE"),
    "agency-subagency": ("EMPCOUNT", "AVGSAL", "AVGLOS", "AGY", "AGYSUB"),
    "agency-detail": ("EMPCOUNT", "AVGSAL", "AVGLOS", "AGY", "AGYSUB", "OCC"),
    "appointment-type": ("EMPCOUNT", "AVGSAL", "AVGLOS", "TOA"),
    "duty-location": ("EMPCOUNT", "AVGSAL", "AVGLOS", "LOC", "STATE"),
    "education-level": ("EMPCOUNT", "AVGSAL", "AVGLOS", "EDLVL"),
    "occupation": ("EMPCOUNT", "AVGSAL", "AVGLOS", "OCC", "OCCFAM"),
    "pay-grade": ("EMPCOUNT", "AVGSAL", "AVGLOS"),
}
# Status-table display names.
STATUS_DISPLAY_NAMES = {
    "AGYT": "Agency", "AGYSUBT": "Sub Agency", "STATET": "State", "AGELVLT": "Age Bracket",
    "EDLVLT": "Education Level", "TOAT": "Appointment Type", "OCCT": "Occupation",
    "OCCFAMT": "Occupation Group", "PAYPLAN": "Pay Plan", "GRD": "Grade",
    "CHANGE": "Change", "PCT_CHANGE": "% Change",
}
# Code and description fields whose coverage the validation run reports.
DIMENSION_PAIRS = tuple((key, rename.get(carry[0], carry[0])) for _, key, carry, rename in WORKFORCE_DIMS if carry)
# Columns that tell where a record came from.
LINEAGE = ("source_file", "source_size", "corrupt_record")
# Codes that are zero-padded to two characters on both sides of the join.
PADDED_CODES = ("loc",)
# ----------------------------------------------------------------------------


# --- R1 / R2: builds -----------------------------------------------------------------------

def workforce_dims(lookups: dict) -> list[Dim]:
    """Dimension specs for the code tables that were found (``lookups``: kind → DataFrame)."""
    dims = []
    for kind, key, carry, rename in WORKFORCE_DIMS:
        lk = lookups.get(kind)
        if lk is None or key not in lk.columns:
            continue
        if key in PADDED_CODES:
            lk = CF.pad_codes(lk, [key])
        cols = carry if carry else tuple(c for c in lk.columns
                                         if c not in (key, "dataset_key", "quarter", "year", "line_no", *LINEAGE))
        cols = tuple(c for c in cols if c in lk.columns)
        dims.append(Dim(kind, lk, ("dataset_key", key), ("dataset_key", key), cols, rename=dict(rename),
                        order="line_no"))
    return dims


def _dated() -> Column:
    return F.col("year").isNotNull() & F.col("quarter").isNotNull()


def _denormalized(spark: SparkSession, facts: DataFrame, lookup_paths: dict, segments=(1, 2, 3), encoding: str = S.LATIN1) -> DataFrame:
    facts = S.null_texts(S.trim_strings(facts))
    facts = CF.pad_codes(facts, [c for c in PADDED_CODES if c in facts.columns])
    lookups = {}
    for kind, paths in lookup_paths.items():
        if paths:
            # a cut description must not name a code: ``bad_record_report`` counts such lines
            lookups[kind] = S.null_texts(S.trim_strings(S.sound(S.read_lookups(spark, paths, encoding, segments))))
    return CF.add_aliases(denormalize(facts, workforce_dims(lookups)))


def denormalized(spark: SparkSession, fact_paths, lookup_paths: dict, segments=(1, 2, 3), encoding: str = S.LATIN1) -> DataFrame:
    """Facts with their code tables' descriptions and lineage columns (J1); records without a period are left out."""
    facts = S.read_facts(spark, fact_paths, encoding, segments)
    return _denormalized(spark, facts.where(_dated()), lookup_paths, segments, encoding)


def build_snapshots(spark: SparkSession, fact_paths, lookup_paths: dict, out_path: str | None = None):
    """Snapshot build (R1): facts + code tables → denormalised snapshots (+ manifest).

    ``lookup_paths`` maps a code-table kind to the files of that kind over all periods.
    Returns (snapshots, manifest, write_check or None); with ``out_path`` the snapshots and the
    manifest are read from the written store.  Records of files whose name gives no period are not
    stored; the manifest lists them under a null period.
    """
    facts = S.read_facts(spark, fact_paths)
    rejected = K.manifest(facts.where(~_dated()).drop("corrupt_record"))
    snap = _denormalized(spark, facts.where(_dated()), lookup_paths)
    if not out_path:
        return snap.drop(*LINEAGE), K.manifest(snap).unionByName(rejected), None
    # The store keeps the lineage columns, so the manifest is a narrow columnar read of the
    # written store instead of a second pass over the delimited sources.
    check = K.write_snapshots(snap, out_path)
    store = S.read_snapshots(spark, out_path, schema=snap.schema)
    return store.drop(*LINEAGE), K.manifest(store).unionByName(rejected), check


def bad_record_report(spark: SparkSession, fact_paths=(), lookup_paths: dict | None = None, pipe_paths=(),
                      status_paths=()) -> DataFrame:
    """Records and malformed records of every input file: kind, source_file, records, bad_records."""
    frames = [(kind, read(spark, paths)) for kind, read, paths in (
        ("facts", S.read_facts, fact_paths), ("pipe", S.read_pipe_files, pipe_paths)) if paths]
    frames += [(kind, S.read_lookups(spark, paths)) for kind, paths in (lookup_paths or {}).items() if paths]
    frames += [("status", S.read_status_table(spark, path, with_source=True)) for path in status_paths]
    counted = [S.bad_records(df).select(F.lit(kind).alias("kind"), "source_file", "records", "bad_records") for kind, df in frames]
    if not counted:
        raise ValueError("no input files")
    return reduce(DataFrame.unionByName, counted)


def build_from_directory(spark: SparkSession, base: str, out_path: str | None = None):
    """R1 over an extracted release tree: fact files and code tables found by their fixed names
    (a code table missing for a period simply leaves that period's descriptions null)."""
    found = S.discover_files(spark, base)
    facts = found.pop("facts")
    return build_snapshots(spark, facts, found, out_path)


def build_alternate(spark: SparkSession, paths, year: int, quarter: str,
                    target=CF.SNAPSHOT_FIELDS, out_path: str | None = None):
    """Alternate-release build (R2): pipe files → per-file redaction and agency profile →
    renamed and conformed snapshot with period columns (+ snapshot profile).  Malformed records are counted per
    file and left out of the snapshot.

    Returns (snapshot, per_file_profile, snapshot_profile).
    """
    raw = S.read_pipe_files(spark, paths)
    value_cols = [c for c in raw.columns if c not in LINEAGE]
    # one aggregation per file: rows, redacted cells (A8) and distinct agencies
    redacted = F.expr(" + ".join(f"CAST(coalesce(`{c}` = 'REDACTED', false) AS INT)" for c in value_cols))
    agencies = [F.countDistinct("AGYT").alias("n_distinct_AGYT")] if "AGYT" in raw.columns else []
    per_file = (raw.groupBy("source_file")
                .agg(F.count(F.lit(1)).alias("rows"), F.count(S.CORRUPT).alias("bad_records"),
                     F.sum(redacted).cast("bigint").alias("redacted_cells"), *agencies)
                .withColumn("cell_pct", F.round(F.col("redacted_cells") / (F.col("rows") * len(value_cols)) * 100.0, 4)))
    snap = CF.rename_columns(S.sound(raw), CF.ALTERNATE_RENAMES)
    snap = snap.withColumns({"dataset_key": F.lit(f"{year}_{quarter}"), "quarter": F.lit(quarter),
                             "year": F.lit(year)})
    snap = CF.pad_codes(snap, ["loc"])
    snap = CF.conform(snap, target, fill="", types={"year": "int"})
    profile = PR.snapshot_profile(snap)
    if out_path:
        K.write_snapshots(snap, out_path)
    return snap, per_file, profile


def alternate_checks(snap: DataFrame) -> dict:
    """R2's checks of a snapshot: its ten largest agencies, fields that are over 90 % redacted, its row count."""
    return {"top_agencies": PR.headcount_top(snap, "agysubt", 10),
            "high_redaction": PR.high_redaction_columns(snap, threshold_pct=90.0),
            "row_range": Q.row_range(snap)}


# --- R3-R10: two-period comparisons --------------------------------------------------------

def age_comparison(snap: DataFrame, before: Column, after: Column) -> DataFrame:
    """Head count by age band, fixed band order, REDACTED then TOTAL last."""
    return C.comparison_table(snap, "agelvlt", before, after, order="domain", domain=O.AGE_ORDER)


def education_comparison(snap: DataFrame, before: Column, after: Column) -> DataFrame:
    """By education code with cleaned labels, least to most education."""
    return C.comparison_table(snap, "edlvl", before, after, text="edlvlt", clean_names=True,
                              order="domain", domain=O.EDUCATION_ORDER)


def appointment_comparison(snap: DataFrame, before: Column, after: Column) -> DataFrame:
    """By appointment code with cleaned labels, count order, specials last."""
    return C.comparison_table(snap, "toa", before, after, text="toat", clean_names=True)


def location_comparison(snap: DataFrame, before: Column, after: Column, flag_field: str = "loct") -> DataFrame:
    """Agencies with a redacted location in the newer period are excluded from both."""
    return C.comparison_table(snap, "loc", before, after, text="loct", exclude=("agy", flag_field))


def age_comparison_excluding(snap: DataFrame, before: Column, after: Column):
    """Age comparison without agencies that redact age; also the excluded agency labels."""
    table = C.comparison_table(snap, "agelvlt", before, after, order="domain", domain=O.AGE_ORDER,
                               exclude=("agy", "agelvlt"))
    flagged = C.flagged_groups(snap.where(after), "agy", "agelvlt")
    names = PR.first_non_null(keep_groups(snap.where(before), flagged, "agy"), "agy", "agysubt")
    from periodlens.functions.text import agency_label
    excluded = names.select("agy", agency_label("agy", "first_agysubt").alias("label"))
    return table, excluded


def salary_availability(snap: DataFrame, before: Column, after: Column) -> DataFrame:
    """Salary availability, agencies redacting age excluded."""
    return C.availability(snap, "salary", before, after, exclude=("agy", "agelvlt"))


def redacted_sample(snap: DataFrame, period: Column, n: int = 5, seed: int = 42,
                    keys=("dataset_key", "agy", "agysub", "occ", "salary")) -> DataFrame:
    """A repeatable sample of rows from agencies that redact age, with a row flag."""
    rows = snap.where(period)
    flagged = C.flagged_groups(rows, "agy", "agelvlt")
    picked = keep_groups(rows, flagged, "agy")
    keys = [k for k in keys if k in snap.columns]
    return O.sample_rows(picked, n, seed, keys).withColumn(
        "has_redaction", row_has_value(string_columns(snap)))


# --- R11 / R12: multi-period ---------------------------------------------------------------

def transition_analysis(snap: DataFrame, transitions, kind: str = "age", period_col: str = "datecode"):
    """Category changes over several (before, after) period pairs.

    kind 'age' groups by age band; 'grade' by standardised plan-grade (with the top-50 split);
    'appointment' by appointment code with a code label.  Returns (matrix, totals, extra).
    """
    if kind == "age":
        cat = F.col("agelvlt")
    elif kind == "grade":
        cat = plan_grade("ppgrd")
    else:
        cat = F.col("toa")
    df = snap.withColumn("category", cat)
    matrix = PV.transition_matrix(df, "category", transitions, period_col=period_col)
    totals = PV.period_totals(df, transitions, period_col=period_col)
    extra = None
    if kind == "grade":
        extra = PV.top_split(df, "category", transitions, 50, period_col=period_col)
    elif kind == "appointment":
        # descriptions: the last transition's newer period is preferred, otherwise the first
        # period (in transition order) that has one; then 'code: description' labels
        from periodlens.functions.text import code_label
        afters = [a for _, _, a in transitions]
        names = C.name_by_preference(df, "toa", "toat", period_col, preferred=afters[-1], order=afters)
        extra = names.select("code", code_label("code", "name").alias("label"))
    return matrix, totals, extra


def transition_tables(snap: DataFrame, transitions, kind: str = "age", period_col: str = "datecode") -> dict:
    """R11's display tables, each with a rank: age bands in the known order; plan-grades as the top 50 and
    the rest, by the last transition's percent ascending; appointments as sorted 'code: description' rows."""
    matrix, _, extra = transition_analysis(snap, transitions, kind, period_col)
    if kind == "age":
        return {"all": O.rank_known_first(matrix, "category", O.AGE_ORDER)}
    if kind == "grade":
        split = matrix.join(extra.select("category", "is_top"), "category")
        order = [up(f"{transitions[-1][0]}_pct"), "category"]
        return {name: rank_codes(split.where(pick).drop("is_top"), order)
                for name, pick in (("top", F.col("is_top")), ("rest", ~F.col("is_top")))}
    labelled = matrix.join(extra, matrix["category"] == extra["code"], "left")
    shown = labelled.withColumn("category", F.coalesce("label", "category")).drop("label", "code")
    return {"all": rank_codes(shown, ["category"])}


def agency_trend(snap: DataFrame, agysub: str, descriptions: DataFrame | None = None):
    """One sub-agency over all periods: totals, appointment mix (with full descriptions
    where known), appointment class per code and the nonpermanent split.

    Returns (trend, appointment_matrix, classes, class_trend).
    """
    rows = snap.where(F.col("agysub") == agysub)
    trend = PV.period_trend(rows)
    by_toa = PV.period_trend(rows, extra_keys=("toa", "toat"))
    if descriptions is not None:
        by_toa = enrich_coalesce(by_toa, descriptions, "toa", "toat_full", "toat_display", "toat")
    else:
        by_toa = by_toa.withColumn("toat_display", F.col("toat"))
    classes = by_toa.select("toa", "toat_display").distinct().withColumn(
        "appt_class", appointment_class("toat_display"))
    shown = rows
    if descriptions is not None:
        shown = enrich_coalesce(rows, descriptions, "toa", "toat_full", "__shown", "toat")
        shown = shown.withColumn("toat", F.col("__shown")).drop("__shown")
    split = PV.class_trend(shown)
    return trend, by_toa, classes, split


def appointment_matrix(by_toa: DataFrame) -> DataFrame:
    """R12 table: appointment code × period head counts (0-filled), most recent period first."""
    return PV.period_matrix(by_toa, ["toa", "toat_display"], "period", "sort_key", "employment")


# --- R13: status tables --------------------------------------------------------------------

def status_comparison(spark: SparkSession, path: str, current: str, prior: str,
                      drop=(), rename: dict | None = None, search: str | None = None) -> DataFrame:
    """A status table's current rows matched to the prior period, projected, searched."""
    st = S.sound(S.read_status_table(spark, path))
    st = st.withColumn("DATECODE", F.col("DATECODE").cast("string"))
    out = C.compare_left(st, "DATECODE", current, prior, line="line_no")
    out = CF.project_table(out, drop, rename)
    if search:
        from periodlens.functions.text import row_contains
        out = out.where(row_contains([c for c in out.columns if c != "rank"], search))
    return out


def status_table_view(spark: SparkSession, path: str, table: str, current: str, prior: str,
                      current_label: str, prior_label: str, search: str | None = None) -> DataFrame:
    """R13 display table: status rows matched to the prior period, per-table columns dropped,
    headers renamed to display names, the two counts labelled by period, optional search."""
    out = status_comparison(spark, path, current, prior)
    drop = ("DATECODE", "EMPCOUNT", "AVGSAL", "AVGLOS", *STATUS_TABLE_DROPS.get(table, ()))
    out = out.withColumnsRenamed({"change": "CHANGE", "pct_change": "PCT_CHANGE"})
    names = dict(STATUS_DISPLAY_NAMES, prior_count=prior_label, current_count=current_label)
    out = CF.project_table(out, drop, names)
    if search:      # the search runs over the displayed cells only, as a viewer would see them
        from periodlens.functions.text import row_contains
        out = out.where(row_contains([F.col(f"`{c}`") for c in out.columns if c != "rank"], search))
    return out


def status_pair_check(spark: SparkSession, path: str, first: str, second: str) -> DataFrame:
    """Positional pairing check of a status table (J8): rows of the two DATECODEs paired by file
    order, every non-metric column compared.  One row: n_first, n_second, mismatches, result."""
    st = S.sound(S.read_status_table(spark, path)).withColumn("DATECODE", F.col("DATECODE").cast("string"))
    keys = [c for c in st.columns if c not in ("DATECODE", "line_no", *S.STATUS_TYPES)]
    return Q.pair_order(st, "DATECODE", first, second, keys, ["line_no"])


# --- R14 / R15 -----------------------------------------------------------------------------

def examples_battery(snap: DataFrame, before: Column | None = None, after: Column | None = None) -> dict:
    """The usage examples as named DataFrames; with two periods also the redaction profile."""
    out = {
        "top_agencies": PR.headcount_top(snap, "agysubt", 10),
        "salary_by_education": PR.mean_by_group(snap, "edlvlt", "salary", 5),
        "by_period": PR.headcount_by(snap, ["year", "quarter"]),
        "salary_summary": PR.numeric_summary(snap, "salary"),
    }
    for col, how in (("loct", {"n": 5}), ("patcot", {}), ("agelvlt", {"by_label": True}), ("supervist", {}), ("wrkscht", {})):
        if col in snap.columns:
            out[f"share_{col}"] = PR.frequency_share(snap, col, **how)
    if before is not None and after is not None:
        out["redaction"] = PR.redaction_profile(snap, before, after)
    return out


def validation_run(snap: DataFrame):
    """Verdict per snapshot, required columns, high-null listing, constant measure, wholly null
    fields, code coverage, era rule, gaps against the publication calendar, overall flag."""
    verdicts = Q.verdict(snap)
    return {
        "verdict": verdicts,
        "required": Q.required_columns(snap),
        "high_null": Q.null_rates(snap).where(F.col("severity") == "warn"),
        "constant": Q.constant_measure(snap),
        "merge_failures": Q.merge_failures(snap),
        "coverage": Q.dim_coverage(snap, DIMENSION_PAIRS),
        "era": Q.era_rule(snap),
        "calendar": Q.calendar_gaps(snap, expected=Q.expected_calendar(snap.sparkSession)),
        "overall": Q.overall_ok(verdicts),
    }


def battery_rows(battery: dict) -> DataFrame:
    """R14's outputs as one long table: example, item, value, rank (null where an example has none)."""
    def rows(example: str, df: DataFrame, item, value: str) -> DataFrame:
        rank = F.col("rank").cast("bigint") if "rank" in df.columns else F.lit(None).cast("bigint")
        return df.select(F.lit(example).alias("example"), item.cast("string").alias("item"), F.col(value).cast("double").alias("value"),
                         rank.alias("rank"))

    out = []
    for name, df in battery.items():
        if name == "salary_summary":
            stats = [c for c in df.columns]
            long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("stat"), F.col(c).cast("double").alias("v")) for c in stats])))
            out.append(rows(name, long, F.col("stat"), "v"))
        elif name == "by_period":
            out.append(rows(name, df, F.concat_ws(" ", "quarter", "year"), "headcount"))
        elif name == "top_agencies":
            out.append(rows(name, df, F.col("agysubt"), "headcount"))
        elif name == "salary_by_education":
            out.append(rows(name, df, F.col("edlvlt"), "mean_value"))
        elif name == "redaction":
            out += [rows(f"{name}_{side}", df, F.col("column_name"), f"{side}_pct") for side in ("before", "after")]
        else:
            out.append(rows(name, df, F.col(name.removeprefix("share_")), "share_pct"))
    return reduce(DataFrame.unionByName, out)


def validation_rows(run: dict) -> DataFrame:
    """R15's nine outputs as one long table: check, period, field, severity."""
    ok = F.when(F.col("valid"), "ok").otherwise("invalid")
    none = F.lit(None).cast("string")
    shown = {
        "verdict": (F.col("dataset_key"), none, ok),
        "required": (F.col("dataset_key"), F.col("column_name"), F.col("severity")),
        "high_null": (F.col("dataset_key"), F.col("field"), F.col("severity")),
        "constant": (F.col("dataset_key"), F.lit("employment"), F.col("severity")),
        "merge_failures": (F.col("dataset_key"), F.col("field"), F.col("severity")),
        "coverage": (F.col("dataset_key"), F.col("code"), F.col("status")),
        "era": (F.col("dataset_key"), F.col("field"), F.col("severity")),
        "calendar": (F.concat_ws("_", "year", "quarter"), none, F.lit("missing")),
        "overall": (none, none, F.when(F.col("all_valid"), "ok").otherwise("invalid")),
    }
    return reduce(DataFrame.unionByName, [
        run[name].select(F.lit(name).alias("check"), period.cast("string").alias("period"), field.alias("field"), severity.alias("severity"))
        for name, (period, field, severity) in shown.items()])
