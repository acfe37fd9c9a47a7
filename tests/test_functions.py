"""Scalar expressions on hand-made edge values."""

from pyspark.sql import functions as F

from periodlens.functions import periods as P
from periodlens.functions import text as T
from periodlens.functions import values as V
from periodlens.sources.files import normalize_header, normalized_names


def one_col(spark, values, name="x"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def test_safe_int_edges(spark):
    vals = ["12", " 12 ", "12.9", "-12.7", ".5", "12.", "1e3", "nan", "*****", "", None,
            "REDACTED", "inf", "NaN", "1_000", "1.5d", "abc", "99999999999999999999999"]
    got = [r[0] for r in one_col(spark, vals).select(V.safe_int("x")).collect()]
    assert got == [12, 12, 12, -12, 0, 12, 1000, None, None, None, None,
                   None, None, None, None, None, None, None]


def test_count_policies(spark):
    vals = ["1", "2", "REDACTED", "*****", "", None, "nan", "3.6", "x"]
    df = one_col(spark, vals)
    row = df.agg(*[V.count_sum("x", p).alias(p) for p in V.COUNT_POLICIES]).first()
    assert row["skip"] == 1 + 2 + 3            # 3.6 truncates to 3
    assert row["impute_one"] == round(1 + 2 + 1 + 1 + 1 + 1 + 1 + 3.6 + 1)  # 11.6 -> 12
    assert row["digits_else_zero"] == 3
    assert row["coerce_zero"] == round(1 + 2 + 3.6)  # 6.6 -> 7


def test_count_skip_all_sentinels_is_zero(spark):
    row = one_col(spark, ["REDACTED", None]).agg(V.count_sum("x", "skip").alias("s")).first()
    assert row["s"] == 0


def test_zero_pad_never_shortens(spark):
    got = [r[0] for r in one_col(spark, ["6", "06", "", "REDACTED", None, "123"])
           .select(T.zero_pad("x")).collect()]
    assert got == ["06", "06", "00", "REDACTED", None, "123"]


def test_prefix_cleaning_dispatch(spark):
    df = spark.createDataFrame([("13-BACHELOR'S DEGREE", "VATA-VETERANS HEALTH", "20-24", "POST-BACHELOR'S"),
                                ("**-INVALID", "0610-NURSE", "REDACTED", "10-FOO")],
                               "edlvlt string, agysubt string, agelvlt string, toat string")
    r = df.select(T.clean_category("edlvlt").alias("e"), T.clean_category("agysubt").alias("a"),
                  T.clean_category("toat").alias("t"), T.strip_generic_prefix("agelvlt").alias("g")).collect()
    assert [x["e"] for x in r] == ["BACHELOR'S DEGREE", "INVALID"]
    assert [x["a"] for x in r] == ["VETERANS HEALTH", "NURSE"]
    assert [x["t"] for x in r] == ["POST-BACHELOR'S", "FOO"]
    # the generic rule damages age labels, which is why age is never cleaned
    assert [x["g"] for x in r] == ["24", "REDACTED"]


def test_plan_grade(spark):
    got = [r[0] for r in one_col(spark, ["GS4", "GS-4", "GS-13", "ES", "12", None])
           .select(T.plan_grade("x")).collect()]
    assert got == ["GS-04", "GS-04", "GS-13", None, None, None]


def test_appointment_class(spark):
    got = [r[0] for r in one_col(spark, ["Career NONPERMANENT x", "competitive permanent", "Other", None])
           .select(T.appointment_class("x")).collect()]
    assert got == ["Nonpermanent", "Permanent", "Other", "Other"]


def test_agency_display_name(spark):
    df = spark.createDataFrame([
        ("AF", "AF02-AIR FORCE INSPECTION AGENCY"), ("AR", "U.S. ARMY MATERIEL"), ("NV", "NAVAL SEA"),
        ("DD", "DEFENSE LOGISTICS"), ("VA", "VETERANS HEALTH"), ("XX", None), ("AX", "AIR FORCE RESERVE")],
        "code string, name string")
    got = [r[0] for r in df.select(T.agency_label("code", "name")).collect()]
    assert got == ["AF (AIR FORCE)", "AR (ARMY)", "NV (NAVY)", "DD (DEPARTMENT OF DEFENSE)",
                   "VA (VETERANS HEALTH)", "XX (XX)", "AX (AIR FORCE)"]


def test_code_label_unknown(spark):
    df = spark.createDataFrame([("01", "ALABAMA"), ("02", None), ("03", "")], "c string, d string")
    assert [r[0] for r in df.select(T.code_label("c", "d")).collect()] == [
        "01: ALABAMA", "02: Unknown", "03: Unknown"]


def test_pct_change_rules(spark):
    df = spark.createDataFrame([(100, 90), (0, 5), (0, 0), (4, 0)], "b long, a long")
    got = [r[0] for r in df.select(P.pct_change("b", "a")).collect()]
    assert got == [-10.0, 100.0, 0.0, -100.0]


def test_period_from_path(spark):
    df = one_col(spark, ["/d/FACTDATA_SEP2024.TXT", "/d/Staff_Snapshot_December_2018/x.txt",
                         "/d/factdata_mar2010.txt", "/d/FACTDATA_ABC2019.TXT", "/d/readme.txt"])
    got = [(r["quarter"], r["year"]) for r in df.select(P.period_from_path("x").alias("p")).select("p.*").collect()]
    assert got == [("September", 2024), ("December", 2018), ("March", 2010), (None, 2019), (None, None)]


def test_period_from_path_takes_the_first_segment_that_matches(spark):
    df = one_col(spark, ["/JUN2001/March_1999/DEC2005.txt", "/JUN2001/March_1999/x.txt", "/JUN2001/a/x.txt", "March_1999", "", None])

    def got(segments):
        return [(r["quarter"], r["year"]) for r in df.select(P.period_from_path("x", segments).alias("p")).select("p.*").collect()]
    none = [(None, None)]
    assert got((1, 2, 3)) == [("December", 2005), ("March", 1999), ("June", 2001), ("March", 1999)] + none * 2
    assert got((2,)) == [("March", 1999)] * 2 + none * 4
    assert got((2, 1)) == [("March", 1999)] * 2 + none + [("March", 1999)] + none * 2
    assert df.where(P.period_from_path("x").isNull()).count() == 0


def test_period_label_and_sort_key(spark):
    df = spark.createDataFrame([("March", 2024), ("September", 2023)], "q string, y int")
    r = df.select(P.period_label("q", "y").alias("l"), P.period_sort_key("y", "q").alias("k"),
                  P.dataset_key("y", "q").alias("d"), P.datecode("y", "q").alias("c")).collect()
    assert [(x.l, x.k, x.d, x.c) for x in r] == [("March 2024", 20241, "2024_March", "202403"),
                                                 ("September 2023", 20233, "2023_September", "202309")]


def test_trim_unicode_whitespace(spark):
    got = [r[0] for r in one_col(spark, ["  AB \t", "x", None]).select(T.trim_all("x")).collect()]
    assert got == ["AB", "x", None]


def test_row_flags(spark):
    df = spark.createDataFrame([("a", "REDACTED"), ("b", None), (None, None)], "p string, q string")
    assert [r[0] for r in df.select(T.row_has_value(["p", "q"])).collect()] == [True, False, False]
    assert [r[0] for r in df.select(T.row_contains(["p", "q"], "RED")).collect()] == [True, False, False]


def test_header_normalisation():
    assert normalize_header(" Agency Sub-Agency ") == "agency_sub_agency"
    assert normalized_names(["OCC", "OCCT", "OCC"]) == ["occ", "occt", "occfam"]
    assert normalized_names(["A", "a", "A"]) == ["a", "a_2", "a_3"]


def test_sql_text_and_column_builders_agree(spark):
    vals = ["12", " 12 ", "12.9", "-12.7", ".5", "1e3", "nan", "*****", "", None, "REDACTED",
            "inf", "1_000", "1.5d", "abc", "99999999999999999999999", " 7 ", "+3"]
    df = one_col(spark, vals)
    exprs = [V.safe_int("x").alias("a"), V.safe_int(F.col("x")).alias("b"),
             V.parse_number("x").alias("c"), V.parse_number(F.col("x")).alias("d")]
    for p in V.COUNT_POLICIES:
        exprs += [V.count_value("x", p).alias(f"{p}_s"), V.count_value(F.col("x"), p).alias(f"{p}_c")]
    for r in df.select(*exprs).collect():
        assert r["a"] == r["b"] and r["c"] == r["d"]
        for p in V.COUNT_POLICIES:
            assert r[f"{p}_s"] == r[f"{p}_c"], (p, r)


def test_safe_int_matches_python_rule(spark):
    """Random numeric-looking texts: Spark's parse equals int(float(x)) on the accepted forms."""
    import math
    import re

    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    pattern = re.compile(V.NUMBER_PATTERN)
    texts = st.one_of(
        st.integers(-10**12, 10**12).map(str),
        st.floats(-1e9, 1e9, allow_nan=False).map(lambda f: f"{f:.3f}"),
        st.floats(-1e6, 1e6, allow_nan=False).map(lambda f: f"{f:e}"),
        st.text(alphabet=" +-.e0123456789_x", max_size=8),
        st.sampled_from(["nan", "*****", "", "REDACTED", " 7 ", "inf"]))

    def expected(v):
        if v in ("", "nan", "*****"):
            return None
        s = v.strip()
        if not pattern.match(s):
            return None
        f = float(s)
        if math.isinf(f) or abs(f) >= 2**63:
            return None
        return int(f)

    seen = []

    @settings(max_examples=300, deadline=None, suppress_health_check=list(HealthCheck))
    @given(texts)
    def collect(v):
        seen.append(v)

    collect()
    df = spark.createDataFrame([(v,) for v in seen], "x string")
    got = [r[0] for r in df.select(V.safe_int("x")).collect()]
    assert got == [expected(v) for v in seen]
