"""Operators on hand-made frames, checked against brute-force Python."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from periodlens.operators import compare as C
from periodlens.operators import conform as CF
from periodlens.operators import order as O
from periodlens.operators import pivot as PV
from periodlens.operators import profile as PR
from periodlens.operators import quality as Q
from periodlens.operators.denorm import Dim, denormalize
from periodlens.operators.joins import enrich_coalesce, exclude_groups, keep_groups
from periodlens.operators.position import down, exact_median, in_ranges, running_total, top_n, up, with_position

SNAP = "year int, agy string, code string, name string, employment string, salary string, line_no long"


def snap(spark, rows):
    return spark.createDataFrame(rows, SNAP)


def test_with_position_matches_sorted_order(spark):
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 50), f"k{i:04d}", rnd.choice(["a", "b", "c"])) for i in range(3000)]
    df = spark.createDataFrame(rows, "v int, k string, g string").repartition(7)
    want = {k: i + 1 for i, (v, k, g) in enumerate(sorted(rows, key=lambda r: (-r[0], r[1])))}
    got = {r["k"]: r["rank"] for r in with_position(df, [down("v"), "k"], "rank").collect()}
    assert got == want
    got_g = {r["k"]: r["pos"] for r in with_position(df, ["v", "k"], "pos", partition_by="g").collect()}
    for g in "abc":
        part = sorted([r for r in rows if r[2] == g], key=lambda r: (r[0], r[1]))
        assert all(got_g[r[1]] == i + 1 for i, r in enumerate(part))


def test_with_position_keeps_null_groups_and_null_keys(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice([None, 1, 2, 3]), i, rnd.choice([None, "a"])) for i in range(700)]
    df = spark.createDataFrame(rows, "v int, k int, g string").repartition(6)
    got = {r["k"]: r["rank"] for r in with_position(df, [down("v"), up("k")], partition_by=["g"]).collect()}
    assert len(got) == len(rows) and dict(with_position(df, ["k"]).dtypes)["rank"] == "bigint"
    for g in (None, "a"):
        part = sorted((r for r in rows if r[2] == g), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
        assert [got[r[1]] for r in part] == list(range(1, len(part) + 1))
    assert with_position(df.limit(0), ["k"]).count() == 0


def test_ranges_are_balanced_on_repeated_keys(spark):
    """300 groups with the same 2,000 keys, and one key in all rows: no range has over 2 / 255 of the rows."""
    for key in (F.col("id") % 2000, F.lit(7)):
        df = spark.range(600_000).select("id", (F.col("id") / 2000).cast("int").alias("g"), key.alias("k"))
        rows, _ = in_ranges(df, ["k"], F.lit(1), ["g"])
        sizes = [r["count"] for r in rows.groupBy("range").count().collect()]
        assert len(sizes) > 250 and sum(sizes) == 600_000 and max(sizes) <= 2 * 600_000 / 255
        got = with_position(df, ["k"], "pos", partition_by="g").groupBy("g").agg(
            F.countDistinct("pos").alias("n"), F.min("pos").alias("lo"), F.max("pos").alias("hi")).distinct().collect()
        assert {(r["n"], r["lo"], r["hi"]) for r in got} == {(2000, 1, 2000)}


def test_exact_median_between_and_on_ties(spark):
    """Medians of many sizes, with ties at the bracket, of negative and of fractional values."""
    rng = random.Random(3)
    rows = []
    for g in range(40):
        n = rng.randrange(1, 400)
        rows += [(g, float(rng.choice([rng.randrange(-5, 5), rng.random()]))) for _ in range(n)]
    rows += [(99, float(i)) for i in range(60_001)] + [(98, float(i % 3)) for i in range(50_000)] + [(97, 1.0), (97, 2.0)]
    rows += [(96, None)]
    df = spark.createDataFrame(rows, "g int, v double").repartition(6)
    want = {g: statistics.median(v for h, v in rows if h == g) for g in {r[0] for r in rows} - {96}}
    assert {r["g"]: r["m"] for r in exact_median(df, "v", "g", "m").collect()} == want
    assert exact_median(df.where("g = 96"), "v", name="m").first()["m"] is None


def test_running_total_and_exact_median(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice(["x", "y", None]), rnd.randint(-50, 50)) for _ in range(901)] + [("z", None)]
    df = spark.createDataFrame(rows, "g string, v int")
    import statistics
    want = {g: float(statistics.median(v for h, v in rows if h == g and v is not None)) for g in ("x", "y", None)}
    assert {r["g"]: r["m"] for r in exact_median(df, "v", "g", "m").collect()} == want
    one = exact_median(df, "v", name="m").first()["m"]
    assert one == float(statistics.median(v for _, v in rows if v is not None))
    ids = spark.range(1000).repartition(5)
    assert [r["t"] for r in running_total(ids, ["id"], F.col("id"), "t").orderBy("id").collect()] == [
        i * (i + 1) // 2 for i in range(1000)]


def test_top_n_ranks(spark):
    df = spark.createDataFrame([(i % 13, f"k{i}") for i in range(100)], "v int, k string")
    got = [(r["rank"], r["k"]) for r in top_n(df, [down("v"), "k"], 3).orderBy("rank").collect()]
    assert got == [(1, "k12"), (2, "k25"), (3, "k38")]


def test_comparison_table_specials_and_total(spark):
    rows = [(2024, "A", "X", "X-name", "1", None, 1), (2024, "A", "Y", None, "1", None, 2),
            (2025, "A", "X", "REDACTED", "1", None, 3), (2025, "A", "X", "X-new", "1", None, 4),
            (2025, "B", "REDACTED", "REDACTED", "REDACTED", None, 5), (2025, "B", "Z", "Z-name", "*****", None, 6),
            (2025, "B", None, "n", "1", None, 7)]
    df = snap(spark, rows)
    b, a = F.col("year") == 2024, F.col("year") == 2025
    out = {r["code"]: r for r in C.comparison_table(df, "code", b, a, text="name").collect()}
    # first name of the newer period is REDACTED (invalid) → older period's name
    assert out["X"]["category"] == "X-name"
    assert (out["X"]["before"], out["X"]["after"], out["X"]["pct_change"]) == (1, 2, 100.0)
    assert out["Y"]["category"] == "Y" and out["Y"]["pct_change"] == -100.0
    assert out["Z"]["after"] == 1 and out["Z"]["pct_change"] == 100.0   # '*****' imputes 1
    assert out["TOTAL"]["before"] == 2 and out["TOTAL"]["after"] == 4
    ranks = sorted((r["rank"], r["code"]) for r in out.values())
    assert [c for _, c in ranks][-2:] == ["REDACTED", "TOTAL"]
    assert None not in out


def test_comparison_total_pct_zero_base(spark):
    df = snap(spark, [(2025, "A", "X", None, "1", None, 1)])
    out = {r["code"]: r for r in C.comparison_table(df, "code", F.col("year") == 2024,
                                                     F.col("year") == 2025).collect()}
    assert out["X"]["pct_change"] == 100.0 and out["TOTAL"]["pct_change"] == 0.0


def test_domain_order(spark):
    labels = ["20-24", "REDACTED", "Less than 20", "zzz", "65 or more"]
    df = snap(spark, [(2025, "A", lab, None, "1", None, i) for i, lab in enumerate(labels)])
    out = C.comparison_table(df, "code", F.col("year") == 2024, F.col("year") == 2025,
                             order="domain", domain=O.AGE_ORDER)
    got = [r["code"] for r in out.orderBy("rank").collect()]
    assert got == ["Less than 20", "20-24", "65 or more", "REDACTED", "zzz", "TOTAL"]


def test_compare_full_outer_semantics(spark):
    df = snap(spark, [(2024, "A", "X", None, "1", None, 1), (2025, "A", "Y", None, "2", None, 2),
                      (2025, "A", "X", None, "x", None, 3)])
    out = {r["category"]: (r["before"], r["after"], r["pct_change"]) for r in
           C.compare_full(df, "code", F.col("year") == 2024, F.col("year") == 2025).collect()}
    assert out == {"X": (1, 0, -100.0), "Y": (0, 2, 100.0)}


def test_name_map_precedence(spark):
    df = snap(spark, [(2024, "A", "C1", "old", "1", None, 1), (2025, "A", "C1", "", "1", None, 2),
                      (2025, "A", "C2", "new2", "1", None, 3), (2024, "A", "C2", "old2", "1", None, 4),
                      (2024, "A", "C3", "REDACTED", "1", None, 5)])
    out = {r["code"]: r["name"] for r in C.name_map(df, "code", "name", F.col("year") == 2024,
                                                    F.col("year") == 2025).collect()}
    assert out == {"C1": "old", "C2": "new2", "C3": "C3"}


def test_compare_left_last_prior_wins(spark):
    st = spark.createDataFrame([("202503", "A", 10, 1), ("202503", "B", 5, 2), ("202409", "A", 7, 3),
                                ("202409", "A", 8, 4), ("202409", "C", 9, 5), ("202503", None, 1, 6),
                                ("202409", None, 2, 7)],
                               "DATECODE string, K string, EMPCOUNT long, line_no long")
    out = {r["K"]: r for r in C.compare_left(st, "DATECODE", "202503", "202409", line="line_no").collect()}
    assert set(out) == {"A", "B", None}
    assert out["A"]["prior_count"] == 8 and out["A"]["change"] == 2
    assert out["B"]["prior_count"] == 0 and out["B"]["pct_change"] == 100.0
    assert out[None]["prior_count"] == 2
    assert out["A"]["rank"] == 1
    full = {r["K"]: r for r in C.compare_left(st, "DATECODE", "202503", "202409", line="line_no",
                                               how="full").collect()}
    assert set(full) == {"A", "B", "C", None}
    assert (full["C"]["current_count"], full["C"]["prior_count"], full["C"]["pct_change"]) == (0, 9, -100.0)


def test_availability_rows(spark):
    df = snap(spark, [(2024, "A", "X", None, "1", "100", 1), (2024, "A", "X", None, "1", "*****", 2),
                      (2025, "A", "X", None, "1", "REDACTED", 3), (2025, "A", "X", None, "1", None, 4),
                      (2025, "A", "X", None, "1", "5", 5)])
    out = {r["status"]: r for r in C.availability(df, "salary", F.col("year") == 2024,
                                                  F.col("year") == 2025).collect()}
    assert (out["Total Records"]["before"], out["Total Records"]["after"]) == (2, 3)
    assert (out["Salary Available"]["before"], out["Salary Available"]["after"]) == (1, 1)
    assert out["Salary Redacted"]["pct_change"] == 100.0       # zero base, redacted row
    assert out["Salary Missing/Blank"]["after"] == 1


def test_exclude_keeps_null_keys(spark):
    df = snap(spark, [(2025, "A", "X", "REDACTED", "1", None, 1), (2025, None, "X", "n", "1", None, 2),
                      (2025, "B", "X", "n", "1", None, 3)])
    flagged = C.flagged_groups(df, "agy", "name")
    kept = sorted((r["agy"] or "-") for r in exclude_groups(df, flagged, "agy").collect())
    assert kept == ["-", "B"]
    assert [r["agy"] for r in keep_groups(df, flagged, "agy").collect()] == ["A"]


def test_keep_first_and_duplicate_report(spark):
    rows = [("k1", 3, "c"), ("k1", 1, "a"), ("k2", 2, "b"), ("k1", 2, "bb")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    assert {(r.k, r.o, r.v) for r in PR.keep_first(df, "k", "o").collect()} == {("k1", 1, "a"), ("k2", 2, "b")}
    rep = {(r.o, r.kept, r.n_records) for r in PR.duplicate_report(df, "k", "o").collect()}
    assert rep == {(1, True, 3), (2, False, 3), (3, False, 3)}


def test_denormalize_dedupes_and_keeps_row_count(spark):
    fact = spark.createDataFrame([("P1", "01"), ("P1", "02"), ("P1", "09"), ("P2", "01"), ("P1", None)],
                                 "dataset_key string, loc string")
    dim = spark.createDataFrame([("P1", " 01", "ONE", 1), ("P1", "01", "UNO", 2), ("P1", "02", "TWO", 3),
                                 ("P2", "01", "EINS", 4)],
                                "dataset_key string, loc string, loct string, line_no long")
    spec = Dim("loc", dim, ("dataset_key", "loc"), ("dataset_key", "loc"), ("loct",), order="line_no")
    out = denormalize(fact, [spec])
    got = sorted(((r.dataset_key, r.loc, r.loct) for r in out.collect()), key=str)
    assert len(got) == 5
    assert ("P1", "01", "ONE") in got and ("P2", "01", "EINS") in got and ("P1", "09", None) in got


def test_denormalize_skips_absent_key_and_rejects_clash(spark):
    fact = spark.createDataFrame([("P1", "x")], "dataset_key string, other string")
    dim = spark.createDataFrame([("P1", "01", "ONE")], "dataset_key string, loc string, loct string")
    spec = Dim("loc", dim, ("dataset_key", "loc"), ("dataset_key", "loc"), ("loct",), unique=True)
    assert denormalize(fact, [spec]).columns == ["dataset_key", "other"]
    fact2 = spark.createDataFrame([("P1", "01", "t")], "dataset_key string, loc string, loct string")
    with pytest.raises(ValueError):
        denormalize(fact2, [spec])


def test_enrich_coalesce(spark):
    rows = spark.createDataFrame([("10", "abbr"), ("99", "other")], "toa string, toat string")
    desc = spark.createDataFrame([("10", "FULL TEN")], "toa string, toat_full string")
    got = {r.toa: r.shown for r in enrich_coalesce(rows, desc, "toa", "toat_full", "shown", "toat").collect()}
    assert got == {"10": "FULL TEN", "99": "other"}


def test_transition_matrix_and_totals(spark):
    df = snap(spark, [(2023, "A", "X", None, "1", None, 1), (2024, "A", "X", None, "1", None, 2),
                      (2024, "A", "X", None, "1", None, 3), (2025, "A", "Y", None, "1", None, 4)])
    tr = [("a", 2023, 2024), ("b", 2024, 2025)]
    m = {r["code"]: r for r in PV.transition_matrix(df, "code", tr).collect()}
    assert (m["X"]["a_before"], m["X"]["a_after"], m["X"]["a_pct"]) == (1, 2, 100.0)
    assert (m["Y"]["b_before"], m["Y"]["b_after"], m["Y"]["b_pct"]) == (0, 1, 100.0)
    assert (m["Y"]["a_before"], m["Y"]["a_pct"]) == (0, 0.0)
    t = {r["period"]: (r["before"], r["after"]) for r in PV.period_totals(df, tr).collect()}
    assert t == {"a": (1, 2), "b": (2, 1)}


def test_quality_checks(spark):
    df = spark.createDataFrame([("2015_March", 2015, "March", "1", None, "x"),
                                ("2015_March", 2015, "March", "2", None, "y"),
                                ("2017_March", 2017, "March", None, "T", "z")],
                               "dataset_key string, year int, quarter string, employment string, "
                               "payplant string, agelvlt string")
    cm = {r.dataset_key: r.non_constant for r in Q.constant_measure(df).collect()}
    assert cm == {"2015_March": 1, "2017_March": 1}
    nr = {(r.dataset_key, r.field): r.severity for r in Q.null_rates(df).collect()}
    assert nr[("2015_March", "payplant")] == "warn" and nr[("2017_March", "payplant")] == "ok"
    mf = {(r.dataset_key, r.field) for r in Q.merge_failures(df).collect()}
    assert mf == {("2015_March", "payplant")}
    v = {r.dataset_key: r.valid for r in Q.verdict(df).collect()}
    assert v == {"2015_March": False, "2017_March": True}
    gaps = {(r.year, r.quarter) for r in Q.calendar_gaps(df).collect()}
    assert ("2016", "June") not in gaps and (2016, "June") in gaps and (2015, "March") not in gaps
    assert len(gaps) == 12 - 2
    req = {(r.dataset_key, r.column_name): r.severity for r in Q.required_columns(df).collect()}
    assert req[("2015_March", "employment")] == "ok" and req[("2015_March", "occt")] == "warn"


def test_pair_order(spark):
    st = spark.createDataFrame([("A", "x", 3), ("A", "y", 2), ("B", "y", 5), ("B", "x", 1), ("C", "x", 1)],
                               "d string, k string, n long")
    r = Q.pair_order(st, "d", "A", "B", ["k"], [down("n"), "k"]).first()
    assert (r.n_first, r.n_second, r.mismatches, r.result) == (2, 2, 2, "mismatch")
    r = Q.pair_order(st, "d", "A", "C", ["k"], [down("n"), "k"]).first()
    assert r.result == "count mismatch"


def test_conform_and_union(spark):
    df = spark.createDataFrame([("a", "b", "c")], "AGY string, STATET string, EXTRA string")
    out = CF.conform(CF.rename_columns(df, CF.ALTERNATE_RENAMES), ["agy", "loct", "occ"])
    assert out.columns == ["agy", "loct", "occ"] and out.first()["occ"] == ""
    u = CF.union_by_name([spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(2, "x")], "a int, b string")])
    assert sorted((r.a, r.b) for r in u.collect()) == [(1, None), (2, "x")]
    al = CF.add_aliases(spark.createDataFrame([("F",)], "worksch string"))
    assert al.columns == ["worksch", "wrksch"]


def test_numeric_aware_and_known_first(spark):
    df = spark.createDataFrame([("a", "1,200"), ("b", "+5%"), ("c", "n/a"), ("d", "30")], "k string, v string")
    got = [r.k for r in O.rank_numeric_aware(df, "v", descending=True).orderBy("rank").collect()]
    assert got == ["a", "d", "b", "c"]
    kf = [r.k for r in O.rank_known_first(df, "k", ["d", "b"]).orderBy("rank").collect()]
    assert kf == ["d", "b", "a", "c"]


def test_sample_is_repeatable(spark):
    df = spark.createDataFrame([(i,) for i in range(500)], "id long")
    a = [r.id for r in O.sample_rows(df, 5, 42, ["id"]).collect()]
    b = [r.id for r in O.sample_rows(df.repartition(5), 5, 42, ["id"]).collect()]
    assert len(a) == 5 and sorted(a) == sorted(b)


def test_numeric_summary_exact_median(spark):
    vals = ["10", "20", "30", "40", "REDACTED", None]
    df = spark.createDataFrame([(v,) for v in vals], "salary string")
    r = PR.numeric_summary(df).first()
    assert (r.n_valid, r.mean_value, r.median_value, r.min_value, r.max_value) == (4, 25.0, 25.0, 10, 40)


def test_standalone_orderings(spark):
    df = spark.createDataFrame([("TOTAL", 9), ("b", 5), ("REDACTED", 7), ("a", 5), ("65 or more", 1),
                                ("20-24", 2)], "k string, n long")
    sp = [r.k for r in O.rank_specials_last(df, "k", "n").orderBy("rank").collect()]
    assert sp == ["a", "b", "20-24", "65 or more", "REDACTED", "TOTAL"]
    dom = [r.k for r in O.rank_domain(df, "k", O.AGE_ORDER).orderBy("rank").collect()]
    assert dom == ["20-24", "65 or more", "REDACTED", "TOTAL", "a", "b"]


def test_rejected_files(spark):
    from periodlens.sources.files import with_period
    from periodlens.sources.sinks import rejected_files
    df = spark.createDataFrame([("/x/FACTDATA_SEP2016.TXT",), ("/x/FACTDATA_XYZ2016.TXT",), ("/x/notes.txt",)],
                               "source_file string")
    bad = {r.source_file for r in rejected_files(with_period(df)).collect()}
    assert bad == {"/x/FACTDATA_XYZ2016.TXT", "/x/notes.txt"}


def test_comparison_exclude_matches_anti_join(spark):
    rows = [(2024, "A", "X", "x-old", "1", None, 1), (2025, "A", "X", "x-new", "1", None, 2),
            (2025, "A", None, "REDACTED", "1", None, 3),          # flag on a row without a code
            (2024, "B", "X", "bx", "1", None, 4), (2025, "B", "Y", "REDACTED", "2", None, 5),
            (2025, None, "Y", "y-new", "1", None, 6), (2024, None, "Z", "REDACTED", "1", None, 7),
            (2025, "C", "Z", "z", "*****", None, 8), (2024, "C", "Y", "y-old", "1", None, 9)]
    df = snap(spark, rows)
    b, a = F.col("year") == 2024, F.col("year") == 2025
    # the flag field here is the text column itself: rows whose name is REDACTED in 2025
    one_pass = C.comparison_table(df, "code", b, a, text="name", exclude=("agy", "name"))
    flagged = C.flagged_groups(df.where(a), "agy", "name")
    two_pass = C.comparison_table(exclude_groups(df, flagged, "agy"), "code", b, a, text="name")
    got = sorted(tuple(r) for r in one_pass.collect())
    want = sorted(tuple(r) for r in two_pass.collect())
    assert got == want
    assert {r.code for r in one_pass.collect()} == {"Y", "Z", "TOTAL"}   # groups A and B are gone


def test_availability_exclude_matches_anti_join(spark):
    rows = [(2024, "A", "X", "n", "1", "100", 1), (2025, "A", "X", "REDACTED", "1", "REDACTED", 2),
            (2024, "B", "X", "n", "1", "*****", 3), (2025, "B", "X", "n", "1", "7", 4),
            (2025, None, "X", "REDACTED", "1", None, 5)]
    df = snap(spark, rows)
    b, a = F.col("year") == 2024, F.col("year") == 2025
    one = {r.status: tuple(r) for r in C.availability(df, "salary", b, a, exclude=("agy", "name")).collect()}
    flagged = C.flagged_groups(df.where(a), "agy", "name")
    two = {r.status: tuple(r) for r in C.availability(exclude_groups(df, flagged, "agy"), "salary", b, a).collect()}
    assert one == two and one["Total Records"][2:4] == (1, 2)


def test_quality_is_judged_on_exact_counts(spark):
    """At 2.3 million rows one non-null value is no merge failure, and one null is worth a note."""
    rows = spark.range(2_300_000).select(
        F.lit("2025_March").alias("dataset_key"), F.lit("March").alias("quarter"), F.lit(2025).alias("year"),
        F.lit("1").alias("employment"), F.when(F.col("id") == 0, "x").alias("loct"),
        F.when(F.col("id") > 0, "x").alias("toat"))
    rates = {r["field"]: r["severity"] for r in Q.null_rates(rows).collect()}
    assert rates == {"loct": "warn", "toat": "info"}
    assert Q.merge_failures(rows).count() == 0
    assert Q.verdict(rows).first()["valid"]


def test_keep_first_keeps_null_keys(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), (None, 5, "z"), (None, 4, "w")], "k string, o int, t string")
    assert {(r["k"], r["t"]) for r in PR.keep_first(df, "k", "o").collect()} == {("a", "y"), (None, "w")}


def test_subtotals_in_one_aggregation(spark):
    rows = [("1", "a", "x"), ("2", "a", None), ("REDACTED", "b", "x"), ("4", None, "y"), ("5", "b", "x")]
    df = spark.createDataFrame(rows, "employment string, k string, m string")
    got = sorted(map(tuple, PV.subtotals(df, ["k", "m"]).collect()), key=str)
    assert got == sorted([("a", "x", 0, 1), ("a", None, 0, 2), ("b", "x", 0, 5), (None, "y", 0, 4), ("a", "TOTAL", 1, 3), ("b", "TOTAL", 1, 5),
                          (None, "TOTAL", 1, 4), ("TOTAL", "TOTAL", 2, 12)], key=str)
    only = PV.subtotals(df, ["k", "m"], sets=[("m",)]).collect()
    assert {(r["k"], r["m"], r["level"], r["headcount"]) for r in only} == {("TOTAL", "x", 1, 6), ("TOTAL", "y", 1, 4), ("TOTAL", None, 1, 2)}
    plan = PV.subtotals(df, ["k", "m"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Expand") == 1


def test_aggregate_kept_groups_scans_once(spark):
    from periodlens.operators.joins import aggregate_kept_groups
    rows = [("a", 1, "REDACTED"), ("a", 1, "x"), ("a", 2, None), ("b", 1, None), (None, 1, "REDACTED"), ("c", 3, "REDACTED")]
    df = spark.createDataFrame(rows, "g string, y int, v string")
    out = aggregate_kept_groups(df, "g", F.col("v") == "REDACTED", "y", [F.count(F.lit(1)).alias("n")])
    assert out._jdf.queryExecution().executedPlan().toString().count("Scan") == 1      # before it runs
    assert sorted(map(tuple, out.collect())) == [("a", 1, 2), ("a", 2, 1), ("c", 3, 1)]
    flagged = df.where("v = 'REDACTED' and g is not null").select("g")
    want = keep_groups(df, flagged, "g").groupBy("g", "y").agg(F.count(F.lit(1)).alias("n"))
    assert sorted(map(tuple, want.collect())) == sorted(map(tuple, out.collect()))
