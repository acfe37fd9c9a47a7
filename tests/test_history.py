"""Partial aggregates, sketches, validity intervals and the text index, on hand-made frames."""

import os

from pyspark.sql import functions as F

from periodlens.operators import partials as PA
from periodlens.operators import pivot as PV
from periodlens.operators import textindex as TI
from periodlens.operators import validity as V
from periodlens.sources import store as ST

FACTS = "year int, quarter string, agy string, agysub string, agysubt string, toa string, toat string, employment string, salary string"


def facts(spark, rows):
    return spark.createDataFrame([(y, q, a[:1], a, f"{a}-name", t, tt, e, s) for y, q, a, t, tt, e, s in rows], FACTS)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


ROWS = [(2016, "March", "VA", "1", "x NONPERMANENT", "1", "10"), (2016, "March", "VA", "1", "x NONPERMANENT", "REDACTED", "nan"),
        (2016, "March", "AF", "2", "PERMANENT", "07", "30"), (2016, "June", "AF", None, None, None, None),
        (2016, "June", "AF", "2", "PERMANENT", "2.5", "*****"), (2017, "March", "XX", "1", "y", "x", "5")]


def test_reports_from_partials_equal_those_from_facts(spark, tmpdir_path):
    store = os.path.join(tmpdir_path, "store")
    full = facts(spark, ROWS)
    ST.publish(full, store)
    assert PA.refresh(spark, store) == [(2016, "June"), (2016, "March"), (2017, "March")]
    p = PA.read_partials(spark, store)
    digits = dict(measure="emp_digits", policy="summed")
    assert rows_of(PV.period_trend(p, **digits)) == rows_of(PV.period_trend(full))
    assert rows_of(PV.period_trend(p, extra_keys=("toa", "toat"), **digits)) == rows_of(PV.period_trend(full, extra_keys=("toa", "toat")))
    assert rows_of(PV.class_trend(p, **digits)) == rows_of(PV.class_trend(full))
    assert rows_of(PV.multi_period_sql(spark, p, measure="emp_int")) == rows_of(PV.multi_period_sql(spark, full))
    transitions = [("t", 2016, 2017)]
    assert rows_of(PV.period_totals(p, transitions, "emp_skip", "summed")) == rows_of(PV.period_totals(full, transitions))
    assert rows_of(PA.mean_value(p, "agysub")) == [("AF", 3, 1, 30.0), ("VA", 2, 1, 10.0), ("XX", 1, 1, 5.0)]
    # no fact file is read for a report
    assert all("/partials/" in f for f in PV.period_trend(p, **digits).inputFiles())


def test_only_changed_periods_are_summed_again(spark, tmpdir_path, monkeypatch):
    store = os.path.join(tmpdir_path, "store")
    ST.publish(facts(spark, ROWS), store)
    PA.refresh(spark, store)
    assert PA.refresh(spark, store) == []
    seen = []
    real = PA.period_partials
    monkeypatch.setattr(PA, "period_partials", lambda f, *a: seen.extend(f.inputFiles()) or real(f, *a))
    ST.publish(facts(spark, [(2016, "June", "AF", "2", "PERMANENT", "40", "1")]), store, remove=[(2017, "March")])
    # a report before the refresh still shows the old state
    trend = lambda: {r["period"]: r["employment"] for r in PV.period_trend(
        PA.read_partials(spark, store), measure="emp_digits", policy="summed").collect()}
    assert trend() == {"March 2016": 8, "June 2016": 0, "March 2017": 0}
    assert PA.refresh(spark, store) == [(2016, "June")]
    assert seen and all("quarter=June" in f for f in seen)
    assert trend() == {"March 2016": 8, "June 2016": 40}
    ST.publish(facts(spark, ROWS).limit(0), store, remove=[(2016, "June")])
    assert PA.refresh(spark, store) == [] and trend() == {"March 2016": 8}


def test_sketches_over_any_set_of_periods(spark):
    """50,000 and 60,000 values a period: far above a sketch's entries, so estimates, not counts."""
    a = spark.range(0, 50_000).select(F.lit(2016).alias("year"), F.lit("March").alias("quarter"), F.col("id").alias("v"))
    b = spark.range(20_000, 80_000).select(F.lit(2016).alias("year"), F.lit("June").alias("quarter"), F.col("id").alias("v"))
    c = spark.range(70_000, 70_100).select(F.lit(2017).alias("year"), F.lit("June").alias("quarter"), F.col("id").alias("v"))
    null = c.limit(3).withColumn("v", F.lit(None).cast("long"))
    sketches = PA.period_sketches(a.unionByName(a).unionByName(b).unionByName(c).unionByName(null), ["v"])
    assert sketches.count() == 3
    years = PA.distinct_over(sketches, "year")
    n = {r["year"]: r["n_estimated"] for r in years.collect()}
    assert abs(n[2016] - 80_000) <= 80_000 * PA.relative_error() and n[2017] == 100
    later = years.withColumn("year", F.col("year") - 1)
    gone = {r["year"]: r["n_vanished"] for r in PA.vanished(years, later, ["year", "field"]).collect()}
    assert abs(gone[2016] - 79_900) <= 80_000 * PA.relative_error() and gone[2017] == 100


def test_intervals_and_as_of(spark):
    rows = [("A", 1, "x"), ("A", 2, "x"), ("A", 4, "x"), ("A", 5, "y"), ("A", 7, "x"), ("B", 3, "z"), ("C", 6, None), (None, 2, "n"), ("D", None, "d")]
    df = spark.createDataFrame([(c, p, t, i) for i, (c, p, t) in enumerate(rows)] + [("A", 1, "second", 99)], "c string, p int, t string, line int")
    spans = V.intervals(V.first_texts(df, "c", "t", "p", "line"), df.where("p is not null").select(F.col("p").alias("period")))
    assert rows_of(spans) == [("A", "x", 1, 2, 2), ("A", "x", 4, 4, 1), ("A", "x", 7, 7, 1), ("A", "y", 5, 5, 1), ("B", "z", 3, 3, 1)]
    asked = [(c, p) for c in ("A", "B", "C", None) for p in (1, 3, 5, 6, 9)] + [("A", 9)]
    got = V.as_of(spark.createDataFrame(asked, "code string, period int"), spans).collect()
    assert len(got) == len(asked)
    named = {(r["code"], r["period"]): (r["name"], r["how"]) for r in got}
    assert [named["A", p] for p in (1, 3, 5, 6, 9)] == [("x", "current"), ("x", "carried"), ("y", "current"), ("y", "carried"), ("x", "carried")]
    assert [named["B", p] for p in (1, 3, 5)] == [("z", "later"), ("z", "current"), ("z", "carried")]
    assert {named[c, 1] for c in ("C", None)} == {(None, "unknown")}


def test_indexed_search_reads_only_files_that_can_match(spark, tmpdir_path):
    rows = [(i, f"{'alpha beta' if i % 4 == 0 else 'gamma'} {i}", None if i % 3 else "Delta É") for i in range(80)]
    path, index = os.path.join(tmpdir_path, "some rows"), os.path.join(tmpdir_path, "index")
    df = spark.createDataFrame(rows, "id long, a string, `b.c` string")
    df.repartitionByRange(8, F.col("id") % 4, "id").write.parquet(path)
    TI.build_index(spark, path, index, df.columns)

    def scan(term):
        return sorted(r[0] for r in rows if term.lower() in " ".join(str(x) for x in r if x is not None).lower())
    for term in ("alpha", "A B", "delta é", "GAMMA 1", "ta de", "zz", "nothing", "1", ""):
        assert sorted(r["id"] for r in TI.search(spark, path, index, term, df.columns).collect()) == scan(term), term
    all_files = len(spark.read.parquet(path).inputFiles())
    found = TI.search(spark, path, index, "alpha", df.columns)
    assert 0 < len(found.inputFiles()) <= all_files / 2
    assert TI.candidate_files(spark, index, "nothing") == [] and TI.candidate_files(spark, index, "no") is None
