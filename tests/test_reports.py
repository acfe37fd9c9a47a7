"""Composed reports on the adapter table: they run end to end and keep their invariants."""

import os

import pytest
from pyspark.sql import functions as F

from periodlens.plans import reports as R
from periodlens.sources.tables import snapshot_facts

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def snap(spark):
    return snapshot_facts(spark, SF)


def test_age_comparison_excluding(snap):
    b, a = F.col("year") == 1996, F.col("year") == 1997
    table, excluded = R.age_comparison_excluding(snap, b, a)
    rows = table.collect()
    assert rows and "REDACTED" not in {r.code for r in rows}        # redacting agencies are gone
    total = [r for r in rows if r.code == "TOTAL"][0]
    assert total.rank == len(rows)
    assert total.before == sum(r.before for r in rows if r.code != "TOTAL")
    labels = [r.label for r in excluded.collect()]
    assert all(" (" in lab and lab.endswith(")") for lab in labels)


def test_appointment_and_redacted_sample(snap):
    b, a = F.col("year") == 1996, F.col("year") == 1997
    rows = R.appointment_comparison(snap, b, a).orderBy("rank").collect()
    assert rows[-1].code == "TOTAL" and rows[0].after >= rows[1].after
    sample = R.redacted_sample(snap, a).collect()
    assert 0 < len(sample) <= 5
    again = R.redacted_sample(snap, a).collect()
    assert sorted(map(str, sample)) == sorted(map(str, again))


def test_transition_analysis_kinds(snap):
    tr = [("t1", 1996, 1997), ("t2", 1997, 1998)]
    m, totals, extra = R.transition_analysis(snap, tr, kind="appointment", period_col="year")
    assert {"category", "t1_before", "t2_pct"} <= set(m.columns)
    t = {r.period: r for r in totals.collect()}
    assert t["t1"].after == t["t2"].before                          # same middle period
    assert all(": " in r.label for r in extra.collect())
    m2, _, split = R.transition_analysis(snap, tr, kind="grade", period_col="year")
    assert split.where("is_top").count() == min(50, split.count())


def test_agency_trend_with_descriptions(snap):
    desc = snap.where(F.col("year") == 2001).select("toa", F.col("toat").alias("toat_full"))
    sub = snap.groupBy("agysub").count().orderBy(F.desc("count"), "agysub").first().agysub
    trend, by_toa, classes, split = R.agency_trend(snap, sub, desc)
    assert trend.count() > 0
    assert {r.appt_class for r in classes.collect()} <= {"Permanent", "Nonpermanent", "Other"}
    s = split.collect()
    assert all(r.total == r.nonpermanent + r.not_nonpermanent for r in s)
    m = R.appointment_matrix(by_toa)
    periods = [c for c in m.columns if c not in ("toa", "toat_display", "rank")]
    chrono = sorted(by_toa.select("period", "sort_key").distinct().collect(), key=lambda r: r.sort_key)
    assert periods == [r.period for r in chrono]
    rows = m.collect()
    assert sum(sum(r[p] for p in periods) for r in rows) == by_toa.agg(F.sum("employment")).first()[0]


def test_examples_and_validation(snap):
    ex = R.examples_battery(snap)
    assert ex["top_agencies"].count() <= 10
    assert ex["salary_summary"].first().n_valid > 0
    v = R.validation_run(snap)
    assert v["overall"].first().snapshots == snap.select("dataset_key").distinct().count()
    assert v["calendar"].count() >= 0
