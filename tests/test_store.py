"""The published store and the incremental build, on hand-made files and frames."""

import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from periodlens.plans import incremental as I
from periodlens.sources import store as ST
from periodlens.sources.sinks import WRITE_SALTS, cluster_for_write
from tests.test_sources import write

ROWS = "year int, quarter string, agy string, employment string"


def frame(spark, *periods, n=5, tag="a"):
    return spark.createDataFrame([(y, q, f"{tag}{i}", "1") for y, q in periods for i in range(n)], ROWS)


def held(spark, store, **kw):
    got = ST.read_published(spark, store, **kw).groupBy("year", "quarter", F.substring("agy", 1, 1).alias("tag")).count().collect()
    return {(r["year"], r["quarter"], r["tag"]): r["count"] for r in got}


def test_publish_replaces_only_the_written_periods(spark, tmpdir_path):
    store = os.path.join(tmpdir_path, "a store")
    assert ST.history(spark, store) is None and ST.current(spark, store) == (0, [])
    check = ST.publish(frame(spark, (2016, "March"), (2016, "June")), store).collect()
    assert {(r["quarter"], r["rows_read"], r["rows_written_total"], r["complete"], r["published"]) for r in check} == {
        ("March", 5, 10, True, True), ("June", 5, 10, True, True)}
    wider = frame(spark, (2016, "June"), (2017, "June"), n=3, tag="b").withColumn("pp", F.lit("01"))
    ST.publish(wider, store)
    assert held(spark, store) == {(2016, "March", "a"): 5, (2016, "June", "b"): 3, (2017, "June", "b"): 3}
    back = ST.read_published(spark, store)
    assert set(back.columns) == {"year", "quarter", "agy", "employment", "pp"} and back.where("pp = '01'").count() == 6
    assert held(spark, store, seq=1) == {(2016, "March", "a"): 5, (2016, "June", "a"): 5}
    assert held(spark, store, keep=lambda r: r["year"] == 2017) == {(2017, "June", "b"): 3}
    # only the folders of the state are listed
    files = ST.read_published(spark, store, schema=wider.schema, keep=lambda r: r["quarter"] == "March").inputFiles()
    assert files and all("quarter=March" in f for f in files)
    ST.publish(frame(spark, (2018, "June"), n=1), store, remove=[(2016, "March")])
    assert held(spark, store) == {(2016, "June", "b"): 3, (2017, "June", "b"): 3, (2018, "June", "a"): 1}


def test_a_write_that_fails_its_check_leaves_the_old_state(spark, tmpdir_path):
    store = os.path.join(tmpdir_path, "store")
    ST.publish(frame(spark, (2016, "March")), store)
    before = held(spark, store)
    check = ST.publish(frame(spark, (2016, "March"), n=9, tag="b"), store, verify=lambda back: back.count() < 9).collect()
    assert [(r["rows_read"], r["complete"], r["published"]) for r in check] == [(9, False, False)]
    assert held(spark, store) == before and ST.current(spark, store)[0] == 1


def test_lost_rows_and_a_killed_write_leave_the_old_state(spark, tmpdir_path, monkeypatch):
    store = os.path.join(tmpdir_path, "store")
    ST.publish(frame(spark, (2016, "March")), store)
    before = held(spark, store)

    class Killed(Exception):
        pass

    def kill(_):
        raise Killed
    with pytest.raises(Killed):                       # the data is written, the manifest is not
        ST.publish(frame(spark, (2016, "March"), n=2, tag="c"), store, before_manifest=kill)
    assert held(spark, store) == before
    # a part file goes before the rows are read back
    real = ST.cluster_for_write

    def short(df, parts):
        monkeypatch.setattr(ST, "_checksum", lambda columns: F.lit(len(glob.glob(f"{store}/data/*/*/*/*.parquet"))).cast("decimal(38,0)"))
        return real(df, parts)
    monkeypatch.setattr(ST, "cluster_for_write", short)
    assert not any(r["published"] for r in ST.publish(frame(spark, (2016, "March"), n=4, tag="d"), store).collect())
    monkeypatch.undo()
    assert held(spark, store) == before and ST.current(spark, store)[0] == 1
    ST.publish(frame(spark, (2016, "March"), n=4, tag="d"), store)
    assert held(spark, store) == {(2016, "March", "d"): 4}


def release(base, period, rows, loct):
    d = os.path.join(base, f"Staff_Snapshot_{period}")
    month, year = period.split("_")
    tag = month[:3].upper() + year
    write(os.path.join(d, f"FACTDATA_{tag}.TXT"), "AGYSUB,LOC,EMPLOYMENT\n" + "".join(f"{a},{c},1\n" for a, c in rows))
    write(os.path.join(d, "DTloc.txt"), f"LOC,LOCT\n06,{loct}\n")
    return d


def touch(path):
    later = time.time() + 100
    os.utime(path, (later, later))


def test_only_changed_periods_are_built_again(spark, tmpdir_path):
    base, store = os.path.join(tmpdir_path, "in put"), os.path.join(tmpdir_path, "store")
    dirs = {p: release(base, p, [("VATA", "6"), ("AF02", "6")], p) for p in ("March_2016", "June_2016", "March_2017")}

    def run():
        return {(r["year"], r["quarter"]): (r["action"], r["rows"]) for r in I.build(spark, base, store).collect()}

    def locations():
        rows = ST.read_published(spark, store).groupBy("year", "quarter", "loct").count().collect()
        return {(r["year"], r["quarter"], r["loct"]): r["count"] for r in rows}
    assert run() == {(2016, "March"): ("built", 2), (2016, "June"): ("built", 2), (2017, "March"): ("built", 2)}
    assert locations() == {(2016, "March", "March_2016"): 2, (2016, "June", "June_2016"): 2, (2017, "March", "March_2017"): 2}
    assert set(v[0] for v in run().values()) == {"kept"} and ST.current(spark, store)[0] == 1
    # another time, the same text: nothing to do
    touch(os.path.join(dirs["June_2016"], "DTloc.txt"))
    assert I.plan_build(spark, base, store)[1:] == (set(), set())
    # one code table changes: its period alone is planned, scanned and built
    write(os.path.join(dirs["June_2016"], "DTloc.txt"), "LOC,LOCT\n06,CALIFORNIA\n")
    files, todo, gone = I.plan_build(spark, base, store)
    assert (todo, gone) == ({(2016, "June")}, set())
    scanned = I.changed_snapshots(spark, files, todo).inputFiles()
    assert len(scanned) == 2 and all("June_2016" in f for f in scanned)
    assert run() == {(2016, "March"): ("kept", 2), (2016, "June"): ("built", 2), (2017, "March"): ("kept", 2)}
    assert locations()[(2016, "June", "CALIFORNIA")] == 2 and len(locations()) == 3
    # the same size, another text
    write(os.path.join(dirs["June_2016"], "DTloc.txt"), "LOC,LOCT\n06,CALIFORNIE\n")
    touch(os.path.join(dirs["June_2016"], "DTloc.txt"))
    assert run()[(2016, "June")] == ("built", 2) and locations()[(2016, "June", "CALIFORNIE")] == 2
    # a fact file goes, another comes; a new period
    os.rename(os.path.join(dirs["March_2016"], "FACTDATA_MAR2016.TXT"), os.path.join(dirs["March_2016"], "kept.bak"))
    write(os.path.join(dirs["March_2017"], "FACTDATA_MAR2017_2.TXT"), "AGYSUB,LOC,EMPLOYMENT\nXX00,6,1\n")
    release(base, "June_2018", [("VATA", "6")], "new")
    assert run() == {(2016, "March"): ("removed", 0), (2016, "June"): ("kept", 2), (2017, "March"): ("built", 3), (2018, "June"): ("built", 1)}
    # a refused build changes nothing, and is done at the next run
    write(os.path.join(dirs["June_2016"], "DTloc.txt"), "LOC,LOCT\n06,ELSEWHERE\n")
    got = {(r["year"], r["quarter"]): r["action"] for r in I.build(spark, base, store, verify=lambda back: False).collect()}
    assert set(got.values()) == {"kept"} and locations()[(2016, "June", "CALIFORNIE")] == 2
    assert run()[(2016, "June")] == ("built", 2) and locations()[(2016, "June", "ELSEWHERE")] == 2


def test_a_hot_period_is_written_by_tasks_of_a_bounded_size(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "100KB")
        df = spark.range(0, 200000, 1, 8).select(F.lit(1999).alias("year"), F.lit("March").alias("quarter"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        tasks = cluster_for_write(df, ["year", "quarter"]).groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.max("v"))
        sizes = [r["n"] for r in tasks.collect()]
    finally:
        spark.conf.set(key, before)
    assert sum(sizes) == 200000 and len(sizes) > WRITE_SALTS and max(sizes) < 200000 / WRITE_SALTS
