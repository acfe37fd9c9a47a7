"""File round trips on hand-made files written to a fresh temp dir."""

import os
import random

from pyspark.sql import functions as F

from periodlens.plans import reports as R
from periodlens.sources import files as S
from periodlens.sources import records
from periodlens.sources import sinks as K


def write(path, text, encoding="latin-1"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as fh:
        fh.write(text)
    return path


def make_history(base):
    """Two periods with drifting headers, padded codes, sentinels and lookup edge rows."""
    d1 = os.path.join(base, "Staff_Snapshot_September_2016")
    d2 = os.path.join(base, "Staff_Snapshot_March_2017")
    f1 = write(os.path.join(d1, "FACTDATA_SEP2016.TXT"),
               "AGYSUB,LOC,AGELVL,SALARY,EMPLOYMENT,OCC,OCC\r\n"
               "VATA,6,E, 50000 ,1,0610,06\r\n"
               "VATA,06,E,*****,1,0610,06\r\n"
               "AF02,11,F,,1,9999,99\r\n"
               "AF02,11,,nan,1,0610,06\r\n")
    f2 = write(os.path.join(d2, "FACTDATA_MAR2017.TXT"),
               "agysub,loc,agelvl,salary,employment,pp\n"
               "VATA,06,E,60000,1,01\n"
               "\"VA,TB\",6,Z,70000,1,01\n")
    lk = {
        "DTloc": [write(os.path.join(d1, "DTloc.txt"), "LOC,LOCT\n06,CALIFORNIA\n6,WRONG\n11,DISTRICT\n"),
                  write(os.path.join(d2, "DTloc.txt"), "LOC,LOCT\n06,CALIFORNIA-17\n")],
        "DTagelvl": [write(os.path.join(d1, "DTagelvl.txt"), "AGELVL,AGELVLT\nE,40-44\nE,DUPLICATE\n F ,45-49\n"),
                     write(os.path.join(d2, "DTagelvl.txt"), "AGELVL,AGELVLT\nE,40-44\n")],
        "DTagy": [write(os.path.join(d1, "DTagy.txt"),
                        "AGYSUB,AGY,AGYSUBT\nVATA,VA,VATA-VETERANS HEALTH\nAF02,AF,AF02-AIR FORCE X\n")],
    }
    return [f1, f2], lk


def test_a_filter_on_the_period_does_not_parse_the_path_again(spark, tmpdir_path):
    write(os.path.join(tmpdir_path, "March_1999", "a.txt"), "AGYSUB,LOC\nx,1\ny,2\n")
    write(os.path.join(tmpdir_path, "other", "a.txt"), "AGYSUB,LOC\nz,3\n")
    paths = [os.path.join(tmpdir_path, d, "a.txt") for d in ("March_1999", "other")]
    df = R.denormalized(spark, paths, {}, segments=(2,))
    assert sorted((r["agysub"], r["year"], r["quarter"], r["dataset_key"]) for r in df.collect()) == [
        ("x", 1999, "March", "1999_March"), ("y", 1999, "March", "1999_March")]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    filters = [x for x in plan.split("\n") if "Filter" in x]
    assert filters and not any("regexp" in x for x in filters) and plan.count("regexp_extract(") <= 10


def test_read_facts_header_drift_and_periods(spark, tmpdir_path):
    facts, _ = make_history(tmpdir_path)
    df = S.read_facts(spark, facts)
    assert {"agysub", "loc", "occ", "occfam", "pp", "dataset_key", "quarter", "year"} <= set(df.columns)
    rows = df.collect()
    assert len(rows) == 6
    periods = sorted({(r.dataset_key, r.year) for r in rows})
    assert periods == [("2016_September", 2016), ("2017_March", 2017)]
    quoted = [r for r in rows if r.agysub == "VA,TB"]
    assert len(quoted) == 1 and quoted[0].pp == "01"
    assert {r.occfam for r in rows if r.year == 2016} == {"06", "99"}


def test_build_snapshots_denormalises(spark, tmpdir_path):
    facts, lk = make_history(tmpdir_path)
    out = os.path.join(tmpdir_path, "out")
    snap, man, check = R.build_snapshots(spark, facts, lk, out)
    rows = snap.collect()
    assert len(rows) == 6                                   # J1 never multiplies rows
    by = {(r.dataset_key, r.agysub, r.salary): r for r in rows}
    r = by[("2016_September", "VATA", "50000")]              # trimmed, loc 6 padded → 06
    assert (r.loc, r.loct, r.agelvlt, r.agysubt, r.agy) == ("06", "CALIFORNIA", "40-44", "VATA-VETERANS HEALTH", "VA")
    af = {r.agelvl: r for r in rows if r.agysub == "AF02"}
    assert af[None].salary is None and af[None].agelvlt is None   # 'nan' → null, null key
    assert af["F"].salary is None                                  # empty cell → null
    assert af["F"].agelvlt == "45-49"                              # padded lookup key matches
    r17 = [x for x in rows if x.year == 2017]
    assert {x.loct for x in r17} == {"CALIFORNIA-17"}
    assert all(x.agysubt is None for x in r17)               # no agency table that period
    chk = {(c.year, c.quarter): (c.rows_read, c.rows_written_total, c.complete) for c in check.collect()}
    assert chk == {(2016, "September"): (4, 6, True), (2017, "March"): (2, 6, True)}
    m = {r.dataset_key: r.records for r in man.collect()}
    assert m == {"2016_September": 4, "2017_March": 2}
    back = S.read_snapshots(spark, out, view="snapshots")
    assert spark.sql("SELECT count(*) FROM snapshots").first()[0] == 6
    assert back.where(F.col("year") == 2017).count() == 2


def test_discover_files(spark, tmpdir_path):
    facts, lk = make_history(tmpdir_path)
    found = S.discover_files(spark, tmpdir_path)
    assert sorted(os.path.basename(f) for f in found["facts"]) == ["FACTDATA_MAR2017.TXT", "FACTDATA_SEP2016.TXT"]
    assert len(found["DTloc"]) == 2 and len(found["DTagy"]) == 1 and len(found["DTagelvl"]) == 2
    snap, man, _ = R.build_from_directory(spark, tmpdir_path)
    assert snap.count() == 6 and snap.where("loct = 'CALIFORNIA-17'").count() == 2


def test_alternate_release_build(spark, tmpdir_path):
    p1 = write(os.path.join(tmpdir_path, "March_2025_Employment_1.txt"),
               'AGY|AGYSUB|LOC|STATET|AGELVLT|COUNT|SALARY|WORKSCHT\n'
               'VA|VATA|6|CALIFORNIA|40-44|1|100000|"FULL, TIME"\n'
               'VA|VATA|REDACTED|REDACTED|REDACTED|1|REDACTED|F\n', "utf-8")
    p2 = write(os.path.join(tmpdir_path, "March_2025_Employment_2.txt"),
               'AGY|AGYSUB|LOC|STATET|AGELVLT|COUNT|SALARY|WORKSCHT\n'
               'AF|AF02|11|DISTRICT|45-49|1|90000|F\n', "utf-8")
    snap, per_file, prof = R.build_alternate(spark, [p1, p2], 2025, "March")
    assert len(snap.columns) == 52 and snap.columns[:3] == ["dataset_key", "quarter", "year"]
    rows = snap.collect()
    assert len(rows) == 3 and {r.loc for r in rows} == {"06", "REDACTED", "11"}
    assert {r.wrkscht for r in rows} == {"FULL, TIME", "F"} and {r.gsegrd for r in rows} == {""}
    pf = {os.path.basename(r.source_file): (r.rows, r.redacted_cells) for r in per_file.collect()}
    assert pf["March_2025_Employment_1.txt"] == (2, 4) and "n_distinct_AGYT" not in per_file.columns
    p = prof.first()
    assert (p.rows, p.salary_valid, p.salary_mean) == (3, 2, 95000.0)


def test_status_table_comparison(spark, tmpdir_path):
    path = write(os.path.join(tmpdir_path, "status.txt"),
                 "DATECODE\tEDLVL\tEDLVLT\tEMPCOUNT\tAVGSAL\tAVGLOS\r\n"
                 "202503\t13\tBACHELOR'S DEGREE\t100\t90000\t10.5\r\n"
                 "202503\t \tNo Data Reported\t5\t50000\t2.0\r\n"
                 "202503\t04\t\"HIGH SCHOOL, OR EQUIVALENT\"\t50\t60000\t12.1\r\n"
                 "202409\t13\tBACHELOR'S DEGREE\t80\t88000\t10.0\r\n"
                 "202409\t04\t\"HIGH SCHOOL, OR EQUIVALENT\"\t60\t59000\t12.0\r\n"
                 "202409\t99\tGONE\t7\t1\t1.0\r\n", "utf-8")
    st = S.read_status_table(spark, path)
    tot = {r.DATECODE: r.t for r in st.groupBy("DATECODE").agg(F.sum("EMPCOUNT").alias("t")).collect()}
    assert tot == {202503: 155, 202409: 147}
    out = R.status_comparison(spark, path, "202503", "202409", drop=("AVGLOS",))
    rows = {r.EDLVL: r for r in out.collect()}
    assert set(rows) == {"13", " ", "04"}                        # prior-only row dropped
    assert rows["13"].change == 20 and rows["13"].rank == 1
    assert rows[" "].pct_change == 100.0 and rows["04"].EDLVLT == "HIGH SCHOOL, OR EQUIVALENT"
    assert "AVGLOS" not in out.columns
    found = R.status_comparison(spark, path, "202503", "202409", search="school")
    assert [r.EDLVL for r in found.collect()] == ["04"]
    view = R.status_table_view(spark, path, "education-level", "202503", "202409", "Mar 2025", "Sep 2024")
    assert view.columns == ["Education Level", "Sep 2024", "Mar 2025", "Change", "% Change", "rank"]
    assert {r["Education Level"]: r["Change"] for r in view.collect()}["BACHELOR'S DEGREE"] == 20
    hit = R.status_table_view(spark, path, "education-level", "202503", "202409", "Mar 2025", "Sep 2024",
                              search="high school")
    assert [r["Education Level"] for r in hit.collect()] == ["HIGH SCHOOL, OR EQUIVALENT"]
    pair = R.status_pair_check(spark, path, "202503", "202409").first()
    assert (pair.n_first, pair.n_second, pair.result) == (3, 3, "mismatch")
    assert pair.mismatches == 2          # row 2 and row 3 hold different codes by position


def test_csv_sink_and_manifest_totals(spark, tmpdir_path):
    df = spark.createDataFrame([("2024_March", "f1", 1048576, "a"), ("2024_March", "f1", 1048576, "b"),
                                ("2024_June", "f2", 2097152, "c")],
                               "dataset_key string, source_file string, source_size long, v string")
    man = K.manifest(df)
    tot = K.manifest_totals(man).first()
    assert (tot.datasets, tot.total_records, tot.total_mb, tot.avg_records) == (2, 3, 3.0, 1.5)
    out = os.path.join(tmpdir_path, "csv")
    K.write_csv(man, out)
    assert spark.read.option("header", True).csv(out).count() == 2


def test_usage_on_built_store(spark, tmpdir_path):
    from pyspark.sql import functions as F
    from periodlens.operators import profile as PR
    facts, lk = make_history(tmpdir_path)
    out = os.path.join(tmpdir_path, "store")
    R.build_snapshots(spark, facts, lk, out)
    snap = S.read_snapshots(spark, out, view="employment_usage")
    assert {r.agysubt for r in PR.headcount_top(snap, "agysubt", 10).collect()} == {"VATA-VETERANS HEALTH", "AF02-AIR FORCE X"}
    assert PR.headcount_by(snap, ["year", "quarter"]).count() == 2
    rows = spark.sql("SELECT year, SUM(TRY_CAST(employment AS INT)) AS e FROM employment_usage GROUP BY year").collect()
    assert {r.year: r.e for r in rows} == {2016: 4, 2017: 2}
    b, a = F.col("year") == 2016, F.col("year") == 2017
    table, _ = R.age_comparison_excluding(snap, b, a)
    assert table.where("code = 'TOTAL'").first().before == 3     # the row without an age code is dropped
    assert R.validation_run(snap)["verdict"].count() == 2


# --- records that are not lines, malformed records -------------------------------------------------

def plain_csv(text, sep=",", quote='"'):
    """Cells of each record by a plain state machine."""
    records, cells, cell, state = [], [], "", "start"
    for c in text + "\n":
        if state == "inside":
            if c == quote:
                state = "closed"
            else:
                cell += c
            continue
        if c == quote and state == "start":
            state = "inside"
        elif c == quote and state == "closed":
            cell, state = cell + c, "inside"
        elif c == sep or c == "\n":
            cells.append(cell)
            cell, state = "", "start"
            if c == "\n":
                records.append(cells)
                cells = []
        else:
            cell += c
            state = "plain" if state == "start" else state
    return [r for r in records if any(x.strip() for x in r) or len(r) > 1]


def test_cells_with_line_breaks_over_many_splits(spark, tmpdir_path):
    """Files read in splits of 64 bytes: cells run over several splits, and quotes in them look like beginnings."""
    rng = random.Random(11)
    pieces = ["plain", "a b", "", "x\ny", "\n", ",", 'say ""hi""', '"" ,""', "\n,\n", "long " * 30, '""\n""', "\n\n\n"]
    paths, want = [], []
    for k in range(4):
        text = "id,a,b\n"
        for i in range(60):
            cells = [rng.choice(pieces) for _ in range(2)]
            body = [f'"{c}"' if rng.random() < 0.5 or set(c) & set(',"\n') else c for c in cells]
            text += f"{k}-{i}," + ",".join(body) + "\n"
        paths.append(write(os.path.join(tmpdir_path, f"some files/f{k}.txt"), text, "utf-8"))
        want += plain_csv(text)[1:]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "16")
    try:
        df = S.read_delimited(spark, paths, line_numbers=True).cache()
        got = df.orderBy("line_no").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [[r["id"], r["a"] or "", r["b"] or ""] for r in got] == want and len(want) == 240
    assert all(r["corrupt_record"] is None for r in got)


def test_all_readers_count_malformed_records(spark, tmpdir_path):
    pipe = write(os.path.join(tmpdir_path, "p", "pipe.txt"), 'A|B\n"1"|"2"|"LOST"\n"3"\n"x\ny"|"4"\n', "utf-8")
    rows = S.read_pipe_files(spark, pipe).collect()
    assert [(r["A"], r["B"]) for r in rows if r["corrupt_record"] is None] == [("x\ny", "4")]
    assert sorted(r["corrupt_record"] for r in rows if r["corrupt_record"]) == ['"1"|"2"|"LOST"', '"3"']
    code = write(os.path.join(tmpdir_path, "Staff_March_2017", "DTloc.txt"), "LOC,LOCT\n10,one, two\n11,three\n12,\"a, b\"\n")
    rows = {r["loc"]: r for r in S.read_lookups(spark, code).collect()}
    assert rows["10"]["corrupt_record"] == "10,one, two" and rows["11"]["corrupt_record"] is None and rows["12"]["loct"] == "a, b"
    fact = write(os.path.join(tmpdir_path, "Staff_March_2017", "FACTDATA_MAR2017.TXT"),
                 "LOC,SALARY\n10,1\n11,2,3\n12,3\n\"12\n,4\n")
    status = write(os.path.join(tmpdir_path, "s", "status.txt"), "DATECODE\tX\tEMPCOUNT\n202503\ta\t1\n202503\tb\tmany\n202503\tc\n", "utf-8")
    got = {(r["kind"], os.path.basename(r["source_file"])): (r["records"], r["bad_records"]) for r in
           R.bad_record_report(spark, [fact], {"DTloc": [code]}, [pipe], [status]).collect()}
    assert got == {("facts", "FACTDATA_MAR2017.TXT"): (5, 2), ("DTloc", "DTloc.txt"): (3, 1), ("pipe", "pipe.txt"): (3, 2),
                   ("status", "status.txt"): (3, 2)}
    # only sound lines name codes; a record is never dropped from the facts
    snap, man, _ = R.build_snapshots(spark, [fact], {"DTloc": [code]})
    named = {(r["loc"], r["salary"]): r["loct"] for r in snap.collect()}
    assert named[("10", "1")] is None and named[("12", "3")] == "a, b" and len(named) == 5
    assert man.first()["bad_records"] == 2


def test_a_quote_that_is_never_closed_ends_with_its_line(spark, tmpdir_path):
    path = write(os.path.join(tmpdir_path, "f.txt"), 'a,b\n1,"x\ny"\n2,"open\n3,z\n4,w\n', "utf-8")
    rows = S.read_delimited(spark, path, line_numbers=True).orderBy("line_no").collect()
    assert [(r["a"], r["b"]) for r in rows if r["corrupt_record"] is None] == [("1", "x\ny"), ("3", "z"), ("4", "w")]
    assert [r["corrupt_record"] for r in rows if r["corrupt_record"]] == ['2,"open']


def test_headers_of_many_files_take_one_job(spark, tmpdir_path):
    """Files with several splits each; splits are packed into tasks by size, so a later split can come first."""
    want = {}
    for i in range(120):
        path = write(os.path.join(tmpdir_path, f"h{i % 7}", f"f{i}.txt"), f"c{i % 5},x\n" + f"{i},{'v' * (i % 50)}\n" * (i % 30), "utf-8")
        want[path] = f"c{i % 5},x"
    write(os.path.join(tmpdir_path, "h0", "nothing.txt"), "", "utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "8")
    group = "survey-of-headers"
    spark.sparkContext.setJobGroup(group, "")
    try:
        got = records.survey(spark, [tmpdir_path + "/*"])
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {"/" + r["source_file"].removeprefix("file:").lstrip("/"): r["header"] for r in got} == want
    assert len(jobs) <= 5           # listing, the files' shuffle, sample and sort of the result: none a file
    df = S.read_delimited(spark, [tmpdir_path + "/*"])
    assert df.count() == sum(i % 30 for i in range(120))
