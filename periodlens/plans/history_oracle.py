"""DuckDB SQL of the queries of ``history_catalog``."""

from __future__ import annotations

from periodlens.plans.oracle import CSUM, IS_RED, ORACLE, PCT, QIDX, QUALITY_FIELDS, RANK, SAFE_INT, VAL, W, _null_rates_cte, _q

AGENCY = "MA07"
SK = f"year * 10 + {QIDX()}"
PERIOD = "quarter || ' ' || CAST(year AS VARCHAR)"
# Code and description fields of the validation run, and whether the derived facts have both.
COVERAGE = (("agelvl", "agelvlt", True), ("edlvl", "edlvlt", True), ("loslvl", "loslvlt", False), ("occ", "occt", False),
            ("patco", "patcot", False), ("ppgrd", "ppgrdt", False), ("sallvl", "sallvlt", False), ("stemocc", "stemocct", False),
            ("supervis", "supervist", False), ("toa", "toat", True), ("worksch", "wrkscht", False), ("workstat", "wkstatt", False),
            ("agysub", "agy", True), ("loc", "loct", True), ("pp", "ppt", False))


def _distinct_periods() -> str:
    values = " UNION ".join(f"SELECT year, '{c}' AS field, {c} AS v FROM facts WHERE {c} IS NOT NULL" for c in ("agy", "agysub", "agysubt", "ppgrd"))
    return (W(f"vals AS ({values})") +
            "SELECT a.year, a.field, COUNT(*) AS n_exact, COUNT(*) FILTER (WHERE b.v IS NULL) AS n_vanished_exact, TRUE AS within_error "
            "FROM vals a LEFT JOIN vals b ON b.year = a.year + 1 AND b.field = a.field AND b.v = a.v GROUP BY a.year, a.field")


def _intervals(where: str = "") -> list[str]:
    return [f"nm AS (SELECT toa AS code, {SK} AS period, arg_min(toat, line_no) AS name FROM facts "
            f"WHERE toa IS NOT NULL AND toat IS NOT NULL {where} GROUP BY 1, 2)",
            f"pd AS (SELECT period, row_number() OVER (ORDER BY period) AS no FROM (SELECT DISTINCT {SK} AS period FROM facts))",
            "isl AS (SELECT code, name, n.period, no - row_number() OVER (PARTITION BY code, name ORDER BY no) AS run "
            "FROM nm n JOIN pd USING (period))",
            "iv AS (SELECT code, name, min(period) AS first_period, max(period) AS last_period, COUNT(*) AS n_periods "
            "FROM isl GROUP BY code, name, run)"]


def _as_of() -> str:
    met = ("met AS (SELECT r.code, r.period, r.n, v.name, CASE WHEN v.name IS NULL THEN 'unknown' WHEN r.period < v.first_period THEN 'later' "
           "WHEN r.period > v.last_period THEN 'carried' ELSE 'current' END AS how, v.first_period, v.last_period "
           "FROM rows r LEFT JOIN iv v ON v.code = r.code)")
    pick = ("pick AS (SELECT *, row_number() OVER (PARTITION BY code, period ORDER BY CASE how WHEN 'current' THEN 0 WHEN 'carried' THEN 1 "
            "ELSE 2 END, CASE WHEN how = 'later' THEN first_period ELSE -last_period END, name) AS k FROM met)")
    return (W(*_intervals("AND quarter IN ('March', 'September')"),
              f"rows AS (SELECT toa AS code, {SK} AS period, COUNT(*) AS n FROM facts GROUP BY 1, 2)", met, pick) +
            "SELECT code, period, n, name, how FROM pick WHERE k = 1")


def _battery() -> str:
    def sub(name: str) -> str:
        return f"({ORACLE[name]})"
    summary = " UNION ALL ".join(f"SELECT 'salary_summary', '{c}', CAST({c} AS DOUBLE), NULL FROM {sub('numeric_summary')}"
                                 for c in ("n_valid", "mean_value", "median_value", "min_value", "max_value", "std_value"))
    top = (W(f"g AS (SELECT agysubt, {CSUM('employment', 'skip')} AS headcount FROM facts WHERE agysubt IS NOT NULL GROUP BY agysubt)") +
           f"SELECT * FROM (SELECT {RANK('headcount DESC, agysubt')} AS rank, * FROM g) WHERE rank <= 10")
    parts = [f"SELECT 'top_agencies' AS example, agysubt AS item, CAST(headcount AS DOUBLE) AS value, rank FROM ({top})",
             f"SELECT 'salary_by_education', edlvlt, mean_value, rank FROM {sub('mean_by_group')}",
             f"SELECT 'by_period', {PERIOD}, CAST(headcount AS DOUBLE), NULL FROM {sub('headcount_period')}", summary,
             f"SELECT 'share_loct', loct, share_pct, rank FROM {sub('freq_top')}",
             f"SELECT 'share_agelvlt', agelvlt, share_pct, rank FROM {sub('freq_by_label')}",
             f"SELECT 'redaction_before', column_name, before_pct, rank FROM {sub('redaction_profile')}",
             f"SELECT 'redaction_after', column_name, after_pct, rank FROM {sub('redaction_profile')}"]
    return " UNION ALL ".join(parts)


def _validation() -> str:
    fields = [f for f in QUALITY_FIELDS if f != "salary"]
    nr = W(*_null_rates_cte(fields))
    cov = " UNION ALL ".join(
        f"SELECT 'coverage', dataset_key, '{c}', " + (
            f"CASE WHEN COUNT({c}) = 0 THEN 'none' WHEN COUNT(*) FILTER (WHERE {c} IS NOT NULL AND {t} IS NOT NULL) = COUNT({c}) THEN 'full' "
            f"WHEN COUNT(*) FILTER (WHERE {c} IS NOT NULL AND {t} IS NOT NULL) = 0 THEN 'failed' ELSE 'partial' END"
            if there else "'absent'") + " FROM facts GROUP BY dataset_key" for c, t, there in COVERAGE)
    return " UNION ALL ".join(f"SELECT * FROM ({x})" for x in (
        nr + "SELECT 'verdict' AS check, dataset_key AS period, NULL AS field, CASE WHEN COUNT(*) FILTER (WHERE null_count = rows) = 0 THEN 'ok' "
        "ELSE 'invalid' END AS severity FROM nr GROUP BY dataset_key",
        f"SELECT 'required', dataset_key, column_name, severity FROM ({ORACLE['required_columns']})",
        nr + "SELECT 'high_null', dataset_key, field, severity FROM nr WHERE severity = 'warn'",
        f"SELECT 'constant', dataset_key, 'employment', severity FROM ({ORACLE['constant_measure']})",
        nr + "SELECT 'merge_failures', dataset_key, field, 'invalid' FROM nr WHERE null_count = rows",
        W() + cov,
        f"SELECT 'calendar', CAST(year AS VARCHAR) || '_' || quarter, NULL, 'missing' FROM ({ORACLE['calendar_expected']})",
        nr + "SELECT 'overall', NULL, NULL, CASE WHEN COUNT(*) FILTER (WHERE null_count = rows) = 0 THEN 'ok' ELSE 'invalid' END FROM nr"))


def _status_views() -> str:
    views = {"age-level": (("agelvlt",), ("agelvlt",)), "appointment-type": (("toa", "toat"), ("toat",)),
             "education-level": (("edlvl", "edlvlt"), ("edlvlt",)), "duty-location": (("loc", "loct"), ("loct",)),
             "pay-grade": (("payplan", "grd"), ("payplan", "grd")), "agency-subagency": (("agy", "agysub", "agysubt"), ("agysubt",))}
    out = []
    for name, (keys, shown) in views.items():
        cols, same = ", ".join(keys), " AND ".join(f"c.{k} IS NOT DISTINCT FROM p.{k}" for k in keys)
        order = "current DESC, " + ", ".join(f"{k} ASC NULLS FIRST" for k in keys)
        out.append(W(f"st AS (SELECT datecode, {cols}, {CSUM('employment', 'skip')} AS n FROM facts WHERE datecode IN ('199703', '199612') "
                     f"GROUP BY datecode, {cols})",
                     f"j AS (SELECT {', '.join('c.' + k for k in keys)}, COALESCE(p.n, 0) AS prior, c.n AS current FROM "
                     f"(SELECT * FROM st WHERE datecode = '199703') c LEFT JOIN (SELECT * FROM st WHERE datecode = '199612') p ON {same})") +
                   f"SELECT '{name}' AS view, concat_ws(' | ', {', '.join(shown)}) AS label, prior, current, current - prior AS change, "
                   f"round({PCT('prior', 'current')}, 4) AS pct_change, {RANK(order)} AS rank FROM j")
    return " UNION ALL ".join(f"SELECT * FROM ({x})" for x in out)


def _excluded() -> str:
    f = "first_agysubt"
    after = f"substr({f}, strpos({f}, '-') + 1)"
    two = f"array_to_string(string_split({after}, ' ')[1:2], ' ')"
    main = (f"CASE WHEN {f} IS NULL THEN agy WHEN {f} LIKE 'AF%' AND contains({f}, '-') THEN {two} "
            f"WHEN contains({f}, 'AIR FORCE') THEN 'AIR FORCE' WHEN contains({f}, 'ARMY') THEN 'ARMY' "
            f"WHEN contains({f}, 'NAVAL') OR contains({f}, 'NAVY') THEN 'NAVY' "
            f"WHEN agy = 'DD' THEN 'DEPARTMENT OF DEFENSE' ELSE {f} END")
    return (W("flagged AS (SELECT DISTINCT agy FROM facts WHERE year = 1997 AND agelvlt = 'REDACTED' AND agy IS NOT NULL)",
              f"g AS (SELECT agy, arg_min(agysubt, line_no) FILTER (WHERE agysubt IS NOT NULL) AS {f} FROM facts "
              "WHERE year = 1996 AND agy IN (SELECT agy FROM flagged) GROUP BY agy)") +
            f"SELECT agy, agy || ' (' || ({main}) || ')' AS label FROM g")


HISTORY_ORACLE = {
    "published_store": W() +
    "SELECT year, quarter, COUNT(*) AS rows, CAST(SUM(TRY_CAST(employment AS INTEGER)) AS BIGINT) AS employees, CAST(2 AS BIGINT) AS n_states, "
    "CAST(CASE WHEN year = 1997 THEN 2 ELSE 1 END AS BIGINT) AS n_versions FROM facts GROUP BY year, quarter",
    "trend_partials": ORACLE["trend"],
    "group_trend_partials": ORACLE["group_trend"],
    "class_trend_partials": ORACLE["class_trend"],
    "multi_period_partials": ORACLE["multi_period_sql"],
    "subtotals": W() +
    "SELECT CASE WHEN grouping(year) = 1 THEN 'TOTAL' ELSE CAST(year AS VARCHAR) END AS year, CASE WHEN grouping(toa) = 1 THEN 'TOTAL' ELSE toa END AS toa, "
    "CASE WHEN grouping(agelvlt) = 1 THEN 'TOTAL' ELSE agelvlt END AS agelvlt, CAST(grouping(year) + grouping(toa) + grouping(agelvlt) AS INTEGER) AS level, "
    f"{CSUM('employment', 'skip')} AS headcount FROM facts "
    "GROUP BY GROUPING SETS ((year, toa, agelvlt), (year, toa), (year, agelvlt), (year), ())",
    "distinct_periods": _distinct_periods(),
    "code_intervals": W(*_intervals()) + "SELECT * FROM iv",
    "code_names_as_of": _as_of(),
    "indexed_search": ORACLE["search_rows"],
    "wrapped_records":
    "SELECT p_partkey AS part, CASE WHEN p_partkey % 5 = 0 THEN 'two' || chr(10) || 'lines, \"quoted\" | and ' || p_type || chr(10) "
    "ELSE p_type END AS type, p_brand AS brand FROM part",
    "bad_records":
    "SELECT 'facts' AS kind, COUNT(*) AS records, COUNT(*) FILTER (WHERE p_partkey % 97 = 0 OR p_partkey % 101 = 0) AS bad_records FROM part "
    "UNION ALL SELECT 'codes', COUNT(*), COUNT(*) FILTER (WHERE p_partkey % 97 <> 0 AND p_partkey % 101 = 0) FROM part",
    "incremental_build": W() +
    "SELECT year, quarter, CASE WHEN year = 1997 AND quarter = 'March' THEN 'built' ELSE 'kept' END AS action, COUNT(*) AS rows "
    "FROM facts GROUP BY year, quarter",
    "examples_battery": _battery(),
    "validation_run": _validation(),
    "agency_appointments": W() +
    f"SELECT {PERIOD} AS period, year, quarter, {SK} AS sort_key, toa, toat, {CSUM('employment', 'digits_else_zero')} AS employment, "
    f"toat AS toat_display FROM facts WHERE agysub = '{AGENCY}' AND toa IS NOT NULL AND toat IS NOT NULL GROUP BY year, quarter, toa, toat",
    "agency_classes": W() +
    "SELECT DISTINCT toa, toat AS toat_display, CASE WHEN contains(upper(toat), 'NONPERMANENT') THEN 'Nonpermanent' "
    f"WHEN contains(upper(toat), 'PERMANENT') THEN 'Permanent' ELSE 'Other' END AS appt_class FROM facts WHERE agysub = '{AGENCY}' "
    "AND toa IS NOT NULL AND toat IS NOT NULL",
    "agency_split": W(f"g AS (SELECT year, quarter, COALESCE(contains(upper(toat), 'NONPERMANENT'), false) AS np, "
                      f"{VAL('employment', 'digits_else_zero')} AS v FROM facts WHERE agysub = '{AGENCY}')",
                      "s AS (SELECT year, quarter, CAST(SUM(CASE WHEN np THEN v ELSE 0 END) AS BIGINT) AS nonpermanent, "
                      "CAST(SUM(CASE WHEN np THEN 0 ELSE v END) AS BIGINT) AS not_nonpermanent FROM g GROUP BY year, quarter)") +
    f"SELECT {PERIOD} AS period, {SK} AS sort_key, nonpermanent, not_nonpermanent, nonpermanent + not_nonpermanent AS total FROM s",
    "excluded_agencies": _excluded(),
    "compare_left_full": W(
        "st AS (SELECT datecode, CASE WHEN datecode = '199612' AND toa = 'P' THEN 'ended' ELSE toa END AS toa, COUNT(*) AS n FROM facts "
        "WHERE datecode IN ('199703', '199612') GROUP BY 1, 2)",
        "j AS (SELECT COALESCE(c.toa, p.toa) AS toa, COALESCE(p.n, 0) AS prior_count, COALESCE(c.n, 0) AS current_count FROM "
        "(SELECT * FROM st WHERE datecode = '199703') c FULL JOIN (SELECT * FROM st WHERE datecode = '199612') p "
        "ON c.toa IS NOT DISTINCT FROM p.toa)") +
    f"SELECT toa, prior_count, current_count, current_count - prior_count AS change, round({PCT('prior_count', 'current_count')}, 4) AS pct_change, "
    f"{RANK('current_count DESC, toa ASC NULLS FIRST')} AS rank FROM j",
    "alternate_checks": W("p AS (SELECT * FROM facts WHERE datecode = '199703')",
                          f"g AS (SELECT agysubt, {CSUM('employment', 'skip')} AS n FROM p WHERE agysubt IS NOT NULL GROUP BY agysubt)",
                          f"x AS (SELECT COUNT(*) FILTER (WHERE line_no % 20 <> 0 OR {IS_RED('loct')}) AS k, COUNT(*) AS n FROM p)") +
    "SELECT 'top_agencies' AS check, agysubt AS item, CAST(n AS DOUBLE) AS value FROM "
    f"(SELECT {RANK('n DESC, agysubt')} AS rank, * FROM g) WHERE rank <= 10 UNION ALL "
    "SELECT 'high_redaction', 'loct', round(k / n * 100.0, 4) FROM x WHERE k * 100.0 > n * 90.0 UNION ALL "
    "SELECT 'row_range', CASE WHEN n BETWEEN 1500000 AND 2500000 THEN 'in range' ELSE 'out of range' END, CAST(n AS DOUBLE) FROM x",
    "status_views": _status_views(),
}
