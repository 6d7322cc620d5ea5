"""Oracle SQL (DuckDB dialect) for every registered query.

The driver checks each Spark query against this SQL on the same parquet tables. The SQL is an
independent statement of the semantics: the stand-in mapping, the cleaning rules and the exact
half-up rounding are written out again here rather than generated from the Spark code.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------------------------
# exact arithmetic (same formulas as wardlens.functions.numeric)


def half_up(n: str, d: str, scale: int) -> str:
    N, D = f"CAST(({n}) AS HUGEINT)", f"CAST(({d}) AS HUGEINT)"
    return (f"(CASE WHEN {D} <> 0 THEN sign({N}) * sign({D}) * "
            f"((abs({N}) * {2 * 10 ** scale} + abs({D})) // (2 * abs({D}))) END)")


def xround(n: str, d: str, scale: int) -> str:
    return f"(CAST({half_up(n, d, scale)} AS DOUBLE) / {float(10 ** scale)!r})"


def pct(part: str, whole: str, scale: int = 2) -> str:
    return xround(f"({part}) * 100", whole, scale)


def cents(col: str) -> str:
    return f"CAST(({col}) * 100 AS HUGEINT)"


def money_avg_rounded(col: str, scale: int = 2) -> str:
    return xround(f"sum({cents(col)})", f"count({col}) * 100", scale)


def money_avg(col: str) -> str:
    return f"(CASE WHEN count({col}) > 0 THEN CAST(sum({cents(col)}) AS DOUBLE) / CAST(count({col}) * 100 AS DOUBLE) END)"


# lcm(1..30), the lengths of stay of the stand-in: sums of money / days over it are whole numbers
DAYS_LCM = 2329089562800


def ratio_avg(money: str, days: str, scale: int) -> str:
    """ROUND(AVG(money / days), scale) over rows with money and a stay, exact: every ratio over one denominator."""
    counted = f"FILTER (WHERE ({days}) <> 0 AND {money} IS NOT NULL)"
    return xround(f"sum({cents(money)} * ({DAYS_LCM} // nullif({days}, 0))) {counted}",
                  f"count(*) {counted} * CAST({100 * DAYS_LCM} AS HUGEINT)", scale)


def trunc_avg(total: str, n: str) -> str:
    return f"(CASE WHEN ({n}) <> 0 THEN CAST(({total}) // ({n}) AS BIGINT) END)"


STAY = "CAST(date_diff('day', admission_date, discharge_date) AS INTEGER)"

# ---------------------------------------------------------------------------------------------
# stand-in tables (same mapping as wardlens.sources.standin)

_ADMISSION_SELECT = """
  CASE c.c_custkey % 3 WHEN 0 THEN upper(c.c_name) WHEN 1 THEN lower(c.c_name) ELSE c.c_name END AS name,
  CASE WHEN l.l_linestatus = 'O' THEN 'Male' ELSE 'Female' END AS gender,
  CASE WHEN l.l_partkey % 13 = 0 THEN NULL ELSE p.p_type END AS medical_condition,
  CAST(o.o_orderdate AS DATE) AS admission_date,
  CAST(o.o_orderdate AS DATE) + CAST(CAST(l.l_quantity AS INTEGER) % 31 AS INTEGER) AS discharge_date,
  CASE WHEN l.l_orderkey % 23 = 0 THEN NULL ELSE CAST(l.l_extendedprice AS DECIMAL(18,2)) END AS billing_amount,
  CASE WHEN o.o_orderpriority = '1-URGENT' THEN 'Urgent' WHEN o.o_orderpriority = '2-HIGH' THEN 'Emergency'
       ELSE 'Elective' END AS admission_type,
  p.p_brand AS medication,
  CASE WHEN l.l_linenumber = 7 THEN NULL WHEN l.l_returnflag = 'A' THEN 'Abnormal'
       WHEN l.l_returnflag = 'N' THEN 'Normal' ELSE 'Inconclusive' END AS test_results,
  CASE WHEN l.l_partkey % 11 = 0 THEN NULL
       WHEN l.l_partkey % 4 = 0 THEN p.p_name || ' Ltd'
       WHEN l.l_partkey % 4 = 1 THEN p.p_name || ', and Sons'
       WHEN l.l_partkey % 4 = 2 THEN 'Group ' || p.p_name
       ELSE p.p_name || ',' END AS hospital"""

_LINES_FROM = """
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey JOIN part p ON l.l_partkey = p.p_partkey"""

ADMISSIONS = f"SELECT {_ADMISSION_SELECT} {_LINES_FROM}"

ADMISSION_LINES = (f"SELECT l.l_orderkey AS order_key, l.l_linenumber AS line_number, "
                   f"l.l_linestatus AS line_status, {_ADMISSION_SELECT} {_LINES_FROM}")

# Warehouse stopwords, as in wardlens.functions.text.
_FIRST_STOP = "'and', 'And', 'Ltd', 'Inc', 'LLC', 'PLC', 'Sons', 'Group', ''"
_ANCHOR_STOP = ("'and', 'ltd', 'inc', 'llc', 'plc', 'sons', 'group', 'the', 'of', 'a', 'an', 'co', 'corp', "
                "'company', 'associates', 'partners', 'services'")


def first_token_sql(col: str) -> str:
    return (f"list_filter(string_split(regexp_replace({col}, '[^A-Za-z]+', ' ', 'g'), ' '), "
            f"lambda t: t NOT IN ({_FIRST_STOP}))[1]")


# Fixed value: word breaks of the warehouse's INITCAP.
_BREAKS = r"""\s\[\](){}/|\\<>!?@"^#$&~_,.:;*%+\-"""


def initcap_sql(col: str) -> str:
    return (f"CASE WHEN {col} IS NOT NULL THEN array_to_string(list_transform("
            f"regexp_extract_all(lower({col}), '([^{_BREAKS}]+|[{_BREAKS}]+)', 1), "
            f"lambda w: upper(left(w, 1)) || substr(w, 2)), '') END")


def anchor_tokens_sql(col: str, min_len: int = 3) -> str:
    return (f"list_filter(regexp_split_to_array(regexp_replace(lower({col}), '[^a-z\\s]', ' ', 'g'), '\\s+'), "
            f"lambda t: length(t) >= {max(min_len, 1)} AND t NOT IN ({_ANCHOR_STOP}))")


CLEAN = (f"SELECT * EXCLUDE (name, hospital), {initcap_sql('name')} AS name, "
         f"{first_token_sql('hospital')} AS hospital FROM admissions")


def with_clean(body: str) -> str:
    return f"WITH admissions AS ({ADMISSIONS}), admissions_clean AS ({CLEAN}) {body}"


def with_raw(body: str) -> str:
    return f"WITH admissions AS ({ADMISSIONS}) {body}"


# ---------------------------------------------------------------------------------------------
# reports (Q1-Q22); parameters as registered in wardlens.plans.registry

BILL_CENTS = cents("billing_amount")
FEMALE = "count(*) FILTER (WHERE gender = 'Female')"

REPORT_YEAR = 1996
REPORT_HOSPITAL = "red"
REPORT_TYPE = "Emergency"
REPORT_CONDITION = "PROMO"

REPORTS = {
    "average_stay": with_clean(
        f"SELECT CASE WHEN count({STAY}) > 0 THEN CAST(sum({STAY}) AS DOUBLE) / CAST(count({STAY}) AS DOUBLE) END "
        f"AS avg_stay FROM admissions_clean"),
    "average_stay_truncated": with_clean(
        f"SELECT {trunc_avg(f'sum({STAY})', f'count({STAY})')} AS avg_stay FROM admissions_clean"),
    "longest_stays": with_clean(
        f"SELECT name, medical_condition, hospital, {STAY} AS stay_length FROM admissions_clean "
        f"ORDER BY stay_length DESC NULLS LAST, name ASC NULLS LAST, medical_condition ASC NULLS LAST, "
        f"hospital ASC NULLS LAST LIMIT 100"),
    "monthly_report": with_clean(
        f"SELECT CAST(year(admission_date) AS INTEGER) AS year, CAST(month(admission_date) AS INTEGER) AS month, "
        f"count(*) AS admissions, {money_avg_rounded('billing_amount')} AS avg_billing, "
        f"count(*) FILTER (WHERE test_results = 'Abnormal') AS abnormal_results FROM admissions_clean "
        f"WHERE admission_date BETWEEN DATE '{REPORT_YEAR}-01-01' AND DATE '{REPORT_YEAR}-12-31' GROUP BY 1, 2 ORDER BY 1, 2"),
    "monthly_admissions": with_clean(
        "SELECT CAST(year(admission_date) AS INTEGER) AS year, CAST(month(admission_date) AS INTEGER) AS month, "
        "count(*) AS admissions FROM admissions_clean GROUP BY 1, 2 ORDER BY 1 NULLS LAST, 2 NULLS LAST"),
    "cases_by_gender": with_clean(
        "SELECT gender, medical_condition, count(*) AS total_cases FROM admissions_clean GROUP BY 1, 2 "
        "ORDER BY 3 DESC, 1 NULLS LAST, 2 NULLS LAST"),
    "top_conditions_by_gender": with_clean(
        "SELECT gender, medical_condition, total_cases, condition_rank, pct_of_gender_admissions FROM ("
        "  SELECT *, rank() OVER (PARTITION BY gender ORDER BY total_cases DESC) AS condition_rank, "
        f"  {pct('total_cases', 'sum(total_cases) OVER (PARTITION BY gender)')} AS pct_of_gender_admissions "
        "  FROM (SELECT gender, medical_condition, count(*) AS total_cases FROM admissions_clean GROUP BY 1, 2)) "
        "WHERE condition_rank <= 3 ORDER BY gender NULLS LAST, condition_rank, medical_condition NULLS LAST"),
    "medication_by_condition": with_clean(
        "SELECT medical_condition, medication, count(*) AS prescription_count, "
        "count(*) FILTER (WHERE gender = 'Female') AS female_prescriptions, "
        f"{pct(FEMALE, 'count(*)')} AS female_percentage "
        "FROM admissions_clean GROUP BY 1, 2 ORDER BY 1 NULLS LAST, 3 DESC, 2 NULLS LAST"),
    "hospital_condition_summary": with_clean(
        f"SELECT hospital, medical_condition, count(*) AS total_cases, "
        f"{money_avg_rounded('billing_amount')} AS avg_billing, "
        f"{xround(f'sum({STAY})', f'count({STAY})', 1)} AS avg_stay_days FROM admissions_clean "
        f"WHERE hospital IS NOT NULL AND medical_condition IS NOT NULL GROUP BY 1, 2 ORDER BY 1, 3 DESC, 2"),
    "top_conditions_by_hospital": with_clean(
        "SELECT hospital, medical_condition, cases, condition_rank FROM ("
        "  SELECT *, rank() OVER (PARTITION BY hospital ORDER BY cases DESC) AS condition_rank FROM ("
        "    SELECT hospital, medical_condition, count(*) AS cases FROM admissions_clean "
        "    WHERE hospital IS NOT NULL GROUP BY 1, 2)) WHERE condition_rank <= 3 "
        "ORDER BY hospital, condition_rank, medical_condition NULLS LAST"),
    "cost_by_condition_hospital": with_clean(
        f"SELECT medical_condition, hospital, {money_avg_rounded('billing_amount')} AS avg_total_bill, "
        f"{ratio_avg('billing_amount', STAY, 2)} AS avg_cost_per_day, "
        f"count(*) FILTER (WHERE {STAY} = 0) AS zero_stay_anomalies FROM admissions_clean GROUP BY 1, 2 "
        f"ORDER BY 4 DESC NULLS LAST, 1 NULLS LAST, 2 NULLS LAST"),
    "busiest_hospitals": with_clean(
        "SELECT hospital, count(*) AS cases FROM admissions_clean GROUP BY 1 "
        "ORDER BY cases DESC NULLS LAST, hospital ASC NULLS LAST LIMIT 5"),
    "condition_by_type": with_clean(
        "SELECT medical_condition, admission_type, count(*) AS frequency FROM admissions_clean "
        f"WHERE hospital = '{REPORT_HOSPITAL}' GROUP BY 1, 2 ORDER BY 2 NULLS LAST, 3 DESC, 1 NULLS LAST"),
    "results_by_type": with_clean(
        f"SELECT admission_type, test_results, count(*) AS total, "
        f"{pct('count(*)', 'sum(count(*)) OVER ()')} AS percentage_of_total FROM admissions_clean GROUP BY 1, 2 "
        f"ORDER BY 2 NULLS LAST, 3 DESC, 1 NULLS LAST"),
    "cost_bands": with_clean(
        "SELECT admission_type, CASE WHEN billing_amount > 40000 THEN 'High Cost' "
        "WHEN billing_amount BETWEEN 20000 AND 40000 THEN 'Medium Cost' ELSE 'Low Cost' END AS cost_category, "
        "count(*) AS cases FROM admissions_clean GROUP BY 1, 2 ORDER BY 1 NULLS LAST, 2"),
    "result_categories": with_clean(
        "SELECT CASE WHEN test_results = 'Abnormal' THEN 'Requires Attention' WHEN test_results = 'Normal' "
        "THEN 'Stable' ELSE 'Inconclusive' END AS result_category, count(*) AS total_cases "
        "FROM admissions_clean GROUP BY 1"),
    "gender_counts": with_clean(
        "SELECT 'Male' AS gender_group, count(*) AS admissions FROM admissions_clean WHERE gender = 'Male' "
        "UNION ALL SELECT 'Female', count(*) FROM admissions_clean WHERE gender = 'Female'"),
    "emergency_vs_elective": with_clean(
        "SELECT 'Emergency Admissions' AS category, count(*) AS total FROM admissions_clean "
        "WHERE admission_type = 'Emergency' UNION ALL SELECT 'Elective Admissions', count(*) "
        "FROM admissions_clean WHERE admission_type = 'Elective'"),
    "billing_vs_daily_cost": with_clean(
        f"SELECT 'Average Billing' AS metric, {money_avg('billing_amount')} AS value FROM admissions_clean "
        f"UNION ALL SELECT 'Average Cost Per Day', {ratio_avg('billing_amount', STAY, 12)} FROM admissions_clean"),
    "hospital_count": with_clean("SELECT count(DISTINCT hospital) AS number_of_hospitals FROM admissions_clean"),
    "billing_summary": with_clean(
        f"SELECT medical_condition, {xround(f'sum({BILL_CENTS})', 'count(billing_amount) * 100', 6)} "
        f"AS avg_billing, {xround(f'sum({BILL_CENTS})', 'count(*) * 100', 6)} AS avg_billing_per_case "
        f"FROM admissions_clean GROUP BY 1"),
    "filtered_summary": with_clean(
        f"SELECT hospital, medical_condition, admission_type, count(*) AS total_cases, "
        f"{xround(f'sum({BILL_CENTS})', 'count(billing_amount) * 100', 6)} AS avg_billing, "
        f"{trunc_avg(f'sum({STAY})', f'count({STAY})')} AS avg_stay_days FROM admissions_clean "
        f"WHERE admission_type = '{REPORT_TYPE}' AND medical_condition = '{REPORT_CONDITION}' GROUP BY 1, 2, 3 "
        f"ORDER BY 4 DESC, 1 NULLS LAST, 2, 3"),
    "value_distribution": with_clean(
        f"SELECT admission_type, count(*) AS row_count, "
        f"CAST(CAST({half_up('count(*) * 100', 'sum(count(*)) OVER ()', 2)} AS DECIMAL(7,0)) * 0.01 AS DECIMAL(5,2)) "
        f"AS pct_of_total FROM admissions_clean GROUP BY 1"),
    "admissions_by_type": with_clean(
        "SELECT name AS patient_name, medical_condition, admission_type, billing_amount, admission_date "
        f"FROM admissions_clean WHERE admission_type = '{REPORT_TYPE}' ORDER BY admission_date DESC NULLS LAST, "
        "patient_name NULLS LAST, medical_condition NULLS LAST, billing_amount NULLS LAST"),
    "quietest_hospitals": with_clean(
        "SELECT hospital, count(*) AS cases FROM admissions_clean GROUP BY 1 "
        "ORDER BY cases ASC NULLS LAST, hospital ASC NULLS LAST LIMIT 5"),
    "admission_peaks": with_clean(
        "SELECT * FROM (SELECT 'Busiest month' AS peak, year, month, admissions FROM (SELECT "
        "CAST(year(admission_date) AS INTEGER) AS year, CAST(month(admission_date) AS INTEGER) AS month, "
        "count(*) AS admissions FROM admissions_clean GROUP BY 1, 2) ORDER BY admissions DESC, year, month LIMIT 1) "
        "UNION ALL SELECT * FROM (SELECT 'Quietest month', year, month, admissions FROM (SELECT "
        "CAST(year(admission_date) AS INTEGER) AS year, CAST(month(admission_date) AS INTEGER) AS month, "
        "count(*) AS admissions FROM admissions_clean GROUP BY 1, 2) ORDER BY admissions ASC, year, month LIMIT 1)"),
    "row_count": with_clean("SELECT count(*) AS total_rows FROM admissions_clean"),
    "profile_clean": with_clean(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, count({c}) AS non_null, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM admissions_clean"
        for c, t in (("gender", "string"), ("medical_condition", "string"), ("admission_date", "date"),
                     ("discharge_date", "date"), ("billing_amount", "decimal(18,2)"), ("admission_type", "string"),
                     ("medication", "string"), ("test_results", "string"), ("name", "string"),
                     ("hospital", "string")))),
}


# ---------------------------------------------------------------------------------------------
# cleaning (C1-C4, C9-C13, F2)

BLANKS = "[ \t\n\r\f]"
NUMERIC_TEXT = rf"^{BLANKS}*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+){BLANKS}*$"


def safe_number_sql(col: str, dtype: str = "DECIMAL(18,2)") -> str:
    stripped = f"regexp_replace({col}, '^{BLANKS}+|{BLANKS}+$', '', 'g')"
    return f"(CASE WHEN regexp_full_match({col}, '{NUMERIC_TEXT}') THEN TRY_CAST({stripped} AS {dtype}) END)"


STAGING = """
SELECT event_id AS staging_id, 'Patient ' || CAST(user_id AS VARCHAR) AS name, event_type AS medical_condition,
       CASE WHEN event_id % 10 = 0 THEN '$' || amt ELSE amt END AS billing_amount,
       strftime(CAST(ts AS DATE), '%Y-%m-%d') AS admission_date,
       strftime(CAST(ts AS DATE) + CAST(event_id % 7 AS INTEGER), '%Y-%m-%d') AS discharge_date
FROM (SELECT *, printf('%d.%02d', c // 100, c % 100) AS amt
      FROM (SELECT *, CAST(round(value * 100) AS BIGINT) AS c FROM events))"""


def with_staging(body: str) -> str:
    return f"WITH staging AS ({STAGING}) {body}"


def title_case_sql(col: str) -> str:
    return (f"CASE WHEN {col} IS NOT NULL THEN array_to_string(list_transform("
            f"regexp_extract_all({col}, '(\\p{{L}}+|[^\\p{{L}}]+)', 1), "
            f"lambda r: upper(left(r, 1)) || lower(substr(r, 2))), '') END")


CLEANING = {
    "clean_warehouse": with_clean("SELECT * FROM admissions_clean"),
    "first_token_entity": with_raw(f"SELECT hospital AS raw_hospital, {first_token_sql('hospital')} AS hospital "
                                   f"FROM admissions"),
    "title_case_names": with_raw(f"SELECT name AS raw_name, {title_case_sql('name')} AS name FROM admissions"),
    "null_check": with_clean("SELECT count(*) FILTER (WHERE hospital IS NULL) AS null_hospital, "
                             "count(*) FILTER (WHERE name IS NULL) AS null_name, count(*) AS total_rows "
                             "FROM admissions_clean"),
    "raw_null_check": with_raw("SELECT count(*) FILTER (WHERE name IS NULL) AS null_name, "
                               "count(*) FILTER (WHERE admission_date IS NULL) AS null_admission_date, "
                               "count(*) AS total_rows FROM admissions"),
    "billing_preview": with_staging(
        f"SELECT billing_amount, {safe_number_sql('billing_amount', 'DOUBLE')} AS safe_billing FROM staging "
        "ORDER BY staging_id LIMIT 5"),
    "delete_abnormal": with_raw("SELECT count(*) AS total_rows FROM admissions WHERE NOT coalesce("
                                "test_results IN ('Abnormal', 'Inconclusive'), false)"),
    "distinct_before_after": with_clean(
        "SELECT 'Raw hospital distinct count' AS metric, count(DISTINCT hospital) AS value FROM admissions "
        "UNION ALL SELECT 'Clean hospital distinct count', count(DISTINCT hospital) FROM admissions_clean"),
    "conversion_issues": with_staging(
        f"SELECT name, medical_condition, billing_amount AS raw_value, {safe_number_sql('billing_amount')} AS safe_value, "
        f"CASE WHEN {safe_number_sql('billing_amount')} IS NULL THEN 'CONVERSION FAILED — investigate source row' "
        f"ELSE 'Valid' END AS quality_flag, admission_date, discharge_date FROM staging "
        f"WHERE {safe_number_sql('billing_amount')} IS NULL OR billing_amount IS NULL"),
    "conversion_diagnosis": with_staging(
        f"SELECT name, medical_condition, billing_amount AS raw_value, {safe_number_sql('billing_amount')} AS safe_value, "
        f"CASE WHEN {safe_number_sql('billing_amount')} IS NULL THEN 'CONVERSION FAILED — investigate source row' "
        f"ELSE 'Valid' END AS quality_flag, admission_date, discharge_date FROM staging"),
    "unparsed_dates": with_staging(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NOT NULL AND coalesce("
        f"try_strptime(trim({c}), '%d/%m/%Y'), try_strptime(trim({c}), '%Y-%m-%d')) IS NULL) AS unparsed, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS missing FROM staging" for c in ("admission_date", "discharge_date"))),
    "parse_dates": with_staging(
        "SELECT staging_id, "
        "CAST(coalesce(try_strptime(trim(admission_date), '%d/%m/%Y'), try_strptime(trim(admission_date), '%Y-%m-%d')) AS DATE) "
        "AS admission_date, "
        "CAST(coalesce(try_strptime(trim(discharge_date), '%d/%m/%Y'), try_strptime(trim(discharge_date), '%Y-%m-%d')) AS DATE) "
        "AS discharge_date FROM staging"),
}

# ---------------------------------------------------------------------------------------------
# entity resolution

_NAMES = "names AS (SELECT rtrim(hospital, ',') AS hospital, count(*) AS w FROM admissions GROUP BY 1)"
_TOKS = (f"toks AS (SELECT hospital, w, unnest(tk) AS token, generate_subscripts(tk, 1) AS pos "
         f"FROM (SELECT hospital, w, {anchor_tokens_sql('hospital')} AS tk FROM names))")
_COUNTS = "counts AS (SELECT token, sum(w) AS cnt FROM toks GROUP BY 1)"
_BEST = ("best AS (SELECT hospital, token AS anchor FROM (SELECT t.hospital, t.token, row_number() OVER "
         "(PARTITION BY t.hospital ORDER BY c.cnt, t.pos) AS rn FROM toks t JOIN counts c USING (token)) WHERE rn = 1)")
_MAPPING = ("mapping AS (SELECT n.hospital, n.w, CASE WHEN n.hospital IS NOT NULL THEN coalesce(b.anchor, 'unknown') END "
            "AS anchor FROM names n LEFT JOIN best b ON n.hospital = b.hospital)")
_CANON = ("canon AS (SELECT anchor, hospital AS canonical FROM (SELECT anchor, hospital, row_number() OVER "
          "(PARTITION BY anchor ORDER BY w DESC, hospital ASC) AS rn FROM mapping WHERE anchor IS NOT NULL) WHERE rn = 1)")
_ENTITY_CTES = f"WITH admissions AS ({ADMISSIONS}), {_NAMES}, {_TOKS}, {_COUNTS}, {_BEST}, {_MAPPING}, {_CANON}"
_ROWS = "(SELECT rtrim(hospital, ',') AS hospital FROM admissions) r"
STRIPPED = "rtrim(hospital, ',')"

# Cosine of TF-IDF vectors over all pairs of names that share a token, in thousandths
SIMILAR = 800
_SIMILAR = (
    f"WITH RECURSIVE admissions AS ({ADMISSIONS}), {_NAMES}, "
    "words AS (SELECT hospital, unnest(list_filter(string_split(regexp_replace(lower(hospital), '[^a-z0-9]+', ' ', 'g'), ' '), "
    "lambda x: x <> '')) AS token FROM names), "
    "tf AS (SELECT hospital, token, count(*) AS n FROM words GROUP BY 1, 2), "
    "idf AS (SELECT token, CAST(round(1000 * (ln(CAST(1 + (SELECT count(hospital) FROM names) AS DOUBLE) / (1 + count(*))) + 1)) "
    "AS HUGEINT) AS w FROM tf GROUP BY 1), "
    "vec AS (SELECT hospital, token, n * w AS w FROM tf JOIN idf USING (token)), "
    "norm AS (SELECT hospital, sum(w * w) AS n2 FROM vec GROUP BY 1), "
    "dots AS (SELECT a.hospital AS a, b.hospital AS b, sum(a.w * b.w) AS dot FROM vec a JOIN vec b "
    "ON a.token = b.token AND a.hospital <> b.hospital GROUP BY 1, 2), "
    "links AS (SELECT a, b FROM dots JOIN norm x ON x.hospital = a JOIN norm y ON y.hospital = b "
    f"WHERE dot * dot * 1000000 >= x.n2 * y.n2 * {SIMILAR * SIMILAR}), "
    "reach AS (SELECT hospital AS a, hospital AS b FROM names WHERE hospital IS NOT NULL "
    "UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a) ")

ENTITY = {
    "similar_entities": _SIMILAR + (
        "SELECT n.hospital AS entity_name, n.w AS name_rows, (SELECT min(b) FROM reach WHERE a = n.hospital) AS similar_group, "
        "(SELECT count(*) FROM links WHERE a = n.hospital) AS n_links FROM names n"),
    "anchor_entity": (f"{_ENTITY_CTES} SELECT r.hospital, m.anchor AS hospital_anchor FROM {_ROWS} "
                      f"LEFT JOIN mapping m ON r.hospital = m.hospital"),
    "canonical_entity": (f"{_ENTITY_CTES} SELECT r.hospital, m.anchor AS hospital_anchor, c.canonical AS hospital_canonical "
                         f"FROM {_ROWS} LEFT JOIN mapping m ON r.hospital = m.hospital "
                         f"LEFT JOIN canon c ON m.anchor = c.anchor"),
    "entity_audit": (f"{_ENTITY_CTES}, samples AS (SELECT anchor, string_agg(hospital, ' | ' ORDER BY hospital) AS sample_names "
                     f"FROM (SELECT anchor, hospital, row_number() OVER (PARTITION BY anchor ORDER BY hospital) AS rn "
                     f"FROM mapping WHERE anchor IS NOT NULL) WHERE rn <= 5 GROUP BY 1) "
                     f"SELECT m.anchor, CAST(sum(m.w) AS BIGINT) AS group_rows, count(*) AS distinct_names, s.sample_names "
                     f"FROM mapping m JOIN samples s USING (anchor) GROUP BY m.anchor, s.sample_names"),
    "entity_audit_summary": (f"{_ENTITY_CTES} SELECT count(DISTINCT anchor) AS anchor_groups, "
                             f"CAST(sum(w) AS BIGINT) AS total_rows, "
                             f"{xround('sum(w)', 'count(DISTINCT anchor)', 1)} AS avg_rows_per_group FROM mapping"),
    "first_long_token_entity": with_raw(
        f"SELECT rtrim(hospital, ',') AS hospital, coalesce({anchor_tokens_sql(STRIPPED, 4)}[1], "
        f"lower(rtrim(hospital, ','))) AS hospital_anchor FROM admissions"),
    "token_signature": with_raw(
        f"SELECT hospital, array_to_string(list_sort(list_distinct({anchor_tokens_sql('hospital')})), ' ') "
        f"AS hospital_clean FROM admissions"),
}


# ---------------------------------------------------------------------------------------------
# defensive loading

def error_id_sql(run_id: str, key: str, context: str) -> str:
    parts = ", ".join(f"coalesce(CAST(({p}) AS VARCHAR), chr(9216))" for p in (f"'{run_id}'", key, context))
    return f"substr(sha256(concat_ws(chr(31), {parts})), 1, 32)"


_CONV_OK = f"(billing_amount IS NULL OR {safe_number_sql('billing_amount')} IS NOT NULL)"
_CONV_CTX = "'Scenario 1 — Billing_Amount conversion failure: ' || name"

LOAD_BATCH_COLS = "order_key, line_number, patient_name, medical_condition, billing_amount, admission_date, discharge_date"
_LOAD_CTES = (f"WITH lines AS ({ADMISSION_LINES}), "
              f"batch AS (SELECT order_key, line_number, name AS patient_name, medical_condition, billing_amount, "
              f"admission_date, discharge_date FROM lines WHERE line_status = 'O'), "
              f"existing AS (SELECT DISTINCT name AS patient_name, admission_date FROM lines WHERE line_status = 'F'), "
              f"d AS (SELECT {LOAD_BATCH_COLS} FROM batch), "
              f"c AS (SELECT *, CASE WHEN patient_name IS NULL THEN 'NOT NULL violation: patient_name' "
              f"WHEN NOT coalesce(billing_amount BETWEEN 0 AND 100000, true) "
              f"THEN 'CHECK violation: billing_amount between 0 and 100000' END AS chk FROM d), "
              f"r AS (SELECT *, row_number() OVER (PARTITION BY patient_name, admission_date ORDER BY "
              + ", ".join(f"{c.strip()} ASC NULLS FIRST" for c in LOAD_BATCH_COLS.split(","))
              + ") AS rn FROM c WHERE chk IS NULL), "
              f"e AS (SELECT r.*, EXISTS (SELECT 1 FROM existing x WHERE x.patient_name IS NOT DISTINCT FROM r.patient_name "
              f"AND x.admission_date IS NOT DISTINCT FROM r.admission_date) AS ex FROM r) ")

_REJECTED = (f"SELECT {LOAD_BATCH_COLS}, chk AS reason FROM c WHERE chk IS NOT NULL "
             f"UNION ALL SELECT {LOAD_BATCH_COLS}, 'DUPLICATE — violates unique key (existing row)' FROM e WHERE ex "
             f"UNION ALL SELECT {LOAD_BATCH_COLS}, 'DUPLICATE — violates unique key (earlier row in batch)' "
             f"FROM e WHERE NOT ex AND rn > 1")

LOADING = {
    "load_typed_accepted": with_staging(
        f"SELECT staging_id, name, medical_condition, {safe_number_sql('billing_amount')} AS billing_amount, "
        f"admission_date, discharge_date FROM staging WHERE {_CONV_OK}"),
    "load_typed_rejected": with_staging(
        f"SELECT {error_id_sql('load', 'staging_id', _CONV_CTX)} AS error_id, 8114 AS error_number, "
        f"16 AS error_severity, 1 AS error_state, 'Error converting data type nvarchar to numeric.' AS error_message, "
        f"{_CONV_CTX} AS process_context FROM staging WHERE NOT {_CONV_OK}"),
    "cost_per_day": with_clean(
        f"SELECT name AS patient_name, billing_amount, {STAY} AS stay_days, "
        f"{xround(BILL_CENTS, f'{STAY} * 100', 2)} AS cost_per_day, "
        f"CASE WHEN {STAY} = 0 THEN 'Flagged — same day discharge, review source data' ELSE 'Valid' END "
        f"AS data_quality_flag FROM admissions_clean"),
    "diagnose_zero_stay": with_clean(
        f"SELECT name AS patient_name, billing_amount, {STAY} AS stay_days, "
        f"CASE WHEN {STAY} = 0 THEN 'ZERO STAY — will cause divide-by-zero' ELSE 'Valid' END AS diagnosis "
        f"FROM admissions_clean"),
    "insert_violations": (
        f"WITH lines AS ({ADMISSION_LINES}), "
        f"batch AS (SELECT name AS patient_name, admission_date, billing_amount FROM lines WHERE line_status = 'O'), "
        f"existing AS (SELECT DISTINCT name AS patient_name, admission_date FROM lines WHERE line_status = 'F') "
        f"SELECT patient_name, admission_date, 'DUPLICATE — violates UQ_patient_admission' AS violation_type "
        f"FROM batch b WHERE EXISTS (SELECT 1 FROM existing x WHERE x.patient_name = b.patient_name "
        f"AND x.admission_date = b.admission_date) "
        f"UNION ALL SELECT patient_name, admission_date, 'BILLING OUT OF RANGE — violates CHK_billing_range' "
        f"FROM batch WHERE NOT coalesce(billing_amount BETWEEN 0 AND 100000, true)"),
    "load_constrained_accepted": _LOAD_CTES + f"SELECT {LOAD_BATCH_COLS} FROM e WHERE rn = 1 AND NOT ex",
    "load_constrained_rejected": _LOAD_CTES + _REJECTED,
    "load_constrained_log": _LOAD_CTES + (
        f"SELECT CASE WHEN reason LIKE 'NOT NULL%' THEN 515 WHEN reason LIKE 'CHECK%' THEN 547 ELSE 2627 END AS error_number, "
        f"reason AS error_message, count(*) AS log_rows, count(*) AS ids, "
        f"count(DISTINCT coalesce(patient_name, 'NULL')) AS contexts FROM ({_REJECTED}) GROUP BY 1, 2"),
    "strict_load_failures": _LOAD_CTES + (
        f"SELECT 'conversion' AS load, count(*) AS failing_rows FROM ({STAGING}) WHERE NOT {_CONV_OK} "
        f"UNION ALL SELECT 'constraints', count(*) FROM ({_REJECTED})"),
}


# ---------------------------------------------------------------------------------------------
# hierarchies (H1-H5) over referral chains derived from conversations

REFERRALS = """
SELECT c.conv_id, c.turn, 'Conversation ' || CAST(c.conv_id AS VARCHAR) AS patient_name,
       p.role AS from_department, c.role AS to_department,
       CASE WHEN c.turn > 0 THEN c.turn - 1 END AS parent_turn
FROM conversations c LEFT JOIN conversations p
  ON c.conv_id = p.conv_id AND p.turn = CASE WHEN c.turn > 0 THEN c.turn - 1 END"""

GUARD_DEPTH = 5
RUNAWAY_ROUNDS = 3


def _chain(guard: int | None) -> str:
    where = f"WHERE c.depth < {guard}" if guard else ""
    return (f"WITH RECURSIVE refs AS ({REFERRALS}), chain AS ("
            f"SELECT conv_id, turn, patient_name, from_department, to_department, parent_turn, 1 AS depth, "
            f"patient_name || ' > ' || to_department AS referral_path FROM refs WHERE parent_turn IS NULL "
            f"UNION ALL SELECT r.conv_id, r.turn, r.patient_name, r.from_department, r.to_department, r.parent_turn, "
            f"c.depth + 1, c.referral_path || ' > ' || r.to_department FROM refs r JOIN chain c "
            f"ON r.conv_id = c.conv_id AND r.parent_turn = c.turn {where}) ")


HIERARCHY = {
    "referral_chain": _chain(None) + ("SELECT conv_id, turn, patient_name, depth, from_department, to_department, "
                                      "referral_path FROM chain ORDER BY patient_name, depth, conv_id, turn"),
    "referral_chain_guarded": _chain(GUARD_DEPTH) + ("SELECT patient_name, depth, to_department FROM chain "
                                                     "ORDER BY patient_name, depth, to_department"),
    "referral_runaway": _chain(RUNAWAY_ROUNDS + 2) + (
        f"SELECT 530 AS error_number, {RUNAWAY_ROUNDS} AS max_recursion, count(*) AS unfinished FROM chain "
        f"WHERE depth = {RUNAWAY_ROUNDS + 2} HAVING count(*) > 0"),
    "referral_roots": (f"WITH refs AS ({REFERRALS}) SELECT conv_id, turn, patient_name, from_department, to_department, "
                       f"parent_turn FROM refs WHERE parent_turn IS NULL"),
    "referral_parent_links": (f"WITH refs AS ({REFERRALS}) SELECT c.conv_id, c.turn, c.patient_name, c.from_department, "
                              f"c.to_department, c.parent_turn, p.turn AS parent_id FROM refs c JOIN refs p "
                              f"ON c.conv_id = p.conv_id AND c.parent_turn = p.turn"),
}


# ---------------------------------------------------------------------------------------------
# typed lookup (Y2): a text column searched with a numeric parameter

SINKS = {
    "csv_round_trip": with_staging("SELECT CAST(staging_id AS VARCHAR) AS staging_id, * EXCLUDE (staging_id) FROM staging"),
    "materialised_distribution": REPORTS["value_distribution"],
    "append_mapped": with_raw("SELECT label, count(*) AS rows, sum(amount) AS amount FROM (SELECT gender AS label, "
                              "billing_amount AS amount FROM admissions UNION ALL SELECT test_results, billing_amount "
                              "FROM admissions) GROUP BY 1"),
    "error_log_search": _LOAD_CTES + (
        f"SELECT CASE WHEN reason LIKE 'NOT NULL%' THEN 515 WHEN reason LIKE 'CHECK%' THEN 547 ELSE 2627 END AS error_number, "
        f"reason AS error_message, 'Scenario 5 — constraint violation: ' || coalesce(patient_name, 'NULL') AS process_context "
        f"FROM ({_REJECTED})"),
}

LOOKUP_VALUE = 12.31
LOOKUP = {
    "lookup_audit": with_staging("SELECT 'staging.billing_amount' AS column_name, 'string' AS column_type, "
                                 "'double' AS value_type, count(*) AS converted_rows FROM staging"),
    "typed_lookup": with_staging(f"SELECT * FROM staging WHERE billing_amount = '{LOOKUP_VALUE!r}'"),
}
