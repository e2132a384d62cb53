"""The same questions as DuckDB SQL on the same tables."""

from __future__ import annotations

VITALS = ("heart_rate", "spo2", "systolic_bp", "diastolic_bp", "temperature")
SHORT = {"heart_rate": "hr", "spo2": "spo2", "systolic_bp": "systolic_bp", "diastolic_bp": "diastolic_bp",
         "temperature": "temp"}
RANGES = {"heart_rate": (30, 220), "spo2": (50, 100), "systolic_bp": (60, 250), "diastolic_bp": (30, 150),
          "temperature": (30, 43)}
DEFAULT = {"hr": 120, "spo2": 90, "temp": 38.5, "sbp": 90}
STRICTER = {"hr": 100, "spo2": 95, "temp": 37.5, "sbp": 110}
METRICS = [f"{kind}_{short}" for short in SHORT.values() for kind in ("avg", "min", "max")]


def patient(expr: str) -> str:
    return f"'P' || lpad(CAST({expr} AS VARCHAR), greatest(length(CAST({expr} AS VARCHAR)), 6)::INTEGER, '0')"


def half_even(x: str, digits: int) -> str:
    """Rounding of the double itself; on a tie the error of the product decides."""
    s = f"{10 ** digits}::DOUBLE"
    hi = f"CAST(CAST({x} AS FLOAT) AS DOUBLE)"
    p = f"({x} * {s})"
    err = f"(({hi} * {s} - {p}) + ({x} - {hi}) * {s})"
    tie = f"({p} - floor({p}) = 0.5)"
    return (
        f"(CASE WHEN {tie} AND {err} > 0 THEN ceil({p}) WHEN {tie} AND {err} < 0 THEN floor({p}) "
        f"ELSE round_even({p}, 0) END / {s})"
    )


def mean(x: str) -> str:
    """Mean of the values as decimals: the same in any order of rows."""
    return f"(CAST(sum(CAST({x} AS DECIMAL(20, 10))) AS DOUBLE) / count({x}))"


READINGS = f"""
readings AS (
  SELECT event_id AS source_id,
    CASE WHEN event_id % 97 <> 0 THEN CAST(event_id AS VARCHAR) END AS event_id,
    CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 89 = 0 THEN {patient('900000000 + user_id')}
         ELSE {patient('user_id')} END AS patient_id,
    CASE WHEN event_type = 'click' THEN 60 + value END AS heart_rate,
    CASE WHEN event_type = 'error' THEN 100 - value / 4 END AS spo2,
    CASE WHEN event_type = 'purchase' THEN 160 - value END AS systolic_bp,
    CASE WHEN event_type = 'signup' THEN 60 + value / 2 END AS diastolic_bp,
    CASE WHEN event_type = 'view' THEN 36 + value / 20 END AS temperature,
    ts AS "timestamp"
  FROM events)"""

RAW = READINGS + """,
vitals_raw AS (
  SELECT * EXCLUDE (source_id) FROM readings
  UNION ALL
  SELECT * EXCLUDE (source_id) FROM readings WHERE source_id % 200 = 0)"""

CLEAN_TEST = " AND ".join(
    ["event_id IS NOT NULL", "patient_id IS NOT NULL", '"timestamp" IS NOT NULL']
    + [f"({v} IS NULL OR {v} BETWEEN {lo} AND {hi})" for v, (lo, hi) in RANGES.items()]
)
CLEAN = RAW + f""",
clean AS (SELECT * FROM vitals_raw WHERE {CLEAN_TEST}),
unique_readings AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY "timestamp", patient_id) AS rn FROM clean)
  WHERE rn = 1)"""


def _trips(limits: dict) -> str:
    return (
        f"bool_or(heart_rate > {limits['hr']}) AS t, bool_or(spo2 < {limits['spo2']}) AS h, "
        f"bool_or(temperature > {limits['temp']}) AS f, bool_or(systolic_bp < {limits['sbp']}) AS p"
    )


FLAGS = (
    "concat_ws(',', CASE WHEN t THEN 'TACHYCARDIA' END, CASE WHEN h THEN 'HYPOXIA' END, "
    "CASE WHEN f THEN 'FEVER' END, CASE WHEN p THEN 'HYPOTENSION' END)"
)
AVERAGES = ", ".join(f"round(avg({v}), 6) AS avg_{s}" for v, s in SHORT.items())


def windows(name: str, minutes: int = 5, limits: dict = DEFAULT, where: str = "true") -> str:
    return f"""
{name}_base AS (
  SELECT patient_id, time_bucket(INTERVAL {minutes} MINUTE, "timestamp") AS window_start,
    {AVERAGES}, round(min(heart_rate), 6) AS min_hr, round(max(heart_rate), 6) AS max_hr,
    round(min(spo2), 6) AS min_spo2, round(max(spo2), 6) AS max_spo2, count(*) AS event_count, {_trips(limits)}
  FROM unique_readings WHERE {where} GROUP BY ALL),
{name} AS (
  SELECT patient_id, window_start, window_start + INTERVAL {minutes} MINUTE AS window_end,
    avg_hr, avg_spo2, avg_systolic_bp, avg_diastolic_bp, avg_temp, min_hr, max_hr, min_spo2, max_spo2,
    event_count, {FLAGS} AS anomaly_flags
  FROM {name}_base)"""


WINDOWS = CLEAN + "," + windows("wins")


def episodes(name: str, source: str) -> str:
    return f"""
{name}_states AS (
  SELECT patient_id, window_start, window_end, k.alert_type, contains(anomaly_flags, k.alert_type) AS flagged
  FROM {source}, (VALUES ('TACHYCARDIA'), ('HYPOXIA'), ('FEVER'), ('HYPOTENSION')) AS k(alert_type)),
{name}_changes AS (
  SELECT * FROM (
    SELECT *, lag(flagged, 1, false) OVER (PARTITION BY patient_id, alert_type ORDER BY window_start) AS before
    FROM {name}_states) WHERE flagged <> before),
{name} AS (
  SELECT patient_id || ':' || alert_type || ':' || strftime(triggered_at, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS alert_id,
    patient_id, alert_type, triggered_at, resolved_at
  FROM (
    SELECT patient_id, alert_type, flagged, window_start AS triggered_at,
      lead(window_end) OVER (PARTITION BY patient_id, alert_type ORDER BY window_start) AS resolved_at
    FROM {name}_changes) WHERE flagged)"""


EPISODES = WINDOWS + "," + episodes("eps", "wins")

PATIENTS = f"""
patients AS (
  SELECT {patient('c_custkey')} AS patient_id, c_mktsegment AS ward,
    CAST(DATE '2023-12-01' + CAST(c_custkey % 30 AS INTEGER) AS DATE) AS admit_date
  FROM customer)"""

LATEST = """
latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY window_start DESC) AS rn FROM wins) WHERE rn = 1)"""

LAB_LINES = f"""
lab_lines AS (
  SELECT l_orderkey, l_linenumber, {patient('patient')} AS patient_id, l_returnflag || l_linestatus AS test_type,
    l_quantity, CAST(DATE '2024-01-01' + CAST(l_orderkey % 30 AS INTEGER) AS DATE) AS day,
    'labs_' || CAST(CAST(DATE '2024-01-01' + CAST(l_orderkey % 30 AS INTEGER) AS DATE) AS VARCHAR) || '.csv' AS source_file
  FROM (
    SELECT l.*, o_custkey % (SELECT 1 + max(user_id) FROM events) AS patient
    FROM lineitem l JOIN orders ON l_orderkey = o_orderkey))"""

LABS = LAB_LINES + """,
labs AS (
  SELECT patient_id, test_type, CAST(l_quantity AS DOUBLE) AS result_value, '5.0-45.0' AS reference_range,
    5.0::DOUBLE AS reference_low, 45.0::DOUBLE AS reference_high, CAST(day AS TIMESTAMP) AS collected_at,
    l_quantity < 5 OR l_quantity > 45 AS is_abnormal, day AS report_date, l_orderkey, l_linenumber
  FROM lab_lines)"""

LABS_RAW = LAB_LINES + """,
labs_raw AS (
  SELECT *, CASE WHEN l_orderkey % 1500 = 17 THEN 'n/a' ELSE CAST(l_quantity AS VARCHAR) END AS result_value,
    CASE WHEN l_orderkey % 1500 = 29 THEN 'bad' ELSE '5.0-45.0' END AS reference_range
  FROM lab_lines),
lab_errors AS (
  SELECT *, CASE WHEN try_cast(result_value AS DOUBLE) IS NULL THEN 'result_not_numeric'
                 WHEN reference_range = 'bad' THEN 'bad_reference_range' END AS row_error
  FROM labs_raw),
verdicts AS (
  SELECT source_file, count(*) AS row_count, count(row_error) AS bad_rows, count(row_error) = 0 AS accepted
  FROM lab_errors GROUP BY source_file)"""

DAILY = CLEAN + f""",
vital_days AS (
  SELECT patient_id, CAST("timestamp" AS DATE) AS report_date, count(*) AS event_count,
    {", ".join(f"{mean(v)} AS avg_{s}_x, min({v}) AS min_{s}_x, max({v}) AS max_{s}_x" for v, s in SHORT.items())}
  FROM unique_readings GROUP BY ALL),
vital_summary AS (
  SELECT patient_id, report_date, event_count, {", ".join(f"{half_even(m + '_x', 3)} AS {m}" for m in METRICS)}
  FROM vital_days WHERE coalesce({", ".join(f"min_{s}_x" for s in SHORT.values())}) IS NOT NULL)"""

TEST_TEXT = (
    "test_type || ':' || CAST(CAST(round(result_value * 100) AS BIGINT) AS VARCHAR) || ':' "
    "|| CAST(is_abnormal AS VARCHAR) || ':' || CAST(times AS VARCHAR)"
)
LAB_SUMMARY = f"""
lab_summary AS (
  SELECT patient_id, report_date, CAST(sum(times) AS BIGINT) AS result_count,
    CAST(coalesce(sum(times) FILTER (WHERE is_abnormal), 0) AS BIGINT) AS abnormal_count,
    string_agg({TEST_TEXT}, ';' ORDER BY test_type, result_value, is_abnormal) AS tests
  FROM (SELECT patient_id, report_date, test_type, result_value, is_abnormal, count(*) AS times FROM labs GROUP BY ALL)
  GROUP BY ALL)"""


def reports(name: str, limits: dict = DEFAULT) -> str:
    names = (("avg_hr", ">", "hr"), ("avg_spo2", "<", "spo2"), ("avg_temp", ">", "temp"), ("avg_systolic_bp", "<", "sbp"))
    tripped = " + ".join(f"CASE WHEN {c} {op} {limits[k]} THEN 1 ELSE 0 END" for c, op, k in names)
    measured = " + ".join(f"CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END" for c, _, _ in names)
    return f"""
{name}_burden AS (
  SELECT *, CASE WHEN ({measured}) > 0 THEN ({tripped})::DOUBLE / ({measured}) ELSE 0::DOUBLE END AS vital_burden,
    least(coalesce(abnormal_count, 0)::DOUBLE / greatest(coalesce(result_count, 0), 1), 1::DOUBLE) AS lab_burden
  FROM vital_summary FULL JOIN lab_summary USING (patient_id, report_date)),
{name}_score AS (
  SELECT *, least(100::DOUBLE, 100::DOUBLE * (0.6::DOUBLE * vital_burden + 0.3::DOUBLE * lab_burden
    + 0.1::DOUBLE * 0::DOUBLE)) AS exact_score
  FROM {name}_burden),
{name}_round AS (SELECT *, {half_even('exact_score', 2)} AS risk_score FROM {name}_score),
{name} AS (
  SELECT *, CASE WHEN risk_score >= 70 THEN 'HIGH' WHEN risk_score >= 30 THEN 'MEDIUM' ELSE 'LOW' END AS risk_flag
  FROM {name}_round)"""


REPORT = DAILY + "," + LABS + "," + LAB_SUMMARY + "," + reports("report")
REPORT_COLUMNS = (
    "patient_id, report_date, event_count, " + ", ".join(METRICS)
    + ", coalesce(result_count, 0) AS result_count, coalesce(abnormal_count, 0) AS abnormal_count, "
    "coalesce(tests, '') AS tests, risk_score, risk_flag"
)

DIRTY = READINGS + f""",
dirty AS (
  SELECT source_id, event_id, patient_id, "timestamp" AS received_at,
    {", ".join(f"CASE WHEN source_id % 109 <> 0 THEN {v} END AS {v}" for v in VITALS)},
    CASE WHEN source_id % 107 = 0 THEN 'not-a-date'
         ELSE strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END AS time_text
  FROM readings),
checked AS (
  SELECT *, CASE WHEN patient_id IS NULL THEN 'missing_patient' WHEN time_text = 'not-a-date' THEN 'bad_timestamp'
                 WHEN coalesce({", ".join(VITALS)}) IS NULL THEN 'no_vitals' END AS invalid_detail
  FROM dirty)"""


PUBLISHED = RAW + f""",
published AS (SELECT * FROM vitals_raw WHERE patient_id IS NOT NULL AND coalesce({", ".join(VITALS)}) IS NOT NULL)"""


def gaps(by: str | None) -> str:
    over = f"PARTITION BY {by} ORDER BY" if by else "ORDER BY"
    keep = f"{by}, " if by else ""
    return f"""WITH {PUBLISHED}
SELECT {keep}gap_start, gap_end, round(epoch_us(gap_end - gap_start) / 1000000.0, 6)::DOUBLE AS gap_seconds,
  gap_start + INTERVAL 90 SECOND AS fired_at
FROM (SELECT {keep}"timestamp" AS gap_start, lead("timestamp") OVER ({over} "timestamp") AS gap_end
      FROM published)
WHERE epoch_us(gap_end - gap_start) > 90000000"""


def age(by: str | None) -> str:
    group, keep = (f"GROUP BY {by}", f"{by}, ") if by else ("", "")
    return f"""WITH {PUBLISHED}
SELECT {keep}last_event, round(age_us / 1000000.0, 6)::DOUBLE AS age_seconds,
  CASE WHEN age_us >= 60000000 THEN 'critical' WHEN age_us >= 30000000 THEN 'warning' ELSE 'ok' END AS band
FROM (SELECT {keep}max("timestamp") AS last_event,
        epoch_us(TIMESTAMP '2024-01-31' - max("timestamp")) AS age_us FROM published {group})"""


def snapshot(where: str) -> str:
    return f"""WITH {EPISODES},{LATEST},{PATIENTS}
SELECT l.patient_id, p.ward, window_start, window_end, avg_hr, avg_spo2, avg_systolic_bp, avg_diastolic_bp, avg_temp,
  event_count, anomaly_flags,
  EXISTS (SELECT 1 FROM eps e WHERE e.patient_id = l.patient_id AND e.resolved_at IS NULL) AS active_alert
FROM latest l JOIN patients p ON p.patient_id = l.patient_id WHERE {where}"""


STORED = {
    "vitals_live": "wins",
    "lab_results": "labs",
    "daily_risk_report": "report",
    "alerts_log": "eps",
}
ALL_STORED = EPISODES + "," + DAILY[len(CLEAN) + 1 :] + "," + LABS + "," + LAB_SUMMARY + "," + reports("report")


def _violations(checks: list[tuple[str, str, str, str]]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, count(*) FILTER (WHERE {bad}) AS violations FROM {source}"
        for table, source, rule, bad in checks
    )


CHECKS = [
    ("vitals_live", "wins", "window_end_after_start", "NOT (window_end > window_start)"),
    ("vitals_live", "wins", "event_count_not_negative", "event_count < 0"),
    ("lab_results", "labs", "low_not_above_high", "reference_low > reference_high"),
    ("daily_risk_report", "report", "score_in_0_100", "risk_score NOT BETWEEN 0 AND 100"),
    ("daily_risk_report", "report", "known_risk_flag", "risk_flag NOT IN ('LOW', 'MEDIUM', 'HIGH')"),
    ("alerts_log", "eps", "known_alert_type", "alert_type NOT IN ('TACHYCARDIA', 'HYPOXIA', 'FEVER', 'HYPOTENSION')"),
    ("alerts_log", "eps", "resolved_not_before_triggered", "resolved_at < triggered_at"),
]
NULLS = {
    ("vitals_raw", "vitals_raw"): ["event_id", "patient_id", *VITALS, "timestamp"],
    ("vitals_live", "wins"): ["patient_id", "window_start", "window_end", "event_count", "anomaly_flags"],
    ("lab_results", "labs"): ["patient_id", "test_type", "result_value", "reference_range", "reference_low",
                              "reference_high", "collected_at", "is_abnormal"],
    ("daily_risk_report", "report"): ["patient_id", "report_date", "risk_score", "risk_flag"],
    ("patients", "patients"): ["patient_id", "ward", "admit_date"],
    ("alerts_log", "eps"): ["alert_id", "patient_id", "alert_type", "triggered_at"],
}
KEYS = {
    "vitals_live": "patient_id, window_start",
    "lab_results": "patient_id, test_type, collected_at",
    "daily_risk_report": "patient_id, report_date",
    "alerts_log": "alert_id",
}
READING_COLUMNS = f'event_id, patient_id, {", ".join(f"round({v}, 6) AS {v}" for v in VITALS)}, "timestamp"'
LAB_COLUMNS = (
    "patient_id, test_type, result_value, reference_range, reference_low, reference_high, collected_at, is_abnormal"
)
WIN_SQL = f"WITH {WINDOWS} SELECT * FROM wins"
EPISODE_SQL = f"WITH {EPISODES} SELECT * FROM eps"
# Without what arrives weeks behind the watermark.
ON_TIME = "FROM events WHERE NOT (event_id % 41 = 5 AND ts < TIMESTAMP '2024-01-08'))"
NOON = "wins_noon AS (SELECT * FROM wins WHERE window_end <= TIMESTAMP '2024-01-15 12:00:00')"


def all_oracles() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["clean_events"] = f"WITH {CLEAN} SELECT {READING_COLUMNS} FROM clean"
    sql["dedupe_events"] = f"WITH {CLEAN} SELECT {READING_COLUMNS} FROM unique_readings"
    sql["event_alerts"] = f"""WITH {CLEAN}
SELECT event_id, patient_id, "timestamp", {FLAGS} AS alerts FROM (
  SELECT *, heart_rate > 120 AS t, spo2 < 90 AS h, temperature > 38.5 AS f, systolic_bp < 90 AS p FROM unique_readings)"""
    sql["window_vitals_5m"] = WIN_SQL
    sql["window_vitals_1h"] = f"WITH {CLEAN}, {windows('wins', 60)} SELECT * FROM wins"
    sql["window_vitals_1d"] = f"WITH {CLEAN}, {windows('wins', 1440)} SELECT * FROM wins"
    sql["alert_episodes"] = EPISODE_SQL
    sql["open_alerts"] = f"""WITH {EPISODES}
SELECT patient_id, alert_type, min(triggered_at) AS triggered_at, min(alert_id) AS alert_id
FROM eps WHERE resolved_at IS NULL GROUP BY ALL"""
    sql["alerts_active"] = EPISODE_SQL + " WHERE resolved_at IS NULL ORDER BY triggered_at DESC"
    sql["alerts_resolved"] = EPISODE_SQL + " WHERE resolved_at IS NOT NULL ORDER BY triggered_at DESC"
    sql["alerts_to_open"] = f"""WITH {WINDOWS},{LATEST}, {NOON},{episodes('eps', 'wins_noon')}
SELECT patient_id, alert_type, window_start AS triggered_at
FROM latest, (VALUES ('TACHYCARDIA'), ('HYPOXIA'), ('FEVER'), ('HYPOTENSION')) AS k(alert_type)
WHERE contains(anomaly_flags, alert_type) AND NOT EXISTS (
  SELECT 1 FROM eps e WHERE e.patient_id = latest.patient_id AND e.alert_type = k.alert_type AND e.resolved_at IS NULL)"""
    sql["alerts_to_close"] = f"""WITH {WINDOWS},{LATEST}, {NOON},{episodes('eps', 'wins_noon')}
SELECT alert_id, e.patient_id, alert_type, triggered_at, window_end AS resolved_at
FROM eps e JOIN latest USING (patient_id)
WHERE resolved_at IS NULL AND NOT contains(anomaly_flags, alert_type) AND window_start >= triggered_at"""
    sql["ward_snapshot"] = snapshot("true")
    sql["ward_snapshot_one_ward"] = snapshot("p.ward = 'BUILDING'")
    sql["patient_alert_list"] = f"""WITH {EPISODES},{PATIENTS}
SELECT * FROM eps WHERE patient_id = (
  SELECT patient_id FROM eps WHERE patient_id IN (SELECT patient_id FROM patients)
  GROUP BY patient_id ORDER BY count(*) DESC, patient_id LIMIT 1)
ORDER BY triggered_at DESC"""
    sql["last_data_received"] = f"WITH {WINDOWS} SELECT max(window_end) AS last_data_received FROM wins"

    sql["dead_letters"] = f"""WITH {DIRTY}
SELECT coalesce(patient_id, 'unknown') AS key, 'failed_validation' AS error_reason, invalid_detail, event_id,
  time_text AS raw_timestamp, 8::BIGINT AS payload_fields FROM checked WHERE invalid_detail IS NOT NULL"""
    sql["dead_letter_totals"] = f"""WITH {DIRTY}
SELECT invalid_detail, count(*) AS dead_letters FROM checked WHERE invalid_detail IS NOT NULL GROUP BY ALL"""
    sql["dead_letters_over_time"] = f"""WITH {DIRTY}
SELECT time_bucket(INTERVAL 1 MINUTE, received_at) AS window_start, invalid_detail, count(*) AS dead_letters
FROM checked WHERE invalid_detail IS NOT NULL GROUP BY ALL"""
    sql["dead_letters_whole"] = f"""WITH {DIRTY},
texts AS (
  SELECT *, '{{"event_id": ' || event_number || ', "patient_id": ' || coalesce('"' || patient_id || '"', 'null') || ', "vital": '
    || coalesce(CAST(coalesce({", ".join(VITALS)}) AS VARCHAR), 'null') || ', "heart_rate": ' || coalesce('"' || CAST(heart_rate AS VARCHAR) || '"', 'null')
    || ', "timestamp": "' || time_text || '", "device": {{"id": ' || event_number % 7 || ', "tag": "a\\"b"}}}}' AS whole FROM (
    SELECT d.*, source_id AS event_number FROM checked d)),
sent AS (SELECT *, CASE WHEN event_number % 113 = 0 THEN left(whole, 40) ELSE whole END AS raw_text, event_number % 113 = 0 AS broken FROM texts)
SELECT CASE WHEN broken THEN 'unknown' ELSE coalesce(patient_id, 'unknown') END AS key,
  '{{"raw_payload":' || CASE WHEN broken THEN '"' || replace(raw_text, '"', '\\"') || '"' ELSE raw_text END
    || ',"error_reason":"failed_validation"}}' AS value,
  CASE WHEN broken THEN 'undecodable' WHEN patient_id IS NULL THEN 'missing_patient'
       WHEN time_text = 'not-a-date' THEN 'bad_timestamp' ELSE 'no_vitals' END AS invalid_detail
FROM sent WHERE broken OR patient_id IS NULL OR time_text = 'not-a-date' OR heart_rate IS NULL"""
    sql["published_messages"] = f"""WITH {DIRTY}
SELECT patient_id AS key, event_id, time_text AS event_time, event_id AS trace_id,
  coalesce(length(event_id), 36) AS trace_length FROM checked WHERE invalid_detail IS NULL"""
    sql["quality_counts"] = f"""WITH {CLEAN}
SELECT (SELECT count(*) FROM unique_readings) AS accepted,
  (SELECT count(*) FROM vitals_raw) - (SELECT count(*) FROM clean) AS rejected"""
    sql["check_violations"] = f"WITH {ALL_STORED}\n{_violations(CHECKS)}"
    filled = ["vitals_summary", "lab_summary", "generated_at"]
    sql["null_violations"] = f"WITH {ALL_STORED},{PATIENTS}\n" + _violations(
        [(t, s, c, f'"{c}" IS NULL') for (t, s), columns in NULLS.items() for c in columns]
        + [("daily_risk_report", "report", c, "false") for c in filled]
    )
    sql["pk_duplicates"] = f"""WITH {LABS}
SELECT patient_id, test_type, collected_at, count(*) AS row_count FROM labs GROUP BY ALL HAVING count(*) > 1"""
    sql["pk_duplicate_totals"] = f"WITH {ALL_STORED}\n" + "\nUNION ALL\n".join(
        f"SELECT count(*) AS duplicated_keys, '{t}' AS table_name FROM "
        f"(SELECT {KEYS[t]} FROM {s} GROUP BY ALL HAVING count(*) > 1)" for t, s in STORED.items()
    )
    sql["fk_orphans"] = f"WITH {ALL_STORED},{PATIENTS}\n" + "\nUNION ALL\n".join(
        f"SELECT patient_id, count(*) AS row_count, '{t}' AS table_name FROM {s} "
        f"WHERE patient_id NOT IN (SELECT patient_id FROM patients) GROUP BY patient_id" for t, s in STORED.items()
    )

    sql["reference_range_parse"] = f"""WITH {LABS_RAW}
SELECT reference_range, try_cast(nullif(regexp_extract(reference_range, '^([0-9.]+)-([0-9.]+)$', 1), '') AS DOUBLE) AS low,
  try_cast(nullif(regexp_extract(reference_range, '^([0-9.]+)-([0-9.]+)$', 2), '') AS DOUBLE) AS high,
  count(*) AS row_count FROM labs_raw GROUP BY ALL"""
    sql["lab_normalized"] = f"WITH {LABS} SELECT {LAB_COLUMNS} FROM labs"
    sql["lab_quoted_breaks"] = f"""WITH {LABS}
SELECT patient_id, CASE WHEN l_orderkey % 5 = 0
    THEN test_type || chr(10) || chr(10) || '"note", ' || l_linenumber || chr(10) || ',' ELSE test_type END AS test_type,
  CAST(l_quantity AS VARCHAR) AS result_value, '5.0-45.0' AS reference_range, CAST(day AS VARCHAR) AS collected_at
FROM lab_lines"""
    sql["lab_row_errors"] = f"""WITH {LABS_RAW}
SELECT source_file, row_error, count(*) AS row_count FROM lab_errors GROUP BY ALL"""
    sql["lab_file_verdicts"] = f"WITH {LABS_RAW} SELECT * FROM verdicts"
    sql["lab_file_verdicts_landing"] = f"""WITH {LABS_RAW}
SELECT source_file, count(*) AS row_count, count(*) FILTER (WHERE row_error = 'result_not_numeric') AS bad_rows,
  count(*) FILTER (WHERE row_error = 'result_not_numeric') = 0 AS accepted FROM lab_errors GROUP BY source_file"""
    sql["lab_valid_rows"] = f"""WITH {LABS_RAW}
SELECT patient_id, test_type, CAST(result_value AS DOUBLE) AS result_value, reference_range,
  5.0::DOUBLE AS reference_low, 45.0::DOUBLE AS reference_high, CAST(day AS TIMESTAMP) AS collected_at,
  l_quantity < 5 OR l_quantity > 45 AS is_abnormal
FROM labs_raw WHERE source_file IN (SELECT source_file FROM verdicts WHERE accepted)"""
    sql["lab_file_counts"] = f"""WITH {LABS_RAW}
SELECT count(*) FILTER (WHERE accepted) AS accepted_files, count(*) FILTER (WHERE NOT accepted) AS rejected_files
FROM verdicts"""
    sql["lab_summary"] = f"WITH {LABS},{LAB_SUMMARY} SELECT * FROM lab_summary"
    sql["lab_test_pages"] = f"""WITH {LABS}
SELECT patient_id, report_date, test_type, result_value, is_abnormal, times,
  CAST(sum(times) OVER day AS BIGINT) AS result_count,
  CAST(sum(CASE WHEN is_abnormal THEN times ELSE 0 END) OVER day AS BIGINT) AS abnormal_count,
  CAST('0x' || md5(concat_ws(':', test_type, CAST(result_value AS VARCHAR), CAST(is_abnormal AS VARCHAR)))[1:8] AS BIGINT)
    % CAST(ceil(count(*) OVER day / 2.0) AS BIGINT) AS page
FROM (SELECT patient_id, report_date, test_type, result_value, is_abnormal, count(*) AS times FROM labs GROUP BY ALL)
WINDOW day AS (PARTITION BY patient_id, report_date)"""

    sql["vitals_daily_summary"] = f"WITH {DAILY} SELECT * FROM vital_summary"
    sql["risk_scores"] = f"""WITH {REPORT}
SELECT patient_id, report_date, event_count, result_count, abnormal_count, risk_score, risk_flag FROM report"""
    sql["daily_risk_report"] = f"""WITH {REPORT}
SELECT {REPORT_COLUMNS} FROM report WHERE report_date = DATE '2024-01-09' ORDER BY patient_id"""
    sql["daily_report_high"] = f"""WITH {REPORT}
SELECT {REPORT_COLUMNS} FROM report WHERE report_date = DATE '2024-01-09' AND risk_flag = 'HIGH'
ORDER BY risk_score DESC, patient_id"""
    sql["report_backfill"] = f"WITH {REPORT} SELECT {REPORT_COLUMNS} FROM report"
    sql["report_counts"] = f"WITH {REPORT} SELECT report_date, count(*) AS report_count FROM report GROUP BY ALL"
    present = " + ".join(f"CASE WHEN {m} IS NOT NULL THEN 1 ELSE 0 END" for m in ["event_count", *METRICS])
    sql["report_json"] = f"""WITH {REPORT}
SELECT patient_id, report_date, event_count, CAST({present} AS BIGINT) AS vital_keys,
  coalesce(result_count, 0) AS result_count, coalesce(result_count, 0) AS test_count FROM report"""

    old = windows("old_wins", where="\"timestamp\" < TIMESTAMP '2024-01-21'")
    new = windows("new_wins", limits=STRICTER, where="\"timestamp\" >= TIMESTAMP '2024-01-10'")
    sql["upsert_live"] = f"""WITH {CLEAN},{old},{new}
SELECT * FROM new_wins UNION ALL
SELECT * FROM old_wins o WHERE NOT EXISTS (
  SELECT 1 FROM new_wins n WHERE n.patient_id = o.patient_id AND n.window_start = o.window_start)"""
    sql["upsert_report"] = f"""WITH {REPORT},{reports('stricter', STRICTER)}
SELECT patient_id, report_date, risk_score, risk_flag FROM report WHERE report_date < DATE '2024-01-10'
UNION ALL
SELECT patient_id, report_date, risk_score, risk_flag FROM stricter WHERE report_date >= DATE '2024-01-10'"""
    sql["report_stored"] = f"""WITH {REPORT}, results AS (
  SELECT patient_id, report_date, test_type, result_value, is_abnormal, count(*) AS times FROM labs GROUP BY ALL)
SELECT patient_id, report_date, event_count, {", ".join(METRICS)}, coalesce(result_count, 0) AS result_count,
  coalesce(abnormal_count, 0) AS abnormal_count, risk_score, risk_flag, test_type, result_value, is_abnormal, times
FROM report LEFT JOIN results USING (patient_id, report_date)"""
    sql["upsert_partial"] = f"""WITH {CLEAN},{old},{new}
SELECT patient_id, window_start, o.window_end,
  CASE WHEN window_start >= TIMESTAMP '2024-01-18' THEN NULL ELSE o.avg_hr END AS avg_hr, o.avg_spo2,
  CASE WHEN n.window_end IS NOT NULL THEN n.event_count ELSE o.event_count END AS event_count,
  CASE WHEN n.window_end IS NOT NULL THEN n.anomaly_flags ELSE o.anomaly_flags END AS anomaly_flags
FROM old_wins o FULL JOIN new_wins n USING (patient_id, window_start)"""
    sql["report_day_mixed_archive"] = f"""WITH {REPORT}, results AS (
  SELECT patient_id, report_date, test_type, result_value, is_abnormal, count(*) AS times FROM labs
  WHERE report_date = DATE '2024-01-09' OR patient_id < 'P000005' GROUP BY ALL)
SELECT patient_id, report_date, event_count, {", ".join(METRICS)},
  CASE WHEN report_date = DATE '2024-01-09' OR patient_id < 'P000005' THEN coalesce(result_count, 0) ELSE 0 END AS result_count,
  test_type, result_value, is_abnormal, times
FROM report LEFT JOIN results USING (patient_id, report_date)
WHERE report_date IN (DATE '2024-01-09', DATE '2024-01-10') AND (event_count IS NOT NULL OR result_count > 0)
  AND NOT (event_count IS NULL AND report_date = DATE '2024-01-10' AND patient_id >= 'P000005')
"""
    broken = {
        "vitals_live": {"window_end_after_start": "minute(window_start) = 0", "event_count_not_negative": "minute(window_start) = 5"},
    }
    bad_windows = broken["vitals_live"]
    sql["check_violations_imported"] = f"""WITH {WINDOWS},{LABS},
rows_of AS (
  SELECT 'vitals_live' AS table_name, unnest(['window_end_after_start', 'event_count_not_negative']) AS rule,
    unnest([(SELECT count(*) FROM wins WHERE {bad_windows["window_end_after_start"]}), (SELECT count(*) FROM wins WHERE {bad_windows["event_count_not_negative"]})]) AS violations
  UNION ALL
  SELECT 'lab_results', 'low_not_above_high', (SELECT count(*) FROM labs WHERE l_orderkey % 15 = 4))
SELECT * FROM rows_of"""
    sql["upsert_patients"] = f"""WITH {PATIENTS}, moved AS (
  SELECT {patient('c_custkey')} AS patient_id, 'MOVED' AS ward, DATE '2024-02-01' AS admit_date
  FROM customer WHERE c_acctbal < 0)
SELECT * FROM moved UNION ALL
SELECT * FROM patients WHERE patient_id NOT IN (SELECT patient_id FROM moved)"""
    sql["upsert_labs"] = f"""WITH {LABS}
SELECT patient_id, test_type, collected_at, result_value, is_abnormal FROM (
  SELECT *, row_number() OVER (PARTITION BY patient_id, test_type, collected_at
    ORDER BY l_orderkey DESC, l_linenumber DESC, result_value DESC) AS rn FROM labs) WHERE rn = 1"""

    sql["upsert_stored_labs"] = f"""WITH {LABS}
SELECT patient_id, test_type, CASE WHEN late THEN 50::DOUBLE ELSE result_value END AS result_value, reference_range,
  reference_low, reference_high, collected_at, late OR is_abnormal AS is_abnormal
FROM (
  SELECT *, collected_at >= TIMESTAMP '2024-01-20' AS late, row_number() OVER (
    PARTITION BY patient_id, test_type, collected_at ORDER BY result_value DESC) AS rn FROM labs) WHERE rn = 1"""

    sql["events_per_second"] = f"""WITH {PUBLISHED}
SELECT window_start, event_count, round(event_count / 60.0, 6)::DOUBLE AS events_per_second FROM (
  SELECT time_bucket(INTERVAL 1 MINUTE, "timestamp") AS window_start, count(*) AS event_count
  FROM published GROUP BY ALL)"""
    sql["source_age"] = age("patient_id")
    sql["feed_age"] = age(None)
    sql["stale_gaps"] = gaps(None)
    sql["stale_gaps_by_patient"] = gaps("patient_id")
    sql["stale_now"] = f"""WITH {PUBLISHED}
SELECT patient_id, gap_start, round(age_us / 1000000.0, 6)::DOUBLE AS gap_seconds, gap_start + INTERVAL 90 SECOND AS fired_at
FROM (SELECT patient_id, max("timestamp") AS gap_start, epoch_us(TIMESTAMP '2024-01-31' - max("timestamp")) AS age_us
      FROM published GROUP BY patient_id)
WHERE age_us > 90000000"""
    sql["dlq_rate_alarm"] = f"""WITH {DIRTY},
steps AS (
  SELECT CAST(floor(epoch_us(received_at) / 3600000000) AS BIGINT) AS step, count(*) AS n
  FROM checked WHERE invalid_detail IS NOT NULL GROUP BY ALL),
instants AS (
  SELECT unnest(range((SELECT min(step) FROM steps), (SELECT max(step) FROM steps) + 12)) AS instant),
rates AS (
  SELECT instant, coalesce((SELECT sum(n) FROM steps WHERE step >= instant - 6 AND step < instant), 0) / 21600::DOUBLE AS rate
  FROM instants)
SELECT make_timestamp(instant * 3600000000) AS alarm_at, round(rate, 6) AS rate FROM rates r
WHERE (SELECT count(*) FROM rates h WHERE h.instant BETWEEN r.instant - 3 AND r.instant AND h.rate > 2 / 21600::DOUBLE) = 4"""
    sql["sim_clock_map"] = """
SELECT event_id, ts AS real_time, date_trunc('second', sim) AS sim_time, CAST(sim AS DATE) AS sim_date FROM (
  SELECT event_id, ts,
    make_timestamp(epoch_us(TIMESTAMP '2026-01-01') + epoch_us(ts - TIMESTAMP '2024-01-01') * 288) AS sim
  FROM events)"""
    sql["sim_date_window"] = """
SELECT sim_date, TIMESTAMP '2024-01-01' + to_seconds(300 * d) AS real_start,
  TIMESTAMP '2024-01-01' + to_seconds(300 * (d + 1)) AS real_end
FROM (
  SELECT DISTINCT sim_date, date_diff('day', DATE '2026-01-01', sim_date) AS d FROM (
    SELECT CAST(make_timestamp(epoch_us(TIMESTAMP '2026-01-01') + epoch_us(ts - TIMESTAMP '2024-01-01') * 288) AS DATE)
      AS sim_date FROM events))"""

    sql["archive_partition_read"] = f"""WITH {CLEAN}
SELECT {READING_COLUMNS}, CAST("timestamp" AS DATE) AS date FROM unique_readings
WHERE CAST("timestamp" AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-13'"""
    sql["lab_archive_read"] = f"""WITH {LABS}
SELECT {LAB_COLUMNS}, report_date AS date FROM labs
WHERE report_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-13'"""
    sql["file_mode_windows"] = WIN_SQL
    sql["file_mode_counts"] = f"""WITH {DIRTY}, good AS (
  SELECT * FROM dirty WHERE event_id IS NOT NULL AND patient_id IS NOT NULL AND time_text <> 'not-a-date'
    AND {" AND ".join(f"({v} IS NULL OR {v} BETWEEN {lo} AND {hi})" for v, (lo, hi) in RANGES.items())})
SELECT (SELECT count(DISTINCT event_id) FROM good) AS accepted,
  (SELECT count(*) FROM dirty) - (SELECT count(*) FROM good) AS rejected"""
    sql["stream_windows"] = WIN_SQL
    sql["stream_alerts"] = EPISODE_SQL
    sql["stream_windows_late"] = WIN_SQL.replace("FROM events)", ON_TIME)
    sql["stream_alerts_late"] = EPISODE_SQL.replace("FROM events)", ON_TIME)
    sql["stream_alert_state"] = f"""WITH {WINDOWS}, closed AS (
  SELECT * FROM wins WHERE window_end <= (SELECT max("timestamp") FROM clean) - INTERVAL 2 MINUTE),
{episodes('eps', 'closed')} SELECT * FROM eps"""
    sql["stream_alert_handover"] = sql["stream_alert_state"]
    sql["stream_stale"] = sql["stale_now"]
    sql["stream_stale_gaps"] = sql["stale_gaps_by_patient"]
    sql["stream_dlq_alarm"] = sql["dlq_rate_alarm"]
    sql["stream_dedupe"] = sql["dedupe_events"]
    sql["stream_archive"] = f'WITH {CLEAN} SELECT {READING_COLUMNS}, CAST("timestamp" AS DATE) AS date FROM clean'
    sql["stream_dead_letters"] = f"""WITH {DIRTY}
SELECT CASE WHEN invalid_detail IS NULL THEN 'vitals' ELSE 'dead_letters' END AS topic,
  coalesce(patient_id, 'unknown') AS key, count(*) AS messages FROM checked GROUP BY ALL"""
    sql["stream_lab_intake"] = f"""WITH {LABS_RAW}
SELECT CAST(day AS VARCHAR) AS day, CAST(sum(row_count) AS BIGINT) AS row_count, CAST(sum(bad_rows) AS BIGINT) AS bad_rows
FROM verdicts JOIN (SELECT DISTINCT source_file, day FROM lab_lines) USING (source_file) GROUP BY ALL"""
    return sql
