"""DuckDB SQL for the further registered queries, written from the rules over the same stand-in rows."""

from __future__ import annotations

from telemsg.sample.oracle_sql import (
    B310_FIELDS, B310_TYPED, C1F0_FIELDS, C1F0_TYPED, HAS_LAYOUT, JOINED, LENGTHS, REFLEN, TEL, VALIDITY, VEH,
    decode_message_sql, typed_select, with_,
)

J = with_(TEL, VEH, JOINED)
V = with_(TEL, VEH, JOINED, LENGTHS, REFLEN, VALIDITY)
TYPED = {"C1F0_supply_voltage", "C1F0_lamp_state", "C1F0_coolant_temp", "C1F0_trip_counter", "B310_latest_start_cause"}
_COLS = [
    c
    for c in typed_select("diag_c1f0", C1F0_FIELDS, C1F0_TYPED, "C1F0_is_valid")
    + typed_select("diag_b310", B310_FIELDS, B310_TYPED, '"B310_is_valid"')
    if c.rpartition('AS "')[2].rstrip('"') in TYPED
]
DECODED = ", ".join(_COLS)
DM = f"WITH dm AS ({decode_message_sql()})\n"
LEN_OK = "coalesce(length(diag_c1f0) = C1F0_reference_len, false)"
BOTH_OK = f"({LEN_OK} AND coalesce(length(diag_b310) = \"B310_reference_len\", false))"

# (event, message) with its text, as the documents see it: every 59th event's texts are empty
MSGS = """, msgs AS (
  SELECT event_id, MODEL_CODE, MODEL_YEAR, 'C1F0' AS msg, diag_c1f0 AS text, C1F0_is_valid AS ok FROM flags
  UNION ALL SELECT event_id, MODEL_CODE, MODEL_YEAR, 'B310', diag_b310, "B310_is_valid" FROM flags
), docs AS (
  SELECT *, CASE WHEN event_id % 59 = 0 OR text IS NULL THEN 'Empty DDT string'
    WHEN NOT """ + HAS_LAYOUT + """ THEN 'Structure file not found' END AS error, ok AND """ + HAS_LAYOUT + """ AS decoded
  FROM msgs
)"""


def _positions() -> str:
    """field_index, first and last byte of every C1F0 field, from its position, size and the message's bytes."""
    out = []
    for i, (_, pos, size, _, _) in enumerate(C1F0_FIELDS):
        b, t = (int(x.strip("[]")) for x in pos.split())
        n, k = (int(x.strip("[]")) for x in size.split())
        first = max(b - 1, 0) if n and k else b
        last = b + n - 1 if n else b
        little = bool(n) == bool(k)
        out.append(f"({i}, {first}, {last}, {str(little and t > 0).lower()})")
    return ", ".join(out)


def _nibbles(hex_text: str) -> str:
    table = ", ".join(f"'{i:04b}'" for i in range(16))
    return (
        f"list_aggregate(list_transform(string_split({hex_text}, ''), "
        f"lambda c: [{table}][strpos('0123456789ABCDEF', c)]), 'string_agg', '')"
    )


B310_LISTS = ["SID-PR", "RecordDataIdentifier", "RecordDataIdentifier"] + [f[0] for f in B310_FIELDS[2:]]

MORE_SQL = {
    "whole_table": "SELECT * FROM events",
    "overwritten_table": J + "SELECT event_id, MODEL_CODE, tbm_keyon FROM joined WHERE MODEL_YEAR <> 2024",
    "appended_table": J
    + "SELECT event_id, MODEL_CODE, CASE WHEN MODEL_YEAR <> 2024 THEN tbm_keyon END AS tbm_keyon FROM joined",
    "union_written": J
    + "SELECT event_id, MODEL_CODE, CASE WHEN MODEL_YEAR <> 2024 THEN tbm_keyon END AS tbm_keyon FROM joined",
    "run_metadata": J
    + "SELECT event_id, true AS processing_timestamp, '2' AS pipeline_version, '7' AS config_version FROM joined",
    "summary_table": J
    + 'SELECT MODEL_CODE, MODEL_YEAR, count(*) AS "rows", true AS processing_timestamp FROM joined GROUP BY ALL',
    "family_year_rows": J + "SELECT event_id, vin FROM joined WHERE MODEL_CODE = 'AU' AND MODEL_YEAR = 2025",
    "named_families": J + "SELECT event_id, MODEL_CODE FROM joined WHERE MODEL_CODE IN ('AU', 'HO')",
    "present_messages": with_(TEL) + "SELECT event_id FROM tel WHERE diag_c1f0 IS NOT NULL AND tbm_keyon IS NOT NULL",
    "pattern_cast": with_(TEL)
    + "SELECT event_id, substr(diag_c1f0, 7, 4) AS code_hex, TRY_CAST(vin AS INTEGER) AS code_vin,"
    " batteryvoltagelevel AS volt FROM tel",
    "dt_added": with_(TEL) + "SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN dt END AS dt FROM tel",
    "sample_counts": J + "SELECT MODEL_CODE, least(count(*), 7) AS count FROM joined GROUP BY MODEL_CODE",
    "filter_effect": J
    + """SELECT MODEL_CODE, count(*) AS rows_before, count(*) FILTER (length(diag_c1f0) = 20) AS rows_after,
  count(*) FILTER (diag_c1f0 IS NULL OR length(diag_c1f0) <> 20) AS rows_removed FROM joined GROUP BY MODEL_CODE""",
    "distinct_rows": J + "SELECT event_id, MODEL_CODE FROM joined",
    "one_family": V + f"SELECT event_id, {DECODED} FROM flags WHERE MODEL_CODE = 'AU' AND MODEL_YEAR = 2025",
    "all_families": V
    + f'SELECT event_id, MODEL_CODE, MODEL_YEAR, {DECODED} FROM flags WHERE C1F0_is_valid OR "B310_is_valid"',
    "prepared_family": V + f"SELECT event_id, MODEL_YEAR FROM flags WHERE MODEL_CODE = 'AU' AND {BOTH_OK}",
    "flagged_rows": V
    + f"SELECT event_id, {BOTH_OK} AS all_ddt_lengths_valid, CASE WHEN {LEN_OK} THEN 'x' ELSE '' END"
    """ AS "goodDiagInput_C1F0", 'unknown' AS "goodDiagInput_A7" FROM flags""",
    "checked_family": V
    + f"SELECT event_id, app_timestamp, {DECODED} FROM flags WHERE MODEL_CODE = 'AU' AND MODEL_YEAR = 2025 AND {BOTH_OK}",
    "merged_families": J
    + """SELECT event_id, volt, tbm_keyon, CAST(dt AS DATE) AS dt FROM (
  SELECT event_id, batteryvoltagelevel AS volt, CAST(NULL AS VARCHAR) AS tbm_keyon, dt FROM joined, range(2)
  WHERE MODEL_CODE = 'AU'
  UNION ALL SELECT event_id, NULL, tbm_keyon, dt FROM joined WHERE MODEL_CODE = 'BU')""",
    "json_documents": V
    + MSGS
    + f""", vals AS ({decode_message_sql()})
SELECT d.event_id, d.msg, d.error, CASE WHEN d.error IS NULL AND decoded THEN MODEL_CODE END AS vehicle_family,
  CASE WHEN d.error IS NULL AND decoded THEN CAST(MODEL_YEAR AS VARCHAR) END AS model_year,
  CASE WHEN d.error = 'Structure file not found' OR (d.error IS NULL AND decoded) THEN d.msg END AS ddt_type,
  CAST(CASE WHEN d.error IS NULL AND decoded THEN n ELSE 0 END AS INTEGER) AS n_fields,
  CASE WHEN d.error IS NULL THEN TRY_CAST(volt AS DOUBLE) END AS supply_voltage,
  CASE WHEN d.error IS NULL THEN cause END AS latest_start_cause
FROM docs d LEFT JOIN (SELECT event_id, msg, count(*) AS n,
    max(decoded_value) FILTER (description = 'Supply Voltage') AS volt,
    max(decoded_value) FILTER (description = 'Latest start cause') AS cause FROM vals GROUP BY event_id, msg) v
  ON d.event_id = v.event_id AND d.msg = v.msg""",
    "error_documents": V + MSGS + " SELECT event_id, msg FROM docs WHERE error IS NOT NULL",
    "document_summary": V
    + MSGS
    + """ SELECT count(*) AS total_rows, count(*) FILTER (error IS NOT NULL OR decoded) AS document_decoded_rows,
  count(*) FILTER (error IS NOT NULL) AS document_error_rows, 3 AS total_columns, 1 AS decoded_columns,
  5 AS flattened_columns, CAST(max(CASE WHEN error IS NOT NULL THEN 1 ELSE 0 END) AS INTEGER) AS columns_with_errors,
  (count(*) FILTER (error IS NOT NULL OR decoded) - count(*) FILTER (error IS NOT NULL)) * 100.0
    / CAST(count(*) FILTER (error IS NOT NULL OR decoded) AS DOUBLE) AS success_rate_pct FROM docs""",
    "named_columns": DM
    + """, joined_ids AS (SELECT e.event_id FROM events e JOIN customer c ON e.user_id = c.c_custkey)
SELECT i.event_id, max(decoded_value) FILTER (description = 'Lamp State') AS "c_Lamp_State",
  max(decoded_value) FILTER (description = 'SID-PR') AS "c_SID_PR"
FROM joined_ids i LEFT JOIN dm ON i.event_id = dm.event_id AND msg = 'C1F0' GROUP BY i.event_id""",
    "placed_columns": DM
    + """, joined_ids AS (SELECT e.event_id FROM events e JOIN customer c ON e.user_id = c.c_custkey)
SELECT i.event_id, max(decoded_value) FILTER (field_index = 2) AS "b_Start_cause", CAST(NULL AS VARCHAR) AS "b_Beyond"
FROM joined_ids i LEFT JOIN dm ON i.event_id = dm.event_id AND msg = 'B310' GROUP BY i.event_id""",
    "covered_fields": V
    + f""", pos(field_index, first_byte, lst, further) AS (VALUES {_positions()}),
cov AS (SELECT event_id, field_index, first_byte, text,
    CASE WHEN further AND lst + 1 < length(text) // 2 THEN lst + 1 ELSE lst END AS last_byte
  FROM (SELECT event_id, diag_c1f0 AS text FROM flags WHERE C1F0_is_valid AND {HAS_LAYOUT}), pos),
hexed AS (SELECT *, substr(text, 2 * first_byte + 1, 2 * (last_byte - first_byte + 1)) AS covered_hex FROM cov)
SELECT event_id, field_index, first_byte, last_byte, covered_hex,
  CASE WHEN covered_hex = '' OR regexp_matches(covered_hex, 'Z') THEN NULL
    ELSE {_nibbles("covered_hex")} END AS covered_binary FROM hexed""",
    "covered_bytes": V
    + f""", b AS (SELECT event_id, diag_b310 AS text, {HAS_LAYOUT} AS known, unnest(range(7)) AS byte FROM flags
  WHERE "B310_is_valid")
SELECT event_id, CAST(byte AS INTEGER) AS byte, substr(text, CAST(2 * byte + 1 AS BIGINT), 2) AS hex,
  {_nibbles("substr(text, CAST(2 * byte + 1 AS BIGINT), 2)")} AS binary,
  CASE WHEN known THEN {B310_LISTS!r}[byte + 1] ELSE '' END AS fields FROM b""",
    "latest_rows": with_(TEL) + "SELECT event_id, app_timestamp FROM tel ORDER BY app_timestamp, event_id LIMIT 20",
}
