"""DuckDB SQL for the queries over tables laid out for the job, and for fields wider than a bigint."""

from __future__ import annotations

from telemsg.sample.oracle_more import J, MORE_SQL
from telemsg.sample.oracle_sql import FFILL_W, JOINED, SIMPLE_SQL, TEL, VEH, LENGTHS, decode_message_sql, with_

_FACTORS = (2654435761, 40503, 977, 69069, 1103515245, 22695477)
_WORDS = ", ".join(f"(event_id * {m} + user_id * 7919 + {12345 * i}) % 4294967296" for i, m in enumerate(_FACTORS))


def _byte(i: int) -> str:
    return f"('0x' || substr(m, {2 * i + 1}, 2))::UHUGEINT"


def _big(first: int, n: int) -> str:
    """The bytes as one number, highest first."""
    return "(" + " + ".join(f"{_byte(first + i)} * {256 ** (n - 1 - i)}::UHUGEINT" for i in range(n)) + ")"


def _little(first: int, n: int) -> str:
    return "(" + " + ".join(f"{_byte(first + i)} * {256 ** i}::UHUGEINT" for i in range(n)) + ")"


_E = "eight::DOUBLE"
_TENTH = f"(({_E} * 0.1::DOUBLE) * 10::DOUBLE)"
_FIELDS = [  # description, number, decoded text, whether the raw value is shown
    ("Eight", "eight", "eight::VARCHAR", False),
    ("Nine", _big(2, 9), None, False),
    ("Sixteen", _big(2, 16), None, False),
    ("Eight and bits", f"({_little(10, 8)} + ({_byte(9)} % 16) * {2**64}::UHUGEINT)", None, False),
    ("Nine, shifted", f"(({_little(10, 9)} + ({_byte(19)} % 8) * {2**72}::UHUGEINT) // 8 + ({_byte(9)} % 2) * {2**72}::UHUGEINT)", None, False),
    ("Half", "eight", f"trunc({_E} * 0.5::DOUBLE)::UHUGEINT::VARCHAR", True),
    ("Tenth", "eight", f"CAST((CASE WHEN {_TENTH} >= 4503599627370496 THEN {_TENTH} ELSE round_even({_TENTH}, 0) END) / 10::DOUBLE AS VARCHAR)", True),
    ("Limited", "eight", "CASE WHEN eight > 65534 THEN 'Out of Range/Invalid' ELSE eight::VARCHAR END", True),
    ("Listed", "eight", "CASE WHEN eight = 1 THEN 'One' ELSE '0x' || regexp_replace(substr(m, 5, 16), '^0+', '') || ' (No match)' END", True),
]


def wide_sql() -> str:
    out = []
    for d, number, text, shown in _FIELDS:
        raw = f"{number}::VARCHAR" if shown else "CAST(NULL AS VARCHAR)"
        out.append(f"SELECT event_id, '{d}' AS description, {text or f'{number}::VARCHAR'} AS decoded_value, {raw} AS raw_text FROM w")
    text = "printf('D0E0' || repeat('%08X', 6), " + _WORDS + ")"
    return f"WITH w AS (SELECT event_id, m, {_big(2, 8)} AS eight FROM (SELECT event_id, {text} AS m FROM events))\n" + "\nUNION ALL\n".join(out)


_GROUPS = [("AU", 2024), ("AU", 2025), ("BU", 2025), ("XX", 2030)]

TABLE_SQL = {
    "wide_fields": wide_sql(),
    "bucketed_fill": J
    + f"SELECT event_id, vin, MODEL_CODE, MODEL_YEAR, last_value(batteryvoltagelevel IGNORE NULLS) {FFILL_W}"
    f" AS batteryvoltagelevel_reference, last_value(tbm_keyon IGNORE NULLS) {FFILL_W} AS tbm_keyon_reference FROM joined",
    "pruned_range": with_(TEL)
    + "SELECT vin, event_id, dt, diag_c1f0 FROM tel WHERE dt >= DATE '2024-01-05' AND dt < DATE '2024-01-20'",
    "pruned_semi": with_(TEL, VEH, JOINED, LENGTHS)
    + "SELECT j.event_id, j.MODEL_CODE, j.MODEL_YEAR FROM joined j WHERE j.MODEL_YEAR = 2025 AND EXISTS (SELECT 1 FROM lens l"
    " WHERE l.msg = 'C1F0' AND l.family = j.MODEL_CODE AND l.year = j.MODEL_YEAR AND l.length = length(j.diag_c1f0))",
    "variant_documents": MORE_SQL["json_documents"],
    "refreshed_coverage": f"SELECT *, 0 AS rebuilt FROM ({SIMPLE_SQL['codec_coverage']})",
    "saved_table": J + "SELECT event_id, MODEL_CODE, '2' AS pipeline_version, '7' AS config_version, true AS same_run FROM joined",
    "saved_summary": J
    + f""", g(MODEL_CODE, MODEL_YEAR) AS (VALUES {", ".join(map(str, _GROUPS))}),
c AS (SELECT g.MODEL_CODE, g.MODEL_YEAR, count(j.event_id) AS n FROM g LEFT JOIN joined j USING (MODEL_CODE, MODEL_YEAR) GROUP BY ALL),
t AS (SELECT count(*) AS n FROM joined)
SELECT c.*, t.n AS total_rows, '2' AS pipeline_version, '7' AS config_version FROM c, t
UNION ALL SELECT NULL, NULL, t.n - (SELECT sum(n) FROM c), t.n, '2', '7' FROM t""".replace("count(j.event_id) AS n", 'count(j.event_id) AS "rows"').replace("sum(n) FROM c", 'sum("rows") FROM c'),
    "round_trip_decode": f"""SELECT event_id, msg, field_index, description, decoded_value, raw_value FROM ({decode_message_sql()})
WHERE event_id IN (SELECT e.event_id FROM events e JOIN customer c ON e.user_id = c.c_custkey WHERE substr(c_mktsegment, 1, 2) IN ('AU', 'BU'))""",
}
