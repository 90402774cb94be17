"""DuckDB SQL for the registered queries: an independent statement of the
decode rules over the same stand-in rows, used as the correctness oracle.

Field expressions are generated per rule from literal positions (the sample
layouts), so every query's SQL is plain SQL over the driver's tables.
"""

from __future__ import annotations

# ---------------------------------------------------------------- stand-in rows

TEL = """
tel AS (
  SELECT CAST(user_id AS VARCHAR) AS vin,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS app_timestamp,
         event_id,
         CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END AS batteryvoltagelevel,
         CASE WHEN event_type IN ('click', 'purchase') THEN event_type END AS tbm_keyon,
         CAST(ts AS DATE) AS dt,
         CASE WHEN event_id % 53 = 0 THEN NULL
              WHEN event_id % 47 = 0 THEN 'E#1'
              WHEN event_id % 43 = 0 THEN substr(a, 1, 18)
              WHEN event_id % 37 = 0 THEN substr(a, 1, 10) || 'ZZ' || substr(a, 13)
              ELSE a END AS diag_c1f0,
         CASE WHEN event_id % 59 = 0 THEN NULL ELSE w END AS diag_B310
  FROM (SELECT *,
          printf('62C1F0%04X%02X%02X%02X%04X', (event_id * 40503) % 65536, user_id % 256,
                 (event_id * 7) % 256, (event_id * 13 + user_id) % 256, (event_id * 977) % 65536) AS a,
          printf('62B310%02X%02X%02X%02X', (event_id * 3) % 32, user_id % 24, (event_id + user_id) % 256,
                 event_id % 17) AS w
        FROM events) e
)"""

VEH = """
veh AS (
  SELECT CAST(c_custkey AS VARCHAR) AS VIN, CAST(2024 + c_nationkey % 3 AS INTEGER) AS MODEL_YEAR,
         substr(c_mktsegment, 1, 2) AS MODEL_CODE, c_name AS MODEL_NAME
  FROM customer
)"""

JOINED = """
joined AS (
  SELECT t.*, v.MODEL_YEAR, v.MODEL_CODE, v.MODEL_NAME FROM tel t JOIN veh v ON t.vin = v.VIN
)"""

LENGTHS = """
lens(family, year, msg, length) AS (VALUES
  ('AU', 2024, 'C1F0', 20), ('AU', 2025, 'C1F0', 20), ('AU', 2026, 'C1F0', 20),
  ('BU', 2024, 'C1F0', 20), ('BU', 2025, 'C1F0', 20), ('FU', 2024, 'C1F0', 20), ('FU', 2025, 'C1F0', 18),
  ('HO', 2024, 'C1F0', 20), ('HO', 2026, 'C1F0', 0),
  ('MA', 2024, 'C1F0', 20), ('MA', 2025, 'C1F0', 20), ('MA', 2026, 'C1F0', 20),
  ('AU', 2024, 'B310', 14), ('AU', 2025, 'B310', 14), ('AU', 2026, 'B310', 14),
  ('BU', 2024, 'B310', 14), ('BU', 2025, 'B310', 14), ('FU', 2024, 'B310', 14), ('HO', 2024, 'B310', 14),
  ('MA', 2024, 'B310', 14), ('MA', 2025, 'B310', 14), ('MA', 2026, 'B310', 14)
)"""

REFLEN = """
reflen AS (
  SELECT family, year,
         max(CASE WHEN msg = 'C1F0' THEN length END) AS a_ref,
         max(CASE WHEN msg = 'B310' THEN length END) AS w_ref
  FROM lens GROUP BY family, year
)"""

# (family, year) pairs that have layout files, and families that have table files
LAYOUT_KEYS = "(('AU',2024),('AU',2025),('AU',2026),('BU',2024),('BU',2025),('FU',2024),('HO',2024),('MA',2024),('MA',2025))"
HAS_LAYOUT = "((MODEL_CODE, MODEL_YEAR) IN " + LAYOUT_KEYS + ")"
HAS_TABLE = "(MODEL_CODE IN ('AU', 'BU', 'MA'))"
VOLT = "(CASE WHEN MODEL_YEAR = 2024 THEN CAST(0.001 AS DOUBLE) ELSE CAST(0.002 AS DOUBLE) END)"

# ---------------------------------------------------------------- extraction rules


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _byte(m: str, i: int) -> str:
    return f"TRY_CAST('0x' || substr({m}, {2 * i + 1}, 2) AS BIGINT)"


def _hexok(text: str) -> str:
    return f"coalesce(regexp_full_match({text}, '[0-9A-Fa-f]+'), false)"


def _bad(text: str) -> str:
    return f"'invalid literal for int() with base 16: ''' || {text} || ''''"


def _mask(bits: int) -> int:
    return (1 << bits) - 1


def bits(m: str, b: int, t: int, k: int):
    L = f"length({m})"
    s = f"substr({m}, {2 * b + 1}, 2)"
    static = None
    if t < 0 or t > 7:
        static = f"Invalid bit_start {t}, must be 0-7"
    elif k <= 0 or t + k > 8:
        static = f"Invalid bit range: start={t}, count={k}"
    err = f"CASE WHEN {b * 2 + 2} > {L} THEN {_q(f'Byte {b} not available in DDT string')}"
    err += f" WHEN true THEN {_q(static)}" if static else f" WHEN NOT {_hexok(s)} THEN {_bad(s)}"
    err += " END"
    raw = f"(({_byte(m, b)} >> {t}) & {_mask(k) if k > 0 else 0})"
    return err, raw


def bytes_be(m: str, b: int, t: int, n: int):
    L = f"length({m})"
    s = f"substr({m}, {2 * b + 1}, {2 * n})"
    err = f"CASE WHEN {b * 2 + 2} > {L} THEN {_q(f'Byte {b} not available in DDT string')}"
    if t < 0 or t > 7:
        err += f" WHEN true THEN {_q(f'Invalid bit_pos {t}, must be 0-7')}"
    err += f" WHEN NOT {_hexok(s)} THEN {_bad(s)} END"
    raw = f"TRY_CAST('0x' || {s} AS BIGINT)"
    return err, raw


def consecutive(m: str, b: int, n: int, t: int):
    L = f"length({m})"
    has_next = f"({(b + n) * 2 + 2} <= {L})"
    err = "CASE"
    if t < 0 or t > 7:
        err += f" WHEN true THEN {_q(f'Invalid bit_offset {t}, must be 0-7')}"
    err += (
        f" WHEN {(b + n) * 2} > {L} THEN 'Insufficient data: need bytes {b} to {b + n - 1}, but only ' ||"
        f" CAST({L} // 2 AS VARCHAR) || ' bytes available in DDT string'"
    )
    for i in range(n):
        s = f"substr({m}, {2 * (b + i) + 1}, 2)"
        err += f" WHEN NOT {_hexok(s)} THEN {_bad(s)}"
    if t > 0:
        s = f"substr({m}, {2 * (b + n) + 1}, 2)"
        err += f" WHEN {has_next} AND NOT {_hexok(s)} THEN {_bad(s)}"
    err += " END"
    value = " + ".join(f"({_byte(m, b + i)} << {8 * i})" for i in range(n))
    if t > 0:
        carry = f"(CASE WHEN {has_next} THEN (({_byte(m, b + n)} & {_mask(t)}) << {8 * n}) ELSE 0 END)"
        raw = f"((({value}) | {carry}) >> {t}) & {_mask(8 * n)}"
    else:
        raw = f"({value})"
    return err, raw


def mixed(m: str, b: int, t: int, n: int, k: int):
    err_main, main = consecutive(m, b, n, t)
    L = f"length({m})"
    p = b - 1
    if p < 0:
        err_back = _q("Cannot expand backward beyond byte 0")
        back = "0"
    else:
        s = f"substr({m}, {2 * p + 1}, 2)"
        err_back = (
            f"CASE WHEN {p * 2 + 2} > {L} THEN {_q(f'Previous byte {p} not available')}"
            f" WHEN NOT {_hexok(s)} THEN {_bad(s)} END"
        )
        back = f"({_byte(m, p)} & {_mask(k)})"
    return f"coalesce({err_main}, {err_back})", f"(({main}) | ({back} << {8 * n}))"


def extract(m: str, pos: str, size: str):
    """(err, raw) SQL for a layout position/size pair such as '7 [4]', '1 [2]'."""
    b, t = (int(x.strip("[]")) for x in pos.split())
    n, k = (int(x.strip("[]")) for x in size.split())
    if n == 0 and k > 0:
        return bits(m, b, t, k)
    if n > 0 and k == 0:
        return bytes_be(m, b, t, n)
    if n > 0 and k > 0:
        return mixed(m, b, t, n, k)
    return consecutive(m, b, 1, t)


# ---------------------------------------------------------------- conversion rules


def rint(y: str) -> str:
    """IEEE round-half-even to an integer, on a DOUBLE expression."""
    f = f"floor({y})"
    return (
        f"(CASE WHEN ({y}) - {f} > 0.5 THEN {f} + 1 WHEN ({y}) - {f} < 0.5 THEN {f}"
        f" WHEN CAST({f} AS BIGINT) % 2 = 0 THEN {f} ELSE {f} + 1 END)"
    )


def np_round(x: str, d: int) -> str:
    s = f"CAST({10 ** d} AS DOUBLE)"
    return f"({rint(f'(({x}) * {s})')} / {s})"


def linear_text(raw: str, factor: str, offset: str, decimals: int, raw_max: int | None,
                singles=(), ranges=()) -> str:
    """Decoded text of a linear field (encodings, special values, scaling)."""
    x = f"(CAST({raw} AS DOUBLE) * {factor} + CAST({offset} AS DOUBLE))"
    parts = ["CASE"]
    for text, label in singles:
        parts.append(f"WHEN printf('$%02X', {raw}) = {_q(text)} THEN {_q(label)}")
    for lo, hi, label in ranges:
        parts.append(f"WHEN {raw} BETWEEN {lo} AND {hi} THEN {_q(label)}")
    if raw_max is not None:
        if raw_max == 0xFFFE:
            parts.append(f"WHEN {raw} = 65535 THEN 'Invalid/Not Available'")
        elif raw_max < 0xFFFF:
            parts.append(f"WHEN {raw} = 65535 THEN 'Invalid/Sensor Error'")
        if raw_max < 0xFFFE:
            parts.append(f"WHEN {raw} = 65534 THEN 'Not Initialized'")
        parts.append(f"WHEN {raw} <> 65535 AND {raw} > {raw_max} THEN 'Out of Range/Invalid'")
    if decimals > 0:
        parts.append(f"ELSE CAST({np_round(x, decimals)} AS VARCHAR) END")
    else:
        parts.append(f"ELSE CAST(CAST(trunc({x}) AS BIGINT) AS VARCHAR) END")
    return " ".join(parts)


def table_text(raw: str, rows: list[tuple[str, str]], name: str, has_table: str, bad_id: bool = False) -> str:
    """Decoded text of a table field: '$X' then '$%02X' lookup, else name fallbacks."""
    if bad_id:
        inner = f"printf('0x%X (Conv Error: invalid literal for int() with base 10: ''-'')', {raw})"
    else:
        seen: dict[str, str] = {}
        for k, v in rows:
            seen.setdefault(k.strip(), v)
        short, pad = f"printf('$%X', {raw})", f"printf('$%02X', {raw})"
        parts = ["CASE"]
        for k, v in seen.items():
            parts.append(f"WHEN {short} = {_q(k)} THEN {_q(v)}")
        for k, v in seen.items():
            parts.append(f"WHEN {pad} = {_q(k)} THEN {_q(v)}")
        if "Present/Not present" in name:
            parts.append(f"WHEN {raw} = 1 THEN 'Present' ELSE 'Not present' END")
        elif "Fault/No Fault" in name:
            parts.append(f"WHEN {raw} = 1 THEN 'Fault' ELSE 'No Fault' END")
        elif "False / True" in name:
            parts.append(f"WHEN {raw} = 1 THEN 'True' ELSE 'False' END")
        else:
            parts.append(f"ELSE printf('0x%X (No match)', {raw}) END")
        inner = " ".join(parts)
    return f"(CASE WHEN {has_table} THEN {inner} ELSE printf('0x%X', {raw}) END)"


LAMP_ROWS = [("$0", "Off"), ("$1", "On"), ("$02", "Blinking"), ("$3", "Fault"), ("$1", "On (duplicate, never used)"),
             (" $A ", "Test")]
CAUSE_ROWS = [("$00", "No Reason"), ("$01", "Door"), ("$2", "Ignition"), ("$02", "Ignition (padded, never used)"),
             ("$0A", "Timer"), ("$10", "CAN Network"), ("$1F", "Remote"), ("$FF", "Invalid")]

# description -> (position, size, type, conversion builder(raw) or None)
C1F0_FIELDS = [
    ("SID-PR", "0 [0]", "1 [0]", "-", None),
    ("RecordDataIdentifier", "1 [0]", "2 [0]", "-", None),
    ("Reserved", "9 [4]", "0 [4]", "I", None),
    ("Supply Voltage", "3 [0]", "2 [0]", "L", lambda r: linear_text(r, VOLT, "0", 3, 0xFFFE)),
    ("Supply Voltage Raw", "3 [0]", "2 [0]", "L", lambda r: f"CAST({r} AS VARCHAR)"),
    ("Wheel Speed", "4 [0]", "1 [0]", "L",
     lambda r: linear_text(r, "CAST(0.05 AS DOUBLE)", "4", 1, 255, singles=[("$FE", "Invalid Signal")])),
    ("Lamp State", "5 [0]", "0 [4]", "T", lambda r: table_text(r, LAMP_ROWS, "Lamp State", HAS_TABLE)),
    ("Door Fault", "5 [4]", "0 [3]", "T", lambda r: table_text(r, [], "Door Fault/No Fault", HAS_TABLE)),
    ("Heater Present", "5 [7]", "0 [1]", "T",
     lambda r: table_text(r, [], "Heater Present/Not present", HAS_TABLE, bad_id=True)),
    ("Coolant Temp", "6 [0]", "1 [0]", "L",
     lambda r: linear_text(r, "CAST(1 AS DOUBLE)", "-40", 0, 0xC8, singles=[("$FF", "No Signal")])),
    ("Charge Level", "7 [0]", "1 [4]", "L",
     lambda r: linear_text(r, "CAST(0.5 AS DOUBLE)", "0", 1, 0xFA0, ranges=[(0xF00, 0xF0F, "Calibrating")])),
    ("Odometer Fine", "7 [4]", "1 [2]", "L", lambda r: linear_text(r, "CAST(0.1 AS DOUBLE)", "0", 1, 0x3FF)),
    ("Trip Counter", "8 [0]", "2 [0]", "I", None),
    ("Trip Low", "8 [0]", "0 [0]", "I", None),
    ("Trip Low Shift", "8 [3]", "0 [0]", "I", None),
    ("Past End", "9 [0]", "2 [0]", "L", lambda r: linear_text(r, VOLT, "0", 3, 0xFFFE)),
    ("Overrun", "9 [0]", "2 [1]", "I", None),
    ("Beyond", "10 [0]", "0 [1]", "I", None),
    ("Bad Range", "0 [6]", "0 [3]", "I", None),
    ("Backward Zero", "0 [0]", "1 [1]", "L", lambda r: linear_text(r, "CAST(1 AS DOUBLE)", "-40", 0, 0xC8)),
]
B310_FIELDS = [
    ("SID-PR", "0 [0]", "1 [0]", "-", None),
    ("RecordDataIdentifier", "1 [0]", "2 [0]", "-", None),
] + [
    (d, f"{3 + i} [0]", "1 [0]", "T", lambda r: table_text(r, CAUSE_ROWS, "Start Causes", HAS_TABLE))
    for i, d in enumerate(
        ["Latest start cause", "Earlier start cause 1", "Earlier start cause 2",
         "Earlier start cause 3"]
    )
]
RAW_VALUE_TYPES = ("L", "T")  # every sample family has a linear table; T ids are all present


def field_sql(m: str, pos: str, size: str, typ: str, conv) -> tuple[str, str]:
    """(decoded text, raw_value) SQL of one field."""
    err, raw = extract(m, pos, size)
    value = f"CASE WHEN ({err}) IS NOT NULL THEN 'Error: ' || ({err}) ELSE "
    value += (conv(raw) if conv else f"CAST({raw} AS VARCHAR)") + " END"
    raw_value = f"CASE WHEN ({err}) IS NULL THEN {raw} END" if typ in RAW_VALUE_TYPES else "CAST(NULL AS BIGINT)"
    return value, raw_value


C1F0_TYPED = [  # (description, output column, SQL type) in declared order
    ("Supply Voltage", "C1F0_supply_voltage", "DOUBLE"),
    ("Supply Voltage Raw", "C1F0_supply_voltage_raw", "INTEGER"),
    ("Wheel Speed", "C1F0_wheel_speed", "DOUBLE"),
    ("Lamp State", "C1F0_lamp_state", "VARCHAR"),
    ("Door Fault", "C1F0_door_fault", "VARCHAR"),
    ("Heater Present", "C1F0_heater_present", "VARCHAR"),
    ("Coolant Temp", "C1F0_coolant_temp", "DOUBLE"),
    ("Charge Level", "C1F0_charge_level", "DOUBLE"),
    ("Odometer Fine", "C1F0_odometer_fine", "DOUBLE"),
    ("Trip Counter", "C1F0_trip_counter", "INTEGER"),
    ("Trip Low Shift", "C1F0_trip_low_shift", "INTEGER"),
    ("Past End", "C1F0_past_end", "DOUBLE"),
    ("Overrun", "C1F0_overrun", "VARCHAR"),
    ("Not In Layout", "C1F0_not_in_layout", "VARCHAR"),
]
B310_TYPED = [
    ("Latest start cause", "B310_latest_start_cause", "VARCHAR"),
    ("Earlier start cause 1", "B310_earlier_start_cause_01", "VARCHAR"),
    ("Earlier start cause 2", "B310_earlier_start_cause_02", "VARCHAR"),
    ("Earlier start cause 3", "B310_earlier_start_cause_03", "VARCHAR"),
]


def typed_select(m: str, fields, typed, valid: str) -> list[str]:
    by_desc = {f[0]: f for f in fields}
    out = []
    for desc, col, typ in typed:
        if desc not in by_desc:
            out.append(f'CAST(NULL AS {typ}) AS "{col}"')
            continue
        _, pos, size, t, conv = by_desc[desc]
        value, _ = field_sql(m, pos, size, t, conv)
        out.append(f'CASE WHEN {valid} AND {HAS_LAYOUT} THEN TRY_CAST(({value}) AS {typ}) END AS "{col}"')
    return out


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


VALIDITY = """
flags AS (
  SELECT j.*, r.a_ref AS C1F0_reference_len, r.w_ref AS "B310_reference_len",
         CAST(length(diag_c1f0) AS INTEGER) AS C1F0_actual_len,
         coalesce(diag_c1f0 IS NOT NULL AND diag_c1f0 <> 'E#1' AND length(diag_c1f0) = r.a_ref AND r.a_ref IS NOT NULL, false) AS C1F0_is_valid,
         CAST(length(diag_B310) AS INTEGER) AS "B310_actual_len",
         coalesce(diag_B310 IS NOT NULL AND diag_B310 <> 'E#1' AND length(diag_B310) = r.w_ref AND r.w_ref IS NOT NULL, false) AS "B310_is_valid"
  FROM joined j LEFT JOIN reflen r ON j.MODEL_CODE = r.family AND j.MODEL_YEAR = r.year
)"""

FFILL_W = "OVER (PARTITION BY vin ORDER BY app_timestamp, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def full_decode_sql() -> str:
    typed = typed_select("diag_c1f0", C1F0_FIELDS, C1F0_TYPED, "C1F0_is_valid") + typed_select(
        "diag_B310", B310_FIELDS, B310_TYPED, '"B310_is_valid"'
    )
    return with_(TEL, VEH, JOINED, LENGTHS, REFLEN, VALIDITY) + f"""
, filled AS (
  SELECT f.*, last_value(batteryvoltagelevel IGNORE NULLS) {FFILL_W} AS batteryvoltagelevel_reference,
         last_value(tbm_keyon IGNORE NULLS) {FFILL_W} AS tbm_keyon_reference
  FROM flags f
)
SELECT vin, CAST(strptime(app_timestamp, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS app_timestamp, event_id,
       batteryvoltagelevel, tbm_keyon, dt, diag_c1f0, diag_B310, MODEL_YEAR, MODEL_CODE, MODEL_NAME,
       batteryvoltagelevel_reference, tbm_keyon_reference, C1F0_reference_len, "B310_reference_len",
       C1F0_actual_len, C1F0_is_valid, "B310_actual_len", "B310_is_valid",
       {", ".join(typed)}
FROM filled WHERE C1F0_is_valid AND "B310_is_valid"
"""


def decode_message_sql() -> str:
    selects = []
    for msg, m, fields, valid in (("C1F0", "diag_c1f0", C1F0_FIELDS, "C1F0_is_valid"),
                                  ("B310", "diag_B310", B310_FIELDS, '"B310_is_valid"')):
        for idx, (desc, pos, size, typ, conv) in enumerate(fields):
            value, raw_value = field_sql(m, pos, size, typ, conv)
            # 'Reserved' keeps the position of its first entry (index 2) but the last entry's rule
            selects.append(
                f"SELECT event_id, '{msg}' AS msg, CAST({idx} AS INTEGER) AS field_index, {_q(desc)} AS description,"
                f" {value} AS decoded_value, {_q(pos)} AS raw_position, {_q(size)} AS size, {_q(typ)} AS msg_type,"
                f" CAST(raw_value_{msg}_{idx} AS BIGINT) AS raw_value"
                f" FROM (SELECT *, {raw_value} AS raw_value_{msg}_{idx} FROM flags) x WHERE {valid} AND {HAS_LAYOUT}"
            )
    return with_(TEL, VEH, JOINED, LENGTHS, REFLEN, VALIDITY) + "\nUNION ALL\n".join(selects)


def _base(*extra: str) -> str:
    return with_(TEL, VEH, JOINED, LENGTHS, REFLEN, *extra)


SIMPLE_SQL = {
    "vehicle_join": with_(TEL, VEH, JOINED) + "SELECT vin, event_id, MODEL_YEAR, MODEL_CODE, MODEL_NAME FROM joined",
    "family_counts": with_(TEL, VEH, JOINED)
    + "SELECT MODEL_CODE, MODEL_YEAR, count(*) AS count FROM joined GROUP BY MODEL_CODE, MODEL_YEAR",
    "distinct_families": with_(TEL, VEH, JOINED) + "SELECT DISTINCT MODEL_CODE FROM joined",
    "first_n_per_family": with_(TEL, VEH, JOINED)
    + "SELECT MODEL_CODE, event_id, app_timestamp FROM (SELECT *, row_number() OVER (PARTITION BY MODEL_CODE"
    " ORDER BY app_timestamp, event_id) AS rn FROM joined) x WHERE rn <= 5",
    "date_range": with_(TEL) + "SELECT event_id, dt FROM tel WHERE dt >= DATE '2024-01-05' AND dt < DATE '2024-01-20'",
    "forward_fill": with_(TEL)
    + f"SELECT vin, event_id, app_timestamp, last_value(batteryvoltagelevel IGNORE NULLS) {FFILL_W}"
    f" AS batteryvoltagelevel_reference, last_value(tbm_keyon IGNORE NULLS) {FFILL_W} AS tbm_keyon_reference FROM tel",
    "reference_length": _base()
    + 'SELECT j.event_id, j.MODEL_CODE, j.MODEL_YEAR, r.a_ref AS C1F0_reference_len, r.w_ref AS "B310_reference_len"'
    " FROM joined j LEFT JOIN reflen r ON j.MODEL_CODE = r.family AND j.MODEL_YEAR = r.year",
    "validity_all": _base(VALIDITY)
    + 'SELECT event_id, MODEL_CODE, MODEL_YEAR, C1F0_actual_len, C1F0_is_valid, "B310_actual_len", "B310_is_valid"'
    ' FROM flags WHERE C1F0_is_valid AND "B310_is_valid"',
    "validity_any": _base(VALIDITY)
    + 'SELECT event_id, MODEL_CODE, MODEL_YEAR, C1F0_actual_len, C1F0_is_valid, "B310_actual_len", "B310_is_valid"'
    ' FROM flags WHERE C1F0_is_valid OR "B310_is_valid"',
    "any_usable": with_(TEL)
    + "SELECT event_id FROM tel WHERE (diag_c1f0 IS NOT NULL AND diag_c1f0 <> 'E#1')"
    " OR (diag_B310 IS NOT NULL AND diag_B310 <> 'E#1')",
    "length_summary": _base()
    + """, fl AS (
  SELECT j.MODEL_CODE, j.MODEL_YEAR,
         coalesce(length(diag_c1f0) = r.a_ref, false) AS va, coalesce(length(diag_B310) = r.w_ref, false) AS vw
  FROM joined j LEFT JOIN reflen r ON j.MODEL_CODE = r.family AND j.MODEL_YEAR = r.year)
SELECT MODEL_CODE, MODEL_YEAR, count(*) AS total_rows, CAST(sum(CAST(va AS INTEGER)) AS BIGINT) AS valid_C1F0_count,
       CAST(sum(CAST(vw AS INTEGER)) AS BIGINT) AS valid_B310_count,
       CAST(sum(CAST(va AND vw AS INTEGER)) AS BIGINT) AS all_valid_count
FROM fl GROUP BY MODEL_CODE, MODEL_YEAR""",
    "good_input": _base()
    + "SELECT j.event_id, CASE WHEN coalesce(length(diag_c1f0) = r.a_ref, false) THEN 'x' ELSE '' END"
    " AS goodDiagInput_C1F0, CASE WHEN coalesce(length(diag_B310) = r.w_ref, false) THEN 'x' ELSE '' END"
    ' AS "goodDiagInput_B310" FROM joined j LEFT JOIN reflen r ON j.MODEL_CODE = r.family AND j.MODEL_YEAR = r.year',
    "length_filter": _base()
    + "SELECT j.event_id, j.MODEL_CODE FROM joined j LEFT JOIN reflen r ON j.MODEL_CODE = r.family"
    " AND j.MODEL_YEAR = r.year WHERE coalesce(length(diag_c1f0) = r.a_ref, false)"
    " AND coalesce(length(diag_B310) = r.w_ref, false)",
    "length_semi": _base()
    + "SELECT j.event_id FROM joined j WHERE EXISTS (SELECT 1 FROM lens l WHERE l.msg = 'C1F0'"
    " AND l.family = j.MODEL_CODE AND l.year = j.MODEL_YEAR AND l.length = length(j.diag_c1f0))",
    "union_by_name": with_(TEL, VEH, JOINED)
    + "SELECT event_id, MODEL_CODE, CAST(NULL AS VARCHAR) AS tbm_keyon FROM joined WHERE MODEL_YEAR = 2024"
    " UNION ALL SELECT event_id, CAST(NULL AS VARCHAR) AS MODEL_CODE, tbm_keyon FROM joined WHERE MODEL_YEAR <> 2024",
    "bulk_cast": with_(TEL)
    + "SELECT event_id, CASE WHEN regexp_full_match(trim(substr(diag_c1f0, 7, 4)), '[+-]?[0-9]+')"
    " THEN TRY_CAST(substr(diag_c1f0, 7, 4) AS INTEGER) END AS digits_int,"
    " TRY_CAST(trunc(batteryvoltagelevel) AS INTEGER) AS volt_int, TRY_CAST(app_timestamp AS TIMESTAMP) AS ts FROM tel",
    "codec_coverage": _base()
    + """SELECT DISTINCT j.MODEL_CODE AS family, j.MODEL_YEAR AS year, l.msg,
       (j.MODEL_CODE, j.MODEL_YEAR) IN """ + LAYOUT_KEYS + """ AS has_layout,
       (j.MODEL_CODE, j.MODEL_YEAR) IN """ + LAYOUT_KEYS + """ OR (j.MODEL_CODE, j.MODEL_YEAR) = ('FU', 2025)
         AS has_linear,
       ((j.MODEL_CODE, j.MODEL_YEAR) IN """ + LAYOUT_KEYS + """ AND j.MODEL_CODE IN ('AU', 'BU', 'MA')) AS has_table
FROM joined j JOIN (SELECT DISTINCT msg FROM lens) l ON true""",
}
