"""Column expressions that read integer fields out of a hex message.

The message is kept as hex text (two characters per byte) because lengths are
counted in characters. Every builder takes Columns, so the same code works on
literal positions and on positions that come from a codec array inside
``F.transform``. Each extractor returns ``struct<raw: bigint, err: string>``:
exactly one of the two is set.

Rules (byte ``b``, bit ``t``, ``n`` whole bytes, ``k`` extra bits):

* bits only (n = 0, k > 0): ``(byte[b] >> t) & (2^k - 1)``
* bytes only (n > 0, k = 0): big-endian value of the text slice of n bytes at b;
  a slice past the end is cut, only byte b itself must exist; t is only range-checked
* bytes and bits (n > 0, k > 0): little-endian n bytes at b with bit offset t,
  plus the low k bits of byte b-1 above them
* neither: one byte at b, little-endian rule with bit offset t

Values wider than 63 bits cannot be held in a bigint; the width is tested before any arithmetic, so no layout can fail
a job. A compiled codec reads such a field by ``functions.wide``; here it gives an error text.

A codec stores for every field a *read plan* (``read_plan``): which text to cut (the message, or the message with
its bytes reversed, where a little-endian value is a plain slice), where, the shift and the mask. A message of hex
digits that is long enough is read by it: one slice, one conversion, one shift and one mask. Everything else
takes the full rules below, which also word the errors.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_RE = "^[0-9A-Fa-f]+$"

# Error texts (fixed values: the reference reports these words per field).
MSG_BYTE_MISSING = "Byte %d not available in DDT string"
MSG_BIT_START = "Invalid bit_start %d, must be 0-7"
MSG_BIT_RANGE = "Invalid bit range: start=%d, count=%d"
MSG_BIT_POS = "Invalid bit_pos %d, must be 0-7"
MSG_BIT_OFFSET = "Invalid bit_offset %d, must be 0-7"
MSG_INSUFFICIENT = "Insufficient data: need bytes %d to %d, but only %d bytes available in DDT string"
MSG_BACKWARD = "Cannot expand backward beyond byte 0"
MSG_PREV_MISSING = "Previous byte %d not available"
MSG_BAD_HEX = "invalid literal for int() with base 16: '%s'"
MSG_TOO_WIDE = "field of %d bits is wider than 63 bits"


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def hex_slice(msg: Column, byte_pos: Column, n_bytes: Column | int = 1) -> Column:
    """Text of ``n_bytes`` bytes starting at byte ``byte_pos`` (cut at the end)."""
    return msg.substr(_lit(byte_pos) * 2 + 1, _lit(n_bytes) * 2)


def byte_at(msg: Column, byte_pos: Column) -> Column:
    """Integer value of one byte; callers check bounds and hex first."""
    return F.conv(hex_slice(msg, byte_pos), 16, 10).cast("bigint")


def shl(x: Column, bits: Column) -> Column:
    """x << bits with a Column shift count."""
    return F.call_function("shiftleft", x, _lit(bits))


def shr(x: Column, bits: Column) -> Column:
    """x >> bits (arithmetic) with a Column shift count."""
    return F.call_function("shiftright", x, _lit(bits))


def mask(bits: Column) -> Column:
    """2^bits - 1 as bigint, for 0 <= bits <= 62."""
    return shl(F.lit(1).cast("bigint"), bits) - 1


def _result(err: Column, raw: Column) -> Column:
    return F.struct(
        F.when(err.isNull(), raw).cast("bigint").alias("raw"), err.cast("string").alias("err")
    )


def _bad_byte(msg: Column, all_hex: Column, first: Column, count: Column) -> Column:
    """First byte text in [first, first+count) that is not hex, or null.
    Short-circuits on ``all_hex`` (the whole message checked once per row)."""
    texts = F.transform(F.sequence(first, first + count - 1), lambda i: hex_slice(msg, i))
    return F.when(~all_hex, F.get(F.filter(texts, lambda s: ~s.rlike(HEX_RE)), 0))


def bits_in_byte(msg: Column, length: Column, all_hex: Column, b: Column, t: Column, k: Column) -> Column:
    bad = _bad_byte(msg, all_hex, b, F.lit(1))
    err = (
        F.when(b * 2 + 2 > length, F.format_string(MSG_BYTE_MISSING, b))
        .when((t < 0) | (t > 7), F.format_string(MSG_BIT_START, t))
        .when((k <= 0) | (t + k > 8), F.format_string(MSG_BIT_RANGE, t, k))
        .when(bad.isNotNull(), F.format_string(MSG_BAD_HEX, bad))
    )
    raw = shr(byte_at(msg, b), t).bitwiseAND(mask(k))
    return _result(err, raw)


def whole_bytes_be(msg: Column, length: Column, all_hex: Column, b: Column, t: Column, n: Column) -> Column:
    text = hex_slice(msg, b, n)
    digits = F.ltrim(text, F.lit("0"))
    narrow = (F.length(digits) <= 15) | ((F.length(digits) == 16) & (F.substring(digits, 1, 1) < "8"))
    raw = F.when(narrow, F.conv(F.concat(F.lit("0"), digits), 16, 10).cast("bigint"))
    err = (
        F.when(b * 2 + 2 > length, F.format_string(MSG_BYTE_MISSING, b))
        .when((t < 0) | (t > 7), F.format_string(MSG_BIT_POS, t))
        .when(~all_hex & ~text.rlike(HEX_RE), F.format_string(MSG_BAD_HEX, text))
        .when(raw.isNull(), F.format_string(MSG_TOO_WIDE, F.length(text) * 4))
    )
    return _result(err, raw)


def _le_value(msg: Column, b: Column, n: Column) -> Column:
    return F.aggregate(
        F.sequence(F.lit(0), n - 1),
        F.lit(0).cast("bigint"),
        lambda acc, i: acc.bitwiseOR(shl(byte_at(msg, b + i), i * 8)),
    )


def _consecutive(msg: Column, length: Column, all_hex: Column, b: Column, n: Column, t: Column):
    """(err, raw) of the little-endian rule with bit offset, as two Columns."""
    has_next = (b + n) * 2 + 2 <= length
    bad_main = _bad_byte(msg, all_hex, b, n)
    bad_next = F.when((t > 0) & has_next, _bad_byte(msg, all_hex, b + n, F.lit(1)))
    err = (
        F.when(b < 0, F.format_string("Invalid byte_pos %d, must be >= 0", b))
        .when(n <= 0, F.format_string("Invalid num_bytes %d, must be > 0", n))
        .when((t < 0) | (t > 7), F.format_string(MSG_BIT_OFFSET, t))
        .when(
            (b + n) * 2 > length,
            F.format_string(MSG_INSUFFICIENT, b, b + n - 1, F.floor(length / 2).cast("int")),
        )
        .when(n * 8 + t > 63, F.format_string(MSG_TOO_WIDE, n * 8 + t))
        .when(bad_main.isNotNull(), F.format_string(MSG_BAD_HEX, bad_main))
        .when(bad_next.isNotNull(), F.format_string(MSG_BAD_HEX, bad_next))
    )
    value = _le_value(msg, b, n)
    carry = F.when((t > 0) & has_next, shl(byte_at(msg, b + n).bitwiseAND(mask(t)), n * 8))
    shifted = shr(value.bitwiseOR(F.coalesce(carry, F.lit(0).cast("bigint"))), t).bitwiseAND(
        mask(n * 8)
    )
    raw = F.when(t > 0, shifted).otherwise(value)
    return err, raw


def consecutive_bytes_le(msg: Column, length: Column, all_hex: Column, b: Column, n: Column, t: Column) -> Column:
    err, raw = _consecutive(msg, length, all_hex, b, n, t)
    return _result(err, raw)


def bytes_and_bits(msg: Column, length: Column, all_hex: Column, b: Column, t: Column, n: Column, k: Column) -> Column:
    err_main, main = _consecutive(msg, length, all_hex, b, n, t)
    prev = b - 1
    bad_prev = _bad_byte(msg, all_hex, prev, F.lit(1))
    err_back = (
        F.when(prev < 0, F.lit(MSG_BACKWARD))
        .when(prev * 2 + 2 > length, F.format_string(MSG_PREV_MISSING, prev))
        .when(bad_prev.isNotNull(), F.format_string(MSG_BAD_HEX, bad_prev))
        .when(n * 8 + k > 63, F.format_string(MSG_TOO_WIDE, n * 8 + k))
    )
    err = F.coalesce(err_main, err_back)
    back = byte_at(msg, prev).bitwiseAND(mask(k))
    raw = main.bitwiseOR(shl(back, n * 8))
    return _result(err, raw)


def extract_field(msg: Column, length: Column, all_hex: Column, b: Column, t: Column, n: Column, k: Column) -> Column:
    """Dispatch on (n > 0, k > 0) to the four extraction rules."""
    return (
        F.when((n == 0) & (k > 0), bits_in_byte(msg, length, all_hex, b, t, k))
        .when((n > 0) & (k == 0), whole_bytes_be(msg, length, all_hex, b, t, n))
        .when((n > 0) & (k > 0), bytes_and_bits(msg, length, all_hex, b, t, n, k))
        .otherwise(consecutive_bytes_le(msg, length, all_hex, b, F.lit(1), t))
    )


def is_all_hex(msg: Column) -> Column:
    """True when every character of the message is a hex digit (checked once per row)."""
    return F.coalesce(msg.rlike("^[0-9A-Fa-f]*$"), F.lit(False))


READ_PLAN = "struct<ok:boolean,need:int,le:boolean,at:int,count:int,shift:int,mask:bigint,back:int,back_mask:bigint,back_shift:int>"


def read_plan(b: Column, t: Column, n: Column, k: Column) -> Column:
    """How to read a field, from its position and size alone. ``ok`` is false where the position is an error by
    itself or the value may need more than seven bytes; ``need`` is the number of bytes the message must have."""
    bits = (n == 0) & (k > 0)
    big = (n > 0) & (k == 0)
    mixed = (n > 0) & (k > 0)
    size = F.when(n > 0, n).otherwise(1)
    offset_ok = (b >= 0) & (t >= 0) & (t <= 7)
    small = (size <= 6) & (k <= 8)
    none = F.lit(0).cast("bigint")
    return F.when(
        b.isNotNull() & t.isNotNull() & n.isNotNull() & k.isNotNull(),
        F.struct(
            (offset_ok & small & F.when(bits, t + k <= 8).when(mixed, b > 0).when(big, F.lit(True)).otherwise((n == 0) & (k == 0))).alias("ok"),
            (b + F.when(bits | big, 1).otherwise(size)).alias("need"),
            (~bits & ~big).alias("le"),
            b.alias("at"),
            F.when(bits, 1).when(big, n).otherwise(size + F.when(t > 0, 1).otherwise(0)).alias("count"),
            F.when(big, 0).otherwise(t).alias("shift"),
            F.when(bits, mask(F.least(k, F.lit(8)))).when(big, F.lit(-1).cast("bigint")).otherwise(mask(F.least(size, F.lit(6)) * 8)).alias("mask"),
            F.when(mixed, b - 1).otherwise(-1).alias("back"),
            F.when(mixed, mask(F.least(k, F.lit(8)))).otherwise(none).alias("back_mask"),
            F.when(mixed, F.least(size, F.lit(6)) * 8).otherwise(0).alias("back_shift"),
        ).cast(READ_PLAN),
    )


def reversed_bytes(msg: Column) -> Column:
    """The message with its bytes in reverse order (an odd last digit is left out)."""
    return F.regexp_replace(F.reverse(msg.substr(F.lit(1), F.shiftright(F.length(msg), 1) * 2)), "(.)(.)", "$2$1")


def fast_raw(msg: Column, rev: Column, n_bytes: Column, plan: Column) -> Column:
    """Raw value by the read plan, for a message of hex digits with at least ``plan.need`` bytes."""
    end = n_bytes - plan["at"]
    start = F.greatest(end - plan["count"], F.lit(0))
    text = F.when(plan["le"], rev.substr(start * 2 + 1, (end - start) * 2)).otherwise(
        msg.substr(plan["at"] * 2 + 1, plan["count"] * 2)
    )
    value = shr(F.conv(text, 16, 10).cast("bigint"), plan["shift"]).bitwiseAND(plan["mask"])
    back = shl(byte_at(msg, plan["back"]).bitwiseAND(plan["back_mask"]), plan["back_shift"])
    return F.when(plan["back"] < 0, value).otherwise(value.bitwiseOR(back))
