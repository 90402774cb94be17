"""Fields of more than 63 bits: read as texts of bits and digits, so of any width (the rules of ``hexbits`` for whole
bytes, highest first, and for bytes with bits beside, lowest first)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from telemsg.functions import hexbits as H


#: Bits of a part, and bits up to which a field at a constant position is written out by its parts.
PART, MOST_BITS = 24, 256
_NINE = 10**9


def bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, as a lambda variable."""
    return F.transform(F.array(value), body)[0]


def bit_text(digits: Column) -> Column:
    """Four characters 0 or 1 for every hex digit."""
    return F.array_join(F.transform(F.split(digits, ""), lambda c: F.lpad(F.conv(c, 16, 2), 4, "0")), "")


def hex_of_bits(bits: Column) -> Column:
    """Hex digits of a text of bits, without leading zeros."""
    padded = F.lpad(bits, F.ceil(F.length(bits) / 60).cast("int") * 60, F.lit("0"))
    groups = F.sequence(F.lit(1), F.length(padded), F.lit(60))
    digits = F.transform(groups, lambda i: F.lpad(F.conv(padded.substr(i, F.lit(60)), 2, 16), 15, "0"))
    return F.ltrim(F.array_join(digits, ""), F.lit("0"))


def decimal_text(digits: Column) -> Column:
    """Decimal digits of a whole number of any size, from its hex digits: six of them at a time are taken into limbs
    of nine decimal digits, lowest first."""
    padded = F.lpad(digits, F.ceil(F.length(digits) / 6).cast("int") * 6, F.lit("0"))
    parts = F.transform(
        F.sequence(F.lit(1), F.length(padded), F.lit(6)), lambda i: F.conv(padded.substr(i, F.lit(6)), 16, 10).cast("bigint")
    )
    base = F.lit(10**9).cast("bigint")
    none = F.array().cast("array<bigint>")
    quotient = lambda v: F.floor((v - v % base) / base).cast("bigint")  # noqa: E731  below 2^25, so the division is exact

    def taken(limbs: Column, part: Column) -> Column:
        def step(s: Column, limb: Column) -> Column:
            v = limb * 16777216 + s["carry"]
            return F.struct(quotient(v).alias("carry"), F.concat(s["out"], F.array(v % base)).alias("out"))

        start = F.struct(part.alias("carry"), none.alias("out"))
        return F.aggregate(limbs, start, step, lambda s: F.concat(s["out"], F.filter(F.array(s["carry"]), lambda c: c > 0)))

    texts = F.transform(F.reverse(F.aggregate(parts, none, taken)), lambda x: F.lpad(x.cast("string"), 9, "0"))
    return F.ltrim(F.array_join(texts, ""), F.lit("0"))


def read_wide(msg: Column, length: Column, all_hex: Column, b: Column, t: Column, n: Column, k: Column) -> Column:
    """struct<raw, digits, err>: the number where a bigint holds it, else its hex digits, or the error."""
    text = H.hex_slice(msg, b, n)
    err_big = (
        F.when(b * 2 + 2 > length, F.format_string(H.MSG_BYTE_MISSING, b))
        .when((t < 0) | (t > 7), F.format_string(H.MSG_BIT_POS, t))
        .when(~all_hex & ~text.rlike(H.HEX_RE), F.format_string(H.MSG_BAD_HEX, text))
    )
    further = F.when((t > 0) & ((b + n) * 2 + 2 <= length), 1).otherwise(0)
    bad = H._bad_byte(msg, all_hex, b, n + further)
    err_little = (
        F.when((t < 0) | (t > 7), F.format_string(H.MSG_BIT_OFFSET, t))
        .when((b + n) * 2 > length, F.format_string(H.MSG_INSUFFICIENT, b, b + n - 1, F.floor(length / 2).cast("int")))
        .when(bad.isNotNull(), F.format_string(H.MSG_BAD_HEX, bad))
        .when(b < 1, F.lit(H.MSG_BACKWARD))
    )
    before = H._bad_byte(msg, all_hex, b - 1, F.lit(1))
    err_little = F.coalesce(err_little, F.when(before.isNotNull(), F.format_string(H.MSG_BAD_HEX, before)))
    err = F.when(b < 0, F.format_string(H.MSG_BYTE_MISSING, b)).otherwise(F.when(k == 0, err_big).otherwise(err_little))
    # little-endian: the bytes in reverse, with one more in front where the offset reaches into it, less the bits below
    # the offset; above them the low bits of the byte before
    plain = bit_text(H.reversed_bytes(H.hex_slice(msg, b, n + further)))
    main = F.reverse(F.rpad(F.reverse(plain).substr(t + 1, n * 8), n * 8, F.lit("0")))
    low = F.reverse(F.reverse(bit_text(H.hex_slice(msg, b - 1))).substr(F.lit(1), k))
    bits = F.when(k == 0, bit_text(text)).otherwise(F.concat(low, main))

    def of(x: Column) -> Column:
        digits = hex_of_bits(x["bits"])
        return F.struct(digits.alias("digits"), x["err"].alias("err"))

    def split(x: Column) -> Column:
        size = F.length(x["digits"])
        narrow = (size <= 15) | ((size == 16) & (F.substring(x["digits"], 1, 1) < "8"))
        raw = F.conv(F.concat(F.lit("0"), F.when(narrow, x["digits"])), 16, 10).cast("bigint")
        return F.struct(raw.alias("raw"), F.when(~narrow, x["digits"]).alias("wide"), x["err"].alias("err"))

    found = bound(F.struct(err.alias("err"), F.when(err.isNull(), bits).alias("bits")), of)
    split_up = bound(found, split)
    return bound(
        split_up,
        lambda x: F.struct(x["raw"].alias("raw"), x["wide"].alias("wide"), x["err"].alias("err"), decimal_text(x["wide"]).alias("digits")),
    )


def parts_raw(parts: list[str]) -> tuple[str, str]:
    """(number, bits beyond a bigint's) of a whole number from its parts of ``PART`` bits each, lowest first."""
    mid = parts[2] if len(parts) > 2 else "0L"
    raw = f"({parts[0]} | shiftleft({parts[1]}, {PART}) | shiftleft({mid} & {(1 << 15) - 1}L, {2 * PART}))"
    return raw, "(" + " | ".join([f"shiftright({mid}, 15)", *parts[3:]]) + ")"


def parts_hex(parts: list[str]) -> str:
    """Hex digits without leading zeros."""
    return f"ltrim('0', concat({', '.join(f"lpad(hex({x}), 6, '0')" for x in reversed(parts))}))"


def parts_decimal(parts: list[str]) -> str:
    """Decimal digits without leading zeros: every part's power of two is cut into limbs of nine digits beforehand, so
    a limb is a sum of products with constants (below 2^54 each) and the carry of the limb below."""
    powers = [1 << (PART * i) for i in range(len(parts))]
    n = -(-len(str((1 << (PART * len(parts))) - 1)) // 9)
    limbs, carry = [], None
    for j in range(n):
        terms = [f"{x} * {c}L" for x, p in zip(parts, powers, strict=True) if (c := p // _NINE**j % _NINE)]
        x = " + ".join([*terms, *([carry] if carry else [])]) or "0L"
        limbs.append(f"lpad(CAST(({x}) % {_NINE}L AS STRING), 9, '0')")
        carry = f"(({x}) div {_NINE}L)"
    return f"ltrim('0', concat({', '.join(reversed(limbs))}))"
