"""Numeric helpers whose results must equal the reference's Python/numpy results.

* ``numpy_round``: the reference rounds ``numpy.float64`` values (pandas hands
  back numpy scalars), and numpy rounds as ``rint(x * 10^d) / 10^d`` in double
  arithmetic. Spark's ``rint`` is the same IEEE round-half-even, and
  ``pow(10, d)`` is exact for small integer d, so this is bit-for-bit equal.
  Spark's own ``round``/``bround`` round the decimal text of the double and differ.
* ``whole_float_text``: a float cut to a whole number, all its digits: the float is a number below 2^57 times a power
  of 16, so its hex digits are those of that number and zeros.
* ``python_float_text``: ``repr()`` of a Python float (fixed notation for
  1e-4 <= |x| < 1e16, otherwise ``1e+16`` style), built from Spark's own text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def numpy_round(x: Column, decimals: Column) -> Column:
    scale = F.pow(F.lit(10.0), decimals.cast("double"))
    return F.rint(x * scale) / scale


def whole_float_text(x: Column) -> Column:
    """``int(x)`` of a finite double as decimal digits, of any size."""
    from telemsg.functions.wide import decimal_text

    size = F.abs(x)
    zeros = F.greatest(F.floor((F.floor(F.log2(size)) - 53) / 4), F.lit(0)).cast("int")
    digits = F.concat(F.hex((size / F.pow(F.lit(16.0), zeros.cast("double"))).cast("bigint")), F.repeat(F.lit("0"), zeros))
    big = F.concat(F.when(x < 0, F.lit("-")).otherwise(F.lit("")), decimal_text(digits))
    return F.when(size < 2.0**63, x.cast("bigint").cast("string")).otherwise(big)


def python_float_text(x: Column) -> Column:
    """Text of a double as Python's ``repr`` prints it."""
    s = x.cast("string")  # Java form: 5.3, 1.0E7, 1.0E-4, NaN, Infinity
    mant = F.regexp_extract(s, r"^(-?)(\d+)\.(\d+)E(-?\d+)$", 2)
    frac = F.regexp_extract(s, r"^(-?)(\d+)\.(\d+)E(-?\d+)$", 3)
    sign = F.regexp_extract(s, r"^(-?)(\d+)\.(\d+)E(-?\d+)$", 1)
    exp = F.regexp_extract(s, r"^(-?)(\d+)\.(\d+)E(-?\d+)$", 4).try_cast("int")
    # significant digits without trailing zeros ("1.0" -> "1", "1.25" -> "125")
    digits = F.regexp_replace(F.concat(mant, frac), "0+$", "")
    digits = F.when(digits == "", F.lit("0")).otherwise(digits)
    nd = F.length(digits)
    # fixed notation for 1e-4 <= |x| < 1e16 (Java switches at 1e-3 and 1e7)
    big = F.when(
        nd <= exp + 1,
        F.concat(digits, F.repeat(F.lit("0"), exp + 1 - nd), F.lit(".0")),
    ).otherwise(F.concat(digits.substr(F.lit(1), exp + 1), F.lit("."), digits.substr(exp + 2, F.lit(400))))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exp - 1), digits)
    fixed = F.concat(sign, F.when(exp >= 0, big).otherwise(small))
    sci_mant = F.when(nd == 1, digits).otherwise(
        F.concat(digits.substr(F.lit(1), F.lit(1)), F.lit("."), digits.substr(F.lit(2), F.lit(400)))
    )
    sci = F.concat(sign, sci_mant, F.lit("e"), F.when(exp >= 0, F.lit("+")).otherwise(F.lit("-")),
                   F.lpad(F.abs(exp).cast("string"), 2, "0"))
    return (
        F.when(x.isNull(), F.lit(None).cast("string"))
        .when(F.isnan(x), F.lit("NaN"))
        .when(x == float("inf"), F.lit("Infinity"))
        .when(x == float("-inf"), F.lit("-Infinity"))
        .when(~s.contains("E"), s)
        .when(exp.isNull(), s)
        .when((exp >= -4) & (exp < 16), fixed)
        .otherwise(sci)
    )


def exact_float_text(x: Column) -> Column:
    """``python_float_text`` with the fewest digits that still give the float, as Python prints: Java 17 prints some
    large floats with more. For values of 1e16 and more, which are whole, they are rounded from all their digits."""
    from telemsg.functions.wide import bound

    large = (F.abs(x) >= 1e16) & (F.abs(x) < float("inf"))
    sign = F.when(x < 0, "-").otherwise("")
    return F.when(large, F.concat(sign, bound(whole_float_text(F.abs(x)), lambda d: _fewest_digits(F.abs(x), d)))).otherwise(
        python_float_text(x)
    )


def _fewest_digits(size: Column, digits: Column) -> Column:
    """``1.23e+20`` with as few digits as still give ``size``, rounded from all its digits."""

    from telemsg.functions.wide import bound

    def rounded(n: int) -> Column:
        head, after = digits.substr(F.lit(1), F.lit(n)).cast("bigint"), digits.substr(F.lit(n + 1), F.lit(1))
        rest = digits.substr(F.lit(n + 2), F.lit(400)).rlike("[1-9]")
        up = (after > "5") | ((after == "5") & (rest | (head % 2 == 1)))
        return (head + F.when(up, 1).otherwise(0)).cast("string")

    def text(n: int) -> Column:
        power = (F.length(digits) - n).cast("string")
        tail = lambda h: F.regexp_replace(h.substr(F.lit(2), F.lit(20)), "0+$", "")
        point = lambda h: F.concat(h.substr(F.lit(1), F.lit(1)), F.when(tail(h) != "", F.concat(F.lit("."), tail(h))).otherwise(""))
        shown = lambda h: F.concat(point(h), F.lit("e+"), (F.length(digits) - n + F.length(h) - 1).cast("string"))
        same = lambda h: F.concat(h, F.lit("E"), power).try_cast("double") == size
        return bound(rounded(n), lambda h: F.when(same(h), shown(h)))

    return F.coalesce(text(15), text(16), text(17))
