"""Decode compiled per layout (D2-D9): expressions with the codec's constants folded in.

``compile_codec`` reads a codec once - it is configuration, as large as the conversion files - and writes for every
message the expressions of its fields. A message is read in three steps:

1. its layout's number, from the family dimension; null where the message is not decoded;
2. the message as words of 56 bits, one conversion for every 14 hex digits; only a message with characters that are
   no hex digits also gets a list of error texts, the one rare branch of a message;
3. every field as shifts and masks of one or two words with constant positions, then its conversion: fields of up to
   ``DENSE_BITS`` bits index a table of finished values, made beforehand by the conversion rules over all raw values;
   wider linear fields compute factor and offset as constants; wider table fields walk a search tree over their keys.

The expected length is part of the layout's key and only valid messages are decoded, so every bound of a position is
settled while compiling: a field beyond the message is a constant text. Layouts that agree on a field share its
expression; where they differ, a CASE on the layout's number chooses. Fields that need more than 63 bits are cut into
parts of 24 bits, from which their number, hex and decimal digits are written out with constants; in a message with
other characters or of another length than its layout's they take the rules in full (``functions.wide``).

Spark plans a projection of plain expressions as one generated method, which the JVM only interprets beyond 8000
bytes of bytecode. The projections here hold a lambda (``apart``), so Spark divides them into small methods instead.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemsg.catalogue import Catalogue, MessageSpec, local_rows
from telemsg.functions import convert as C
from telemsg.functions import hexbits as H
from telemsg.functions import wide as W
from telemsg.functions.numeric import exact_float_text, numpy_round, python_float_text, whole_float_text
from telemsg.operators.decode import DECODED_FIELD
from telemsg.operators.flatten import typed_value

DENSE_BITS, WORD = 8, 56
FIELD_DDL = (
    "struct<type:string,id:string,id_int:bigint,name:string,labels:map<bigint,string>,"
    "lin:struct<factor:double,offset:double,decimals:int,raw_max:bigint,encodings:array<struct<lo:bigint,hi:bigint,label:string>>>>"
)


@dataclass(frozen=True)
class Read:
    """How a field is read from a message of known length: an error known beforehand, or byte texts that must be hex
    (in the order in which they are tested), then perhaps an error, then ``value`` over the words."""

    error: str | None = None
    checks: tuple[tuple[int, int], ...] = ()
    late_error: str | None = None
    parts: tuple[tuple[int, int, int], ...] = ()  # (first bit, bits, shift to the left)
    shift: int = 0
    mask_bits: int | None = None
    back: tuple[int, int, int] | None = None
    full: tuple[int, int, int, int, int] | None = None  # (b, t, n, k, length) of a field of more than 63 bits

    @property
    def bits(self) -> int:
        if self.mask_bits is not None:
            total = self.mask_bits
        else:
            total = sum(p[1] for p in self.parts) - self.shift
        return total + (self.back[1] if self.back else 0)


def read_of(b: int, t: int, n: int, k: int, length: int) -> Read:
    """The rules of ``hexbits`` for a field at constant positions in a message of ``length`` characters."""
    if b < 0:
        return Read(error=H.MSG_BYTE_MISSING % b)
    n, k = max(n, 0), max(k, 0)
    byte = (8 * b, 8, 0)
    if n == 0 and k > 0:
        if b * 2 + 2 > length:
            return Read(error=H.MSG_BYTE_MISSING % b)
        if not 0 <= t <= 7:
            return Read(error=H.MSG_BIT_START % t)
        if t + k > 8:
            return Read(error=H.MSG_BIT_RANGE % (t, k))
        return Read(checks=((2 * b, 2),), parts=((8 * b + 8 - t - k, k, 0),))
    if n > 0 and k == 0:
        if b * 2 + 2 > length:
            return Read(error=H.MSG_BYTE_MISSING % b)
        if not 0 <= t <= 7:
            return Read(error=H.MSG_BIT_POS % t)
        digits = min(2 * n, length - 2 * b)
        if digits > 14:
            return Read(full=(b, t, n, k, length))
        return Read(checks=((2 * b, digits),), parts=((8 * b, 4 * digits, 0),))
    size = max(n, 1)
    if not 0 <= t <= 7:
        return Read(error=H.MSG_BIT_OFFSET % t)
    if (b + size) * 2 > length:
        return Read(error=H.MSG_INSUFFICIENT % (b, b + size - 1, length // 2))
    if size * 8 + max(t, k) > 63:
        return Read(full=(b, t, n, k, length))
    further = t > 0 and (b + size) * 2 + 2 <= length
    checks = [(2 * i, 2) for i in range(b, b + size + further)]
    parts = [(byte[0] + 8 * i, 8, 8 * i) for i in range(size)]
    if further:
        parts.append((8 * (b + size) + 8 - t, t, 8 * size))
    late, back = None, None
    if k > 0:
        if b == 0:
            late = H.MSG_BACKWARD
        else:
            checks.append((2 * (b - 1), 2))
            low = min(k, 8)
            back = (8 * b - low, low, 8 * size)
    return Read(checks=tuple(checks), late_error=late, parts=tuple(parts), shift=t, mask_bits=8 * size if t else None, back=back)


def bits_sql(words: str, first: int, count: int) -> str:
    """``count`` bits from bit ``first`` on, as a whole number: shifts and masks of the words they lie in."""
    out, left = [], count
    at = first
    while left:
        w, inside = divmod(at, WORD)
        take = min(left, WORD - inside)
        down = WORD - inside - take
        x = f"{words}[{w}]"
        if down:
            x = f"shiftright({x}, {down})"
        if inside or take < WORD:
            x = f"({x} & {(1 << take) - 1}L)"
        left -= take
        out.append(f"shiftleft({x}, {left})" if left else x)
        at += take
    return " | ".join(out) if len(out) == 1 else "(" + " | ".join(out) + ")"


def raw_sql(words: str, r: Read) -> str:
    terms = []
    for first, count, left in r.parts:
        x = bits_sql(words, first, count)
        terms.append(f"shiftleft({x}, {left})" if left else x)
    value = terms[0] if len(terms) == 1 else "(" + " | ".join(terms) + ")"
    if r.shift:
        value = f"(shiftright({value}, {r.shift}) & {(1 << r.mask_bits) - 1}L)"
    if r.back:
        first, count, left = r.back
        value = f"({value} | shiftleft({bits_sql(words, first, count)}, {left}))"
    return value


def wide_bits(b: int, t: int, n: int, k: int, length: int) -> list[tuple[int, int]] | None:
    """Where the bits of a field of more than 63 bits lie in the message, as (first bit, bits), lowest bits first and
    (-1, bits) for zeros; null where there is no byte before the first."""
    if k == 0:
        return [(8 * b, 4 * min(2 * n, length - 2 * b))]
    if b < 1:
        return None
    out = [(8 * b, 8 - t), *[(8 * i, 8) for i in range(b + 1, b + n)]]
    if t:
        out.append((8 * (b + n) + 8 - t if (b + n) * 2 + 2 <= length else -1, t))
    low = min(k, 8)
    return [*out, (8 * b - low, low)]


def part_sql(words: str, bits: list[tuple[int, int]], low: int, size: int) -> str:
    """The bits from ``low`` on, ``size`` of them, of a value whose bits lie at ``bits``."""
    out, at = [], 0
    for first, count in bits:
        a, e = max(low, at), min(low + size, at + count)
        if a < e and first >= 0:
            x = bits_sql(words, first + count - (e - at), e - a)
            out.append(f"shiftleft({x}, {a - low})" if a > low else x)
        at += count
    return "(" + " | ".join(out) + ")" if out else "0L"


def text_sql(s: str | None) -> str:
    if s is None:
        return "CAST(NULL AS STRING)"
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def double_sql(x: float | None) -> str:
    if x is None:
        return "CAST(NULL AS DOUBLE)"
    if x != x or x in (float("inf"), float("-inf")):
        return f"CAST('{'NaN' if x != x else ('' if x > 0 else '-') + 'Infinity'}' AS DOUBLE)"
    return f"{x!r}D"


@dataclass(frozen=True)
class Rule:
    """How a raw value is converted; equal rules share one table of values."""

    type: str
    id: str | None
    id_int: int | None
    name: str
    lin: tuple | None  # (factor, offset, decimals, raw_max, ((lo, hi, label), ...))
    labels: tuple[tuple[int, str], ...] | None
    has_linear: bool
    has_table: bool

    @property
    def linear(self) -> bool:
        return self.type == "L" and self.lin is not None and self.has_linear

    def sort_key(self) -> str:
        return repr(self)


@dataclass(frozen=True)
class Field:
    description: str
    raw_position: str
    size: str
    read: Read
    rule: Rule


def _rule(f, has_linear: bool, has_table: bool) -> Rule:
    lin = None
    if f.type == "L" and f.lin is not None:
        lin = (f.lin.factor, f.lin.offset, f.lin.decimals, f.lin.raw_max, tuple((e.lo, e.hi, e.label) for e in f.lin.encodings))
    labels = tuple(sorted(f.labels.items())) if f.type == "T" and f.labels is not None else None
    return Rule(f.type, f.id, f.id_int, f.name if f.type == "T" else "", lin, labels, has_linear, has_table)


def field_struct(rule: Rule) -> dict:
    """The rule as the row the conversion rules take."""
    lin = None
    if rule.lin is not None:
        factor, offset, decimals, raw_max, encodings = rule.lin
        lin = (factor, offset, decimals, raw_max, [tuple(e) for e in encodings])
    return (rule.type, rule.id, rule.id_int, rule.name, dict(rule.labels) if rule.labels is not None else None, lin)


#: Output types with a table of finished values each.
TYPED = {"text": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType()}


def value_tables(spark, rules: dict[Rule, int], bits_of: dict[Rule, int]) -> dict[Rule, dict[str, list]]:
    """For every rule the finished values of all raw values of its width, by the conversion rules themselves: one
    small job over at most 2^DENSE_BITS rows a rule."""
    rows = [(i, bits_of[r], field_struct(r), r.has_linear, r.has_table) for r, i in rules.items() if r in bits_of]
    if not rows:
        return {}
    df = spark.createDataFrame(rows, f"rule int, bits int, f {FIELD_DDL}, has_linear boolean, has_table boolean")
    raws = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(2**DENSE_BITS - 1).cast("bigint"))).alias("raw")
    each = df.select("*", raws).where("raw < shiftleft(1L, bits)")
    value = C.convert_field(F.col("f"), F.col("raw"), F.col("has_linear"), F.col("has_table"))
    done = each.select("rule", "raw", value.alias("v")).select(
        "rule", "raw", *[typed_value(F.col("v"), t).alias(n) for n, t in TYPED.items() if n != "text"], C.value_text(F.col("v")).alias("text")
    )
    found: dict[int, dict[str, list]] = {}
    for r in done.orderBy("rule", "raw").collect():
        t = found.setdefault(r.rule, {n: [] for n in TYPED})
        for n in TYPED:
            t[n].append(r[n])
    return {rule: found[i] for rule, i in rules.items() if i in found}


def table_sql(kind: str, values: list, raw: str) -> str:
    """A table of finished values, indexed by the raw value."""
    lit = {"text": text_sql, "double": double_sql, "int": lambda x: "CAST(NULL AS INT)" if x is None else str(x)}[kind]
    if len(set(map(repr, values))) == 1 and values[0] is None:
        return lit(None)
    return f"array({', '.join(lit(v) for v in values)})[CAST({raw} AS INT)]"


def search_sql(raw: str, labels: tuple[tuple[int, str], ...]) -> str:
    """The label of the raw value, null without one: a search tree over the sorted keys."""
    if len(labels) <= 2:
        return f"CASE {' '.join(f'WHEN {raw} = {k}L THEN {text_sql(v)}' for k, v in labels)} END"
    mid = len(labels) // 2
    return f"IF({raw} < {labels[mid][0]}L, {search_sql(raw, labels[:mid])}, {search_sql(raw, labels[mid:])})"


def special_branches(rule: Rule, raw: str, top: int) -> list[tuple[str, str]]:
    """(condition, label) of a linear field's encodings and special values, those that its width can reach."""
    _, _, _, raw_max, encodings = rule.lin
    out = [(f"{raw} BETWEEN {lo}L AND {hi}L", label) for lo, hi, label in encodings if lo <= hi and lo <= top]
    if raw_max is not None:
        if top >= 0xFFFF and raw_max == 0xFFFE:
            out.append((f"{raw} = 65535L", C.INVALID_NOT_AVAILABLE))
        elif top >= 0xFFFF and raw_max < 0xFFFF:
            out.append((f"{raw} = 65535L", C.INVALID_SENSOR_ERROR))
        if top >= 0xFFFE and raw_max < 0xFFFE:
            out.append((f"{raw} = 65534L", C.NOT_INITIALIZED))
        if top > raw_max:
            out.append((f"{raw} > {raw_max}L", C.OUT_OF_RANGE))
    return out


def linear_sql(rule: Rule, raw: str, bits: int, kind: str) -> str | Column:
    """A linear field of more than ``DENSE_BITS`` bits."""
    factor, offset, decimals, _, _ = rule.lin
    top = (1 << bits) - 1
    x = f"(CAST({raw} AS DOUBLE) * {double_sql(factor)} + {double_sql(offset)})"

    def as_kind(label: str) -> str:
        return text_sql(label) if kind == "text" else f"try_cast({text_sql(label)} AS {kind})"

    if decimals > 0:
        scale = double_sql(10.0**decimals)
        num = f"(rint({x} * {scale}) / {scale})"
        if kind == "int":
            value = "CAST(NULL AS INT)"
        elif kind == "double":
            value = num
        else:
            largest = abs(factor) * top + abs(offset)
            if decimals <= 3 and largest < 1e6:  # no float in this range is printed with an exponent
                value = f"CAST({num} AS STRING)"
            else:
                value = W.bound(F.expr(num), exact_float_text if largest >= 1e16 else python_float_text)
    elif factor != factor or offset != offset:
        value = as_kind("Conv Error: cannot convert float NaN to integer")
    else:
        whole = f"try_cast({x} AS BIGINT)"
        value = {"text": f"CAST({whole} AS STRING)", "int": f"try_cast({whole} AS INT)", "double": f"CAST({whole} AS DOUBLE)"}[kind]
    branches = special_branches(rule, raw, top)
    if isinstance(value, str):
        return f"CASE {' '.join(f'WHEN {c} THEN {as_kind(v)}' for c, v in branches)} ELSE {value} END" if branches else value
    out = None
    for c, v in branches:
        out = F.when(F.expr(c), F.expr(as_kind(v))) if out is None else out.when(F.expr(c), F.expr(as_kind(v)))
    return value if out is None else out.otherwise(value)


def plain_sql(rule: Rule, raw: str, kind: str) -> str:
    """Any other field of more than ``DENSE_BITS`` bits: whole numbers, table labels, constant error texts."""
    bad_id = C.BAD_INT_ID % rule.id
    text = None
    if rule.type == "T":
        if rule.id is None or not rule.has_table:
            text = f"concat('0x', hex({raw}))"
        elif rule.id_int is None:
            text = f"concat('0x', hex({raw}), {text_sql(f' (Conv Error: {bad_id})')})"
        else:
            text = f"concat('0x', hex({raw}), ' (No match)')"
            for needle, yes, no in reversed(C.NAME_FALLBACKS):
                if needle in rule.name:
                    text = f"IF({raw} = 1, {text_sql(yes)}, {text_sql(no)})"
            if rule.labels:
                text = f"coalesce({search_sql(raw, rule.labels)}, {text})"
    elif rule.type == "L" and rule.id is not None and rule.has_linear and rule.id_int is None:
        text = text_sql(f"Conv Error: {bad_id}")
    if text is not None:
        return text if kind == "text" else f"try_cast({text} AS {kind})"
    return {"text": f"CAST({raw} AS STRING)", "int": f"try_cast({raw} AS INT)", "double": f"CAST({raw} AS DOUBLE)"}[kind]


@dataclass
class CompiledMessage:
    msg: str
    layouts: list[tuple[int, tuple[Field | None, ...]]] = field(default_factory=list)  # (length, fields) by number
    number: dict[tuple[str, int], int] = field(default_factory=dict)  # (family, year) -> layout
    checks: dict[tuple[tuple[int, int], ...], int] = field(default_factory=dict)  # texts to test -> place in the list
    full: dict[tuple[int, int, int, int, int], int] = field(default_factory=dict)  # positions of wide fields -> place

    @property
    def n_words(self) -> int:
        return max((-(-4 * length // WORD) for length, _ in self.layouts), default=0)


@dataclass
class CompiledCodec:
    messages: dict[str, CompiledMessage]
    tables: dict[Rule, dict[str, list]]
    lengths: dict[tuple[str, int], dict[str, int]]

    def dimension(self, spark) -> DataFrame:
        """(family, year, {m}_reference_len, {m}_layout): one short row a family and year."""
        msgs = list(self.messages)
        keys = sorted(set(self.lengths) | {k for m in self.messages.values() for k in m.number})
        rows = [
            (fam, year, *[x for m in msgs for x in (self.lengths.get((fam, year), {}).get(m), self.messages[m].number.get((fam, year)))])
            for fam, year in keys
        ]
        ddl = "family string, year int, " + ", ".join(f"{m}_reference_len int, {m}_layout int" for m in msgs)
        return local_rows(spark, rows, ddl)


def compile_codec(codec: DataFrame, catalogue: Catalogue) -> CompiledCodec:
    """Compile codec rows (family, year, msg, has_linear, has_table, broken, fields). Two small jobs: the codec is
    read, and the tables of finished values are made."""
    spark = codec.sparkSession
    lengths: dict[tuple[str, int], dict[str, int]] = {}
    for m in catalogue.messages:
        for fam, year, n in m.lengths:
            lengths.setdefault((fam, year), {})[m.msg] = n
    messages = {m.msg: CompiledMessage(m.msg) for m in catalogue.messages}
    wanted = codec.where(F.col("msg").isin(list(messages)) & ~F.coalesce("broken", F.lit(False)))
    rows = wanted.select("family", "year", "msg", "has_linear", "has_table", "fields").collect()
    for r in sorted(rows, key=lambda r: (r.msg, r.family, r.year)):
        length = lengths.get((r.family, r.year), {}).get(r.msg)
        if not length:
            continue  # a message without an expected length is never valid
        fields = tuple(
            None
            if f is None
            else Field(f.description, f.raw_position, f.size, read_of(f.b, f.t, f.n, f.k, length), _rule(f, r.has_linear, r.has_table))
            for f in r.fields
        )
        m = messages[r.msg]
        key = (length, fields)
        if key not in m.layouts:
            m.layouts.append(key)
        m.number[r.family, r.year] = m.layouts.index(key)
        for f in fields:
            if f is not None and f.read.checks:
                m.checks.setdefault(f.read.checks, len(m.checks))
            if f is not None and f.read.full:
                m.full.setdefault(f.read.full, len(m.full))
    bits_of: dict[Rule, int] = {}
    for m in messages.values():
        for _, fields in m.layouts:
            for f in fields:
                if f is not None and f.read.parts and f.read.bits <= DENSE_BITS:
                    bits_of[f.rule] = max(bits_of.get(f.rule, 0), f.read.bits)
    rules = {r: i for i, r in enumerate(sorted(bits_of, key=Rule.sort_key))}
    return CompiledCodec(messages, value_tables(spark, rules, bits_of), lengths)


def apart(c: Column) -> Column:
    """``c``, by way of a lambda: its projection is then divided into small methods."""
    return W.bound(c, lambda x: x)


def prepared(df: DataFrame, compiled: CompiledCodec, columns: dict[str, str], valid: Callable[[str], Column] | None = None) -> DataFrame:
    """Add {m}_words, {m}_errors and perhaps {m}_full, and clear {m}_layout where the message is not decoded."""
    out, parts, wide = {}, {}, {}
    for msg, col in columns.items():
        m, text = compiled.messages[msg], F.col(col)
        ok = text.isNotNull() if valid is None else valid(msg)
        number = F.when(ok, F.col(f"{msg}_layout"))
        all_hex = text.rlike("^[0-9A-Fa-f]*$")
        # other characters count as 0 here: a field that reads one has its error text below
        padded = F.rpad(F.when(all_hex, text).otherwise(F.regexp_replace(text, "[^0-9A-Fa-f]", "0")), max(1, m.n_words) * 14, "0")
        out[f"{msg}_layout"] = number
        out[f"{msg}_words"] = F.when(number.isNotNull(), _words(padded, max(1, m.n_words)))
        out[f"{msg}_errors"] = F.when(number.isNotNull() & ~all_hex, _errors(text, m))
        if m.full:
            parts[f"{msg}_parts"] = _parts(m)
            wide[f"{msg}_full"] = F.when(F.col(f"{msg}_layout").isNotNull(), _full(text, m))
    out = df.withColumns(out)
    # a projection each, so that words and parts are made once; the parts hold a lambda, as ``apart`` says
    return out.withColumns(parts).withColumns(wide).drop(*parts) if wide else out


def _words(padded: Column, n: int) -> Column:
    """The message as ``n`` numbers of 14 hex digits each; the text is made once."""
    return W.bound(padded, lambda p: F.array(*[F.conv(p.substr(14 * i + 1, 14), 16, 10).cast("bigint") for i in range(n)]))


def _own_layouts(m: CompiledMessage, position: tuple[int, int, int, int, int]) -> Column:
    """Whether the message's layout has a wide field at this position."""
    own = [i for i, (_, fields) in enumerate(m.layouts) if any(f is not None and f.read.full == position for f in fields)]
    return F.col(f"{m.msg}_layout").isin(own)


def _written_out(position: tuple[int, int, int, int, int]) -> list[tuple[int, int]] | None:
    """Where the field's bits lie, if it is written out by parts."""
    bits = wide_bits(*position)
    return bits if bits is not None and sum(n for _, n in bits) <= W.MOST_BITS else None


def _parts(m: CompiledMessage) -> Column:
    """array<array<bigint>>: the parts of every wide field that is written out."""
    items = []
    for position in m.full:
        bits = _written_out(position) or []
        n = -(-sum(c for _, c in bits) // W.PART)
        sqls = [part_sql(f"`{m.msg}_words`", bits, W.PART * i, W.PART) for i in range(n)]
        some = F.array(*[F.expr(f"CAST({x} AS BIGINT)") for x in sqls]).cast("array<bigint>")
        items.append(F.when(_own_layouts(m, position), some))
    return F.when(apart(F.col(f"{m.msg}_layout")).isNotNull(), F.array(*items))


def _full(text: Column, m: CompiledMessage) -> Column:
    """array<struct<raw, wide, err, digits>> of the fields of more than 63 bits; ``digits`` is a wide value in decimal."""
    all_hex = F.col(f"{m.msg}_errors").isNull()
    in_full = _in_full(text, all_hex, [p[:4] for p in m.full])
    lengths = F.array(*[F.lit(length) for length, _ in m.layouts])
    plain = all_hex & (F.length(text) == F.element_at(lengths, F.col(f"{m.msg}_layout") + 1))
    items = []
    for position, i in m.full.items():
        bits = _written_out(position)
        if bits is None:
            items.append(_in_full(text, all_hex, [position[:4]])[0])
            continue
        parts = [f"`{m.msg}_parts`[{i}][{j}]" for j in range(-(-sum(n for _, n in bits) // W.PART))]
        raw, beyond = W.parts_raw(parts)
        items.append(
            F.struct(
                F.expr(f"IF({beyond} = 0L, {raw}, CAST(NULL AS BIGINT))").alias("raw"),
                F.expr(f"IF({beyond} = 0L, CAST(NULL AS STRING), {W.parts_hex(parts)})").alias("wide"),
                F.lit(None).cast("string").alias("err"),
                F.expr(f"IF({beyond} = 0L, CAST(NULL AS STRING), {W.parts_decimal(parts)})").alias("digits"),
            )
        )
    own = [F.when(_own_layouts(m, p), x) for p, x in zip(m.full, items, strict=True)]
    return F.when(plain, F.array(*own)).otherwise(in_full)


def _in_full(text: Column, all_hex: Column, positions: list[tuple[int, int, int, int]]) -> Column:
    """The same by the rules in full, for any text."""
    places = F.array(*[F.struct(*[F.lit(x).alias(c) for x, c in zip(p, "btnk", strict=True)]) for p in positions])

    def read(p: Column) -> Column:
        return W.read_wide(text, F.length(text), all_hex, p["b"], p["t"], p["n"], p["k"])

    return F.transform(places, read)


def _errors(text: Column, m: CompiledMessage) -> Column:
    """For every list of texts that some field reads, the error of the first that is not hex, else null."""
    zeroed = F.translate(text, "123456789ABCDEFabcdef", "0" * 21)

    def bad(at: int, n: int) -> Column:
        wrong = zeroed.substr(at + 1, n) != F.lit("0" * n)
        return F.when(wrong, F.concat(F.lit("invalid literal for int() with base 16: '"), text.substr(at + 1, n), F.lit("'")))

    items = [F.coalesce(*[bad(at, n) for at, n in checks]) for checks in m.checks]
    return F.array(*items) if items else F.array().cast("array<string>")


def _column(x: str | Column) -> Column:
    return F.expr(x) if isinstance(x, str) else x


def wide_column(rule: Rule, wide: Column, digits: Column, kind: str) -> Column:
    """The value of a raw value of 2^63 or more, given by its hex and decimal digits . No encoding or table
    row reaches it, and every Raw Max that is a number lies below it."""

    def as_kind(text: Column) -> Column:
        return text if kind == "text" else text.try_cast(TYPED[kind])

    bad_id = C.BAD_INT_ID % rule.id
    if rule.linear:
        factor, offset, decimals, raw_max, _ = rule.lin
        if raw_max is not None:
            return as_kind(F.lit(C.OUT_OF_RANGE))
        if decimals <= 0 and (factor != factor or offset != offset):
            return as_kind(F.lit("Conv Error: cannot convert float NaN to integer"))
        x = digits.cast("double") * F.lit(factor) + F.lit(offset)
        if decimals <= 0:
            return as_kind(W.bound(x, whole_float_text))
        rounded = numpy_round(x, F.lit(decimals))
        return {"text": W.bound(rounded, exact_float_text), "double": rounded, "int": F.lit(None).cast("int")}[kind]
    if rule.type == "T":
        if rule.id is None or not rule.has_table:
            return as_kind(F.concat(F.lit("0x"), wide))
        if rule.id_int is None:
            return as_kind(F.concat(F.lit("0x"), wide, F.lit(f" (Conv Error: {bad_id})")))
        named = [no for needle, _, no in C.NAME_FALLBACKS if needle in rule.name]
        return as_kind(F.lit(named[0]) if named else F.concat(F.lit("0x"), wide, F.lit(" (No match)")))
    if rule.type == "L" and rule.id is not None and rule.has_linear and rule.id_int is None:
        return as_kind(F.lit(f"Conv Error: {bad_id}"))
    return as_kind(digits)


class FieldCode:
    """The expressions of one field of one message column."""

    def __init__(self, f: Field, compiled: CompiledCodec, m: CompiledMessage, text_col: str):
        self.f, self.m, self.text = f, m, text_col
        self.words = f"`{m.msg}_words`"
        self.raw, self.bits = (raw_sql(self.words, f.read), f.read.bits) if f.read.parts else (None, 63)
        if f.read.full:
            self.raw = f"`{m.msg}_full`[{m.full[f.read.full]}].raw"
        self.table = compiled.tables.get(f.rule) if self.bits <= DENSE_BITS else None

    def error(self) -> Column | None:
        """The error text of this field in this message, null where it was read."""
        r = self.f.read
        if r.error is not None:
            return F.lit(r.error)
        if r.full:
            return self._full("err")
        found = None
        if r.checks:
            found = F.col(f"{self.m.msg}_errors")[self.m.checks[r.checks]]
        if r.late_error is not None:
            return F.lit(r.late_error) if found is None else F.coalesce(found, F.lit(r.late_error))
        return found

    def _full(self, part: str) -> Column:
        return F.col(f"{self.m.msg}_full")[self.m.full[self.f.read.full]][part]

    def value(self, kind: str) -> Column:
        """The decoded value as ``text``, ``int`` or ``double``."""
        rule, r = self.f.rule, self.f.read
        err = self.error()
        if r.error is not None or r.late_error is not None:
            text = F.concat(F.lit("Error: "), err)
            return text if kind == "text" else F.lit(None).cast(TYPED[kind])
        if self.table is not None:
            good = table_sql(kind, self.table[kind], self.raw)
        elif rule.linear:
            good = linear_sql(rule, self.raw, self.bits, kind)
        else:
            good = plain_sql(rule, self.raw, kind)
        bad = F.concat(F.lit("Error: "), err) if kind == "text" else F.lit(None).cast(TYPED[kind])
        out = F.when(err.isNotNull(), bad)
        if r.full:
            wide = self._full("wide")
            out = out.when(wide.isNotNull(), wide_column(rule, wide, self._full("digits"), kind))
        return out.otherwise(_column(good))

    def raw_values(self) -> tuple[Column, Column]:
        """(raw_value, raw_wide) as shown beside the decoded value."""
        rule, r = self.f.rule, self.f.read
        none = F.lit(None).cast("bigint"), F.lit(None).cast("string")
        if rule.id is None or not ((rule.type == "L" and rule.has_linear) or rule.type == "T") or r.error or r.late_error:
            return none
        shown = F.lit(True)
        if any(v.startswith("Error") for _, v in rule.labels or ()):
            shown = ~F.coalesce(self.value("text").startswith("Error"), F.lit(False))
        if r.full:
            return F.when(shown, self._full("raw")), F.when(shown, self._full("digits"))
        return F.when(self.error().isNull() & shown, F.expr(self.raw)), none[1]


def by_layout(m: CompiledMessage, items: dict[int, tuple], build: Callable[[tuple], Column], none: Column) -> Column:
    """CASE on the layout's number; layouts with equal items share a branch."""
    groups: dict[tuple, list[int]] = {}
    for number, item in items.items():
        groups.setdefault(item, []).append(number)
    layout, out = F.col(f"{m.msg}_layout"), None
    for item, numbers in groups.items():
        whole = len(numbers) == len(m.layouts)
        cond = layout.isNotNull() if whole else layout.isin(numbers) if len(numbers) > 1 else layout == numbers[0]
        out = F.when(cond, build(item)) if out is None else out.when(cond, build(item))
    return none if out is None else out


def typed_columns(compiled: CompiledCodec, spec: MessageSpec) -> list[Column]:
    """One ``{msg}_{clean_name}`` column per declared field."""
    m, out = compiled.messages[spec.msg], []
    for c in spec.columns:
        kind = {T.StringType(): "text", T.IntegerType(): "int", T.DoubleType(): "double"}.get(c.spark_type)
        items = {
            i: (f,) for i, (_, fields) in enumerate(m.layouts) for f in fields if f is not None and f.description == c.description
        }

        def build(item: tuple, kind=kind, c=c) -> Column:
            code = FieldCode(item[0], compiled, m, spec.column_name)
            return code.value(kind) if kind else code.value("text").try_cast(c.spark_type)

        out.append(by_layout(m, items, build, F.lit(None).cast(c.spark_type)).alias(f"{spec.msg}_{c.clean_name}"))
    return out


def decoded_array(compiled: CompiledCodec, spec: MessageSpec) -> Column:
    """array<DECODED_FIELD> of a message, null where it is not decoded."""
    m = compiled.messages[spec.msg]
    places = max((len(fields) for _, fields in m.layouts), default=0)

    def build(item: tuple) -> Column:
        if item[0] is None:
            return F.lit(None).cast(DECODED_FIELD)
        f, code = item[0], FieldCode(item[0], compiled, m, spec.column_name)
        raw, wide = code.raw_values()
        return F.struct(
            F.lit(f.description).alias("description"), code.value("text").alias("decoded_value"),
            F.lit(f.raw_position).alias("raw_position"), F.lit(f.size).alias("size"), F.lit(f.rule.type).alias("msg_type"),
            F.lit(f.rule.id).cast("string").alias("msg_id"), raw.alias("raw_value"), wide.alias("raw_wide"),
        ).cast(DECODED_FIELD)

    layout = F.col(f"{m.msg}_layout")
    elements = []
    for j in range(places):
        items = {i: (fields[j],) for i, (_, fields) in enumerate(m.layouts) if j < len(fields)}
        elements.append(by_layout(m, items, build, F.lit(None).cast(DECODED_FIELD)))
    if not elements:
        return F.lit(None).cast(f"array<{DECODED_FIELD}>")
    whole = F.array(*elements)
    sizes = {len(fields) for _, fields in m.layouts}
    if len(sizes) > 1:
        size = F.element_at(F.array(*[F.lit(len(fields)) for _, fields in m.layouts]), layout + 1)
        whole = F.slice(whole, F.lit(1), size)
    return F.when(apart(layout).isNotNull(), whole)
