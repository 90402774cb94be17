"""Near-duplicate documents by b-bit MinHash.

1. Signatures: the set of a document's five-word shingles gives 128 minima. Runs of five minima hash to 24 band
   keys; of every minimum only the ``BITS`` low bits are kept, packed into four words.
2. Classes: documents with equal shingle sets are one class, named by its smallest id, by a map-side aggregation.
3. Candidates: classes that share a band key are a bucket. Each member is paired with its bucket's first class; of
   the distinct pairs, the packed signatures, by bit counts corrected for chance agreement, drop those far below the
   threshold.
4. Confirmation on the full sets, recomputed from the two texts, and connected components of the links.
5. Members that their bucket's first class did not reach are paired with the first of those left over, again and
   again, as long as that resolves many of them; no pair is tried twice. Of the buckets that still hold several
   components, the pairs of different ones are judged, inside the join, by longer signatures of ``FINE`` minima with a
   narrow margin, and those that pass are checked. So no candidate link is lost, while a bucket of near copies costs
   one pair a member, not all pairs.

Rows that are shuffled by band hold two numbers; a text is shuffled once, and once more for each centre it is held
against. A round's tables are deleted when the next one is written.

A pair at similarity 0.85 shares no band with probability 8e-7 (7e-5 at 0.80, the pipeline's threshold), and falls to
a bit-count margin with at most 1e-6.

Defined cases: a null or empty text has no shingles and is linked with nothing; a text below five words is one
shingle; repeated rows are copies of each other; rows without an id are linked with nothing and kept, their
component null; rows that share an id count as one document; an empty table gives an empty result; extra columns
are not read. Texts are cut whole, however long: memory in a task follows the longest single text.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, written
from .components import components
from .textbytes import chunks, mix64, shingles, utf8, words

cloudpickle.register_pickle_by_value(sys.modules[__name__])

HASHES, BANDS, ROWS, BITS, FINE = 128, 24, 5, 2, 1024
_RNG = np.random.default_rng(777)
_MUL = _RNG.integers(0, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _RNG.integers(0, 2**32, HASHES, dtype=np.uint32)
_FINE_MUL = _RNG.integers(0, 2**31, FINE, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_FINE_ADD = _RNG.integers(0, 2**32, FINE, dtype=np.uint32)
_SIGNATURE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_shingles", pa.int64()),
        ("s1", pa.int64()),
        ("s2", pa.int64()),
        ("bands", pa.list_(pa.int64())),
        ("sig", pa.list_(pa.int64())),
    ]
)


def _list_column(a: np.ndarray) -> pa.Array:
    offsets = np.arange(0, a.size + 1, a.shape[1] or 1, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(a).view(np.int64).ravel()))


def set_ids(rows: np.ndarray, grams: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that name each row's set, whatever the order of its members."""
    out = []
    for salt in (0x1234567, 0x89ABCDEF):
        total = np.zeros(n, np.uint64)
        if len(rows):
            first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
            total[rows[first]] = np.add.reduceat(mix64(grams ^ np.uint64(salt)), first)
        out.append(mix64(total))
    return out[0], out[1]


def signatures(data: np.ndarray, offsets: np.ndarray):
    """Per text: set size, set id (two words), band keys, packed low bits of the minima."""
    n = len(offsets) - 1
    _, _, row, h = words(data, offsets)
    rows, grams = shingles(row, h, n)
    size = np.bincount(rows, minlength=n).astype(np.int64)
    s1, s2 = set_ids(rows, grams, n)
    minima = minima_of(rows, grams, n, _MUL, _ADD)
    return size, s1, s2, band_keys(minima, BANDS, ROWS), packed(minima)


def band_keys(minima: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key per text and band, of ``rows`` minima each."""
    out = np.empty((minima.shape[1], bands), np.uint64)
    for b in range(bands):
        key = np.full(minima.shape[1], b + 1, np.uint64)
        for m in minima[b * rows : (b + 1) * rows]:
            key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + m)
        out[:, b] = key
    return out


def minima_of(rows: np.ndarray, grams: np.ndarray, n: int, mul: np.ndarray, add: np.ndarray) -> np.ndarray:
    out = np.zeros((len(mul), n), np.uint32)
    if len(rows):
        first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        x = (grams >> np.uint64(32)).astype(np.uint32)
        for i in range(len(mul)):
            out[i, rows[first]] = np.minimum.reduceat(x * mul[i] + add[i], first)
    return out


def packed(minima: np.ndarray) -> np.ndarray:
    """The low ``BITS`` bits of each minimum, packed into words of 64."""
    per = 64 // BITS
    sig = np.zeros((minima.shape[1], len(minima) // per), np.uint64)
    for i, row in enumerate(minima):
        # the low bits of a product follow the low bits of the shingle alone, so the minima are mixed first
        low = mix64(row.astype(np.uint64)) & np.uint64(2**BITS - 1)
        sig[:, i // per] |= low << np.uint64(BITS * (i % per))
    return sig


def _fine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Longer signatures: ``(rep, fine)``."""
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for a, b in chunks(offsets):
            part = offsets[a : b + 1]
            _, _, row, h = words(data[part[0] : part[-1]], part - part[0])
            rows, grams = shingles(row, h, b - a)
            sig = packed(minima_of(rows, grams, b - a, _FINE_MUL, _FINE_ADD))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), _list_column(sig)], ["rep", "fine"])


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for a, b in chunks(offsets):
            part = offsets[a : b + 1]
            size, s1, s2, bands, sig = signatures(data[part[0] : part[-1]], part - part[0])
            ids = batch.column(0).slice(a, b - a).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(size), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)), _list_column(bands), _list_column(sig)],
                schema=_SIGNATURE,
            )


def _verifier(num: int, den: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs ``(a, b, text_a, text_b)`` whose sets really meet ``num / den``."""
        for batch in batches:
            texts = [utf8(batch.column(2)), utf8(batch.column(3))]
            for x, y in chunks(np.add(texts[0][1], texts[1][1])):
                sets = []
                for data, offsets in texts:
                    part = offsets[x : y + 1]
                    _, _, row, h = words(data[part[0] : part[-1]], part - part[0])
                    sets.append(shingles(row, h, y - x))
                n = y - x
                both = np.concatenate([sets[0][0], sets[1][0]])
                grams = np.concatenate([sets[0][1], sets[1][1]])
                order = np.lexsort((grams, both))
                both, grams = both[order], grams[order]
                twin = (both[1:] == both[:-1]) & (grams[1:] == grams[:-1])
                common = np.bincount(both[1:][twin], minlength=n)
                union = np.bincount(both, minlength=n) - common
                ok = pa.array((den * common >= num * union) & (common > 0))
                yield batch.select([0, 1]).slice(x, n).filter(ok)

    return verify


def agreement(x: list[Column], y: list[Column]) -> Column:
    """Of two packed signatures, given by their words, how many fields agree."""
    per = 64 // BITS
    low = sum(1 << (BITS * i) for i in range(per))
    low = low - (1 << 64) if low >= 1 << 63 else low
    wrong = None
    for a, b in zip(x, y, strict=True):
        diff = a.bitwiseXOR(b)
        any_bit = diff
        for i in range(1, BITS):
            any_bit = any_bit.bitwiseOR(F.shiftrightunsigned(diff, i))
        n = F.bit_count(any_bit.bitwiseAND(F.lit(low)))
        wrong = n if wrong is None else wrong + n
    return F.lit(len(x) * per) - wrong


def words_of_signature(column: str, hashes: int = HASHES) -> list[Column]:
    return [F.col(column)[k] for k in range(hashes * BITS // 64)]


def similarity(x: list[Column], y: list[Column]) -> Column:
    """Estimated Jaccard similarity: the share of agreeing fields, less what agrees by chance."""
    chance = 1 / 2**BITS
    return (agreement(x, y) / F.lit(len(x) * 64.0 / BITS) - chance) / (1 - chance)


def margin(hashes: int, at: float) -> float:
    """Five standard errors of the estimate at a true similarity ``at``."""
    chance = 1 / 2**BITS
    p = at * (1 - chance) + chance
    return 5 * (p * (1 - p) / hashes) ** 0.5 / (1 - chance)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", num: int = 85, den: int = 100
) -> DataFrame:
    """One row per document, ``(doc_id, n_shingles, component_id, kept)``: documents are linked where
    ``den * |A & B| >= num * |A | B|`` over their shingle sets; the component is the smallest id that links reach."""
    floor = num / den - margin(HASHES, num / den)
    fine_floor = num / den - margin(FINE, num / den)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    kind = "doc_id long, n_shingles long, s1 long, s2 long, bands array<bigint>, sig array<bigint>"
    signed = written(d.mapInArrow(_signed, kind), "signatures")
    named = signed.where("n_shingles > 0 and doc_id is not null")
    classes = written(
        named.groupBy("s1", "s2", "n_shingles")
        .agg(F.min(F.struct("doc_id", "bands", "sig")).alias("x"))
        .select("s1", "s2", "n_shingles", F.col("x.doc_id").alias("rep"), "x.bands", "x.sig"),
        "classes",
    )
    # buckets are rows of two numbers; signatures and texts are fetched for the pairs that need them
    member = classes.select("rep", F.explode("bands").alias("band"))
    first = member.groupBy("band").agg(F.min("rep").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    buckets = written(member.join(written(first, "stars"), "band"), "buckets")

    def likely(pairs: DataFrame, name: str) -> DataFrame:
        """Of distinct pairs, those whose packed signatures may meet the threshold."""
        sides = [classes.select(F.col("rep").alias(x), F.col("sig").alias(f"sig_{x}")) for x in "ab"]
        both = pairs.join(sides[0], "a").join(sides[1], "b")
        close = similarity(words_of_signature("sig_a"), words_of_signature("sig_b")) >= floor
        return written(both.where(close).select("a", "b"), f"{name}-likely")

    def confirmed(members: DataFrame, centres: DataFrame, name: str) -> DataFrame:
        """Links among ``(a, b, text_b)``, checked against the texts of the centres ``a``: the text of a centre is
        sent once, and a hot centre's members are split over tasks."""
        both = members.join(centres.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")).hint("merge"), "a")
        links = both.select("a", "b", "text_a", "text_b").mapInArrow(_verifier(num, den), "a long, b long")
        return written(links.distinct(), f"{name}-links")

    def by_member(pairs: DataFrame, texts: DataFrame) -> DataFrame:
        return pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")

    pairs = written(buckets.where("rep <> first").select(F.col("first").alias("a"), F.col("rep").alias("b")).distinct(), "pairs")
    good = likely(pairs, "star-0")
    # the one shuffle of texts, by the same plan at every size: each bucket member's text, with its centres
    roles = good.select(F.col("b").alias("rep"), F.col("a").alias("centre"), F.lit(False).alias("is_centre"))
    roles = roles.union(good.select("a", F.lit(None).cast("long"), F.lit(True)))
    roles = roles.union(buckets.select("rep", F.lit(None).cast("long"), F.lit(False)))
    roles = roles.groupBy("rep").agg(F.collect_set("centre").alias("centres"), F.max("is_centre").alias("is_centre"))
    texts = d.join(written(roles, "roles").hint("merge"), d["doc_id"] == F.col("rep"))
    texts = written(texts.select("doc_id", "text", "centres", "is_centre"), "member-texts")
    members = texts.select(F.explode("centres").alias("a"), F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    links = confirmed(members, texts.where("is_centre"), "star-0")
    discard(good)
    texts = texts.select("doc_id", "text")
    left, tried, open_rows = None, pairs, None
    for k in range(1, 13):
        comp = written(components(links, f"star-{k}-comp"), f"star-{k}-labels")
        labelled = buckets.join(comp, buckets["rep"] == comp["node"], "left").select(
            "band", "rep", F.coalesce("component", "rep").alias("comp")
        )
        # buckets that still hold several components, and in them the members outside the first one's
        mixed = labelled.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
        discard(open_rows)
        open_rows = written(labelled.join(written(mixed, f"star-{k}-mixed"), "band"), f"star-{k}-open")
        rest = open_rows.where("comp <> lo")
        n = rest.count()
        if n == 0:
            return _result(signed, classes, comp)
        if left is None:  # from here on only texts of members of mixed buckets are needed
            wanted = written(open_rows.select("rep").distinct(), "open-members")
            texts = written(texts.join(wanted, texts["doc_id"] == wanted["rep"], "left_semi"), "open-texts")
        elif n > 0.7 * left:
            break
        left = n
        star = rest.join(rest.groupBy("band").agg(F.min(F.struct("comp", "rep")).alias("f")), "band")
        pairs = star.where("comp <> f.comp").select(F.col("f.rep").alias("a"), F.col("rep").alias("b")).distinct()
        pairs = written(pairs.join(tried, ["a", "b"], "left_anti"), f"star-{k}-pairs")
        if pairs.isEmpty():
            break
        good = likely(pairs, f"star-{k}")
        new = confirmed(by_member(good, texts), texts.join(good, texts["doc_id"] == good["a"], "left_semi"), f"star-{k}")
        tried, old = tried.union(pairs), links
        links = written(links.union(new), f"links-{k}")
        discard(good, new, old, comp)
    open_reps = written(open_rows.select("rep").distinct(), "open-reps")
    fine = texts.join(open_reps, texts["doc_id"] == open_reps["rep"], "left_semi").select("doc_id", "text")
    keys = classes.select("rep", "bands", "sig").join(fine.mapInArrow(_fine, "rep long, fine array<bigint>"), "rep")
    # the short signature's words as columns: most pairs are told apart by them alone
    q = [f"q{k}" for k in range(HASHES * BITS // 64)]
    keys = written(keys.withColumns(dict(zip(q, words_of_signature("sig"), strict=True))).drop("sig"), "fine")
    x = written(rest.select("band", "rep", "comp").join(keys, "rep"), "rest-left").alias("x")
    y = written(open_rows.select("band", "rep", "comp").join(keys, "rep"), "rest-right").alias("y")
    short_x, short_y = ([F.col(f"{side}.{c}") for c in q] for side in "xy")
    shared = F.filter(F.col("x.bands"), lambda k: F.array_contains(F.col("y.bands"), k))
    pairs = x.join(y, F.col("x.band") == F.col("y.band")).where(
        (F.col("x.comp") != F.col("y.comp"))
        & (similarity(short_x, short_y) >= floor)
        & (similarity(words_of_signature("x.fine", FINE), words_of_signature("y.fine", FINE)) >= fine_floor)
        & (shared[0] == F.col("x.band"))  # a pair counts in the first bucket it shares
    )
    pairs = pairs.select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")).distinct()
    good = written(pairs.join(tried, ["a", "b"], "left_anti"), "rest-pairs")
    new = confirmed(by_member(good, texts), texts.join(good, texts["doc_id"] == good["a"], "left_semi"), "rest")
    links = written(links.union(new), "links")
    return _result(signed, classes, components(links, "final"))


def _result(signed: DataFrame, classes: DataFrame, comp: DataFrame) -> DataFrame:
    by_class = classes.join(comp, classes["rep"] == comp["node"], "left").select(
        "s1", "s2", "n_shingles", F.coalesce("component", "rep").alias("component_id")
    )
    linked = signed.join(by_class, ["s1", "s2", "n_shingles"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce(component, F.col("doc_id")))
    return linked.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )
