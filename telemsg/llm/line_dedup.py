"""Line de-duplication over a whole corpus.

Line hashes (128 bits) are range-partitioned together with their document and position and sorted inside each
partition, so one hot line is spread over many partitions; a window streams over the sorted rows and marks the
first occurrence of a line in each document. Partial sums of those marks give, per line, its number of documents.
What comes back is one compressed bitmap per document - 64 lines a word, words whose lines all stay are left out -
and the text itself is shuffled once, when the bitmaps are applied.

Defined cases: a null text is an empty text (one empty line); an empty key (blank line) is never a duplicate; the
document is the pair (id, text), so exact repeats of a row count once and null ids are ordinary ids; extra columns
of any name pass through ``apply_bitmaps`` unless they are the reserved ``__ld_*``; an empty table gives no bitmaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WS_CHARS, lines_of, lower_ascii, text_or_empty, written


def line_key(line: Column) -> Column:
    """What makes two lines equal: white space stripped at both ends, A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(WS_CHARS)))


def _text_id(text: Column) -> Column:
    return F.xxhash64(text_or_empty(text))


def line_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per line with a key: ``(h1, h2, d, t, pos)``, range-partitioned by hash and document, sorted."""
    rows = docs.select(
        F.col(id_col).alias("d"),
        _text_id(F.col(text_col)).alias("t"),
        F.posexplode(lines_of(text_or_empty(text_col))).alias("pos", "line"),
    ).select("d", "t", "pos", line_key(F.col("line")).alias("key"))
    hashed = rows.where(F.col("key") != "").select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"), "d", "t", "pos"
    )
    return hashed.repartitionByRange("h1", "h2", "d", "t").sortWithinPartitions("h1", "h2", "d", "t", "pos")


def keep_bitmaps(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, keep_first: bool = False
) -> DataFrame:
    """Documents that lose lines: ``(d, t, keep, n_dropped)``.

    A line whose key is in at least ``min_docs`` documents is dropped everywhere, or with ``keep_first`` everywhere
    but at its first occurrence by (document, position). ``keep`` maps word number to a 64-bit mask of the lines
    that stay (line ``i`` is bit ``i % 64`` of word ``i / 64``); absent words keep all their lines.
    """
    w = Window.partitionBy("h1", "h2", "d", "t").orderBy("pos")
    rows = written(line_rows(docs, id_col, text_col).withColumn("nth", F.row_number().over(w)), "line-hashes")
    per_line = rows.groupBy("h1", "h2").agg(
        F.sum(F.when(F.col("nth") == 1, 1).otherwise(0)).alias("n_docs"),
        *([F.min(F.struct("d", "t", "pos")).alias("origin")] if keep_first else []),
    )
    # written first, so that the join below is a plain one and a hot line's rows can be split
    often = written(per_line.where(F.col("n_docs") >= min_docs), "frequent-lines")
    hit = rows.join(often, ["h1", "h2"])
    if keep_first:
        hit = hit.where(~F.struct("d", "t", "pos").eqNullSafe(F.col("origin")))
    bits = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("pos").bitwiseAND(F.lit(63))))
    words = hit.groupBy("d", "t", F.shiftright("pos", 6).alias("w")).agg(bits.alias("bits"))
    return words.groupBy("d", "t").agg(
        F.map_from_entries(F.collect_list(F.struct("w", F.bitwise_not("bits").alias("mask")))).alias("keep"),
        F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"),
    )


def apply_bitmaps(
    docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with the text reduced to its kept lines joined by ``\\n``, plus ``__ld_lines`` (lines before) and
    ``__ld_dropped`` (lines lost). Texts that lose nothing are left as they are (null becomes empty)."""
    b = bitmaps.select(
        F.col("d").alias("__ld_d"), F.col("t").alias("__ld_t2"),
        F.col("keep").alias("__ld_keep"), F.col("n_dropped").alias("__ld_n"),
    )
    left = docs.withColumn("__ld_t", _text_id(F.col(text_col)))
    j = left.join(b, left[id_col].eqNullSafe(b["__ld_d"]) & (left["__ld_t"] == b["__ld_t2"]), "left")
    text, keep = text_or_empty(text_col), F.col("__ld_keep")

    def stays(_: Column, i: Column) -> Column:
        mask = F.coalesce(keep[F.shiftright(i, 6)], F.lit(-1).cast("long"))
        return F.call_function("shiftright", mask, i.bitwiseAND(F.lit(63))).bitwiseAND(F.lit(1).cast("long")) == 1

    kept = F.array_join(F.filter(lines_of(text), stays), "\n")
    out = j.withColumns(
        {
            "__ld_lines": F.size(lines_of(text)).cast("long"),
            "__ld_dropped": F.coalesce(F.col("__ld_n"), F.lit(0).cast("long")),
            text_col: F.when(keep.isNull(), text).otherwise(kept),
        }
    )
    return out.drop("__ld_t", "__ld_d", "__ld_t2", "__ld_keep", "__ld_n")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **rules) -> DataFrame:
    """``docs`` without duplicate lines; see :func:`keep_bitmaps` for the rules."""
    return apply_bitmaps(docs, keep_bitmaps(docs, id_col, text_col, **rules), id_col, text_col)
