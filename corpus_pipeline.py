"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, mixing - in this order.

Each stage takes all its predecessor kept, written as Parquet and read again; all but the last return the columns
of ``documents``. A null text counts as empty, repeated rows and null ids as rows like any other, an empty table
passes through empty, and extra columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemsg.llm.common import table, written
from telemsg.llm.decontaminate import leaks, without_leaks
from telemsg.llm.line_dedup import line_dedup
from telemsg.llm.minhash_dedup import near_duplicates
from telemsg.llm.mixing import mix
from telemsg.llm.quality_rules import kept_rows


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return kept_rows(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that are in ten documents or more; ``n_chars``, where there is one, follows the text."""
    out = line_dedup(docs).drop("__ld_lines", "__ld_dropped")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates (similarity 0.8 on five-word shingles): that with the smallest id, by
    hashes of the text and of the whole row among equal ids. Rows are told apart by a number each, written with them, so
    ids may be shared; a row without an id stays only where no row of its group has one. Rows without words stay."""
    key = F.struct(F.xxhash64("text").alias("text"), F.xxhash64(*docs.columns).alias("all"))
    numbered = docs.withColumns({"__nd_row": F.monotonically_increasing_id(), "__nd_text": key})
    rows = written(numbered, "numbered")
    found = written(near_duplicates(rows, "__nd_row", num=80).withColumnRenamed("doc_id", "row"), "components")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__nd_text", "row")
    named = found.join(rows.select(F.col("__nd_row").alias("row"), "doc_id", "__nd_text"), "row")
    first = named.groupBy("component_id").agg(F.min(order).alias("x")).select("x.row")
    # rows beside a list that grows with them: one plan at every size, and none of it is broadcast
    gone = found.join(first, "row", "left_anti").select("row").hint("merge")
    return rows.join(gone, rows["__nd_row"] == gone["row"], "left_anti").select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage. A row is known by its id, null or not, and its text."""
    found = leaks(docs, table(spark, sf_dir, "benchmark"), keyed=True).select("doc_id", "text_key").distinct()
    return without_leaks(docs, written(found, "leaky-rows")).select(docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: one row per document with the words it gives."""
    return mix(docs).select("doc_id", "size", "source", "source_size", "target", "taken")


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("minhash_near_dedup", near),
    ("benchmark_decontamination", decontaminate),
    ("mix_sources", mixing),
]

#: The seeded choice of blocks has no SQL form; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
