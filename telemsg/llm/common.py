"""Helpers shared by the corpus operators: tables, shared folders, small native expressions."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of every contract here, as a Java character class and as a plain set of characters.
WS_CLASS = r"[\x20\x09-\x0D]"
WS_CHARS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Where a local session names none (tests), a temporary
    folder is set for it and removed at exit."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="telemsg-shared-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        root = f"file://{root}"
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_root(spark)}/telemsg-{uuid.uuid4().hex}/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as a table in the shared folder and read it again. A lost executor costs only
    a re-read, and several uses of the result share one computation."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Delete tables made by ``written`` that no later plan reads."""
    for t in tables:
        if t is not None:
            jvm = t.sparkSession._jvm
            path = jvm.org.apache.hadoop.fs.Path(t.written_to)
            path.getFileSystem(t.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path.getParent(), True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row (a lambda variable), however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def lower_ascii(s: Column) -> Column:
    """A-Z lower-cased, nothing else. Pure ASCII strings take the cheap path."""
    return F.when(F.octet_length(s) == F.char_length(s), F.lower(s)).otherwise(
        F.translate(s, UPPER, UPPER.lower())
    )


def words_of(text: Column) -> Column:
    """Array of the maximal runs of non-white-space characters."""
    return F.array_remove(F.split(text, WS_CLASS + "+"), "")


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def shuffle_width(spark: SparkSession) -> int:
    """Number of shuffle partitions the session asks for: it follows the input on a tuned cluster."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
