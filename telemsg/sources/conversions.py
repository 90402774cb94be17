"""Readers for message layouts and conversion tables.

Files are laid out as ``{root}/{family}/{year}/...``:

* ``DDT_{ecu}_{msg}_{family}_{year}.json``  message layout
* ``conv_L_{ecu}_{family}_{year}.csv``       linear conversions
* ``conv_T_{ecu}_{family}_{year}.csv``       table conversions

All files of one kind are read by a single Spark reader with an explicit schema;
(family, year, ...) come from the file path, and a file whose folder does not
match its name (e.g. ``2026/..._2025.json``) is not picked up, exactly as a
lookup by constructed file name would miss it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

LAYOUT_ENTRY = T.StructType(
    [
        T.StructField("byte", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("default_value", T.StringType()),
    ]
)
LAYOUT_FILE = T.StructType(
    [T.StructField("name", T.StringType()), T.StructField("entries", T.ArrayType(LAYOUT_ENTRY))]
)

# Linear CSV header (fixed by the file format); read as text, typed in the codec.
LINEAR_COLUMNS = [
    "ID", "Description", "Size", "Factor (m)", "Offset (b)", "Type", "Decimal Places", "Units",
    "Scaled Min", "Scaled Max", "Raw Min", "Raw Max", "Encoding Name",
]
TABLE_COLUMNS = ["ID", "Min", "Encoding Name"]

LAYOUT_CSV_COLUMNS = ["ByteBit", "ByteBit_Description", "Size", "Type", "Name", "ID"]

# Texts a pandas CSV reader turns into missing values (fixed values: pandas'
# default ``na_values``); the conversion rules treat them as absent.
NA_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

LAYOUT_PATH_RE = r".*/([^/]+)/([^/]+)/DDT_([^_/]+)_([^/]+)_([^_/]+)_([^_/]+)\.json$"
CONV_PATH_RE = r".*/([^/]+)/([^/]+)/conv_%s_([^_/]+)_([^_/]+)_([^_/]+)\.csv$"


def _string_schema(cols) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in cols])


def na_to_null(c) -> F.Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isin(NA_TEXTS), F.lit(None).cast("string")).otherwise(c)


def _read_or_empty(reader, path: str, schema: T.StructType, spark: SparkSession) -> DataFrame:
    try:
        return reader(path).withColumn("_path", F.col("_metadata.file_path"))
    except AnalysisException as e:  # no file matches the glob
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            empty = spark.createDataFrame([], schema)
            return empty.withColumn("_path", F.lit(None).cast("string"))
        raise


def _file_order(df: DataFrame) -> DataFrame:
    """``ord``: increases with the row position inside each file. A conversion
    file is far below one split, so it is read by one task in file order, and
    ``ord`` is only ever compared between rows of the same file."""
    return df.withColumn("ord", F.monotonically_increasing_id())


def read_layouts(spark: SparkSession, root: str) -> DataFrame:
    """One row per layout entry:
    (family, year, ecu, msg, layout_name, ord, byte, description, size, type, name, id, default_value)."""
    df = _read_or_empty(
        lambda p: spark.read.schema(LAYOUT_FILE).option("multiLine", True).json(p),
        f"{root.rstrip('/')}/*/*/DDT_*.json",
        LAYOUT_FILE,
        spark,
    )
    parts = [F.regexp_extract("_path", LAYOUT_PATH_RE, i) for i in range(1, 7)]
    df = (
        df.select(
            parts[0].alias("family"),
            parts[1].alias("_dir_year"),
            parts[2].alias("ecu"),
            parts[3].alias("msg"),
            parts[4].alias("_file_family"),
            parts[5].alias("_file_year"),
            F.col("name").alias("layout_name"),
            F.posexplode_outer("entries").alias("ord", "e"),
        )
        .filter(
            (F.col("family") == F.col("_file_family"))
            & (F.col("_dir_year") == F.col("_file_year"))
            & F.col("_dir_year").rlike(r"^\d+$")
        )
        .filter(F.col("e").isNotNull())
    )
    return df.select(
        "family",
        F.col("_dir_year").cast("int").alias("year"),
        "ecu",
        "msg",
        "layout_name",
        "ord",
        *[F.col(f"e.{f.name}").alias(f.name) for f in LAYOUT_ENTRY.fields],
    )


def read_linear(spark: SparkSession, root: str) -> DataFrame:
    """Linear conversion rows: (family, year, ecu, ord, <LINEAR_COLUMNS as text>)."""
    return _read_conv(spark, root, "L", LINEAR_COLUMNS)


def read_table(spark: SparkSession, root: str) -> DataFrame:
    """Table conversion rows: (family, year, ecu, ord, ID, Min, Encoding Name as text)."""
    return _read_conv(spark, root, "T", TABLE_COLUMNS)


def _read_by_header(spark: SparkSession, glob: str, required: list[str], optional: list[str] = ()) -> DataFrame:
    """Rows of all CSV files of a glob: (_path, ord, <columns by header name, as text>). Every file is read by its own
    header, so files may differ in width and order; a file without a required column ends the job with its name. A
    row's cells beyond its header are dropped, missing ones are null; blank lines are skipped; a line is a row."""
    schema = _string_schema(["value"])
    lines = _read_or_empty(lambda p: spark.read.schema(schema).text(p), glob, schema, spark)
    lines = _file_order(lines.where(F.trim("value") != ""))
    # commas outside double quotes; a quoted cell loses its quotes, doubled ones inside become one
    cells = F.split(F.regexp_replace("value", "^\ufeff|\r$", ""), r',(?=(?:[^"]*"[^"]*")*[^"]*$)', -1)
    cells = F.transform(
        cells,
        lambda c: F.when(
            c.rlike(r'^\s*".*"\s*$'), F.replace(F.regexp_replace(c, r'^\s*"|"\s*$', ""), F.lit('""'), F.lit('"'))
        ).otherwise(c),
    )
    lines = lines.select("_path", "ord", cells.alias("cells"))
    header = Window.partitionBy("_path").orderBy("ord").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = lines.withColumn("header", F.first("cells").over(header)).withColumn(
        "nth", F.row_number().over(Window.partitionBy("_path").orderBy("ord"))
    )

    def cell(name: str, must: bool):
        at = F.array_position("header", name)
        found = F.when(at > 0, F.get("cells", (at - 1).cast("int")))
        if must:
            missing = F.concat(F.lit(f"no column {name!r} in the header of "), "_path")
            found = F.when(at > 0, F.get("cells", (at - 1).cast("int"))).otherwise(F.raise_error(missing).cast("string"))
        return found.alias(name)

    return rows.where("nth > 1").select(
        "_path", "ord", *[cell(c, True) for c in required], *[cell(c, False) for c in optional]
    )


def _read_conv(spark: SparkSession, root: str, kind: str, cols) -> DataFrame:
    df = _read_by_header(spark, f"{root.rstrip('/')}/*/*/conv_{kind}_*.csv", cols)
    rx = CONV_PATH_RE % kind
    df = df.select(
        F.regexp_extract("_path", rx, 1).alias("family"),
        F.regexp_extract("_path", rx, 2).alias("_dir_year"),
        F.regexp_extract("_path", rx, 3).alias("ecu"),
        F.regexp_extract("_path", rx, 4).alias("_file_family"),
        F.regexp_extract("_path", rx, 5).alias("_file_year"),
        "ord",
        *cols,
    ).filter(
        (F.col("family") == F.col("_file_family"))
        & (F.col("_dir_year") == F.col("_file_year"))
        & F.col("_dir_year").rlike(r"^\d+$")
    )
    return df.select("family", F.col("_dir_year").cast("int").alias("year"), "ecu", "ord", *cols)


def read_layout_csv(spark: SparkSession, path: str) -> DataFrame:
    """Layout in CSV form (``ByteBit,ByteBit_Description,Size,Type,Name,ID`` and perhaps ``Default_Value``, by header
    name) -> one row per file: (file, name, entries) in the JSON layout shape (S8). ``default_value`` is set only
    where the ``Default_Value`` cell is not blank; a header without one of the six columns is refused."""
    df = _read_by_header(spark, path, LAYOUT_CSV_COLUMNS, ["Default_Value"])
    entry = F.struct(
        F.col("ByteBit").alias("byte"),
        F.col("ByteBit_Description").alias("description"),
        F.col("Size").alias("size"),
        F.col("Type").alias("type"),
        F.col("Name").alias("name"),
        F.col("ID").alias("id"),
        F.when(F.trim("Default_Value") != "", F.col("Default_Value")).alias("default_value"),
    )
    return df.groupBy("_path").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct(F.col("ord"), entry.alias("e")))), lambda x: x["e"]
        ).alias("entries")
    ).select(
        F.col("_path").alias("file"),
        F.regexp_extract("_path", r"([^/]+)$", 1).alias("name"),
        "entries",
    )


def write_layout_json(layouts: DataFrame, out_dir: str) -> None:
    """Write layouts from ``read_layout_csv`` as JSON, one file each, under the name and folder by which
    ``read_layouts`` finds them: ``{family}/{year}/DDT_{ecu}_{msg}_{family}_{year}.json``. ``out_dir`` is a store the
    executors share; a repeated task writes the same file again."""
    name = F.regexp_replace("name", r"\.csv$", "")
    rows = layouts.select(
        F.concat(F.regexp_extract(name, r"_([^_]+)_[^_]+$", 1), F.lit("/"), F.regexp_extract(name, r"_([^_]+)$", 1),
                 F.lit("/"), name, F.lit(".json")).alias("file"),
        F.to_json(F.struct("name", "entries")).alias("json"),
    )

    def store(rows) -> None:
        from pyarrow import fs

        target, root = fs.FileSystem.from_uri(out_dir) if "://" in out_dir else (fs.LocalFileSystem(), out_dir)
        for r in rows:
            target.create_dir(f"{root}/{r['file'].rpartition('/')[0]}", recursive=True)
            with target.open_output_stream(f"{root}/{r['file']}") as f:
                f.write(r["json"].encode("utf-8"))

    rows.foreachPartition(store)
