"""Message catalogue: which message columns exist, their expected lengths per
(family, model year), and the typed output columns declared for each message.

The catalogue is configuration (a few kB of JSON), so it is parsed on the driver
once; everything derived from it that meets data becomes a small DataFrame.
"""

from __future__ import annotations

import json
import warnings
from dataclasses import dataclass, field
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Declared output type names -> Spark types (fixed by the catalogue format).
TYPE_NAMES = {
    "string": T.StringType(),
    "str": T.StringType(),
    "int": T.IntegerType(),
    "integer": T.IntegerType(),
    "float": T.DoubleType(),
    "double": T.DoubleType(),
    "bool": T.BooleanType(),
    "boolean": T.BooleanType(),
}


def local_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Configuration rows as a local relation: it goes by Arrow, so the planner knows its size (a list of tuples
    would become an RDD of unknown size, which is never broadcast)."""
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}
    names = [x.split() for x in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return spark.createDataFrame(pa.table({n: pa.array(c, kinds[k]) for (n, k), c in zip(names, columns, strict=True)}))


@dataclass(frozen=True)
class OutputColumn:
    description: str  # field description in the layout
    type_name: str  # declared type, a key of TYPE_NAMES
    clean_name: str  # output column is f"{msg}_{clean_name}"

    @property
    def spark_type(self) -> T.DataType:
        return TYPE_NAMES[self.type_name]


@dataclass(frozen=True)
class MessageSpec:
    msg: str  # message code, e.g. "A001"
    column_name: str  # telemetry column holding the hex text
    ecu: str
    columns: tuple[OutputColumn, ...]
    lengths: tuple[tuple[str, int, int], ...]  # (family, year, expected length)


@dataclass
class Catalogue:
    messages: tuple[MessageSpec, ...]
    telemetry_path: str | None = None
    telemetry_columns: tuple[str, ...] = ()
    ffill_columns: tuple[str, ...] = ()
    vehicle_path: str | None = None
    conversions_path: str | None = None
    duplicate_keys: list[str] = field(default_factory=list)

    @property
    def message_codes(self) -> list[str]:
        return [m.msg for m in self.messages]

    def message(self, msg: str) -> MessageSpec:
        for m in self.messages:
            if m.msg == msg:
                return m
        raise KeyError(msg)

    def family_years(self) -> list[tuple[str, int]]:
        """Union of (family, year) over all messages, in first-seen order."""
        seen: dict[tuple[str, int], None] = {}
        for m in self.messages:
            for fam, year, _ in m.lengths:
                seen.setdefault((fam, year), None)
        return list(seen)

    def lengths_df(self, spark: SparkSession) -> DataFrame:
        """(family, year, msg, length): one row per configured version."""
        rows = [(fam, year, m.msg, n) for m in self.messages for fam, year, n in m.lengths]
        schema = "family string, year int, msg string, length int"
        return local_rows(spark, rows, schema)

    def output_columns_df(self, spark: SparkSession) -> DataFrame:
        """(msg, idx, description, type_name, column): the declared output columns."""
        rows = [
            (m.msg, i, c.description, c.type_name, f"{m.msg}_{c.clean_name}")
            for m in self.messages
            for i, c in enumerate(m.columns)
        ]
        schema = "msg string, idx int, description string, type_name string, column string"
        return local_rows(spark, rows, schema)


def _pairs_hook(dups: list[str]):
    def hook(pairs):
        out: dict = {}
        for k, v in pairs:
            if k in out:
                dups.append(k)
            out[k] = v  # the last definition wins, as in any JSON reader
        return out

    return hook


def parse_catalogue(text: str, stream_key: str = "telemetry") -> Catalogue:
    """``stream_key`` names the telemetry stream's entry under ``input_data``."""
    dups: list[str] = []
    cfg = json.loads(text, object_pairs_hook=_pairs_hook(dups))
    if dups:
        warnings.warn(f"catalogue repeats keys {sorted(set(dups))}; the last definition wins")
    messages = []
    for msg, spec in cfg.get("diagnostic_messages", {}).items():
        cols = tuple(
            OutputColumn(desc, c.get("type", "string"), c.get("clean_name", desc))
            for desc, c in spec.get("columns", {}).items()
        )
        for c in cols:
            if c.type_name not in TYPE_NAMES:
                raise ValueError(f"unknown output type {c.type_name!r} for {msg}/{c.description}")
        lengths = tuple(
            (fam, int(year), int(v["length"]))
            for fam, years in spec.get("versions", {}).items()
            for year, v in years.items()
        )
        messages.append(
            MessageSpec(msg, spec["column_name"], spec.get("ecu", "BCM"), cols, lengths)
        )
    inp = cfg.get("input_data", {})
    stream = inp.get(stream_key, {})
    return Catalogue(
        messages=tuple(messages),
        telemetry_path=stream.get("path"),
        telemetry_columns=tuple(stream.get("cols_to_load", ())),
        ffill_columns=tuple(stream.get("cols_to_ffill", ())),
        vehicle_path=inp.get("vehicle_data"),
        conversions_path=cfg.get("paths", {}).get("conversions"),
        duplicate_keys=dups,
    )


def load_catalogue(path: str | Path, stream_key: str = "telemetry") -> Catalogue:
    """Read a catalogue JSON file; a relative conversions path is resolved
    against the catalogue's folder."""
    path = Path(path)
    cat = parse_catalogue(path.read_text(), stream_key)
    if cat.conversions_path and not cat.conversions_path.startswith(("/", "file:", "s3", "hdfs", "abfs", "gs:", "dbfs:")):
        cat.conversions_path = str((path.parent / cat.conversions_path).resolve())
    return cat
