"""WARC archives: one gzip member per record, written by Spark tasks and read back sequentially.

Writer: pages with equal payloads of at least ``least`` bytes share one ``response`` record, that of the largest
id; the others become ``revisit`` records that refer to it. The group is found by digest with a map-side
aggregation. Each task writes its pages, in id order, into archives of bounded size in a folder all executors share;
an archive appears under its final name only when it is whole, so a repeated task replaces it by the same bytes.

Reader: takes an archive as a stream of bytes, inflates one gzip member at a time in small steps, frames the block
by its Content-Length and checks the block and payload digests.

Defined cases: a null payload is empty; a null id is lowest and is written as an empty header; rows that share the
largest id of a group are all responses; payloads of any length are streamed; repeated rows are records each; extra
columns are not read; an empty table gives no archives and no records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import sys
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from io import BytesIO

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import shared_path, text_or_empty, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CRLF = b"\r\n"
_DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1_32(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, url: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}|{url}')}>"


def header_text(value: object) -> str:
    """A header value on one line, percent-encoding what would end it."""
    return "" if value is None else re.sub(r"[\r\n%]", lambda m: f"%{ord(m.group()):02X}", str(value))


def header_value(value: str) -> str:
    return re.sub(r"%(0D|0A|25)", lambda m: chr(int(m.group(1), 16)), value)


def record(page_id, url, payload: bytes, refers_to=None) -> bytes:
    """One record: WARC headers, an HTTP header, and the payload unless it is a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, url)),
        ("WARC-Date", _DATE),
        ("WARC-Target-URI", header_text(url)),
        ("X-Page-Id", header_text(page_id)),
        ("WARC-Payload-Digest", sha1_32(payload)),
        ("WARC-Block-Digest", sha1_32(block)),
    ]
    if revisit:
        head += [("WARC-Profile", PROFILE), ("X-Refers-To-Page-Id", header_text(refers_to))]
    head += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return lines.encode() + block + CRLF + CRLF


def gzip_member(data: bytes, level: int = 6) -> bytes:
    """Deterministic: no time and no name in the header."""
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes

    def payload(self) -> bytes:
        return self.block.partition(CRLF + CRLF)[2]

    def http_length(self) -> int:
        return int(re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", self.block.partition(CRLF + CRLF)[0]).group(1))


class WarcError(ValueError):
    """An archive that is cut short, wrongly framed or whose digests do not match."""


def members(stream, step: int = 1 << 16) -> Iterator[bytes]:
    """Each gzip member of ``stream``, inflated step by step."""
    rest = b""
    while True:
        rest = rest or stream.read(step)
        if not rest:
            return
        z, out = zlib.decompressobj(31), []
        while not z.eof:
            rest = rest or stream.read(step)
            if not rest:
                raise WarcError("the archive ends within a record")
            try:
                out.append(z.decompress(rest))
            except zlib.error as e:
                raise WarcError(str(e)) from e
            rest = z.unused_data
        yield b"".join(out)


def parse(member: bytes) -> Record:
    head, sep, body = member.partition(CRLF + CRLF)
    lines = head.decode("utf-8").split("\r\n")
    if not sep or not lines[0].startswith("WARC/"):
        raise WarcError("no WARC header")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    n = int(headers["Content-Length"])
    if body[n:] != CRLF + CRLF:
        raise WarcError("the block is not as long as its header says")
    return Record(headers, body[:n])


def verify(r: Record) -> None:
    if sha1_32(r.block) != r.headers["WARC-Block-Digest"]:
        raise WarcError(f"block digest of {r.headers['WARC-Record-ID']}")
    if r.headers["WARC-Type"] == "response":
        if sha1_32(r.payload()) != r.headers["WARC-Payload-Digest"] or len(r.payload()) != r.http_length():
            raise WarcError(f"payload digest of {r.headers['WARC-Record-ID']}")


def read_archive(stream) -> Iterator[Record]:
    """The records of one archive, verified, in order."""
    for member in members(stream):
        r = parse(member)
        verify(r)
        yield r


def _store(uri: str):
    """File system and path for a URI, on whatever store the executors share."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def _writer(folder: str, max_bytes: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        done: list[tuple[str, int]] = []
        out, size, count, temp = None, 0, 0, ""

        def close():
            nonlocal out
            out.close()
            final = f"{root}/part-{part:06d}-{len(done):05d}.warc.gz"
            store.move(temp, final)
            done.append((final.rpartition("/")[2], count))
            out = None

        for batch in batches:
            for page_id, url, html, refers in zip(*batch.columns, strict=True):
                if out is None:
                    size, count, temp = 0, 0, f"{root}/_{part:06d}-{len(done):05d}-{attempt}.tmp"
                    out = store.open_output_stream(temp, compression=None)
                payload = (html.as_py() or "").encode("utf-8")
                member = gzip_member(record(page_id.as_py(), url.as_py(), payload, refers.as_py()))
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= max_bytes:
                    close()
        if out is not None:
            close()
        names, counts = [a for a, _ in done], [n for _, n in done]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())], ["archive", "records"])

    return run


def write_warc(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    least: int = 1000, max_bytes: int = 64 << 20,
) -> int:
    """Write the archives below ``folder`` (on a store the executors share); returns the number of records."""
    html = text_or_empty(html_col)
    p = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), html.alias("html"),
        F.sha2(html, 256).alias("digest"),
    )
    groups = (
        p.where(F.octet_length("html") >= least)
        .groupBy("digest")
        .agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "first")
    )
    # the pages are shuffled once, by digest; the groups are a table, so that a hot digest's pages can be split
    placed = p.join(written(groups, "warc-groups").hint("merge"), "digest", "left").select(
        "page_id", "url", "html",
        F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"),
    )
    dealt = placed.sortWithinPartitions("page_id", "url", "html")
    done = dealt.mapInArrow(_writer(folder, max_bytes), "archive string, records long")
    return done.agg(F.sum("records")).first()[0] or 0


_READ = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


def _reader(with_payload: bool):
    def number(value: str) -> int | None:
        return int(value) if value else None

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for content in pdf["content"]:
                rows = []
                for r in read_archive(BytesIO(content)):
                    h = r.headers
                    digest = base64.b32decode(h["WARC-Payload-Digest"].partition(":")[2]).hex()
                    rows.append(
                        (
                            number(h["X-Page-Id"]), header_value(h["WARC-Target-URI"]), r.http_length(), digest,
                            h["WARC-Type"], number(h.get("X-Refers-To-Page-Id", "")),
                            r.payload() if with_payload and h["WARC-Type"] == "response" else None,
                        )
                    )
                    if len(rows) >= 256:
                        yield _frame(rows)
                        rows = []
                if rows:
                    yield _frame(rows)

    return run


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[f.name for f in _READ.fields], dtype=object)
    for name in ("page_id", "payload_bytes", "refers_to"):
        out[name] = out[name].astype("Int64")
    return out


def read_warc(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives below ``folder``; a revisit has no payload of its own."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    return files.select("content").mapInPandas(_reader(with_payload), _READ)


def round_trip(pages: DataFrame, with_payload: bool = False, **how) -> DataFrame:
    """Write ``pages`` as archives in the session's shared folder and read them back."""
    spark = pages.sparkSession
    folder = shared_path(spark, "warc")
    if write_warc(pages, folder, **how) == 0:
        return spark.createDataFrame([], _READ)
    return read_warc(spark, folder, with_payload)
