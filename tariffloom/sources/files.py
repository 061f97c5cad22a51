"""Small files and remote contents: through Spark's file systems, and over HTTP from the executors."""

from __future__ import annotations

import gzip
import time
import urllib.error
import urllib.request
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffloom.functions import columns as C


def _system(path: str):
    """(path, file system) of the running session; None without a session."""
    spark = SparkSession.getActiveSession()
    if spark is None:
        return None
    at = spark._jvm.org.apache.hadoop.fs.Path(str(path))
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration()), spark


def write_text(path: str | Path, text: str) -> None:
    """One small text file, on whatever file system the path names."""
    if (own := _system(path)) is None:
        Path(path).parent.mkdir(parents=True, exist_ok=True)
        Path(path).write_text(text)
        return
    at, system, _ = own
    out = system.create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(path: str | Path) -> str:
    """The text of one small file."""
    if (own := _system(path)) is None:
        return Path(path).read_text()
    at, system, spark = own
    stream = system.open(at)
    try:
        return str(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def fetched(urls: DataFrame, column: str = "url", tries: int = 3, wait: float = 1.0, timeout: float = 60.0) -> DataFrame:
    """(url, name, value, error) of the distinct addresses of a column: each is read once, by an executor.

    name is the file name under which the content of an address is kept (see `columns.file_of_url`). Compressed contents
    (gzip, by their first bytes) are expanded. An address that cannot be read has its error and no value.
    """

    def one(url: str) -> tuple[str | None, str | None]:
        error = None
        for k in range(tries):
            try:
                with urllib.request.urlopen(url, timeout=timeout) as answer:
                    body = answer.read()
                return (gzip.decompress(body) if body[:2] == b"\x1f\x8b" else body).decode("utf-8", "replace"), None
            except (OSError, EOFError, ValueError) as e:
                error = str(e)
                if isinstance(e, urllib.error.HTTPError) and e.code < 500 or isinstance(e, ValueError):
                    break
                time.sleep(wait * 2**k)
        return None, error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for url, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                value, error = one(url)
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.string()) for v in (url, name, value, error)], ["url", "name", "value", "error"])

    own = urls.select(F.col(column).alias("url")).where("url is not null").distinct()
    return own.select("url", C.file_of_url(F.col("url")).alias("name")).mapInArrow(run, "url string, name string, value string, error string")


def fetched_csv(contents: DataFrame) -> DataFrame:
    """Rows of fetched CSV texts as maps from the sanitized header to the value, with their address."""
    import csv
    import io

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for url, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = csv.reader(io.StringIO(text or ""))
                taken: set[str] = set()
                names = [C.identifier(h, taken) for h in next(rows, [])]
                part = []
                for row in rows:
                    part.append(list(zip(names, row, strict=False)))
                    if len(part) == 10_000:
                        yield _maps(url, part)
                        part = []
                if part:
                    yield _maps(url, part)

    def _maps(url: str, part: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([url] * len(part)), pa.array(part, pa.map_(pa.string(), pa.string()))], ["url", "row"])

    return contents.where("value is not null").select("url", "value").mapInArrow(run, "url string, row map<string,string>")
