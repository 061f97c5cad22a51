"""What the corpus operators share: staged tables, whole-text word kernels and text groups.

The word kernel works on the flat byte buffer of an Arrow string column, so that finding words and
hashing them is a handful of numpy passes over bytes and no Python object is made per word.
"""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import functools
import tempfile
import threading
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of rows that a Python worker receives at once.
BATCH_BYTES = 4 << 20
#: Bytes of text that a numpy pass takes at once; a longer text forms a group of its own.
GROUP_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 2**64, 256, dtype=np.uint64)
_BYTE[_SPACE] = 0
_M1, _M2, _M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


@functools.lru_cache(maxsize=1)
def _few_places() -> np.ndarray:
    return mix(np.arange(1, (1 << 16) + 1, dtype=np.uint64) * _M3) | np.uint64(1)


def places(n: int) -> np.ndarray:
    """A multiplier for each of the first n bytes of a word. No two are related, so they never repeat in a long word."""
    return _few_places()[:n] if n <= 1 << 16 else mix(np.arange(1, n + 1, dtype=np.uint64) * _M3) | np.uint64(1)


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which the driver and all executors share.

    Where the session names none, a local session (a single machine) gets one of its own; a cluster is told to set one,
    as a folder of one machine would be lost with it.
    """
    sc = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or sc._jsc.sc().getCheckpointDir().getOrElse(None)
    if not at:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="tariffloom-")
        sc.setCheckpointDir(at)
    return at.rstrip("/")


def stage(df: DataFrame, tag: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it again: lineage ends here, lost executors cost nothing.

    Inside a function marked `scoped` the table goes when that function returns; else it stays, for whoever reads it later.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tariffloom-{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    if _scopes():
        _scopes()[-1].append(out)
    else:
        _left.append(out)
    return out


#: Staged results: a plan may read them as long as its session lives, so they go when the program ends.
_left: list[DataFrame] = []


@atexit.register
def _clear_away() -> None:
    for df in _left:
        with contextlib.suppress(Exception):  # the session may be gone before
            drop_staged(df)


_here = threading.local()


def _scopes() -> list[list[DataFrame]]:
    """Staged tables of the scoped functions that run in this thread, the innermost last."""
    if not hasattr(_here, "scopes"):
        _here.scopes = []
    return _here.scopes


def scoped(make):
    """A function whose result is staged, and whose own staged tables are deleted when it returns."""

    @functools.wraps(make)
    def run(*args, **more) -> DataFrame:
        scopes = _scopes()
        scopes.append([])
        own = scopes[-1]
        try:
            out = make(*args, **more)
            scopes.pop()
            return stage(out, make.__name__)
        finally:
            if scopes and scopes[-1] is own:
                scopes.pop()
            for df in own:
                drop_staged(df)

    return run


def drop_staged(df: DataFrame) -> None:
    """Deletes the folder of a staged table that no later step reads."""
    if not getattr(df, "_staged_at", None):
        return
    jvm = df.sparkSession._jvm
    path = jvm.org.apache.hadoop.fs.Path(df._staged_at)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
    df._staged_at = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder."""
    return bounded(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def bounded(df: DataFrame) -> DataFrame:
    """df, after its session has been told to bound Arrow batches by BATCH_BYTES as well as by rows, for tables with very long
    texts. It is the one setting that the operators change, and all of them that read texts in Python call this first."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df


def fresh(name: str, *tables: DataFrame) -> str:
    """A column name that none of the tables has in any case: the name itself, or with underscores after it."""
    taken = {c.lower() for t in tables for c in t.columns}
    while name.lower() in taken:
        name += "_"
    return name


def one_text_of_id(docs: DataFrame, own: DataFrame) -> DataFrame:
    """(doc_id, label, text) of the ids in own (doc_id, label), a bounded table: of several texts of one id that with the
    smallest hash, so there are never more rows than ids."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(own), "doc_id")
    return text.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))


def crc_mod(col, n: int):
    """crc32 of the id written as text, modulo n; null for a null id."""
    return F.pmod(F.crc32(col.cast("string").cast("binary")), F.lit(n))


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Returns freed memory to the system, so that a Python worker that is kept does not keep the most it ever used."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def groups(column: pa.Array, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column with about `limit` bytes each."""
    n = len(column)
    off = offsets(column)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)
    give_back()


def strings(column) -> pa.Array:
    """One large_string array without nulls (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string())
    return column.fill_null("") if column.null_count else column


def offsets(column: pa.Array) -> np.ndarray:
    return np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]


def packed(df: DataFrame, column: str) -> DataFrame:
    """df with a text column compressed (binary), for the way through a shuffle; a null text becomes an empty one."""
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            small = pa.array([press(t.as_buffer()) for t in strings(batch.column(at))], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], small, *batch.columns[at + 1 :]], batch.schema.names)

    fields = [T.StructField(f.name, T.BinaryType()) if f.name == column else f for f in df.schema.fields]
    return df.mapInArrow(run, T.StructType(fields))


def unpacked(column) -> pa.Array:
    """The texts of a compressed column."""
    expand = zstandard.ZstdDecompressor().decompress
    return strings(pa.array([expand(b) for b in column.to_pylist()], pa.large_binary()).cast(pa.large_string()))


class Words:
    """The words `[^\\x20\\x09-\\x0D]+` of some rows of a string column.

    data: the bytes; start, end: of each word in data; doc: its row, from 0; first: index of each row's
    first word, with the number of words at the end.
    """

    def __init__(self, column: pa.Array, lo: int, hi: int, lower: bool = False, apart: np.ndarray = _SPACE):
        """apart: of the 256 bytes, those that separate words."""
        off = offsets(column)[lo : hi + 1]
        buf = column.buffers()[2]
        raw = np.frombuffer(buf, np.uint8)[off[0] : off[-1]] if buf is not None else np.zeros(0, np.uint8)
        at = off - off[0]
        self.data = _LOWER[raw] if lower else raw
        self.at, self.apart = at, apart
        n, docs = len(raw), hi - lo
        word = ~apart[self.data]
        before = np.zeros(n + 1, bool)
        before[1:] = word
        before[at] = False  # nothing runs over from one row into the next
        self.start = np.flatnonzero(word & ~before[:n])
        after = np.zeros(n + 1, bool)
        after[:n] = word
        after[at] = False
        self.end = np.flatnonzero(word & ~after[1:]) + 1
        self.first = np.searchsorted(self.start, at)
        self.first[-1] = len(self.start)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(docs), self.count)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes: every byte counts by its value and its place, whatever the word's length."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        lo = self.start[0]
        span = np.diff(np.append(self.start, len(self.data)))
        place = np.arange(len(self.data) - lo)
        place -= np.repeat(self.start - lo, span)
        value = _BYTE[self.data[lo:]]
        if self.apart is not _SPACE:  # white space has 0 as it is
            value[self.apart[self.data[lo:]]] = 0
        longest = int((self.end - self.start).max())
        np.minimum(place, longest - 1, out=place)  # what lies after a word counts nothing
        value *= places(longest)[place]
        total = np.add.reduceat(value, self.start - lo)
        return mix(total + (self.end - self.start).astype(np.uint64) * _M3)

    def bytes_of(self, k: int) -> bytes:
        return self.data[self.start[k] : self.end[k]].tobytes()


def windows(first: np.ndarray, k: int) -> np.ndarray:
    """Positions at which k consecutive words of one row start; first: as in Words."""
    n = int(first[-1])
    ok = np.ones(n, bool)
    for j in range(1, k):
        back = first[1:] - j
        ok[back[back >= first[:-1]]] = False
    return np.flatnonzero(ok)


def chain(h: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of the k words from each position in `at`, in order."""
    out = np.full(len(at), _M3)
    for j in range(k):
        out ^= out >> np.uint64(29)
        out *= _M1
        out += h[at + j]
    return mix(out)
