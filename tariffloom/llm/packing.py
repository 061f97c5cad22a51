"""Best-fit packing of tokenised documents into sequences of a fixed length (best-two-fit).

Best-two-fit looks at lengths only, and there are at most `seq_len` of them. So the driver needs no more than a
histogram of the lengths, whatever the number of documents: it fills one bin greedily (largest first), improves it by
replacing the smallest piece with the two unpacked pieces that fit the expanded gap most tightly, and applies the same
pattern as often as the histogram allows, which is what filling bin after bin would do. Each pattern uses up a length,
so there are few of them. Executors then give each piece the slot of its rank among the pieces of its length.
"""

from __future__ import annotations

import contextlib
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tariffloom.llm.common import bounded, fresh, scoped, stage, strings, table

SEQ_LEN, END_ID = 1024, 2
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, chunk int, place long"

_encoders: dict[str, object] = {}


def byte_alphabet() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte: printable bytes stand for themselves,
    the others take the code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids as the tokenizers library gives them. A byte-level vocabulary whose ids follow its merges is run by
    tiktoken, several times faster with the same ids; any other by the tokenizers library itself."""

    def __init__(self, spec: str):
        self.spec, self._slow = spec, None
        self.fast = self._fast(json.loads(spec))

    @property
    def slow(self):
        """The library's own tokenizer, which takes much memory and is made only where it is needed."""
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_str(self.spec)
            self._slow.no_truncation()
            self._slow.no_padding()
        return self._slow

    @staticmethod
    def _fast(d: dict):
        import tiktoken

        pre, model = d.get("pre_tokenizer") or {}, d["model"]
        vocab, merges = model["vocab"], [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        plain = all(not (a.get(k)) for a in d["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        if d.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex") or model.get("ignore_merges") or model.get("dropout") or not plain:
            return None
        if any(vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(merges)):
            return None
        alphabet = byte_alphabet()
        ranks = {bytes(alphabet[c] for c in t): i for t, i in vocab.items() if all(c in alphabet for c in t)}
        # The split pattern of byte-level pre-tokenizers (a fixed value).
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={a["content"]: a["id"] for a in d["added_tokens"]})

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is not None:
            with contextlib.suppress(ValueError):  # its splitter gives up on very long runs of white space
                return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4")
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4")


def encoder(spec: str) -> Encoder:
    key = str(zlib.crc32(spec.encode()))
    if key not in _encoders:
        _encoders[key] = Encoder(spec)
    return _encoders[key]


def pieces(docs: DataFrame, tokenizer_path: str, seq_len: int = SEQ_LEN, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Tokenises whole texts, appends end_id and cuts what is longer than seq_len; the remainder is the first piece.

    A null or empty text is the end id alone. Rows with a null or repeated id are pieces of their own. chunk and place
    number the pieces of a length within the task that made them; with_ids adds the ids themselves.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, chunk, seen = encoder(spec.value), TaskContext.get().partitionId(), {}
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(enc(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                cut = len(ids) % seq_len or seq_len
                at, k = 0, 0
                while at < len(ids):
                    part = ids[at : at + (cut if not k else seq_len)]
                    place = seen.get(len(part), 0)
                    seen[len(part)] = place + 1
                    rows.append((doc, k, at, len(part), zlib.crc32(part.tobytes()), chunk, place, *([part.astype("i8")] if with_ids else [])))
                    at, k = at + len(part), k + 1
            if rows:
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), *([pa.list_(pa.int64())] if with_ids else [])]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "chunk", "place", "ids"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names[: len(kinds)])

    return bounded(docs).select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, PIECE_SCHEMA + (", ids array<long>" if with_ids else ""))


def plan(counts: np.ndarray, size: int) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Best-two-fit over counts[length]: (bins, [(length, pieces in each bin, offset of the first)]) for each pattern."""
    left, out = counts.astype(np.int64).copy(), []
    left[0] = 0
    while True:
        there = np.flatnonzero(left)
        if not len(there):
            return out
        used: dict[int, int] = {}
        gap = size

        def fill(gap: int, used: dict[int, int], there: np.ndarray = there) -> int:
            at = int(np.searchsorted(there, gap, "right")) - 1
            while gap > 0 and at >= 0:
                x = int(there[at])
                k = min(int(left[x]) - used.get(x, 0), gap // x)
                if k > 0:
                    used[x] = used.get(x, 0) + k
                    gap -= k * x
                at = min(at - 1, int(np.searchsorted(there, gap, "right")) - 1)
            return gap

        gap = fill(gap, used)
        while gap and sum(used.values()) > 1:
            low = min(used)
            room = gap + low
            free = left[there].copy()
            free[np.searchsorted(there, list(used))] -= list(used.values())
            a = there[(free > 0) & (there < room)]
            if not len(a):
                break
            n = free[(free > 0) & (there < room)]
            b_at = np.searchsorted(a, np.minimum(a, room - a), "right") - 1
            own = np.arange(len(a))
            b_at = np.where((b_at == own) & (n < 2), b_at - 1, b_at)
            total = np.where(b_at >= 0, a + a[b_at], 0)
            best = int(total.argmax())
            if total[best] <= low:
                break
            used[low] -= 1
            if not used[low]:
                del used[low]
            for x in (int(a[best]), int(a[b_at[best]])):
                used[x] = used.get(x, 0) + 1
            gap = fill(room - int(total[best]), used)
        times = min(int(left[x]) // k for x, k in used.items())
        parts, at = [], 0
        for x in sorted(used, reverse=True):
            parts.append((x, used[x], at))
            left[x] -= times * used[x]
            at += x * used[x]
        out.append((times, parts))


def slots(patterns: list[tuple[int, list[tuple[int, int, int]]]]) -> dict[int, np.ndarray]:
    """For each length, rows (first rank, pieces in each bin, first sequence, offset) by rank."""
    taken: dict[int, int] = {}
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    bins = 0
    for times, parts in patterns:
        for x, k, at in parts:
            rows.setdefault(x, []).append((taken.get(x, 0), k, bins, at))
            taken[x] = taken.get(x, 0) + times * k
        bins += times
    return {x: np.array(r, np.int64) for x, r in rows.items()}


@scoped
def pack(parts: DataFrame, seq_len: int = SEQ_LEN) -> DataFrame:
    """Adds sequence_id and offset to pieces (see `pieces`). An empty table stays empty.

    Full pieces are sequences of their own, numbered below zero. Extra columns stay, whatever their names; only columns
    named sequence_id and offset are replaced.
    """
    spark = parts.sparkSession
    parts = stage(parts.drop("sequence_id", "offset"), "pieces")
    rank_name, rank0 = fresh("rank", parts), fresh("rank0", parts)
    full = parts.where(F.col("length") >= seq_len)
    short = parts.where(F.col("length") < seq_len)
    tally = stage(short.groupBy("chunk", "length").agg(F.count("*").alias("n")), "tally")
    counts = np.zeros(seq_len, np.int64)
    for r in tally.groupBy("length").agg(F.sum("n").alias("n")).collect():  # a row for each length: below seq_len
        counts[r["length"]] = r["n"]
    where = spark.sparkContext.broadcast(slots(plan(counts, seq_len)))
    before = tally.select("chunk", "length", (F.sum("n").over(W.partitionBy("length").orderBy("chunk")) - F.col("n")).alias(rank0))
    schema = parts.schema
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column(rank_name).to_numpy(zero_copy_only=False)
            seq, off = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.diff(length[order])) + 1
            for own in np.split(order, cuts):
                if len(own):
                    x = int(length[own[0]])
                    t = where.value[x]
                    r = t[np.searchsorted(t[:, 0], rank[own], "right") - 1]
                    d = rank[own] - r[:, 0]
                    seq[own], off[own] = r[:, 2] + d // r[:, 1], r[:, 3] + d % r[:, 1] * x
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(seq), pa.array(off)], [*names, "sequence_id", "offset"])

    ranked = short.join(before, ["chunk", "length"]).select(*names, (F.col("place") + F.col(rank0)).alias(rank_name))
    out = ranked.mapInArrow(run, T_add(schema))
    alone = full.select(*names, (-(F.col("chunk").cast("long") * F.lit(1 << 32) + F.col("place") + 1)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return out.unionByName(alone)


def T_add(schema):
    from pyspark.sql import types as T

    return T.StructType([*schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents; a null text is the end id alone, rows with null or repeated ids are pieces of their own."""
    import public_tokenizers

    parts = pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pack(parts).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


QUERIES = {"op1_best_fit_packing": op1_best_fit_packing}
