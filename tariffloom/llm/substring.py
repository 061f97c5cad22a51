"""Substring dedup: words that a window of an earlier document covers are removed.

Difference-cover anchors: a hash of the ANCHOR words from a position is taken only where the position modulo PERIOD is in
COVER. For any shift between two documents there is a cover position in every PERIOD consecutive ones that is a cover
position in both; so two equal windows of ANCHOR + PERIOD - 1 words share an aligned anchor. Anchors that several
documents share are extended: the windows around them, and no others, are hashed and compared by their smallest document.

A window is known by 96 bits of hash, so that among 10^13 of them no two different ones are expected to be taken for equal.
Anchors and windows that meet within a task are settled there and go on as one row, so a passage in a third of all
documents is a few rows for each task, not one for each document. Texts travel once; both joins read that exchange.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tariffloom.llm.common import Words, bounded, chain, groups, mix, packed, strings, table, unpacked, windows

WINDOW, PERIOD, COVER = 13, 7, (1, 2, 4)  # a perfect difference set: every residue is a difference of two members
ANCHOR = WINDOW - PERIOD + 1
#: Rows that a task gathers before it settles what they share.
SETTLED_AT = 1_000_000

_IN_COVER = np.isin(np.arange(PERIOD), COVER)


def anchors(w: Words, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, hash) of every anchor in documents that have a window."""
    at = windows(w.first, ANCHOR)
    doc = w.doc[at]
    at = at[_IN_COVER[(at - w.first[doc]) % PERIOD] & (w.count[doc] >= WINDOW)]
    return at, chain(h, at, ANCHOR)


def _runs(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order by key and document, start of each key's run, whether the run holds several documents)."""
    order = np.lexsort((doc, key))
    start = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
    last = np.append(start[1:], len(key)) - 1
    return order, start, doc[order][start] != doc[order][last]


_NAMES = ["key", "doc", "own", "more"]
_SCHEMA = "key long, doc long, own array<long>, more int"


def _lists(doc: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
    """One row (a key of its own, doc, list of values) for each document; values stay in order."""
    order = np.argsort(doc, kind="stable")
    doc, value = doc[order], value[order]
    start = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])) if len(doc) else np.zeros(0, np.int64)
    lists = pa.ListArray.from_arrays(pa.array(np.append(start, len(value)).astype(np.int32)), pa.array(value, pa.int64()))
    key = mix(doc[start].astype(np.uint64) + np.uint64(start.size))
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(doc[start], pa.int64()), lists, pa.nulls(len(start), pa.int32())], _NAMES)


def _rows(key: np.ndarray, doc: np.ndarray, more: np.ndarray | None = None) -> pa.RecordBatch:
    further = pa.nulls(len(key), pa.int32()) if more is None else pa.array(more, pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(doc, pa.int64()), pa.nulls(len(key), pa.list_(pa.int64())), further], _NAMES)


def further_bits(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """32 bits of a second hash of the window from each position, independent of the first."""
    out = np.full(len(at), np.uint64(0x6A09E667F3BCC909))
    for j in range(WINDOW):
        out *= np.uint64(0xA24BAED4963EE407)
        out ^= out >> np.uint64(31)
        out += h[at + j]
    return (mix(out) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _each_settled(batches: Iterator[pa.RecordBatch], texts, of_group, settle) -> Iterator[pa.RecordBatch]:
    """Gathers what of_group(batch, text, lo, hi) gives, (key, doc, position) arrays, and settles it now and then."""
    held, size = [], 0
    for batch in batches:
        text = texts(batch.column(1))
        for lo, hi in groups(text):
            held.append(of_group(batch, text, lo, hi))
            size += len(held[-1][0])
            if size > SETTLED_AT:
                yield from settle(*(np.concatenate(v) for v in zip(*held, strict=True)))
                held, size = [], 0
    if size:
        yield from settle(*(np.concatenate(v) for v in zip(*held, strict=True)))


def find_anchors(docs: DataFrame) -> DataFrame:
    """Of (doc, text, ...): rows (key, doc) with one document for each anchor and task, and rows (key, doc, own: positions)
    of the anchors that documents of the task share.

    The key is 47 bits of the anchor's hash, whether documents of the task share it, and 16 bits of its position. Hash and
    position only choose what is compared later, so it does no harm that they are cut.
    """

    def of_group(batch: pa.RecordBatch, text: pa.Array, lo: int, hi: int) -> tuple[np.ndarray, ...]:
        w = Words(text, lo, hi)
        at, key = anchors(w, w.hashes())
        doc = w.doc[at]
        return key, batch.column(0).to_numpy(zero_copy_only=False)[lo:hi][doc], (at - w.first[doc]) & 0xFFFF

    def settle(key: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> Iterator[pa.RecordBatch]:
        order, start, several = _runs(key, doc)
        first = order[start]
        by_doc = np.argsort(doc[first], kind="stable")  # equal documents side by side travel better compressed
        first, shared = first[by_doc], several[by_doc]
        yield _rows((key[first] & ~np.uint64(0x1FFFF)) | (shared.astype(np.uint64) << np.uint64(16)) | pos[first].astype(np.uint64), doc[first])
        inside = order[np.repeat(several, np.diff(np.append(start, len(key))))]
        if len(inside):
            yield _lists(doc[inside], pos[inside])

    return docs.mapInArrow(lambda batches: _each_settled(batches, strings, of_group, settle), _SCHEMA)


def shared_anchors(rows: DataFrame) -> DataFrame:
    """(doc, own: positions in 16 bits) of the anchors that several documents share. rows: see `find_anchors`."""
    anchor = F.shiftright("key", 17)
    over = W.partitionBy("anchor")
    # dealt by the expression before the column is made: the shuffle carries one number for hash, flag and position
    met = rows.repartition(anchor).withColumn("anchor", anchor)
    met = met.select("key", "doc", "own", F.min("doc").over(over).alias("low"), F.max("doc").over(over).alias("high"), F.max(F.col("key").bitwiseAND(1 << 16)).over(over).alias("any"))
    told = met.where("own is not null or low < high or any > 0")
    return told.select("doc", F.coalesce("own", F.array(F.col("key").bitwiseAND(0xFFFF))).alias("own")).groupBy("doc").agg(F.flatten(F.collect_list("own")).alias("own"))


def find_windows(docs: DataFrame) -> DataFrame:
    """Of (doc, packed text, own: anchor positions, ...): rows (key: hash, doc, more: further bits) with one document for each window and task,
    and rows (key, doc, own) of windows that a smaller document of the task has, as runs: start and half of the first hash, length."""

    def of_group(batch: pa.RecordBatch, text: pa.Array, lo: int, hi: int) -> tuple[np.ndarray, ...]:
        w = Words(text, lo, hi)
        h = w.hashes()
        at, key = anchors(w, h)
        lists = batch.column(2).slice(lo, hi - lo)
        row = np.repeat(np.arange(hi - lo), pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False))
        told = np.unique(lists.flatten().to_numpy(zero_copy_only=False) + (row << 16))
        here = ((at - w.first[w.doc[at]]) & 0xFFFF) + (w.doc[at] << 16)
        # an anchor may stand at other places of the document too
        key_doc = np.stack([key, w.doc[at].astype(np.uint64)], 1).view([("k", np.uint64), ("d", np.uint64)]).ravel()
        hit = at[np.isin(key_doc, key_doc[np.isin(here, told)])]
        cover = np.zeros(len(h) + 1, np.int64)  # windows that hold a shared anchor
        np.add.at(cover, np.maximum(hit - (PERIOD - 1), w.first[w.doc[hit]]), 1)
        np.add.at(cover, hit + 1, -1)
        start = np.flatnonzero(np.cumsum(cover)[:-1] > 0)
        start = start[start + WINDOW <= w.first[1:][w.doc[start]]]
        doc = w.doc[start]
        return chain(h, start, WINDOW), batch.column(0).to_numpy(zero_copy_only=False)[lo:hi][doc], start - w.first[doc], further_bits(h, start)

    def settle(key: np.ndarray, doc: np.ndarray, pos: np.ndarray, more: np.ndarray) -> Iterator[pa.RecordBatch]:
        order, start, _ = _runs(key, doc)
        first = order[start]
        sent = first[np.argsort(doc[first], kind="stable")]
        yield _rows(key[sent], doc[sent], more[sent])
        later = np.sort(order[doc[order] > np.repeat(doc[first], np.diff(np.append(start, len(key))))])
        if len(later):  # gathered document by document in order of position, so runs are consecutive
            head = np.append(True, (doc[later][1:] != doc[later][:-1]) | (pos[later][1:] != pos[later][:-1] + 1))
            at = np.flatnonzero(head)
            run = np.stack([(pos[later][at] << 32) | (key[later][at] >> np.uint64(32)).astype(np.int64), np.diff(np.append(at, len(later)))], 1)
            yield _lists(np.repeat(doc[later][at], 2), run.ravel())

    return docs.mapInArrow(lambda batches: _each_settled(batches, unpacked, of_group, settle), _SCHEMA)


def windows_to_remove(rows: DataFrame) -> DataFrame:
    """(doc, runs, hashes) of the windows that a smaller document has. rows: see `find_windows`."""
    met = rows.withColumn("low", F.min("doc").over(W.partitionBy("key", "more"))).where("own is not null or doc > low")
    told = met.groupBy("doc").agg(F.flatten(F.collect_list("own")).alias("runs"), F.collect_list(F.when(F.col("own").isNull(), F.col("key"))).alias("hashes"))
    return told


def keep_words(docs: DataFrame) -> DataFrame:
    """Of (doc, packed text, runs and hashes of windows to remove, others): doc, n_words, n_removed, kept, and the others."""
    others = docs.schema.fields[4:]
    names = ["doc", "n_words", "n_removed", "kept", *(f.name for f in others)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, text, runs, hashes = batch.column(0), unpacked(batch.column(1)), batch.column(2), batch.column(3)
            for lo, hi in groups(text):
                w = Words(text, lo, hi)
                h = None
                removed, kept = np.zeros(hi - lo, np.int64), []
                for i in range(hi - lo):
                    a, b = w.first[i], w.first[i + 1]
                    words = w.data[w.at[i] : w.at[i + 1]].tobytes().split()
                    if runs[lo + i].is_valid and b - a >= WINDOW:
                        h = w.hashes() if h is None else h
                        key = chain(h, np.arange(a, b - WINDOW + 1), WINDOW)
                        told = [hashes[lo + i].values.to_numpy(zero_copy_only=False).view(np.uint64)]
                        for head, size in runs[lo + i].values.to_numpy(zero_copy_only=False).reshape(-1, 2).tolist():
                            if head >> 32 < len(key) and int(key[head >> 32]) >> 32 == head & 0xFFFFFFFF:  # an id may come with several texts
                                told.append(key[head >> 32 : (head >> 32) + size])
                        start = np.flatnonzero(np.isin(key, np.concatenate(told)))
                        cover = np.zeros(b - a + 1, np.int64)
                        np.add.at(cover, start, 1)
                        np.add.at(cover, start + WINDOW, -1)
                        gone = np.cumsum(cover)[:-1] > 0
                        removed[i] = gone.sum()
                        words = [x for x, g in zip(words, gone.tolist(), strict=True) if not g]
                    kept.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), pa.array(w.count, pa.int64()), pa.array(removed), pa.array(kept, pa.binary()).cast(pa.string()), *(c.slice(lo, hi - lo) for c in batch.columns[4:])], names)

    own = [T.StructField("doc", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())]
    return docs.mapInArrow(run, T.StructType([*own, *others]))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the kept words with a space between them) of every document, and the columns
    in carry, whatever their names.

    A null text has no words. Rows with a null id take no part and keep all words. Rows of one id are one document for
    the comparison, and each keeps what no smaller id has.
    """
    extra = [f"_carry{i}" for i in range(len(carry))]
    source = bounded(docs).select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"), *(F.col(c).alias(e) for c, e in zip(carry, extra, strict=True)))
    known = source.where("doc is not null")
    # both joins ask for the same exchange of the texts, with all columns, and so read one
    shared = shared_anchors(find_anchors(known.select("doc", "text")).drop("more"))
    small = packed(known, "text").where("doc is not null")
    found = find_windows(small.join(shared, "doc").select("doc", "text", "own", *extra))
    gone = windows_to_remove(found)
    out = keep_words(small.join(gone, "doc", "left").select("doc", "text", "runs", "hashes", *extra))
    none = F.lit(None).cast("array<long>")
    alone = keep_words(packed(source.where("doc is null"), "text").select("doc", "text", none.alias("runs"), none.alias("hashes"), *extra))
    out = out.unionByName(alone)
    return out.select(F.col("doc").alias("doc_id"), "n_words", "n_removed", "kept", *(F.col(e).alias(c) for c, e in zip(carry, extra, strict=True)))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


QUERIES = {"op7_substring_dedup": op7_substring_dedup}
ORACLE = {
    "op7_substring_dedup": r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM d WHERE len(w) >= 13),
    k AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k FROM s),
    m AS (SELECT k, min(doc_id) AS low FROM k GROUP BY k),
    r AS (SELECT DISTINCT doc_id, i + j AS at FROM (SELECT k.doc_id, k.i FROM k JOIN m USING (k) WHERE m.low < k.doc_id) x, generate_series(0, 12) g(j)),
    p AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS at FROM d),
    kept AS (SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.at) AS t, count(*) AS n FROM p ANTI JOIN r ON p.doc_id = r.doc_id AND p.at = r.at GROUP BY p.doc_id)
    SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (doc_id)
    """,
}
