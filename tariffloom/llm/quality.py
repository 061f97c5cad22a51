"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics of all documents are computed with numpy over the flat text of an Arrow batch. The trees are grown on
the driver from the statistics of a bounded sample of labelled rows, then flattened into arrays; a batch walks all
trees at once by indexing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffloom.llm.common import Words, bounded, crc_mod, groups, one_text_of_id, strings, table

#: The most labelled rows that the trees are grown on, the first by a hash of the id.
SAMPLE_ROWS = 20_000
TREES, DEPTH, BINS, RATE, RIDGE, LEAST_WEIGHT = 80, 4, 48, 0.12, 1.0, 1.0

_CLASSES = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "stop": b".,;:", "mark": b"!?",
    "symbol": b"#$%&*+<=>@^_`~\\/", "bar": b"|", "bracket": b"()[]{}\"'", "break": b"\n", "space": b" \t\r\x0b\x0c", "wide": range(128, 256),
}
_LUTS = {k: np.isin(np.arange(256), list(v)) for k, v in _CLASSES.items()}
FEATURES = ["log_bytes", "log_words", "word_len", "word_len_sd", "longest", "distinct", "top_share", "same_next", "pairs_distinct", "short", "lines", "byte_kinds", *_CLASSES]


def statistics(w: Words) -> np.ndarray:
    """One row of FEATURES for each document; a text without words has zeros where words are counted."""
    docs = len(w.count)
    x = np.zeros((docs, len(FEATURES)))
    size = np.diff(w.at)
    n = np.maximum(w.count, 1)
    x[:, 0], x[:, 1] = np.log1p(size), np.log1p(w.count)
    sums = lambda v: np.diff(np.append(0, np.cumsum(v))[w.first])
    length = (w.end - w.start).astype(float)
    x[:, 2] = sums(length) / n
    x[:, 3] = np.sqrt(np.maximum(sums(length * length) / n - x[:, 2] ** 2, 0))
    own = np.flatnonzero(w.count)
    if len(w):
        h = w.hashes()
        x[own, 4] = np.log1p(np.maximum.reduceat(length, w.first[own]))
        order = np.lexsort((h, w.doc))
        new = np.append(True, (h[order][1:] != h[order][:-1]) | (w.doc[order][1:] != w.doc[order][:-1]))
        x[:, 5] = sums(new) / n
        at = np.flatnonzero(new)
        runs = np.diff(np.append(at, len(h)))
        x[:, 6] = np.array([0.0] * docs)
        np.maximum.at(x[:, 6], w.doc[order][at], runs)
        x[:, 6] /= n
        same_doc = np.append(w.doc[1:] == w.doc[:-1], False)
        x[:, 7] = sums(np.append(h[1:] == h[:-1], False) & same_doc) / n
        pair = h + np.append(h[1:], h[:1]) * np.uint64(0x9E3779B97F4A7C15)
        order = np.lexsort((pair, w.doc))
        x[:, 8] = sums(np.append(True, (pair[order][1:] != pair[order][:-1]) | (w.doc[order][1:] != w.doc[order][:-1]))) / n
        x[:, 9] = sums(length <= 3) / n
    each = np.maximum(size, 1)
    for j, lut in enumerate(_LUTS.values()):
        x[:, 12 + j] = np.diff(np.append(0, np.cumsum(lut[w.data]))[w.at]) / each
    x[:, 10] = x[:, 12 + FEATURES[12:].index("break")] * each / n
    for k in np.flatnonzero(size):
        x[k, 11] = np.count_nonzero(np.bincount(w.data[w.at[k] : w.at[k + 1]], minlength=256)) / np.sqrt(size[k])
    return x


@dataclass
class Trees:
    """All trees in one array: node i goes to child[i] + (x[feature[i]] > cut[i]); a leaf's child is itself, its cut infinite."""

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    depth: int

    def raw(self, x: np.ndarray) -> np.ndarray:
        node = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            node = self.child[node] + (x[rows, self.feature[node]] > self.cut[node])
        return self.base + self.value[node].sum(1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE) -> Trees:
    """Boosted trees for the logistic loss. Without rows, or with one class only, the score is the smoothed share of 1."""
    n, width = x.shape
    share = (y.sum() + 1) / (n + 2) if n else 0.5
    base = float(np.log(share / (1 - share)))
    feature, cut, child, value, roots = [], [], [], [], []
    if n and 0 < y.sum() < n:
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
        coded = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1)  # bin b: edges[b-1] < x <= edges[b]
        slot = coded + np.arange(width) * bins
        f = np.full(n, base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-f))
            grad, hess = y - p, p * (1 - p)
            root = len(feature)
            roots.append(root)
            feature.append(0), cut.append(np.inf), child.append(root), value.append(0.0)
            node = np.full(n, root)
            level = [root]
            for _ in range(depth):
                of = {k: i for i, k in enumerate(level)}
                open_rows = np.flatnonzero(np.isin(node, level))
                which = np.array([of[k] for k in node[open_rows]])
                at = (which[:, None] * width * bins + slot[open_rows]).ravel()
                g, h = (np.bincount(at, np.repeat(v[open_rows], width), len(level) * width * bins).reshape(len(level), width, bins) for v in (grad, hess))
                gl, hl = g.cumsum(2), h.cumsum(2)
                gt, ht = gl[:, :, -1:], hl[:, :, -1:]
                gain = gl**2 / (hl + RIDGE) + (gt - gl) ** 2 / (ht - hl + RIDGE) - gt**2 / (ht + RIDGE)
                gain[(hl < LEAST_WEIGHT) | (ht - hl < LEAST_WEIGHT)] = 0
                following = []
                for i, k in enumerate(level):
                    best = int(gain[i].argmax())
                    j, b = divmod(best, bins)
                    if gain[i].flat[best] <= 1e-6 or b >= len(edges[j]):
                        continue
                    left = len(feature)
                    feature[k], cut[k], child[k] = j, float(edges[j][b]), left
                    for side in (0, 1):
                        gs = gl[i, j, b] if not side else gt[i, j, 0] - gl[i, j, b]
                        hs = hl[i, j, b] if not side else ht[i, j, 0] - hl[i, j, b]
                        feature.append(0), cut.append(np.inf), child.append(left + side), value.append(rate * gs / (hs + RIDGE))
                    rows = np.flatnonzero(node == k)
                    node[rows] = left + (x[rows, j] > cut[k])
                    following += [left, left + 1]
                level = following
                if not level:
                    break
            f += np.array(value)[node]
    return Trees(np.array(feature, np.int64), np.array(cut), np.array(child, np.int64), np.array(value), np.array(roots, np.int64), base, depth)


def sample_of(labels: DataFrame, label_col: str, learn, rows: int | None, id_col: str = "doc_id") -> DataFrame:
    """At most `rows` labelled ids, the first by a hash (None: all of them); of repeated labels the larger counts, null ids and labels never."""
    own = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & learn(F.col(id_col)))
    every = own.groupBy("doc_id").agg(F.max("label").alias("label"))
    return every if rows is None else every.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def measure(docs: DataFrame) -> DataFrame:
    """(label, x: FEATURES) of rows (label, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = strings(batch.column(1))
            for lo, hi in groups(text):
                x = statistics(Words(text, lo, hi))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(list(x), pa.list_(pa.float64()))], ["label", "x"])

    return docs.select("label", "text").mapInArrow(run, "label int, x array<double>")


def train(docs: DataFrame, labels: DataFrame, learn, label_col: str = "quality", rows: int = SAMPLE_ROWS) -> Trees:
    """Grows the trees. learn: takes the id column, says which labelled rows may be learned from.

    At most `rows` texts are used, one for each id: null ids and labels never, of repeated labels the larger. Without labels
    or documents the trees are empty and score one half.
    """
    own = sample_of(labels, label_col, learn, rows)  # bounded by rows, so it may be broadcast
    got = measure(one_text_of_id(bounded(docs), own)).toArrow()
    y = got.column("label").to_numpy().astype(float)
    x = np.array(got.column("x").to_pylist()).reshape(len(y), len(FEATURES))
    order = np.lexsort((*x.T, y))  # the same trees whatever order the rows came in
    return fit(x[order], y[order])


def score(docs: DataFrame, trees: Trees) -> DataFrame:
    """doc_id, score and predicted for every whole text; a null text is empty and is scored as such.

    Rows with a null or repeated id are rows of their own; other columns are left out.
    """
    held = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = strings(batch.column(1))
            for lo, hi in groups(text):
                s = held.value.score(statistics(Words(text, lo, hi)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    return bounded(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double, predicted int")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents; a row with a null id is held out, as it is never learned from."""
    docs = table(spark, sf_dir, "documents")
    trees = train(docs, table(spark, sf_dir, "labels"), lambda c: crc_mod(c, 3) != 1)
    return score(docs, trees).select("doc_id", F.coalesce(crc_mod(F.col("doc_id"), 3) == 1, F.lit(True)).alias("held_out"), "score", "predicted")


QUERIES = {"op2_quality": op2_quality}
