"""Toxicity: a convolutional text classifier in numpy.

A word's embedding is the sum of two hashed rows, of the word and of its first letters, so that inflected forms share
what is learned. Filters of several widths slide over the words, and each filter keeps its largest
value in the document, so that a few words in a very long text still count. The network is trained on all labelled rows: on
the driver as long as there are few; beyond that the driver's network is a start, from which the executors go on, round after
round, each shard of the rows by itself, and the changes are averaged. An eighth of the rows is kept out and sets the
thresholds. A text without a word that the network knows has the share of toxic texts as
its probability. The threshold is set for each language, which is guessed from the text
alone, and the score is stretched so that 0.5 is the threshold everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffloom.llm.common import Words, bounded, crc_mod, drop_staged, fresh, groups, mix, stage, strings, table
from tariffloom.llm.quality import sample_of

#: The most labelled rows of either class that the driver trains on, the first by a hash of the id.
START_ROWS = 4_000
#: Passes of the executors over all labelled rows where there are more, the rows of a shard, and parts that a network is averaged in.
ROUNDS, SHARD, PIECES = 3, 8_192, 64
ROWS, WIDE, FILTERS, WIDTHS = 1 << 16, 12, 12, (1, 2, 3)
#: An embedding row that fewer training documents share keeps a zero embedding: a rare word proves nothing.
LEAST_DOCS = 4
#: Bytes of a word that its second row is hashed from.
STEM = 5
EPOCHS, LEAST_STEPS, BATCH, RATE = 8, 400, 64, 0.02
#: Words that texts of a language hold often (fixed values).
COMMON = {
    "de": "der die das und ist von mit zu den auf für nicht ein im dem des sich auch es an",
    "en": "the of and to in is that it was for on are as with his they at be this from",
    "es": "el los las que y en un por con una para del se al lo como más su es no",
    "fr": "le les des et est une dans pour qui sur au avec ce il pas du par la de ne",
}
LANGS = sorted(COMMON)

_APART = np.ones(256, bool)  # words here are runs of letters, digits and bytes of other scripts
_APART[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def _hash_words(words: list[str]) -> np.ndarray:
    return Words(strings(pa.array([" ".join(words)])), 0, 1, True, _APART).hashes()


_COMMON = {k: np.sort(_hash_words(v.split())) for k, v in COMMON.items()}


def read(column: pa.Array, lo: int, hi: int) -> tuple[Words, np.ndarray, np.ndarray]:
    """(words, both embedding rows of each word, language of each document as an index into LANGS) of some rows."""
    w = Words(column, lo, hi, True, _APART)
    h = w.hashes()
    hits = np.stack([np.diff(np.append(0, np.cumsum(_isin(h, _COMMON[k])))[w.first]) for k in LANGS], 1)
    hits[:, LANGS.index("en")] += 1  # English where nothing tells
    stem = np.zeros(len(h), np.uint64)
    for k in range(STEM):
        at = np.minimum(w.start + k, len(w.data) - 1)
        stem += np.where(w.start + k < w.end, w.data[at] + 1, 0).astype(np.uint64) << np.uint64(8 * k)
    rows = np.stack([h >> np.uint64(48), mix(stem) >> np.uint64(48)], 1).astype(np.int64) % ROWS
    return w, rows, hits.argmax(1)


def _isin(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h


@dataclass
class Network:
    table: np.ndarray  # ROWS x WIDE
    filters: list[np.ndarray]  # for each width: (width * WIDE) x FILTERS
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: float
    limits: dict[str, float]
    share: float = 0.5  # of toxic texts among all labelled ones
    known: np.ndarray | None = None  # rows of the table that are in use

    def pooled(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(largest value of each filter in each document, its position): documents x all filters. Without words: zeros."""
        docs = len(first) - 1
        n = len(ids)
        best, at = np.zeros((docs, FILTERS * len(WIDTHS)), np.float32), np.zeros((docs, FILTERS * len(WIDTHS)), np.int64)
        own = np.flatnonzero(np.diff(first))
        if not n:
            return best, at
        emb = self.table[ids[:, 0]] + self.table[ids[:, 1]]
        for i, width in enumerate(WIDTHS):
            f = self.filters[i].reshape(width, WIDE, FILTERS)
            v = np.zeros((n, FILTERS), np.float32)
            m = n - width + 1
            if m > 0:
                for k in range(width):
                    v[:m] += emb[k : k + m] @ f[k]
                v[:m] += self.bias[i]
                for k in range(1, width):  # windows do not run over a document's end
                    late = first[1:] - k
                    v[late[late >= first[:-1]]] = 0
            np.maximum(v, 0, out=v)
            part = np.maximum.reduceat(v, first[own], axis=0)
            cols = slice(i * FILTERS, (i + 1) * FILTERS)
            best[own, cols] = part
            if self.limits is None:  # positions are for training only
                for d, k in zip(own, first[own], strict=True):
                    at[d, cols] = k + v[k : first[d + 1]].argmax(0)
        return best, at

    def raw(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        z = self.pooled(ids, first)[0] @ self.out + self.out_bias
        p = 1 / (1 + np.exp(-np.clip(z.astype(float), -30, 30)))
        if self.known is not None:
            p[np.diff(np.append(0, np.cumsum(self.known[ids].any(1)))[first]) == 0] = self.share
        return p

    def score(self, ids: np.ndarray, first: np.ndarray, lang: np.ndarray) -> np.ndarray:
        s = self.raw(ids, first)
        t = np.array([self.limits[k] for k in LANGS])[lang]
        return np.where(s < t, 0.5 * s / t, 0.5 + 0.5 * (s - t) / (1 - t))


def fit(docs: list[np.ndarray], y: np.ndarray, lang: np.ndarray, share: float, epochs: int = EPOCHS, seed: int = 7, kept: np.ndarray | None = None) -> Network:
    """Trains on lists of embedding rows. share: of label 1 among all labelled rows, for the calibration; kept: rows of the
    table in use, if more documents than these are to be learned from.

    Every eighth document is kept out of the training and sets the thresholds. With one class only, the network stays at zero.
    """
    rng = np.random.default_rng(seed)
    part = rng.permutation(len(docs))
    held = part[: len(docs) // 8] if len(docs) >= 100 else part
    own = part[len(docs) // 8 :] if len(docs) >= 100 else part
    seen = np.zeros(ROWS, np.int64)
    for k in own:
        seen[np.unique(docs[k])] += 1
    kept = seen >= LEAST_DOCS if kept is None else kept
    net = Network(
        (rng.normal(0, 0.1, (ROWS, WIDE)) * kept[:, None]).astype(np.float32),
        [rng.normal(0, 0.5 / np.sqrt(w * WIDE) * 2, (w * WIDE, FILTERS)).astype(np.float32) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        rng.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32),
        0.0,
        None,
        share,
        kept,
    )
    if 0 < y[own].sum() < len(own):
        _descend(net, docs, y, own, kept, max(epochs, -(-LEAST_STEPS * BATCH // len(own))), rng)
    net.limits = {}
    s = np.concatenate([net.raw(docs[k], np.array([0, len(docs[k])])) for k in held]) if len(held) else np.zeros(0)
    net.limits = _limits(s, y[held], lang[held], share)
    return net


def _descend(net: Network, docs: list[np.ndarray], y: np.ndarray, own: np.ndarray, kept: np.ndarray, epochs: int, rng: np.random.Generator, start: float = RATE) -> None:
    params = {"out": net.out, **{f"f{i}": f for i, f in enumerate(net.filters)}, **{f"b{i}": b for i, b in enumerate(net.bias)}}
    m = {k: np.zeros_like(v) for k, v in params.items()}
    s = {k: np.zeros_like(v) for k, v in params.items()}
    table_s = np.zeros(ROWS, np.float32)
    mb = sb = 0.0
    weight = np.where(y == 1, len(own) / (2 * max(1, y[own].sum())), len(own) / (2 * max(1, len(own) - y[own].sum())))
    step = 0
    for epoch in range(epochs):
        rate = start * (1 - epoch / epochs) + 0.001
        for lo in range(0, len(own), BATCH):
            pick = rng.permutation(own)[:BATCH] if lo == 0 and epoch == 0 else own[(np.arange(lo, min(lo + BATCH, len(own))) * 7919 + epoch * 104729) % len(own)]
            step += 1
            ids = np.concatenate([docs[k] for k in pick])
            first = np.append(0, np.cumsum([len(docs[k]) for k in pick]))
            best, at = net.pooled(ids, first)
            z = best @ net.out + net.out_bias
            err = ((1 / (1 + np.exp(-z)) - y[pick]) * weight[pick] / len(pick)).astype(np.float32)
            grads = {"out": best.T @ err + 1e-4 * net.out}
            back = err[:, None] * net.out[None, :] * (best > 0)
            touched_ids, touched = [], []
            for i, width in enumerate(WIDTHS):
                cols = slice(i * FILTERS, (i + 1) * FILTERS)
                b, pos = back[:, cols], at[:, cols]
                grads[f"b{i}"] = b.sum(0)
                g = np.zeros_like(net.filters[i])
                for k in range(width):
                    word = ids[np.minimum(pos + k, len(ids) - 1)] if len(ids) else np.stack([pos, pos], -1)
                    e = net.table[word].sum(2)  # documents x filters x WIDE
                    g[k * WIDE : (k + 1) * WIDE] = np.einsum("dfw,df->wf", e, b)
                    live = b != 0
                    down = (b[:, :, None] * net.filters[i][k * WIDE : (k + 1) * WIDE].T[None])[live]
                    touched_ids += [word[live][:, 0], word[live][:, 1]]
                    touched += [down, down]
                grads[f"f{i}"] = g + 1e-4 * net.filters[i]
            for k, v in params.items():
                m[k] = 0.9 * m[k] + 0.1 * grads[k]
                s[k] = 0.99 * s[k] + 0.01 * grads[k] ** 2
                v -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.99**step)) + 1e-7)
            mb, sb = 0.9 * mb + 0.1 * err.sum(), 0.99 * sb + 0.01 * err.sum() ** 2
            net.out_bias -= float(rate * (mb / (1 - 0.9**step)) / (np.sqrt(sb / (1 - 0.99**step)) + 1e-7))
            if touched_ids:
                word, grad = np.concatenate(touched_ids), np.concatenate(touched)
                uniq, where = np.unique(word, return_inverse=True)
                total = np.zeros((len(uniq), WIDE), np.float32)
                np.add.at(total, where, grad)
                ok = kept[uniq]
                uniq, total = uniq[ok], total[ok]
                table_s[uniq] += (total**2).mean(1)
                net.table[uniq] -= 2 * rate * total / (np.sqrt(table_s[uniq]) + 1e-7)[:, None]


def _limits(s: np.ndarray, t: np.ndarray, g: np.ndarray, share: float) -> dict[str, float]:
    """The threshold of each language with the best F1 at the true share of toxic texts, drawn towards that of all languages.
    s, t, g: score, label and language of the documents that were kept out."""
    one = share * max(1, (t == 0).sum()) / (max(1, t.sum()) * max(1e-6, 1 - share))  # a positive's weight that restores the share

    def best(own: np.ndarray, start: float, pull: float) -> float:
        grid = np.unique(np.clip(np.append(np.linspace(0.05, 0.95, 37), start), 0.02, 0.98))
        hit = np.array([((s[own] >= c) & (t[own] == 1)).sum() * one for c in grid])
        false = np.array([((s[own] >= c) & (t[own] == 0)).sum() for c in grid])
        f1 = 2 * hit / np.maximum(hit + false + (t[own] == 1).sum() * one, 1e-9)
        return float(grid[(f1 - pull * np.abs(grid - start)).argmax()])

    everywhere = best(np.arange(len(s)), 0.5, max(0.02, 3 / max(1, t.sum())))
    return {k: best(np.flatnonzero(g == i), everywhere, 0.2) if t[g == i].sum() >= 20 else everywhere for i, k in enumerate(LANGS)}


def _labelled(docs: DataFrame, labels: DataFrame, learn, label_col: str) -> DataFrame:
    """(doc_id, label, lang, ids: embedding rows) of every labelled text that may be learned from, one for each id."""
    own = sample_of(labels, label_col, learn, None)
    text = bounded(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    text = text.where(learn(F.col("doc_id"))).join(own, "doc_id").groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = strings(batch.column(2))
            for lo, hi in groups(text):
                w, ids, lang = read(text, lo, hi)
                parts = [p.astype("<u2").tobytes() for p in np.split(ids, w.first[1:-1])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(lang, pa.int64()), pa.array(parts, pa.binary())], ["doc_id", "label", "lang", "ids"])

    return text.mapInArrow(run, "doc_id long, label int, lang long, ids binary")


def _arrays(t: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(embedding rows, labels, languages) of documents, by id."""
    order = np.argsort(t.column("doc_id").to_numpy(), kind="stable")
    ids = [np.frombuffer(b, "<u2").reshape(-1, 2) for b in t.column("ids").to_pylist()]
    return [ids[k] for k in order], t.column("label").to_numpy()[order], t.column("lang").to_numpy()[order]


def _flat(net: Network) -> np.ndarray:
    """What is learned, end to end."""
    return np.concatenate([v.ravel() for v in (net.table, *net.filters, *net.bias, net.out, np.array([net.out_bias]))]).astype(np.float32)


def _filled(net: Network, flat: np.ndarray) -> Network:
    """A network of the same shape from `_flat`."""
    kinds = [net.table, *net.filters, *net.bias, net.out]
    at = np.cumsum([v.size for v in kinds])
    t, *rest = (v.reshape(k.shape).copy() for v, k in zip(np.split(flat[: at[-1]], at[:-1]), kinds, strict=True))
    k = len(WIDTHS)
    return Network(t, rest[:k], rest[k : 2 * k], rest[2 * k], float(flat[-1]), None, net.share, net.known)


def _known(rows: DataFrame) -> np.ndarray:
    """Which embedding rows LEAST_DOCS documents or more have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(ROWS, np.int64)
        for batch in batches:
            for b in batch.column(0).to_pylist():
                seen[np.unique(np.frombuffer(b, "<u2"))] += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["row", "n"])

    out = np.zeros(ROWS, bool)
    got = rows.select("ids").mapInArrow(run, "row long, n long").groupBy("row").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_DOCS)
    out[got.select("row").toArrow().column("row").to_numpy()] = True  # at most ROWS
    return out


def _round(rows: DataFrame, net: Network, shards: int, turn: int) -> Network:
    """One pass over all rows, or several where they are few: each shard goes on from net by itself; each weight moves by the mean change of the shards that
    have changed it, so that a word that few shards hold learns as fast as a frequent one."""
    held = rows.sparkSession.sparkContext.broadcast(net)
    start = RATE / 4 * (1 - turn / ROUNDS)

    def run(t: pa.Table) -> pa.Table:
        docs, y, _ = _arrays(t)
        before = _flat(held.value)
        own, shard = _filled(held.value, before), t.column("shard")[0].as_py()
        if 0 < y.sum() < len(y):
            _descend(own, docs, y, np.arange(len(docs)), own.known, max(1, LEAST_STEPS * BATCH // (ROUNDS * len(docs))), np.random.default_rng([turn, shard]), start)
        moved = np.array_split(_flat(own) - before, PIECES)
        return pa.table({"shard": pa.array([shard] * PIECES, pa.int32()), "piece": pa.array(range(PIECES), pa.int32()), "moved": pa.array([v.tobytes() for v in moved], pa.binary())})

    def mean(t: pa.Table) -> pa.Table:
        order = np.argsort(t.column("shard").to_numpy())  # the same sum whatever order they came in
        total = many = 0
        for k in order.tolist():
            v = np.frombuffer(t.column("moved")[k].as_py(), np.float32).astype(float)
            total, many = total + v, many + (v != 0)
        return pa.table({"piece": t.column("piece").slice(0, 1), "moved": pa.array([(total / np.maximum(many, 1)).astype(np.float32).tobytes()], pa.binary())})

    shard = F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int")
    each = rows.withColumn("shard", shard).groupBy("shard").applyInArrow(run, "shard int, piece int, moved binary")
    got = each.groupBy("piece").applyInArrow(mean, "piece int, moved binary").toArrow()  # one network
    moved = [b for _, b in sorted(zip(got.column("piece").to_pylist(), got.column("moved").to_pylist(), strict=True))]
    return _filled(net, _flat(net) + np.frombuffer(b"".join(moved), np.float32))


def train(docs: DataFrame, labels: DataFrame, learn, label_col: str = "toxic", rows: int = START_ROWS) -> Network:
    """Trains the network on every labelled row. learn: takes the id column, says which labelled rows may be learned from.

    rows: how many of either class the driver trains on; where there are more, these are the start, and ROUNDS passes of the
    executors over all rows follow. One text for each id: null ids and labels never, of repeated labels the larger. Without
    labels or documents, or with one class only, every text has the smoothed share of toxic labels.
    """
    tally = {r["label"]: r["n"] for r in labels.where(learn(F.col("doc_id"))).groupBy(F.col(label_col).cast("int").alias("label")).agg(F.count("*").alias("n")).where("label in (0, 1)").collect()}
    share = (tally.get(1, 0) + 1) / (sum(tally.values()) + 2)
    every = stage(_labelled(docs, labels, learn, label_col), "labelled")
    try:
        first = lambda d: _arrays(d.where("label = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).unionByName(d.where("label = 0").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)).toArrow())
        many = {r["label"]: r["n"] for r in every.groupBy("label").agg(F.count("*").alias("n")).collect()}
        if max(many.values(), default=0) <= rows:
            return fit(*first(every), share)
        out = F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(8)) == 0
        own = every.where(~out)
        net = fit(*first(own), share, kept=_known(own))
        net.limits = None
        shards = -(-sum(many.values()) // SHARD)
        for turn in range(ROUNDS):
            net = _round(own, net, shards, turn)
        net.limits = {}
        held = every.sparkSession.sparkContext.broadcast(net)

        def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = [np.frombuffer(b, "<u2").reshape(-1, 2) for b in batch.column(2).to_pylist()]
                s = [held.value.raw(v, np.array([0, len(v)])) for v in ids]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*s, np.zeros(0)])), batch.column(0), batch.column(1)], ["s", "label", "lang"])

        # three numbers for each row that was kept out
        got = every.where(out).select("label", "lang", "ids").mapInArrow(judge, "s double, label int, lang long").toArrow()
        net.limits = _limits(*(got.column(c).to_numpy() for c in ("s", "label", "lang")), share)
        return net
    finally:
        drop_staged(every)


def score(docs: DataFrame, net: Network, into: tuple[str, str] = ("score", "predicted"), text_col: str = "text") -> DataFrame:
    """All columns of docs, with score and predicted, for every whole text; a null text is empty and is scored as such.

    Rows with a null or repeated id are rows of their own. Columns of docs that are named so are replaced; `into` names the
    two otherwise. An empty table gives no rows.
    """
    docs = bounded(docs).drop(*into)
    held = docs.sparkSession.sparkContext.broadcast(net)
    names = docs.columns
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = strings(batch.column(at).cast(pa.string()))
            for lo, hi in groups(text):
                w, ids, lang = read(text, lo, hi)
                s = held.value.score(ids, w.first, lang)
                yield pa.RecordBatch.from_arrays([*(c.slice(lo, hi - lo) for c in batch.columns), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], [*names, *into])

    from pyspark.sql import types as T

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(into[0], T.DoubleType()), T.StructField(into[1], T.IntegerType())]))


def without_toxic(docs: DataFrame, net: Network) -> DataFrame:
    """The rows of docs that are not predicted toxic, with all their columns, whatever their names."""
    into = (fresh("score", docs), fresh("predicted", docs))
    return score(docs, net, into).where(F.col(into[1]) == 0).drop(*into)


def learned_from(col):
    return crc_mod(col, 5) != 0


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents; a row with a null id is held out, as it is never learned from."""
    docs = table(spark, sf_dir, "documents")
    net = train(docs, table(spark, sf_dir, "labels"), learned_from)
    return score(docs.select(F.col("doc_id").cast("long"), "text"), net).select("doc_id", F.coalesce(crc_mod(F.col("doc_id"), 5) == 0, F.lit(True)).alias("held_out"), "score", "predicted")


QUERIES = {"op8_toxicity": op8_toxicity}
