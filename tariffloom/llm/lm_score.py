"""Language-model scoring by online logistic context mixing over the bit counts of hashed contexts.

A text is a sequence of symbols: the words of a dictionary, an escape that the bytes of a rarer word follow, a rarer word
again, and an end. A symbol is a path of bits in a binary tree (of the words by their training counts, of the bytes by
theirs). Each bit has three predictors: the counts of its node over all training texts, those under the word before, and
those under the two words before (for a byte: two and four bytes before). Their log-odds are mixed with weights
chosen by a gate (how often, and how surely, each context has been seen), and the mixture is refined by a table of
corrections. Weights and corrections start from plain smoothing and learn online, from training texts alone: block after
block, each occurrence is predicted without itself. Where no context has seen a node, the rest of the path has the
probability of the counts. So the product of the bit probabilities is a probability of the whole text. A text that is learned
from is scored in the same way, each of its occurrences without itself: by what the other texts teach. Else all training
texts would be told their own words, and one that occurs twice could not be told from one that occurs once.

Contexts and symbols go to the context, not the counts to the texts: each symbol is sent once, with the words before it, to
the part that its context belongs to. There all counts of the context meet, however many contexts there are; the part
learns, predicts, and sends back one sum for each text. So the model grows with the input, nothing of it is
broadcast but the dictionary, and no text is shuffled. What is sent travels as compressed columns, some bytes a word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffloom.llm.common import Words, bounded, crc_mod, groups, mix, scoped, stage, strings, table

#: Words with a symbol of their own: the most frequent in the training texts, of those that come twice or more.
DICTIONARY = 1_000_000
#: Symbols that a part is meant for, and that a task gathers before it sends them; from PARTS parts on, up to four times as
#: many, so that what a task sends to a part stays worth compressing. A context with a quarter of it is split by the word before it.
PART, PARTS = 1 << 19, 1 << 12
#: Distinct rows, and bits, that are predicted at once; bits after which the weights change.
SLICE, BLOCK = 1 << 16, 1 << 14
#: How many occurrences the shorter context weighs in a longer one.
PRIOR_NEAR, PRIOR_FAR = np.float32(1), np.float32(0.5)
GATES, BANDS, RATE = 8 * 5 * 4, 24, 0.02
REPEATS, BYTE_END, TOP = 20, 256, 31
#: What a held row adds to a sum of occurrences, which stays below it (2.7 * 10^11 under one context).
_HELD = 1 << 38
_K = np.uint64(0x9E3779B97F4A7C15)
_ODD_WORD, _BYTES = np.uint32(1 << 31), np.uint32(3 << 30)


@dataclass
class Tree:
    """A canonical prefix code over symbols with weights: short codes first, so that a node is known by depth and prefix.

    code: the path of each symbol, left-justified in TOP bits; size: its length; weight: of the symbol;
    base: what is added to a prefix at each depth to get its node; node_weight: of each inner node.
    """

    code: np.ndarray
    size: np.ndarray
    weight: np.ndarray
    base: np.ndarray
    node_weight: np.ndarray

    def above(self, sym: np.ndarray, code: np.ndarray, size: np.ndarray, depth: int) -> np.ndarray:
        """Weight of what lies below the node that each symbol's path passes at a depth; of the symbol itself at its end.

        code and size: of the symbols."""
        inside = size > depth
        at = code >> (TOP - depth)
        at += self.base[min(depth, len(self.base) - 1)]
        at *= inside
        out = self.node_weight[at]
        ended = np.flatnonzero(~inside)
        out[ended] = self.weight[sym[ended]]
        return out


def code_sizes(weights: np.ndarray) -> np.ndarray:
    """Lengths of Huffman codes, none above TOP: tiny weights are raised until that holds."""
    n = len(weights)
    floor = float(weights.sum()) / (1 << 24)
    while True:
        order = np.argsort(weights, kind="stable")
        leaf = np.maximum(weights[order], floor).tolist() + [np.inf, np.inf]
        made, up = [], [0] * (2 * n - 1)
        i = j = 0
        for k in range(n - 1):  # two queues: leaves by weight, and sums as they are made
            total = 0.0
            for _ in (0, 1):
                if j >= len(made) or leaf[i] <= made[j]:
                    total += leaf[i]
                    up[i] = n + k
                    i += 1
                else:
                    total += made[j]
                    up[n + j] = n + k
                    j += 1
            made.append(total)
        depth = [0] * (2 * n - 1)
        for k in range(2 * n - 3, -1, -1):
            depth[k] = depth[up[k]] + 1
        size = np.zeros(n, np.int64)
        size[order] = depth[:n]
        if size.max(initial=0) <= TOP:
            return size
        floor *= 16


def tree(weights: np.ndarray) -> Tree:
    """The code of at least two symbols with positive weights."""
    weights = weights.astype(float)
    size = code_sizes(weights)
    order = np.lexsort((np.arange(len(size)), size))
    deepest = int(size.max())
    leaves = np.bincount(size, minlength=deepest + 1)
    code, first, at = np.zeros(len(size), np.int64), 0, 0
    start = np.zeros(deepest + 1, np.int64)
    for d in range(1, deepest + 1):
        first = (first + int(leaves[d - 1])) * 2
        start[d] = first
        own = order[at : at + leaves[d]]
        code[own] = (first + np.arange(len(own))) << (TOP - d)
        at += len(own)
    inner = [(1 << d) - int(start[d]) - int(leaves[d]) for d in range(deepest)]
    begin = np.append(0, np.cumsum(inner))
    parts, below, at = [None] * deepest, np.zeros(0), len(order)
    for d in range(deepest, 0, -1):
        row = np.concatenate([weights[order[at - leaves[d] : at]], below])
        at -= leaves[d]
        below = row[0::2] + row[1::2]
        parts[d - 1] = below
    base = begin[:-1] - start[:deepest] - leaves[:deepest]
    return Tree(code.astype(np.int32), size.astype(np.int32), weights.astype(np.float32), base.astype(np.int32), np.concatenate(parts).astype(np.float32))


@dataclass
class Code:
    """Symbols 0..n-1: words, the most frequent first; n: escape; n+1: end; then REPEATS: a rarer word of this text again, by
    the power of two of how many rarer words ago it was; from `spelt` on: bytes 0..255 and the end of a spelt word."""

    hashes: np.ndarray  # sorted
    rank: np.ndarray  # the symbol of each hash
    counts: np.ndarray  # of each symbol
    words: Tree
    bytes: Tree
    parts: int
    texts: int
    odd: int  # occurrences of words outside the dictionary
    rest_log: float  # log10 of the denominator of the base
    total: int
    part: int  # symbols of a part

    @property
    def hot(self) -> int:
        """Occurrences of a context from which it is split."""
        return max(1, self.part >> 2)

    @property
    def n(self) -> int:
        return len(self.hashes)

    @property
    def spelt(self) -> int:
        return self.n + 2 + REPEATS

    @cached_property
    def salts(self) -> np.ndarray:
        """Into how many contexts each word (and, last, the start of a text) is split as a context."""
        return (-(-np.append(self.counts, self.texts) // self.hot)).astype(np.uint64).clip(1)

    @cached_property
    def begin(self) -> tuple[int, np.ndarray]:
        """(shift, where the hashes with each value of their leading bits begin)."""
        bits = max(1, self.n.bit_length())
        edge = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
        return 64 - bits, np.searchsorted(self.hashes, edge).astype(np.int32)

    def look_up(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbol, whether the word is in the dictionary)."""
        if not self.n:
            return np.zeros(len(h), np.int32), np.zeros(len(h), bool)
        shift, begin = self.begin
        at = np.minimum(begin[(h >> np.uint64(shift)).astype(np.int64)], self.n - 1)
        there = self.hashes[at]
        left = np.flatnonzero(there < h)
        while len(left):  # few hashes share their leading bits
            at[left] += 1
            left = left[at[left] < self.n]
            there[left] = self.hashes[at[left]]
            left = left[there[left] < h[left]]
        at[at == self.n] = 0
        known = there == h
        return np.where(known, self.rank[at], 0), known

    def context(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        """The shorter context as one number; that of a frequent word is split by the word before it, so none has more than
        about `hot` occurrences, however large the corpus."""
        out = k1.astype(np.uint64) << np.uint64(32)
        by = np.append(self.salts, [1, max(1, self.odd // self.hot)]).astype(np.uint64)[np.where(k1 >= _BYTES, self.n + 2, np.minimum(k1, self.n + 1))]
        own = np.flatnonzero(by > 1)
        out[own] |= mix(k2[own].astype(np.uint64) * _K + np.uint64(1)) % by[own]
        return out

    def part_of(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        return (mix(self.context(k1, k2) * _K) % np.uint64(self.parts)).astype(np.int32)

    def steps(self, w: Words, h: np.ndarray, at: np.ndarray, known: np.ndarray, first_doc: int = 0) -> tuple[np.ndarray, ...]:
        """(document, symbol, both context words of every symbol, log2 of the parts of each document that no context predicts).

        at, known: see `look_up`."""
        docs = len(w.count)
        name = np.where(known, at.astype(np.uint32), (h >> np.uint64(34)).astype(np.uint32) | _ODD_WORD)
        sym = np.where(known, at, self.n).astype(np.int32)
        plain = np.zeros(docs)
        odd = np.flatnonzero(~known)
        order = np.lexsort((odd, h[odd], w.doc[odd]))
        again = np.flatnonzero((h[odd][order][1:] == h[odd][order][:-1]) & (w.doc[odd][order][1:] == w.doc[odd][order][:-1])) + 1
        if len(again):
            ago = order[again] - order[again - 1]
            power = np.minimum(np.log2(ago + 0.5).astype(np.int64), REPEATS - 1)
            sym[odd[order[again]]] = self.n + 2 + power
            far = np.maximum(power, np.log2(ago).astype(np.int64))  # beyond the last power: as many bits as it takes
            plain -= np.bincount(w.doc[odd[order[again]]], far, docs)
        slot = np.arange(len(h)) + w.doc
        total = len(h) + docs
        out = np.full(total, self.n + 1, np.int32)
        out[slot] = sym
        past = np.zeros(total + 2, np.uint32)
        past[2:][slot] = name
        k1, k2 = past[1:-1].copy(), past[:-2].copy()
        first = np.append(0, np.cumsum(w.count + 1))[:-1]
        k1[first] = self.n  # the start of a text, split by the text
        k2[first] = (first_doc + np.arange(docs)) % int(self.salts[-1])
        later = first[w.count > 0] + 1
        k2[later] = self.n
        doc = np.repeat(np.arange(docs, dtype=np.int32), w.count + 1)
        odd = np.flatnonzero(sym == self.n)
        if len(odd):
            length = (w.end - w.start)[odd] + 1
            begin = np.append(0, np.cumsum(length))
            inside = np.arange(begin[-1]) - np.repeat(begin[:-1], length)
            data = w.data[np.minimum(np.repeat(w.start[odd], length) + inside, len(w.data) - 1)].astype(np.int32)
            data[begin[1:] - 1] = BYTE_END
            back = np.zeros((4, len(data)), np.uint32)
            for k in range(4):  # 0: before the word
                live = inside > k
                back[k, live] = data[np.flatnonzero(live) - k - 1] + 1
            out = np.append(out, self.spelt + data)
            doc = np.append(doc, np.repeat(w.doc[odd].astype(np.int32), length))
            k1 = np.append(k1, _BYTES | back[0] << np.uint32(9) | back[1])
            k2 = np.append(k2, back[2] << np.uint32(9) | back[3])
        return doc, out, k1, k2, plain


def word_counts(texts: DataFrame) -> DataFrame:
    """(h, n, byte) over a column of texts: how often each word comes, and (byte true, h the byte) each byte of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        letters, size = np.zeros(256, np.int64), 0

        def out() -> pa.RecordBatch:
            uniq, where = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
            n = np.bincount(where, np.concatenate([n for _, n in held])).astype(np.int64)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(uniq.view(np.int64)), pa.array(n), pa.array(np.zeros(len(n), bool))], ["h", "n", "byte"])

        for batch in batches:
            text = strings(batch.column(0))
            for lo, hi in groups(text):
                w = Words(text, lo, hi, True)
                letters += np.bincount(w.data, minlength=256)
                held.append(np.unique(w.hashes(), return_counts=True))
                size += len(held[-1][0])
                if size > 1_000_000:
                    yield out()
                    size = 0
        if held:
            yield out()
        seen = np.flatnonzero(letters)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(letters[seen]), pa.array(np.ones(len(seen), bool))], ["h", "n", "byte"])

    return texts.mapInArrow(run, "h long, n long, byte boolean").groupBy("byte", "h").agg(F.sum("n").alias("n"))


def most_frequent(words: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts) of the `size` most frequent words, of equally frequent ones those with the smallest hash parts.

    No sort and no single task: a histogram of the counts tells the least count, one of hash parts where its words end.
    """
    level = F.when(F.col("n") < 4096, F.col("n")).otherwise(4096 + F.floor(F.log2(F.col("n") / 4096.0) * 64)).cast("int")
    part = F.shiftrightunsigned("h", 52).cast("int")
    rows = words.withColumn("level", level)
    tally = sorted(((r["level"], r["n"]) for r in rows.groupBy("level").agg(F.count("*").alias("n")).collect()), reverse=True)
    left, least = size, 0
    for k, n in tally:
        if n > left:
            least = k
            break
        left -= n
    keep = F.col("level") > least
    if least:
        cut = 0
        for k, n in sorted((r["part"], r["n"]) for r in rows.where(F.col("level") == least).groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()):
            if n > left:
                break
            left, cut = left - n, k + 1
        keep = keep | ((F.col("level") == least) & (part < cut))
    got = rows.where(keep).select("h", "n").toArrow()  # at most `size` rows
    return got.column("h").to_numpy().view(np.uint64), got.column("n").to_numpy().astype(np.int64)


def make_code(h: np.ndarray, n: np.ndarray, odd: int, texts: int, letters: np.ndarray, total: int = 0, kinds: int = 0, parts: int = 1, part: int | None = None) -> Code:
    """The dictionary and both trees. odd: occurrences of other words; texts: training texts, an end each."""
    by_count = np.lexsort((h, -n))
    h, n = h[by_count], n[by_count]
    rank = np.argsort(h)
    rest = max(1, odd)
    weights = np.concatenate([n, [rest, max(1, texts)], np.maximum(1, rest / (4.0 * np.arange(1, REPEATS + 1) ** 2))])
    spelt = np.append(letters + 1, max(1, letters.sum() // 8))
    return Code(h[rank], rank.astype(np.int32), n, tree(weights), tree(spelt), parts, texts, rest, float(np.log10(total + 0.5 * (kinds + 1))), total, part or PART)


def build_code(counts: DataFrame, texts: int) -> Code:
    """counts: of the training texts (see `word_counts`); texts: how many there are."""
    words = counts.where("not byte")
    whole = words.agg(F.count("*").alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    h, n = most_frequent(words.where("n > 1"), DICTIONARY)
    letters = np.zeros(256, np.int64)
    for r in counts.where("byte").collect():
        letters[r["h"]] = r["n"]
    total, kinds = int(whole["n"]) + texts, int(whole["v"]) + (texts > 0)
    part = min(max(PART, total // PARTS), 4 * PART)
    return make_code(h, n, int(whole["n"]) - int(n.sum()), texts, letters, total, kinds, max(1, -(-total // part)), part)


def _press(*columns: np.ndarray) -> bytes:
    """Columns of one length, byte plane by byte plane, compressed."""
    planes = [np.ascontiguousarray(c.view(np.uint8).reshape(len(c), -1).T).tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _expand(blob: bytes, *kinds: str) -> list[np.ndarray]:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    widths = [np.dtype(k).itemsize for k in kinds]
    n, at, out = len(data) // sum(widths), 0, []
    for k, width in zip(kinds, widths, strict=True):
        out.append(np.ascontiguousarray(data[at : at + n * width].reshape(width, n).T).view(k).ravel())
        at += n * width
    return out


_ROW = ("<u4", "<u4", "<u4", "<u2", "<u4", "<u4")  # both context words, symbol, text, occurrences in it, of these learned from
_META = ("<u2", "<i8", "<u1", "<i8", "<i8", "<f8", "<f8", "<i8")  # text, doc_id, its null mark, tokens, known, base, plain log, bytes
_RARE = ("<u2", "<i8", "<u4")  # text, hash, occurrences
_SUM = ("<u2", "<f4")
ROWS, META, RARE, SUMS = range(4)
_SENT = "part int, chunk long, kind int, blob binary"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.int32(), pa.binary()), strict=True)], ["part", "chunk", "kind", "blob"])


def send(rows: DataFrame, code) -> DataFrame:
    """(part, chunk, kind, blob) of rows (doc_id, text, learn). code: a broadcast Code.

    A chunk is what a task has gathered between two sendings: as many symbols as a part is meant for, or one longer text.
    Equal texts of a chunk are sent once, with how many they are; those that are learned from and those that are not apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c: Code = code.value
        chunk = TaskContext.get().partitionId() << 32
        held: list[tuple[np.ndarray, ...]] = []
        seen: dict[bytes, int] = {}
        learned: list[int] = []
        meta: list[tuple[np.ndarray, ...]] = []
        rare: list[tuple[np.ndarray, ...]] = []
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            home = int(chunk % c.parts)
            sent = [(home, chunk, META, _press(*(np.concatenate(v).astype(k) for v, k in zip(zip(*meta, strict=True), _META, strict=True))))]
            if rare:
                sent.append((home, chunk, RARE, _press(*(np.concatenate(v).astype(k) for v, k in zip(zip(*rare, strict=True), _RARE, strict=True)))))
            if held:
                doc, sym, k1, k2 = (np.concatenate(v) for v in zip(*held, strict=True))
                of = c.part_of(k1, k2)
                # by part and first context word; the last bits bring equal rows together
                last = mix(k2.astype(np.uint64) << np.uint64(32) | sym.astype(np.uint64)) + doc.astype(np.uint64) * _K
                order = np.argsort(of.astype(np.uint64) << np.uint64(48) | k1.astype(np.uint64) << np.uint64(16) | last >> np.uint64(48))
                doc, sym, k1, k2, of = (v[order] for v in (doc, sym, k1, k2, of))
                new = np.flatnonzero(np.append(True, (k1[1:] != k1[:-1]) | (doc[1:] != doc[:-1]) | (sym[1:] != sym[:-1]) | (k2[1:] != k2[:-1])))
                times = np.diff(np.append(new, len(doc))).astype(np.uint32)
                doc, sym, k1, k2, of = (v[new] for v in (doc, sym, k1, k2, of))
                counted = times * np.array(learned, np.uint32)[doc]
                cut = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
                near = np.diff(k1, prepend=np.uint32(0))  # sorted within a part, whose first stays whole
                near[cut] = k1[cut]
                for lo, hi in zip(cut.tolist(), [*cut[1:].tolist(), len(of)], strict=True):
                    sent.append((int(of[lo]), chunk, ROWS, _press(near[lo:hi], k2[lo:hi], sym[lo:hi].astype("<u4"), doc[lo:hi].astype("<u2"), times[lo:hi], counted[lo:hi])))
            held.clear(), seen.clear(), learned.clear(), meta.clear(), rare.clear()
            for lo in range(0, len(sent), 256):
                yield _batch(sent[lo : lo + 256])

        for batch in batches:
            text = strings(batch.column(1))
            ids, learn = batch.column(0), batch.column(2).fill_null(False).to_numpy(zero_copy_only=False)
            for lo, hi in groups(text):
                if len(seen) + hi - lo > 60_000:
                    yield from out()
                    chunk, size = chunk + 1, 0
                w = Words(text, lo, hi, True)
                h = w.hashes()
                at, known = c.look_up(h)
                m = hi - lo
                rep, new = np.zeros(m, np.int64), np.zeros(m, bool)
                for i in range(m):
                    mark = hashlib.blake2b(w.data[w.at[i] : w.at[i + 1]], digest_size=16).digest() + bytes([int(learn[lo + i])])
                    new[i] = mark not in seen
                    rep[i] = seen.setdefault(mark, len(seen))
                    if new[i]:
                        learned.append(0)
                    learned[rep[i]] += int(learn[lo + i])
                doc, sym, k1, k2, plain = c.steps(w, h, at, known, len(seen))
                own = new[doc]
                held.append((rep[doc[own]].astype(np.uint32), sym[own], k1[own], k2[own]))
                size += int(own.sum())
                base = np.bincount(w.doc[known], np.log10(c.counts[at[known]] + 0.5), m) - (w.count + 1) * c.rest_log + np.log10(c.texts + 0.5)
                sure = np.bincount(w.doc[known], minlength=m) + int(c.texts > 0)
                none = ids.slice(lo, m).is_null().to_numpy(zero_copy_only=False)
                meta.append((rep, ids.slice(lo, m).fill_null(0).to_numpy(zero_copy_only=False), none, w.count + 1, sure, base, plain * np.log10(2.0), np.diff(w.at)))
                odd = np.flatnonzero(~known & new[w.doc])
                if len(odd):  # words outside the dictionary, each once for a text
                    odd = odd[np.lexsort((h[odd], w.doc[odd]))]
                    one = np.flatnonzero(np.append(True, (h[odd][1:] != h[odd][:-1]) | (w.doc[odd][1:] != w.doc[odd][:-1])))
                    rare.append((rep[w.doc[odd[one]]], h[odd[one]].view(np.int64), np.diff(np.append(one, len(odd)))))
                if size > c.part:
                    yield from out()
                    chunk, size = chunk + 1, 0
        if meta:
            yield from out()

    return rows.mapInArrow(run, _SENT)


def _same(key: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(where the rows begin that share a key down to a depth, the number of each row's group). Keys end in TOP bits of code."""
    key = key >> (TOP - depth)
    edge = np.empty(len(key), bool)
    edge[:1] = True
    np.not_equal(key[1:], key[:-1], out=edge[1:])
    return np.flatnonzero(edge), np.cumsum(edge) - 1


def bits_of(t: Tree, near: np.ndarray, far: np.ndarray, sym: np.ndarray, n: np.ndarray, held: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """(row, count of the shorter context at the node, on the bit taken, the same of the longer one, share of the bit taken by
    weights) of all bits that a context has seen, each row's natural log of the rest of its path, and the bits of each depth.

    Rows are whole contexts, sorted by near, far and code. A longer context lies within its shorter one. held: the rows that are
    predicted by all counts (without it, all rows). A path ends also where one occurrence that is learned from has come alone and
    no held row passes: without itself, no context has seen what follows. Bits come depth by depth, from the top of each row.
    """
    code, n = t.code[sym], n.astype(np.int64)
    both = n + (_HELD if held is None else held * _HELD)  # one sum tells occurrences and held rows
    near, far = (np.cumsum(np.append(False, k[1:] != k[:-1])).astype(np.int64) << TOP | code for k in (near, far))
    rows = np.argsort(near)  # by shorter context and code
    place = np.empty(len(rows), np.int64)
    place[rows] = np.arange(len(rows))
    # the longer contexts at whose node several rows are; elsewhere the row's own occurrences are all
    far_at, far_n = place, n
    near, both, n, sym, code = (v[rows] for v in (near, both, n, sym, code))
    size, weight = t.size[sym], t.weight[sym]
    rest, out = np.zeros(len(sym)), []

    def counts(depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        nonlocal far, far_at, far_n
        begin, of = _same(near, depth)
        a = np.add.reduceat(both, begin)
        lone = (a == 1) | (a & (_HELD - 1) == 0)
        a = (a & (_HELD - 1)).astype(np.float32)[of]
        b = n.astype(np.float32)
        if len(far):
            begin, group = _same(far, depth)
            b[far_at] = np.add.reduceat(far_n, begin)[group]
            many = np.flatnonzero((np.diff(np.append(begin, len(far))) > 1)[group])
            far, far_at, far_n = far[many], far_at[many], far_n[many]
        return a, b, lone[of]

    depth = 0
    c1, c2, lone = counts(0)
    above = t.above(sym, code, size, 0)
    while len(rows):
        live = size > depth
        ended = np.flatnonzero(live & lone)
        rest[rows[ended]] = np.log(weight[ended] / above[ended])
        live &= ~lone
        if not live.all():
            kept = np.flatnonzero(live)
            if not len(kept):
                break
            if len(far):
                stay = np.flatnonzero(live[far_at])
                far, far_n = far[stay], far_n[stay]
                far_at = (np.cumsum(live) - 1)[far_at[stay]]
            rows, near, both, sym, code, n, size, weight, c1, c2, above = (v[kept] for v in (rows, near, both, sym, code, n, size, weight, c1, c2, above))
        depth += 1
        d1, d2, lone = counts(depth)
        below = t.above(sym, code, size, depth)
        out.append((rows, c1, d1, c2, d2, below / above))
        c1, c2, above = d1, d2, below
    if not out:
        return np.zeros(0, np.int64), *(np.zeros(0, np.float32) for _ in range(5)), rest, np.zeros(0, np.int64)
    return *(np.concatenate(v) for v in zip(*out, strict=True)), rest, np.array([len(v[0]) for v in out])


def _level(c: np.ndarray, most: int) -> np.ndarray:
    """How many binary digits a count (a float32 from 0 on) has, at most `most`: what its exponent says."""
    return np.clip((c.view(np.int32) >> 23) - 126, 0, most)


@dataclass
class Mixer:
    """Gated weights of the three log-odds and, after them, corrections by how sure the mixture is. All are odd in the bit, so
    a bit may be looked at from the side that was taken."""

    weights: np.ndarray = field(default_factory=lambda: np.tile(np.array([0, 0, 1], np.float32), (GATES, 1)))
    fixes: np.ndarray = field(default_factory=lambda: np.zeros(10 * BANDS, np.float32))
    w_seen: np.ndarray = field(default_factory=lambda: np.full((GATES, 3), 1e-3))
    f_seen: np.ndarray = field(default_factory=lambda: np.full(10 * BANDS, 1e-3))

    @staticmethod
    def inputs(c1, d1, c2, d2, share) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(log-odds of the bit taken by three predictors, gate, row of the corrections)."""
        near = (d1 + PRIOR_NEAR * share) / (c1 + PRIOR_NEAR)
        far = (d2 + PRIOR_FAR * near) / (c2 + PRIOR_FAR)
        x = np.stack([share, near, far])
        np.clip(x, 1e-6, 1 - 1e-6, out=x)
        x /= 1 - x
        np.log(x, out=x)
        one, two = _level(c1, 7), _level(c2, 4)
        sure1, sure2 = (d1 == 0) | (d1 == c1), (d2 == 0) | (d2 == c2)
        return x, ((one * 5 + two) * 2 + sure1) * 2 + sure2, two * 2 + sure2

    def mixed(self, x: np.ndarray, gate: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log-odds of the bit taken, cell of the correction)."""
        z = self.weights[:, 0].take(gate) * x[0]
        z += self.weights[:, 1].take(gate) * x[1]
        z += self.weights[:, 2].take(gate) * x[2]
        cell = np.minimum(np.abs(z) * 2, BANDS - 1).astype(np.int64)
        cell += row * BANDS
        z += np.sign(z) * self.fixes.take(cell)
        return np.clip(z, -18, 18, out=z), cell

    def learn(self, x: np.ndarray, gate: np.ndarray, row: np.ndarray, times: np.ndarray) -> None:
        """Online: predicts a block of bits, then moves weights and corrections against their errors."""
        for lo in range(0, len(gate), BLOCK):
            own = slice(lo, lo + BLOCK)
            z, cell = self.mixed(x[:, own], gate[own], row[own])
            miss = times[own] / (1 + np.exp(z))
            for k in range(3):
                g = np.bincount(gate[own], miss * x[k, own], GATES)
                self.w_seen[:, k] += g * g
                self.weights[:, k] += (RATE * g / np.sqrt(self.w_seen[:, k])).astype(np.float32)
            g = np.bincount(cell, miss * np.sign(z), len(self.fixes))
            self.f_seen += g * g
            self.fixes += (RATE * g / np.sqrt(self.f_seen)).astype(np.float32)

    def logs(self, x: np.ndarray, gate: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Natural log of the probability of each bit taken."""
        return -np.log1p(np.exp(-self.mixed(x, gate, row)[0].astype(float)))


def predict(t: Tree, near: np.ndarray, far: np.ndarray, sym: np.ndarray, n: np.ndarray, held: np.ndarray, mixer: Mixer) -> tuple[np.ndarray, np.ndarray]:
    """Natural log of the probability of each row's symbol, by all counts (where held) and without one occurrence of itself
    (where n is above 0); rows as in `bits_of`. The mixer learns from all of the latter first."""
    row, c1, d1, c2, d2, share, logs, depths = bits_of(t, near, far, sym, n, held)
    fresh, own = logs.copy(), (n > 0)[row]
    # the bits that are learned from: rows in the order of a hash, each from the top down; its bits are the first ones of its path
    taught = np.flatnonzero(own & (c1 > 1))
    of = row[taught]
    order = np.argsort(mix(np.arange(len(n), dtype=np.uint64)))
    size = np.bincount(of, minlength=len(n))[order]
    begin = np.cumsum(size) - size
    place = np.empty(len(n), np.int64)
    place[order] = begin
    place = place[of]
    place += np.repeat(np.arange(len(depths)), np.diff(np.searchsorted(taught, np.append(0, np.cumsum(depths)))))
    bit = np.empty(len(of), np.int64)
    bit[place] = taught
    times = np.repeat(n[order].astype(np.float32), size)
    seen = []  # looked at twice: to learn, and with what has been learned
    for lo in range(0, len(bit), SLICE):
        at = bit[lo : lo + SLICE]
        seen.append(mixer.inputs(c1[at] - 1, d1[at] - 1, c2[at] - 1, d2[at] - 1, share[at]))
        mixer.learn(*seen[-1], times[lo : lo + SLICE])
    if seen:
        some = size > 0
        fresh[order[some]] += np.add.reduceat(np.concatenate([mixer.logs(*v) for v in seen]), begin[some])
    alone = np.flatnonzero(own & (c1 == 1))  # nobody else has been here
    fresh += np.bincount(row[alone], np.log(share[alone]), len(logs))
    asked = np.flatnonzero(held[row])
    for lo in range(0, len(asked), SLICE):
        at = asked[lo : lo + SLICE]
        logs += np.bincount(row[at], mixer.logs(*mixer.inputs(c1[at], d1[at], c2[at], d2[at], share[at])), len(logs))
    return logs, fresh


def score_part(code: Code, k1: np.ndarray, k2: np.ndarray, sym: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Natural log of the probability of each row's symbol. n: occurrences that are learned from, summed over equal rows here;
    a row that is itself learned from (n above 0) is predicted without one occurrence of itself."""
    logs = np.zeros(len(sym))
    for t, own, first in ((code.words, np.flatnonzero(sym < code.spelt), 0), (code.bytes, np.flatnonzero(sym >= code.spelt), code.spelt)):
        if not len(own):
            continue
        s = sym[own].astype(np.int64) - first
        # a hash of the context: 36 bits of the shorter one, then 28 bits of the word before it
        key = mix(code.context(k1[own], k2[own]) * _K) & ~np.uint64((1 << 28) - 1) | mix(k2[own].astype(np.uint64) + _K) >> np.uint64(36)
        order = np.argsort(key)
        key = key[order]
        far = np.cumsum(np.append(False, key[1:] != key[:-1])).astype(np.int64) << TOP
        far |= t.code[s[order]]
        by_code = np.argsort(far)
        order, key, far = order[by_code], key[by_code], far[by_code]
        new = np.append(True, far[1:] != far[:-1])
        where = np.empty(len(own), np.int64)
        where[order] = np.cumsum(new) - 1
        one = np.flatnonzero(new)
        s, near, far = s[order[one]], (key[one] >> np.uint64(28)).astype(np.int64), far[one] >> TOP
        total = np.bincount(where, n[own], len(one)).astype(np.int64)
        del key, order, by_code, new
        held = np.bincount(where, n[own] == 0, len(one)) > 0
        got, fresh, mixer, lo = np.zeros(len(one)), np.zeros(len(one)), Mixer(), 0
        edge = np.append(np.flatnonzero(near[1:] != near[:-1]) + 1, len(near))
        while lo < len(one):  # whole contexts, about SLICE rows at once
            hi = int(edge[min(np.searchsorted(edge, lo + SLICE), len(edge) - 1)])
            got[lo:hi], fresh[lo:hi] = predict(t, near[lo:hi], far[lo:hi], s[lo:hi], total[lo:hi], held[lo:hi], mixer)
            lo = hi
        logs[own] = np.where(n[own] > 0, fresh[where], got[where])
    return logs


@scoped
def score(docs: DataFrame, learn) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte of every whole text.

    learn: a condition on doc_id that says which rows are learned from; others, and rows with a null id, are held out
    (held_out is true for a null id). A row that is learned from is scored by what the other rows teach. A null text is empty: the end alone. Rows with a repeated id are rows of their own.
    Without training rows every word is unknown and is spelt by evenly weighted bytes. An empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = bounded(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("learn", F.coalesce(learn(F.col("doc_id")), F.lit(False)))
    own = rows.where("learn")
    counts = stage(word_counts(own.select("text")), "words")
    code = spark.sparkContext.broadcast(build_code(counts, own.count()))

    def run(t: pa.Table) -> pa.Table:
        c, out = code.value, []
        kind, chunk, blob = t.column("kind").to_numpy(), t.column("chunk").to_numpy(), t.column("blob")
        at = np.flatnonzero(kind == ROWS)
        at = at[np.argsort(chunk[at], kind="stable")]
        if len(at):
            parts = [_expand(blob[i].as_py(), *_ROW) for i in at.tolist()]
            k1, k2, sym, doc, times, n = (np.concatenate(v) for v in zip(*((np.cumsum(p[0], dtype=np.uint32), *p[1:]) for p in parts), strict=True))
            logs = score_part(c, k1, k2, sym, n) * times
            cut = np.append(0, np.cumsum([len(p[0]) for p in parts]))
            for i, lo, hi in zip(at.tolist(), cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                texts, where = np.unique(doc[lo:hi], return_inverse=True)
                out.append((0, int(chunk[i]), SUMS, _press(texts, np.bincount(where, logs[lo:hi]).astype("<f4"))))
        out += [(0, int(chunk[i]), int(kind[i]), blob[i].as_py()) for i in np.flatnonzero(kind != ROWS).tolist()]
        return pa.Table.from_batches([_batch(out)])

    told = stage(send(rows, code).groupBy("part").applyInArrow(run, _SENT), "scored")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rep, h, n = _expand(blob.as_py(), *_RARE)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), chunk)), pa.array(rep.astype(np.int64)), pa.array(h), pa.array(n.astype(np.int64))], ["chunk", "rep", "h", "n"])

    def whole(t: pa.Table) -> pa.Table:
        kind, blob = t.column("kind").to_numpy(), t.column("blob")
        rep, ids, none, tokens, known, base, plain, size = (np.concatenate(v) for v in zip(*(_expand(blob[i].as_py(), *_META) for i in np.flatnonzero(kind == META).tolist()), strict=True))
        total = np.zeros(int(rep.max()) + 1)
        for i in np.flatnonzero(kind == SUMS).tolist():
            texts, s = _expand(blob[i].as_py(), *_SUM)
            total[texts] += s.astype(float)
        s = total[rep] / np.log(10) + plain
        ids = pa.array(ids, mask=none.astype(bool))
        return pa.table({"chunk": np.full(len(rep), t.column("chunk")[0].as_py()), "rep": rep.astype(np.int64), "doc_id": ids, "n_tokens": tokens, "known": known, "base": base, "score": s, "n_bytes": size})

    rare = told.where(F.col("kind") == RARE).select("chunk", "blob").mapInArrow(spread, "chunk long, rep long, h long, n long")
    rare = rare.join(counts.where("not byte").select("h", F.col("n").alias("c")), "h", "left")
    c = F.coalesce(F.col("c"), F.lit(0))
    more = rare.groupBy("chunk", "rep").agg(F.sum(F.col("n") * F.log10(c + 0.5)).alias("more"), F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("also"))
    each = told.where(F.col("kind").isin(META, SUMS)).groupBy("chunk").applyInArrow(whole, "chunk long, rep long, doc_id long, n_tokens long, known long, base double, score double, n_bytes long")
    out = each.join(more, ["chunk", "rep"], "left")
    return out.select(
        "doc_id", (~F.coalesce(learn(F.col("doc_id")), F.lit(False))).alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce(F.col("also"), F.lit(0))).alias("n_known"), F.lit(code.value.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce(F.col("more"), F.lit(0.0))).alias("base_score"), "score",
        (-F.col("score") / F.log10(F.lit(2.0)) / F.greatest(F.col("n_bytes"), F.lit(1))).alias("bits_per_byte"),
    )


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents, learned from where crc32 of the id is not 1 modulo 5; see `score` for nulls and repeats."""
    return score(table(spark, sf_dir, "documents"), lambda c: crc_mod(c, 5) != 1)


QUERIES = {"op10_lm_score": op10_lm_score}
