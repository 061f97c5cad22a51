"""BPE encoding and decoding with a word-end vocabulary, in batched numpy merge rounds.

The symbols of all new words of a batch lie in one flat array. A round looks up every neighbouring pair in the sorted
pair keys by binary search, takes each word's lowest rank, and merges that pair wherever it stands in the word. Words
are looked up once in a task: texts repeat their words far more often than they bring new ones.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffloom.llm.common import bounded, groups, strings, table
from tariffloom.llm.packing import byte_alphabet

#: Words that a task remembers, and their bytes; when full, it starts again.
REMEMBERED, REMEMBERED_BYTES = 300_000, 16 << 20
_NONE = np.int64(1) << 40

_models: dict[int, WordBpe] = {}


class Known(dict):
    """Words with what is known of them, and how many characters they have."""

    size = 0


class WordBpe:
    """A BPE model with a word-end mark, NFC and lower-case normalisation, and a splitting pattern whose matches are words.

    Text that no pattern match covers (white space) is dropped. Added tokens are found in the raw text first.
    """

    def __init__(self, spec: str):
        d = json.loads(spec)
        model = d["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.mark = model.get("end_of_word_suffix") or ""
        steps = [s["type"] for s in (d["normalizer"] or {"normalizers": []})["normalizers"]]
        split = next(s for s in d["pre_tokenizer"]["pretokenizers"] if s["type"] == "Split")
        if not set(steps) <= {"NFC", "Replace", "Lowercase"} or split["behavior"] != "Removed" or not split["invert"]:
            raise ValueError("not a word BPE of the kind read here")
        # \s as in the vocabulary's own library: the Unicode property, without the control characters 1C to 1F
        self.words = regex.compile(split["pattern"]["Regex"].replace(r"[^\s", r"[^\p{White_Space}")).findall
        self.nfc, self.lower = "NFC" in steps, "Lowercase" in steps
        self.added = {a["content"]: a["id"] for a in d["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")").split if self.added else None
        n = max([*self.vocab.values(), *self.added.values()]) + 1
        self.names = [""] * n
        for t, i in (self.vocab | self.added).items():
            self.names[i] = t
        by_byte = {b: c for c, b in byte_alphabet().items()}
        self.first = np.array([self.vocab.get(by_byte[b], -1) for b in range(256)], np.int64)
        self.last = np.array([self.vocab.get(by_byte[b] + self.mark, -1) for b in range(256)], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.size = np.int64(n)
        keys = np.array([self.vocab[a] * n + self.vocab[b] for a, b in pairs], np.int64)
        into = np.array([self.vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.into = keys[order], order.astype(np.int64), into[order]

    def split(self, text: str) -> list[str]:
        """The words of a text; an added token stands for itself."""
        parts = self.cut(text) if self.cut else [text]
        out: list[str] = []
        for k, part in enumerate(parts):
            if k % 2:
                out.append(part)
                continue
            if self.nfc and not part.isascii():
                part = unicodedata.normalize("NFC", part)
            if self.lower:  # letter by letter: a final sigma is no special case
                part = part.replace("Σ", "σ").lower()
            out += self.words(part)
        return out

    def merge(self, words: list[str]) -> list[np.ndarray]:
        """The ids of each word."""
        raw = [w.encode() for w in words]
        size = np.array([len(r) for r in raw], np.int64)
        flat = np.frombuffer(b"".join(raw), np.uint8)
        sym = self.first[flat]
        ends = np.cumsum(size)
        sym[ends - 1] = self.last[flat[ends - 1]]
        word = np.repeat(np.arange(len(words)), size)
        keep = sym >= 0  # a byte without a symbol is dropped, as there is no token for the unknown
        sym, word = sym[keep], word[keep]
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym):
            same = word[1:] == word[:-1]
            key = sym[:-1] * self.size + sym[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where(same & (self.keys[at] == key), self.rank[at], _NONE) if len(self.keys) else np.full(len(key), _NONE)
            rank = np.append(rank, _NONE)
            starts = np.flatnonzero(np.append(True, ~same))
            low = np.minimum.reduceat(rank, starts)
            of = np.repeat(low, np.diff(np.append(starts, len(sym))))
            live = of < _NONE
            if not live.all():
                done.append((word[~live], sym[~live]))
            hit = live & (rank == of)
            # in a run of equal symbols every second pair merges, from the left
            pos = np.flatnonzero(hit)
            fresh = np.append(True, np.diff(pos) > 1)
            run = pos[np.flatnonzero(fresh)][np.cumsum(fresh) - 1] if len(pos) else pos
            pos = pos[(pos - run) % 2 == 0]
            sym[pos] = self.into[at[pos]]
            live[pos + 1] = False
            sym, word = sym[live], word[live]
        ids = np.concatenate([s for _, s in done]) if done else np.zeros(0, np.int64)
        of = np.concatenate([w for w, _ in done]) if done else np.zeros(0, np.int64)
        order = np.argsort(of, kind="stable")
        return np.split(ids[order], np.searchsorted(of[order], np.arange(1, len(words))))

    def learn(self, words: list[str], known: Known) -> None:
        """Adds (number of ids, ids as text, decoded text) of the words that are not known."""
        new = [w for w in set(words) if w not in known]
        if not new:
            return
        if len(known) + len(new) > REMEMBERED or known.size + sum(map(len, new)) > REMEMBERED_BYTES:
            known.clear()
            known.size, new = 0, list(set(words))
        known.size += sum(map(len, new))
        for w in [w for w in new if w in self.added]:
            known[w] = (1, str(self.added[w]), w)
        new = [w for w in new if w not in self.added]
        for w, ids in zip(new, self.merge(new) if new else [], strict=True):
            row = ids.tolist()
            known[w] = (len(row), " ".join(map(str, row)), " ".join([self.names[i] for i in row]))

    def encode(self, text: str) -> list[int]:
        words = self.split(text)
        known = Known()
        self.learn(words, known)
        return [int(i) for w in words for i in known[w][1].split()]

    def decode(self, ids: list[int]) -> str:
        """As a vocabulary without a decoder does: the tokens with a space between them; ids out of range are left out."""
        return " ".join([self.names[i] for i in ids if 0 <= i < self.size])


def model(spec: str) -> WordBpe:
    key = hash(spec)
    if key not in _models:
        _models[key] = WordBpe(spec)
    return _models[key]


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Encodes and decodes whole texts: id, n_tokens, ids_text (decimal ids with spaces), decoded, both hashes and, if asked, ids.

    A null text is empty and has no tokens. Rows with a null or repeated id are rows of their own; other columns are left out.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, known = model(spec.value), Known()
        for batch in batches:
            ids, texts = batch.column(0), strings(batch.column(1))
            for lo, hi in groups(texts):
                part = [bpe.split(t) for t in texts.slice(lo, hi - lo).to_pylist()]
                bpe.learn([w for words in part for w in words], known)
                rows = []
                for words in part:
                    got = [x for x in map(known.__getitem__, words) if x[0]]
                    text, back = " ".join([x[1] for x in got]), " ".join([x[2] for x in got])
                    rows.append((sum([x[0] for x in got]), hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest(), *([[int(i) for i in text.split()], back] if with_ids else [])))
                kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.string()]
                names = ["n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
                cols = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=False)]
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), *cols], ["doc_id", *names[: len(cols)]])

    return bounded(docs).select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<long>, decoded string" if with_ids else ""))


def decode(encoded: DataFrame, tokenizer_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The texts of id lists; a null list is empty, null ids and ids out of range are left out."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = encoded.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(spec.value)
        for batch in batches:
            back = [bpe.decode([i for i in ids or [] if i is not None]) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(back, pa.string())], ["doc_id", "decoded"])

    return bounded(encoded).select(F.col(id_col).cast("long"), F.col(ids_col).cast("array<long>")).mapInArrow(run, "doc_id long, decoded string")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents; null ids and repeated ids stay, a null text has no tokens."""
    import public_tokenizers

    return encode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


QUERIES = {"op9_bpe": op9_bpe}
