"""Secret scans: three base kinds by pattern, and random-looking strings by sliding-window Shannon entropy.

Candidate strings are runs of key characters. A window moves over each; the counts of its characters change by one in
and one out, and with them the sum of c * log2(c), from which the entropy follows. The limit depends on the character
class of the window (hex digits, letters, letters and digits, all base-64 characters). Windows that overlap make one span, so
plain text between two keys of a string is no part of either. Allow-listed strings (digests after a known prefix, UUIDs, paths and
strings that are plain words) are suppressed, and so are spans that are mostly a placeholder; what the base patterns find
stays in any case.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffloom.llm.common import bounded, table

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # the greedy run from the leftmost AKIA, 18 characters or more
HEX = re.compile(r"[0-9a-f]{16,}")  # whole runs: a run is matched from its first character on
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WINDOW = 20
#: Bits a character from which a window of this class counts as random.
LIMITS = {"hex": 3.0, "alnum": 3.7, "base64": 3.9, "letters": 4.05}
#: Strings that are never reported by entropy alone.
ALLOW = [
    re.compile(r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"),
    re.compile(r"(?i)(sha(1|224|256|384|512)|md5)[-_=].*"),
    re.compile(r"[A-Za-z]*[/_-]?([a-z]{2,}[/_-])+[a-z]*"),
    re.compile(r"[A-Za-z]?[a-z]*|[A-Z]+|[0-9]+|[-_=+/]+"),
]
#: Parts of made-up keys. A span of which they are half or more is not reported.
PLACEHOLDER = re.compile(r"(?i)example|placeholder|changeme|xxxxxxxx|00000000|abcdefgh|12345678")

_CLOG = [0.0, 0.0, *(c * math.log2(c) for c in range(2, WINDOW + 1))]
_HEX_CHARS = frozenset("0123456789abcdef")


def class_of(counts: dict[str, int]) -> str:
    if all(c in _HEX_CHARS for c in counts):
        return "hex"
    if all(c.isalpha() for c in counts):
        return "letters"
    return "alnum" if all(c.isalnum() for c in counts) else "base64"


def random_windows(s: str, width: int = WINDOW) -> list[tuple[int, int]]:
    """Spans of s: maximal runs of overlapping windows whose entropy reaches the limit of their class. Letters must come in
    both cases; all other windows must hold digits as well as letters. Shorter strings have no window."""
    counts: dict[str, int] = {}
    total, digits, letters, capitals = 0.0, 0, 0, 0
    out: list[tuple[int, int]] = []
    for i, c in enumerate(s):
        n = counts.get(c, 0)
        total += _CLOG[n + 1] - _CLOG[n]
        counts[c] = n + 1
        digits += c.isdigit()
        letters += c.isalpha()
        capitals += c.isupper()
        if i >= width:
            old = s[i - width]
            n = counts[old]
            total += _CLOG[n - 1] - _CLOG[n]
            if n == 1:
                del counts[old]
            else:
                counts[old] = n - 1
            digits -= old.isdigit()
            letters -= old.isalpha()
            capitals -= old.isupper()
        if i >= width - 1 and letters and (digits or 0 < capitals < letters):
            bits = math.log2(width) - total / width
            if bits >= LIMITS["hex"]:
                kind = class_of(counts)
                if bits >= LIMITS[kind] and (digits or kind == "letters"):
                    lo = i - width + 1
                    if out and lo < out[-1][1]:
                        out[-1] = (out[-1][0], i + 1)
                    else:
                        out.append((lo, i + 1))
    return out


def made_up(s: str) -> bool:
    """Whether half of a span or more is placeholders."""
    return 2 * sum(m.end() - m.start() for m in PLACEHOLDER.finditer(s)) >= len(s)


def scan(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(base spans, all spans) of a text as (start, end, kind) in order of start, then of KINDS."""
    base = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end() - m.start(2) >= 12]
    base += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text)] if "AKIA" in text else []
    base += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    base.sort(key=lambda x: (x[0], x[2]))
    more = []
    for m in CANDIDATE.finditer(text):
        s = m.group()
        if any(a.fullmatch(s) for a in ALLOW):
            continue
        for a, b in random_windows(s):
            lo, hi = m.start() + a, m.start() + b
            if not made_up(s[a:b]) and not any(x <= lo and hi <= y for x, y, _ in base):
                more.append((lo, hi, 3))
    name = lambda xs: [(a, b, KINDS[k]) for a, b, k in xs]
    return name(base), name(sorted(base + more, key=lambda x: (x[0], x[2])))


def redact(text: str, spans: list[tuple[int, int, str]], mask: str = "[SECRET]") -> str:
    """The text with every span, or run of overlapping spans, replaced by the mask."""
    out, at = [], 0
    for lo, hi, _ in spans:
        if lo >= at:
            out += [text[at:lo], mask]
        at = max(at, hi)
    return "".join(out) + text[at:]


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scans whole texts: id, counts of the base kinds, base and spans (arrays of start, end, kind), and the redacted text.

    Offsets are code points, ends exclusive. A null text is empty: no spans, and its redacted text stays null. Rows with
    a null or repeated id are rows of their own; other columns are left out.
    """
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 500):
                rows = []
                for text in batch.column(1).slice(lo, 500).to_pylist():
                    base, found = scan(text or "")
                    n = [sum(k == kind for *_, k in base) for kind in KINDS[:3]]
                    dicts = [[{"start": a, "end": b, "kind": k} for a, b, k in xs] for xs in (base, found)]
                    rows.append((*n, *dicts, None if text is None else redact(text, found) if found else text))
                kinds = [pa.int64(), pa.int64(), pa.int64(), span, span, pa.string()]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, 500), *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True))], ["doc_id", "n_assign", "n_access", "n_hex", "base", "found", "redacted"])

    kind = "array<struct<start:long,end:long,kind:string>>"
    return bounded(docs).select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, f"doc_id long, n_assign long, n_access long, n_hex long, base {kind}, found {kind}, redacted string")


def redact_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All rows and columns of docs, with every span of the text masked; a null text stays null."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(at).to_pylist():
                found = scan(text)[1] if text else []
                out.append(redact(text, found) if found else text)
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(out, pa.string()), *batch.columns[at + 1 :]], batch.schema.names)

    return bounded(docs).mapInArrow(run, docs.schema)


def digest(spans):
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def base_digest(text: str) -> str:
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in scan(text)[0]).encode()).hexdigest()


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents, with null or repeated ids as they are; a null text has no spans; an empty table no rows."""
    out = scan_documents(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(digest("base").cast("binary"), 256).alias("base_sha256"), digest("found").alias("spans"))


# The contract's columns are the base spans' counts and digest; the entropy spans have no SQL form, so there is no twin.
QUERIES = {"op5_secret_scan": op5_secret_scan}
