"""Shapes of JSON documents: analysis rows, largest payloads, rare keys, and items that bring new keys."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tariffloom.functions import columns as C

MAX_DEPTH, MAX_ITEMS = 100, 10
ANALYSIS = "file_name string, source_name string, file_size long, level int, path string, path_group string, key string, top_level_key string, value string, value_dtype string, url_in_value boolean"
_URL = re.compile(C.URL)


def key_names(value, depth: int = 0, most: int | None = None) -> set[str]:
    """The distinct key names anywhere in a value; a value nested deeper than `most` (MAX_DEPTH) is an error, never cut."""
    if depth > (most or MAX_DEPTH):
        raise ValueError(f"a document is nested more than {most or MAX_DEPTH} levels deep")
    if isinstance(value, dict):
        return set(value).union(*(key_names(v, depth + 1, most) for v in value.values()))
    if isinstance(value, list):
        return set().union(*(key_names(v, depth + 1, most) for v in value))
    return set()


def complexity(value) -> tuple[int, int]:
    """(keys, nested list items) of an item: the older ranking."""
    if not isinstance(value, dict):
        return (0, 0)
    count = lambda v: len(v) + sum(map(count, v)) if isinstance(v, list) else sum(map(count, v.values())) if isinstance(v, dict) else 0
    return len(value), count(value)


def richest(items: list, limit: int = MAX_ITEMS, older: bool = False) -> int:
    """The place of the item with the most distinct key names among the first `limit`; the first of equals. older: of all
    items that with the most own keys, then the most nested list items."""
    ranks = [complexity(v) for v in items] if older else [len(key_names(v)) for v in items[:limit]]
    return ranks.index(max(ranks))


def _kind(value) -> str:
    return "list" if isinstance(value, list) else "dict" if isinstance(value, dict) else "scalar"


def walk(document, limit: int = MAX_ITEMS, older: bool = False) -> Iterator[tuple[int, str, str, str | None, str, bool]]:
    """(level, path, key, value, dtype, url_in_value) of all keys; of a list only its richest item is looked into."""
    if not isinstance(document, dict):
        return
    todo = [(document, 0, "")]
    while todo:
        node, level, path = todo.pop()
        below = []
        for key, value in node.items():
            at = f"{path}.{key}" if path else key
            kept, inner, inner_at = value, value, at
            while isinstance(inner, list) and inner:
                k = richest(inner, limit, older)
                inner, inner_at = inner[k], f"{inner_at}[{k}]"
                kept = [inner] if kept is value else kept
            yield level, at, key, None if kept is None else json.dumps(kept), _kind(value), bool(_URL.search(value if isinstance(value, str) else json.dumps(value)))
            if isinstance(inner, dict):
                below.append((inner, level + 1, inner_at))
        todo += reversed(below)


def analyze(documents: DataFrame, limit: int = MAX_ITEMS, older: bool = False) -> DataFrame:
    """Analysis rows of documents (file_name, source_name, file_size, value: JSON text). Text that is no JSON object has none.

    The recursion over keys that no schema names is the one thing here that is not a column expression.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in ANALYSIS.split(", ")]
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.bool_()]
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                try:
                    document = json.loads(r["value"] or "")
                except ValueError:
                    continue
                for level, path, key, value, dtype, url in walk(document, limit, older):
                    rows.append((r["file_name"], r["source_name"], r["file_size"], level, path, path, key, re.split(r"[.\[]", path)[0], value, dtype, url))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return documents.select("file_name", "source_name", F.col("file_size").cast("long").alias("file_size"), "value").mapInArrow(run, ANALYSIS)


def landing(documents: DataFrame, max_items: int | None = None) -> DataFrame:
    """(file_name, record_type, payload, payload_size) of every top-level key of JSON texts, arrays cut to max_items."""
    own = documents.select("file_name", F.try_parse_json("value").alias("v"))
    out = own.sparkSession.sql("SELECT d.file_name, e.key AS record_type, to_json(e.value) AS payload FROM {d} d, LATERAL variant_explode(d.v) e", d=own)
    if max_items is not None:
        items = F.from_json("payload", "array<variant>")
        out = out.withColumn("payload", F.when(F.col("payload").startswith("["), F.to_json(F.slice(items, 1, max_items))).otherwise(F.col("payload")))
    return out.withColumn("payload_size", F.length("payload"))


def largest_payloads(rows: DataFrame, order_id: str = "id") -> DataFrame:
    """One landing row for each file and record type: the largest payload, the first of equals; no size counts as 0."""
    over = W.partitionBy("file_name", "record_type").orderBy(F.coalesce("payload_size", F.lit(0)).desc(), order_id)
    return rows.withColumn("_row", F.row_number().over(over)).where("_row = 1").drop("_row")


def key_counts(items: DataFrame, array: str, key: str) -> DataFrame:
    return items.groupBy(array, key).agg(F.count("*").alias("n"))


def rare_keys(counts: DataFrame, array: str, key: str, lowest: int = 5, below: int = 3) -> DataFrame:
    """For each array its `lowest` rarest keys, of those that come fewer than `below` times."""
    over = W.partitionBy(array).orderBy("n", key)
    return counts.withColumn("rank", F.row_number().over(over)).where((F.col("rank") <= lowest) & (F.col("n") < below))


def new_key_items(items: DataFrame) -> DataFrame:
    """Of items (file_name, record_type, item_id, has_rare, keys) those that are the first to hold some key, rare ones first."""
    each = items.withColumn("key", F.explode("keys"))
    over = W.partitionBy("file_name", "record_type", "key").orderBy(F.desc("has_rare"), "item_id")
    first = each.withColumn("_row", F.row_number().over(over)).where("_row = 1")
    return first.select("file_name", "record_type", "item_id", "has_rare").distinct()


def scalar_or_array(rows: DataFrame) -> DataFrame:
    """(record_type, kind): array where a record type has more than one record, else scalar."""
    return rows.groupBy("record_type").agg(F.when(F.max("record_index") > 0, "array").otherwise("scalar").alias("kind"))
