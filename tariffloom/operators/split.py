"""Splitting documents into parts by items or by bytes, and their names."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def part_name(file: Column, part: Column, digits: int = 5) -> Column:
    """A part's name: f.json.gz with part 3 becomes f_part00003.json.gz."""
    return F.concat(F.regexp_replace(file, r"\.json(\.gz)?$", ""), F.lit("_part"), F.lpad(part.cast("string"), digits, "0"), F.regexp_extract(file, r"\.json(\.gz)?$", 0))


def by_items(documents: DataFrame, array: str, items: int, file: str = "source_file") -> DataFrame:
    """(file, part, value): documents cut into parts of so many items of an array; other columns come with every part."""
    others = [c for c in documents.columns if c not in (file, array)]
    each = documents.select(file, *others, F.posexplode(array).alias("_pos", "_item")).withColumn("part", F.floor(F.col("_pos") / items) + 1)
    keep = [F.first(c).alias(c) for c in others]
    parts = each.groupBy(file, "part").agg(F.array_sort(F.collect_list(F.struct("_pos", "_item"))).alias("_items"), *keep)
    parts = parts.withColumn(array, F.transform("_items", lambda s: s["_item"]))
    return parts.select(file, "part", F.to_json(F.struct(*others, array)).alias("value"))


def by_bytes(rows: DataFrame, size: int, file: str = "file", pos: str = "pos", value: str = "value") -> DataFrame:
    """Adds part to items: greedy, in order, each part of at most `size` bytes unless one item alone is larger.

    A part starts where the one before is full, which is sequential within a file; one file's items are streamed in
    order through a task, and only sizes matter, so a file of any length needs constant memory.
    """
    schema = rows.schema
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, part, filled = None, 0, 0
        for batch in batches:
            out = []
            for f, n in zip(batch.column(file).to_pylist(), pa.compute.binary_length(batch.column(value)).to_pylist(), strict=True):
                n = n or 0
                if f != now:
                    now, part, filled = f, 1, 0
                elif filled + n > size and filled:
                    part, filled = part + 1, 0
                filled += n
                out.append(part)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], [*names, "part"])

    from pyspark.sql import types as T

    ordered = rows.repartition(file).sortWithinPartitions(file, pos)
    return ordered.mapInArrow(run, T.StructType([*schema.fields, T.StructField("part", T.LongType())]))


def documents_by_bytes(documents: DataFrame, size: int, arrays: list[str] | None = None, file: str = "source_file") -> DataFrame:
    """(file, part, value): part 0 holds what a document has besides its arrays, parts from 1 on its items, each array cut into
    parts of at most `size` bytes of items. Parts are numbered through the arrays in their order."""
    from tariffloom.operators.flatten import arrays_of

    arrays = arrays_of(documents) if arrays is None else arrays
    others = [c for c in documents.columns if c not in (file, *arrays)]
    head = documents.select(file, F.lit(0).cast("long").alias("part"), (F.to_json(F.struct(*others)) if others else F.lit("{}")).alias("value"))
    each = [documents.select(F.col(file), F.lit(k).alias("_array"), F.posexplode(a).alias("_at", "_item")).select(file, "_array", "_at", F.to_json(F.struct("_item")).alias("_text")) for k, a in enumerate(arrays)]
    if not each:
        return head
    items = each[0]
    for e in each[1:]:
        items = items.unionByName(e)
    items = items.withColumn("_text", F.expr("substring(_text, 10, length(_text) - 10)"))  # without the struct around it
    key = F.to_json(F.struct(F.col(file), "_array"))
    cut = by_bytes(items.withColumn("_file", key), size, "_file", "_at", "_text")
    parts = cut.groupBy(file, "_array", "part").agg(F.array_sort(F.collect_list(F.struct("_at", "_text"))).alias("_items"))
    names = F.array(*(F.to_json(F.array(F.lit(a))) for a in arrays))
    name = F.expr("substring(_name, 2, length(_name) - 2)")
    value = F.concat(F.lit("{"), name, F.lit(":["), F.array_join(F.transform("_items", lambda s: s["_text"]), ","), F.lit("]}"))
    last = parts.groupBy(file, "_array").agg(F.max("part").alias("_last"))
    before = last.withColumn("_before", F.sum("_last").over(W.partitionBy(file).orderBy("_array")) - F.col("_last")).drop("_last")
    numbered = parts.join(before, [file, "_array"]).withColumn("_name", F.get(names, F.col("_array")))
    return head.unionByName(numbered.select(file, (F.col("part") + F.col("_before")).alias("part"), value.alias("value")))


def array_lengths(documents: DataFrame, array: str) -> DataFrame:
    """(items, files): how many items an array has over all documents, and how many documents there are."""
    return documents.agg(F.sum(F.greatest(F.size(array), F.lit(0))).alias("items"), F.count("*").alias("files"))
