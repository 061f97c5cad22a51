"""Schemas of documents: a type lattice, schemas from values and from analysis rows, signatures, groups and differences."""

from __future__ import annotations

import json
import re
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tariffloom.functions import columns as C
from tariffloom.sources import files

_WIDTH = {T.IntegerType: 0, T.LongType: 1, T.DoubleType: 2}


def merge(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type of the lattice that holds both: integer, long, double; structs by sorted fields; arrays by items;
    all else is text."""
    if a == b:
        return a
    if type(a) in _WIDTH and type(b) in _WIDTH:
        return max(a, b, key=lambda t: _WIDTH[type(t)])
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        both: dict[str, T.DataType] = {f.name: f.dataType for f in a.fields}
        for f in b.fields:
            both[f.name] = merge(both[f.name], f.dataType) if f.name in both else f.dataType
        return T.StructType([T.StructField(n, both[n]) for n in sorted(both)])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merge(a.elementType, b.elementType))
    return T.StringType()


def type_of(value, sampled: bool = False) -> T.DataType:
    """The type of a JSON value; numbers are double unless sampled types (integer, long) are asked for.

    sampled takes an array's type from its first item, else it is merged over all.
    """
    if isinstance(value, bool):
        return T.BooleanType()
    if isinstance(value, int):
        return (T.IntegerType() if -(2**31) <= value < 2**31 else T.LongType()) if sampled else T.DoubleType()
    if isinstance(value, float):
        return T.DoubleType()
    if isinstance(value, list):
        items = [type_of(v, sampled) for v in (value[:1] if sampled else value) if v is not None]
        return T.ArrayType(reduce(merge, items) if items else T.StringType())
    if isinstance(value, dict):
        return T.StructType([T.StructField(k, type_of(v, sampled)) for k, v in value.items()])
    return T.StringType()


def save(schema: T.StructType, path: str | Path) -> None:
    """Writes a schema as JSON, on whatever file system the path names."""
    files.write_text(path, json.dumps(json.loads(schema.json()), indent=2))


def load(path: str | Path) -> T.StructType:
    return T.StructType.fromJson(json.loads(files.read_text(path)))


def paths(t: T.DataType, prefix: str = "") -> dict[str, str]:
    """The type of each path of a schema; [] stands for any item."""
    if isinstance(t, T.StructType):
        return {k: v for f in t.fields for k, v in paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name).items()}
    if isinstance(t, T.ArrayType):
        return paths(t.elementType, f"{prefix}[]")
    return {prefix: t.simpleString()}


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """(path, left_type, right_type, kind: only_left, only_right or mismatch) of two tables (path, type)."""
    a, b = left.select("path", F.col("type").alias("left_type")), right.select("path", F.col("type").alias("right_type"))
    kind = F.when(F.col("right_type").isNull(), "only_left").when(F.col("left_type").isNull(), "only_right").when(F.col("left_type") != F.col("right_type"), "mismatch")
    return a.join(b, "path", "full").withColumn("kind", kind).where("kind is not null")


def signatures(analysis: DataFrame) -> DataFrame:
    """(file_name, schema_sig, file_size, has_urls): the sorted distinct paths of each file, item numbers left out."""
    path = C.normal_path(F.col("path_group"))
    return analysis.groupBy("file_name").agg(
        F.array_join(F.array_sort(F.collect_set(path)), ", ").alias("schema_sig"), F.max("file_size").alias("file_size"), F.bool_or("url_in_value").alias("has_urls")
    )


def groups(per_file: DataFrame) -> DataFrame:
    """Files with their signature group: its smallest file and how many files it has, and group_id."""
    over = W.partitionBy("schema_sig")
    least = F.min("file_size").over(over)
    own = per_file.withColumn("_least", least).withColumn("is_min_file", F.coalesce(F.col("file_size") == F.col("_least"), F.lit(False)))
    return own.select(
        "schema_sig", "file_name", "file_size", "is_min_file",
        F.min(F.when(F.col("is_min_file"), F.col("file_name"))).over(over).alias("min_file_name"), F.col("_least").alias("min_file_name_size"),
        "has_urls", F.count("*").over(over).alias("file_count"), C.group_name(F.col("schema_sig")).alias("group_id"),
    )


def group_summary(grouped: DataFrame) -> DataFrame:
    """One row for each signature: its smallest file, whether it has addresses, its files."""
    return grouped.groupBy("schema_sig").agg(F.min(F.when(F.col("is_min_file"), F.col("file_name"))).alias("min_file_name"), F.bool_or("has_urls").alias("has_urls"), F.count("*").alias("file_count"))


def schema_groups(schemas: DataFrame) -> DataFrame:
    """(file_name, group_id) of (file_name, schema_json); a file with several different schemas has none and is left out."""
    own = schemas.groupBy("file_name").agg(F.collect_set("schema_json").alias("s")).where(F.size("s") == 1)
    return own.select("file_name", C.group_name(F.col("s")[0]).alias("group_id"))


def from_analysis(rows: list[dict], sampled: bool = False) -> T.StructType:
    """The schema of one file from its analysis rows (path, value as JSON text); the driver needs the rows of one file only.

    Item numbers are left out of the paths, and what rows say about a path is merged.
    """
    root: dict = {}
    for r in rows:
        node = root
        steps = re.findall(r"[^.\[\]]+|\[\d*\]", r["path"])
        for k, step in enumerate(steps):
            key = "[]" if step.startswith("[") else step
            node = node.setdefault(key, {})
            if k == len(steps) - 1 and r["value"] is not None:
                value = json.loads(r["value"])
                kind = type_of(value, sampled)
                node["type"] = merge(node["type"], kind) if "type" in node else kind

    def build(node: dict) -> T.DataType:
        fields = {k: v for k, v in node.items() if k not in ("type", "[]") or isinstance(v, dict) and k != "[]"}
        if "[]" in node:
            inner = build(node["[]"])
            own = node.get("type")
            return merge(T.ArrayType(inner), own) if isinstance(own, T.ArrayType) and isinstance(own.elementType, T.StructType) else T.ArrayType(inner)
        if fields:
            own = T.StructType([T.StructField(k, build(v)) for k, v in fields.items()])
            return merge(own, node["type"]) if isinstance(node.get("type"), T.StructType) else own
        return node.get("type", T.StringType())

    built = build({k: v for k, v in root.items()})
    return built if isinstance(built, T.StructType) else T.StructType([])


def inferred(landing: DataFrame) -> DataFrame:
    """(file_name, record_type, schema): the DDL of each record type's payloads, merged over all of them."""
    return landing.groupBy("file_name", "record_type").agg(F.schema_of_variant_agg(F.try_parse_json("payload")).alias("schema"))
