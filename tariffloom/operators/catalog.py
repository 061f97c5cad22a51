"""The file catalog and key scans: lookups, status changes, key counts, and one representative row of each kind."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffloom.functions import columns as C
from tariffloom.operators import filters, flatten, joins


def select_files(catalog: DataFrame, urls: list[str] | None = None, text: str | None = None, not_status: list[str] | None = None) -> DataFrame:
    """Catalog rows with one of the addresses, or whose address or name holds a text in any case, and not in some status."""
    out = catalog
    if urls:
        out = out.where(F.col("file_url").isin(urls))
    if text:
        out = out.where(filters.contains_ci(F.col("file_url"), text) | filters.contains_ci(F.col("file_name"), text))
    if not_status:
        out = out.where(F.col("download_status").isNull() | ~F.col("download_status").isin(not_status))
    return out


def set_status(catalog: DataFrame, changes: DataFrame) -> DataFrame:
    """The catalog with the status of (file_url, status, file_path) changes; what a change leaves null stays as it was."""
    own = joins.first_by(changes, ["file_url"], F.desc("status")).select("file_url", F.col("status").alias("_status"), F.col("file_path").alias("_path"))
    out = catalog.join(own, "file_url", "left")
    out = out.withColumn("download_status", F.coalesce("_status", "download_status")).withColumn("file_path", F.coalesce("_path", "file_path"))
    return out.select(*catalog.columns)


def file_of_plan(catalog: DataFrame, plan: str) -> DataFrame:
    """The first file, by name, that lists a plan."""
    return joins.files_of_plan(catalog, plan).select("file_name").orderBy("file_name").limit(1)


def analyzed_files(catalog: DataFrame, analyzed: DataFrame) -> DataFrame:
    return catalog.join(analyzed.select("file_name").distinct(), "file_name")


def first_urls(analysis: DataFrame) -> DataFrame:
    """The first analysis row with an address for each file and path."""
    return joins.first_by(analysis.where("url_in_value"), ["file_name", "path"], "id")


def below(analysis: DataFrame, path: str) -> DataFrame:
    """Analysis rows of a path and all under it."""
    return analysis.where((F.col("path") == path) | F.startswith("path", F.lit(f"{path}.")) | F.startswith("path", F.lit(f"{path}[")))


def level_histogram(analysis: DataFrame) -> DataFrame:
    return analysis.groupBy("level").agg(F.count("*").alias("n"), F.countDistinct("path").alias("paths"))


def key_scan(texts: DataFrame) -> DataFrame:
    """(file_name, array, key, n): how often each key name comes in each top-level array; array is null for the top level.

    Of texts (file_name, value). Keys of any depth count, strings that look like keys do not: the text is parsed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import json
        from collections import Counter

        for batch in batches:
            rows = []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    document = json.loads(text or "")
                except ValueError:
                    continue
                if not isinstance(document, dict):
                    continue
                seen: Counter = Counter()
                for top, value in document.items():
                    seen[None, top] += 1
                    todo = [value]
                    while todo:
                        v = todo.pop()
                        if isinstance(v, dict):
                            seen.update((top, k) for k in v)
                            todo += v.values()
                        elif isinstance(v, list):
                            todo += v
                rows += [(name, a, k, n) for (a, k), n in seen.items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.string(), pa.string(), pa.int64()), strict=True)], ["file_name", "array", "key", "n"])

    return texts.select("file_name", "value").mapInArrow(run, "file_name string, array string, key string, n long")


def new_keys(left: Column, right: Column) -> Column:
    """The items of one array that the other does not hold."""
    return F.array_except(left, right)


def group_table(documents: DataFrame, code_type: str | None = None, codes: list[str] | None = None, npis: DataFrame | None = None, keys: list[str] | None = None, keep: list[str] | None = None, contents: DataFrame | None = None) -> DataFrame:
    """The older conversion of a signature group: flatten with leaf names, filter codes and identifiers, group prices, add
    the contents of linked addresses, and keep the columns asked for."""
    out = flatten.auto_flatten(documents)
    if code_type and "billing_code_type" in out.columns:
        out = out.where(F.col("billing_code_type") == code_type)
    if codes:
        out = filters.where_column(out, "billing_code", lambda c: filters.matches(c, codes))
    if npis is not None and "npi" in out.columns:
        kind = out.schema["npi"].dataType.typeName()
        out = filters.array_in_set(out, "npi", npis) if kind == "array" else filters.in_set(out, "npi", npis)
    out = joins.group_prices(out, keys) if keys else out
    if contents is not None and (column := filters.url_column(out)):
        out = joins.url_contents(out, F.col(column), contents)
    return filters.keep_columns(out, keep) if keep else out


def display(catalog: DataFrame) -> DataFrame:
    """Files by status."""
    return catalog.groupBy("download_status").agg(F.count("*").alias("n"), F.countDistinct(C.url_tail(F.col("file_url"))).alias("names"))
