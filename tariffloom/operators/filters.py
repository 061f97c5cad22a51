"""Row filters: codes and code ranges, identifiers, texts, blank rows. Values become literals; sets become semi joins."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffloom.functions import columns as C

#: What may stand between the bounds of a range: a hyphen or either dash.
DASHES = "-\u2013\u2014"


def bounds(value: str) -> tuple[str, str] | None:
    """The two sides of the first dash that has something before and after it; None if the value is no range."""
    at = next((k for k in range(1, len(value) - 1) if value[k] in DASHES), None)
    return None if at is None else (value[:at], value[at + 1 :])


def _number(text: str) -> float | None:
    try:
        return float(text.strip())
    except ValueError:
        return None


def in_range(c: Column, low: str, high: str) -> Column:
    """Between two bounds, both included: as numbers where both bounds are numbers, else as texts."""
    a, b = _number(low), _number(high)
    if a is not None and b is not None:
        return F.trim(c.cast("string")).try_cast("double").between(a, b)
    return (c.cast("string") >= low.strip()) & (c.cast("string") <= high.strip())


def matches(c: Column, values: Iterable[str], strict_kind: bool = False) -> Column:
    """Any of a list of values and ranges (70010-76499, with a hyphen or dash).

    strict_kind takes ranges as ranges only where all values are ranges; in a mixed list they are plain values then.
    """
    values = [str(v) for v in values]
    ranges = [bounds(v) for v in values]
    if strict_kind and not all(ranges):
        ranges = [None] * len(values)
    exact = [v for v, r in zip(values, ranges, strict=True) if r is None]
    tests = [in_range(c, *r) for r in ranges if r] + ([c.cast("string").isin(exact)] if exact else [])
    return reduce(lambda a, b: a | b, tests) if tests else F.lit(False)


def contains_ci(c: Column, value: str) -> Column:
    return F.contains(F.lower(c), F.lit(value.lower()))


def equals_value(c: Column, value) -> Column:
    return c == F.lit(value)


def like_core(c: Column, core: str) -> Column:
    """Equal to a name or holding it; its characters have no special meaning."""
    return (c == core) | F.contains(c, F.lit(core))


def where_column(df: DataFrame, column: str, test, on_missing: str = "skip") -> DataFrame:
    """df where test(column) holds; without the column all rows (skip), none (none) or an error (raise)."""
    if column in df.columns:
        return df.where(test(F.col(f"`{column}`")))
    if on_missing == "raise":
        raise ValueError(f"no column {column}")
    return df if on_missing == "skip" else df.where(F.lit(False))


def in_set(df: DataFrame, column: str, ids: DataFrame, id_column: str | None = None) -> DataFrame:
    """Rows whose value is in the first (or named) column of ids: a semi join, broadcast only if Spark finds it small."""
    own = ids.select(F.col(id_column or ids.columns[0]).cast("string").alias("_id")).distinct()
    return df.join(own, F.col(f"`{column}`").cast("string") == F.col("_id"), "left_semi")


def npi_filter(df: DataFrame, npis: DataFrame | None, column: str = "npi", empty_passes: bool = False, keep_null: bool = False) -> DataFrame:
    """Rows of the given providers. None filters nothing; an empty set leaves no rows, unless empty_passes.

    keep_null keeps rows without a provider as well.
    """
    if npis is None or (empty_passes and npis.isEmpty()):
        return df
    kept = in_set(df, column, npis)
    return kept.unionByName(df.where(F.col(column).isNull())) if keep_null else kept


def array_in_set(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Keeps the items of an array column that are in ids, and the rows that keep any; equal rows stay apart.

    A row is numbered once and travels with its items, so it is put together again by one shuffle and no join.
    """
    rest = F.struct(*(F.col(f"`{c}`") for c in df.columns if c != column), F.lit(True).alias("_there"))
    numbered = df.select(F.monotonically_increasing_id().alias("_row"), rest.alias("_rest"), F.col(f"`{column}`").alias("_items"))
    item = numbered.select("_row", "_rest", F.posexplode("_items").alias("_pos", "_item"))
    kept = in_set(item, "_item", ids).groupBy("_row").agg(F.first("_rest").alias("_rest"), F.array_sort(F.collect_list(F.struct("_pos", "_item"))).alias("_kept"))
    return kept.select(*((F.transform("_kept", lambda s: s["_item"]).alias(c) if c == column else F.col(f"_rest.`{c}`").alias(c)) for c in df.columns))


def not_blank(df: DataFrame, keep: tuple[str, ...] = ("source_file",)) -> DataFrame:
    """Rows with a value in some column; the columns in keep do not count."""
    own = [F.coalesce(F.trim(F.col(f"`{c}`").cast("string")), F.lit("")) != "" for c in df.columns if c not in keep]
    return df.where(reduce(lambda a, b: a | b, own)) if own else df


def drop_null_columns(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Without the columns that are null in all rows; those in keep stay."""
    seen = df.select(*(F.count(F.col(f"`{c}`")).alias(c) for c in df.columns)).first()
    return df.select(*(F.col(f"`{c}`") for c in df.columns if c in keep or seen[c]))


def keep_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.select(*(F.col(f"`{c}`") for c in names if c in df.columns))


def stringified(df: DataFrame) -> DataFrame:
    """Every column as text, for sinks that want it."""
    return df.select(*(F.col(f"`{c}`").cast("string").alias(c) for c in df.columns))


def reference_filter(df: DataFrame, code_column: str | None = None, codes: Iterable[float] = (), zip_column: str | None = None, zips: Iterable[str] = ()) -> DataFrame:
    """Rows whose code is one of the numbers ("1" is 1.0) and whose postal code is one of the five-digit ones.

    Every column named after a zip or postal code gets a companion with its first five digits.
    """
    for c in [c for c in df.columns if "zip" in c.lower() or "postal" in c.lower()]:
        df = df.withColumn(f"{c}_5digit", C.zip5(F.col(f"`{c}`")))
    if code_column:
        df = df.where(F.col(f"`{code_column}`").try_cast("double").isin([float(c) for c in codes]))
    if zip_column:
        df = df.where(C.zip5(F.col(f"`{zip_column}`")).isin([re.sub("[^0-9]", "", str(z))[:5] for z in zips]))
    return df


def url_column(df: DataFrame, rows: int = 100) -> str | None:
    """The column that holds addresses: by its name, else the first with one in the first rows."""
    for c in df.columns:
        if c.lower() in ("url", "location", "link", "href") or c.lower().endswith("_url"):
            return c
    texts = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    if not texts:
        return None
    seen = df.limit(rows).agg(*(F.bool_or(C.has_url(F.col(f"`{c}`"))).alias(c) for c in texts)).first()
    return next((c for c in texts if seen[c]), None)


def complete_items(df: DataFrame, column: str = "value") -> DataFrame:
    """Rows whose text is one whole JSON value.

    The parser stops after a value, so the text must also stand as an item of an array and as a field of an object: what
    could follow it in one cannot in the other.
    """
    c = F.col(f"`{column}`")
    item, field = F.concat(F.lit("["), c, F.lit("]")), F.concat(F.lit('{"v":'), c, F.lit("}"))
    return df.where(F.try_parse_json(item).isNotNull() & F.try_parse_json(field).isNotNull())
