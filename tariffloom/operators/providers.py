"""Providers of a document: found by shape, flattened inline or from linked files, joined by a canonical key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tariffloom.functions import columns as C

# Fields that tell a rate array or a provider array.
RATE_FIELDS = ({"negotiated_prices", "negotiated_rates", "provider_references"}, {"negotiated_rate", "billing_class", "negotiated_type"})
PROVIDER_FIELDS = {"provider_groups", "location"}
KEY_NAMES = ("provider_group_id", "provider_reference", "provider_references")


def is_rate_array(t: T.DataType) -> bool:
    """An array of structs with one of the fields of rates or of prices."""
    if not isinstance(t, T.ArrayType) or not isinstance(t.elementType, T.StructType):
        return False
    names = set(t.elementType.fieldNames())
    return any(names & own for own in RATE_FIELDS)


def provider_array(schema: T.StructType) -> str | None:
    """The top-level array of providers: by name, else the first with groups or a location."""
    if "provider_references" in schema.fieldNames() and isinstance(schema["provider_references"].dataType, T.ArrayType):
        return "provider_references"
    for f in schema.fields:
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType) and PROVIDER_FIELDS & set(f.dataType.elementType.fieldNames()):
            return f.name
    return None


def inline_providers(raw: DataFrame, array: str = "provider_references", file: str = "source_file") -> DataFrame:
    """(source_file, provider_group_id, npi) of groups written into the documents; missing identifiers are dropped."""
    ref = raw.select(file, F.explode(array).alias("ref"))
    group = ref.select(file, F.col("ref.provider_group_id").cast("string").alias("provider_group_id"), F.explode("ref.provider_groups").alias("g"))
    return group.select(file, "provider_group_id", F.explode(F.col("g.npi").cast("array<string>")).alias("npi")).where("npi is not null")


def provider_links(raw: DataFrame, array: str = "provider_references", file: str = "source_file") -> DataFrame:
    """(source_file, provider_group_id, location) of groups kept in linked files."""
    ref = raw.select(file, F.explode(array).alias("ref"))
    return ref.select(file, F.coalesce(F.col("ref.provider_group_id").cast("string"), F.lit("")).alias("provider_group_id"), "ref.location").where("location is not null")


def linked_providers(links: DataFrame, content: DataFrame, file: str = "source_file") -> DataFrame:
    """Providers of linked files. content: (name: file name of the address, see `file_of_url`; value: JSON text).

    A file holds provider_groups or a list of groups; an npi that is no list is ignored, a missing file is skipped.
    """
    groups = "array<struct<npi:array<string>>>"
    parsed = F.coalesce(F.when(F.ltrim("value").startswith("["), F.from_json("value", groups)), F.from_json("value", f"struct<provider_groups:{groups}>")["provider_groups"])
    own = content.select(F.col("name"), parsed.alias("groups"))
    named = links.withColumn("name", C.file_of_url(F.col("location")))
    rows = named.join(own, "name").select(file, "provider_group_id", C.url_tail(F.col("location")).alias("provider_url_file"), F.explode("groups").alias("g"))
    return rows.select(file, "provider_group_id", F.explode("g.npi").alias("npi"), "provider_url_file").where("npi is not null")


def key_column(names: list[str]) -> str | None:
    """The column that joins rates with providers: by exact name, then by the end of the name, then by a part of it."""
    for test in (lambda c, k: c == k, lambda c, k: c.endswith(k), lambda c, k: k in c):
        for k in KEY_NAMES:
            for c in names:
                if test(c.lower(), k):
                    return c
    return None


def join_providers(rates: DataFrame, providers: DataFrame, how: str = "left", canonical: bool = True, across_files: bool = False, file: str = "source_file") -> DataFrame:
    """Rates with npi (and provider_url_file): left keeps rates without a provider, inner does not.

    The key is canonical (7 is 7.0) unless the plain text is asked for; rows meet within a file unless across_files.
    """
    left = key_column(rates.columns)
    if left is None:
        raise ValueError(f"no provider key among {rates.columns}")
    key = C.canonical_key if canonical else (lambda c: c.cast("string"))
    own = providers.withColumn("_key", key(F.col("provider_group_id"))).drop("provider_group_id").distinct()
    on = ["_key"] if across_files else [file, "_key"]
    own = own.drop(file).distinct() if across_files else own
    return rates.withColumn("_key", key(F.col(f"`{left}`"))).join(own, on, how).drop("_key")
