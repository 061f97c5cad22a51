"""Conversion of nested rate documents to an enriched fact table.

A request names its filters; the plan is declared in one piece, so the filters on items are applied inside the arrays
before anything is exploded and Catalyst prunes what is not asked for.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffloom.operators import filters, flatten, joins, providers


@dataclass
class Request:
    """What to convert and how. The switches give the older behaviors; the defaults lose no rows and mix no files."""

    codes: list[str] = field(default_factory=list)
    code_type: str | None = None
    npis: DataFrame | None = None
    provider_join: str = "left"  # or inner
    canonical_keys: bool = True
    cross_file_join: bool = False
    strict_list_kind: bool = False
    empty_filter_passes: bool = False
    npi_filter_keeps_null: bool = False
    preserve_null_arrays: bool = True
    type_contains: bool = False
    drop_scalars: bool = False
    explode_codes: bool = False
    stringify: bool = False
    sample_rows: int | None = None
    on_missing: str = "skip"  # a test whose column is absent: skip it (a provider test then leaves no rows), pass (that too), raise


def item_filter(request: Request, fields: set[str]):
    """The request's tests on an item of a rate array whose fields are there, as a function of the item; None if there are none."""
    wanted = {"billing_code": bool(request.codes), "billing_code_type": bool(request.code_type)}
    if request.on_missing == "raise" and (absent := [f for f, w in wanted.items() if w and f not in fields]):
        raise ValueError(f"items have no {', '.join(absent)}")
    own = [f for f, w in wanted.items() if w and f in fields]

    def test(item: Column) -> Column:
        tests = []
        if "billing_code" in own:
            tests.append(filters.matches(item["billing_code"], request.codes, request.strict_list_kind))
        if "billing_code_type" in own:
            kind = item["billing_code_type"]
            tests.append(filters.contains_ci(kind, request.code_type) if request.type_contains else kind == request.code_type)
        return reduce(lambda a, b: a & b, tests)

    return test if own else None


def rates(raw: DataFrame, request: Request, array: str = "in_network") -> DataFrame:
    """Price rows of documents with short names; the filters reach into the array. Each test is made if items have its field."""
    fields = set(raw.schema[array].dataType.elementType.fieldNames())
    if test := item_filter(request, fields):
        raw = raw.withColumn(array, flatten.push_into(array, test))
        if request.preserve_null_arrays:  # a document without such an item has no row
            raw = raw.where(F.size(array) > 0)
    return flatten.simplify(flatten.flatten_rates(raw, array, outer=request.preserve_null_arrays, explode_codes=request.explode_codes))


def of_providers(rows: DataFrame, request: Request) -> DataFrame:
    """Price rows of the request's providers. Where rows name no provider none is one of them, unless on_missing lets them pass."""
    if request.npis is None:
        return rows
    rows = flatten.explode_npis(rows) if "npi" in flatten.arrays_of(rows) else rows
    if "npi" in rows.columns:
        return filters.npi_filter(rows, request.npis, empty_passes=request.empty_filter_passes, keep_null=request.npi_filter_keeps_null)
    if request.on_missing == "raise":
        raise ValueError("rows have no npi")
    if request.on_missing == "pass" or request.empty_filter_passes and request.npis.isEmpty():
        return rows
    return rows.where(F.lit(False))


def steps(raw: DataFrame, request: Request | None = None, master: DataFrame | None = None, catalog: DataFrame | None = None, linked: DataFrame | None = None) -> dict[str, DataFrame]:
    """The conversion with the tables on its way: rates_prejoin, providers_prejoin and structs_prejoin before they are joined,
    fact_before_provider_data_join, and fact. All are plans: nothing is computed for a table that nobody writes."""
    request = request or Request()
    arrays = flatten.arrays_of(raw)
    own = providers.provider_array(raw.schema)
    rate_arrays = [a for a in arrays if a != own and providers.is_rate_array(raw.schema[a].dataType)] or [a for a in arrays if a != own]
    rows = joins.by_name(*(rates(raw, request, a) for a in rate_arrays))
    out = {"rates_prejoin": rows}
    if own is not None and providers.key_column(rows.columns):
        fields = set(raw.schema[own].dataType.elementType.fieldNames())
        parts = []
        if "provider_groups" in fields:
            parts.append(providers.inline_providers(raw, own))
        if "location" in fields and linked is not None:
            parts.append(providers.linked_providers(providers.provider_links(raw, own), linked))
        if parts:
            found = joins.by_name(*parts)
            if request.npis is not None and not request.empty_filter_passes:
                found = filters.in_set(found, "npi", request.npis)
            out["providers_prejoin"] = found
            rows = providers.join_providers(rows, found, request.provider_join, request.canonical_keys, request.cross_file_join)
    rows = of_providers(rows, request)
    _, structs = flatten.split_top_level(raw, drop_scalars=request.drop_scalars)
    out["structs_prejoin"] = structs
    extra = [c for c in structs.columns if c != "source_file" and c not in rows.columns]
    if extra:
        rows = joins.join_structs(rows, structs.select("source_file", *(F.col(f"`{c}`") for c in extra)))
    out["fact_before_provider_data_join"] = rows
    if master is not None and "npi" in rows.columns:
        rows = joins.enrich(rows, master)
    if catalog is not None:
        rows = flatten.explode_plans(joins.join_catalog(rows, catalog))
    if request.sample_rows:
        rows = rows.limit(request.sample_rows)
    out["fact"] = filters.stringified(rows) if request.stringify else rows
    return out


def fact(raw: DataFrame, request: Request | None = None, master: DataFrame | None = None, catalog: DataFrame | None = None, linked: DataFrame | None = None) -> DataFrame:
    """The fact table of documents (with source_file): prices with their providers and, where given, provider columns and
    plans. linked: contents of provider files (see `sources.readers.provider_files`)."""
    return steps(raw, request, master, catalog, linked)["fact"]


def scalars_only(df: DataFrame) -> DataFrame:
    """Facts with every array exploded, rows without a business value left out."""
    return filters.not_blank(flatten.simplify(flatten.explode_all(df)))

