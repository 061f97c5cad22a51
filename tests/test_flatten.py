"""The nested fixture: flattening, provider joins, filters and names, with the row counts of the older behaviors."""

import json

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tariffloom.functions import columns as C
from tariffloom.operators import filters, flatten, providers
from tariffloom.plans.convert import Request, fact, rates

PRICE = "billing_class:string,billing_code_modifier:array<string>,expiration_date:string,negotiated_rate:double,negotiated_type:string,service_code:array<string>"
SCHEMA = (
    f"in_network array<struct<billing_code:string,billing_code_type:string,description:string,name:string,negotiated_rates:array<struct<negotiated_prices:array<struct<{PRICE}>>,"
    "provider_references:array<string>>>,negotiation_arrangement:string>>,provider_references array<struct<provider_group_id:double,provider_groups:array<struct<npi:array<bigint>,"
    "tin:struct<type:string,value:string>>>>>,reporting_entity_name string,version string"
)
DOCUMENT = {
    "reporting_entity_name": "Acme", "version": "1.0.0",
    "provider_references": [
        {"provider_group_id": 430.1, "provider_groups": [{"npi": [1111111111, 2222222222], "tin": {"type": "ein", "value": "12-3"}}]},
        {"provider_group_id": 7, "provider_groups": [{"npi": [3333333333], "tin": {"type": "ein", "value": "45-6"}}]},
    ],
    "in_network": [
        {"billing_code": "70450", "billing_code_type": "CPT", "description": "CT HEAD", "name": "CT", "negotiation_arrangement": "ffs", "negotiated_rates": [{"provider_references": [430.1, 7], "negotiated_prices": [
            {"negotiated_rate": 100.5, "negotiated_type": "negotiated", "billing_class": "professional", "service_code": ["11", "22"]},
            {"negotiated_rate": 250, "negotiated_type": "negotiated", "billing_class": "institutional", "service_code": ["21"]}]}]},
        {"billing_code": "0134U", "billing_code_type": "CPT", "description": "PLA", "name": "PLA", "negotiation_arrangement": "ffs", "negotiated_rates": [{"provider_references": [99], "negotiated_prices": [
            {"negotiated_rate": 10, "negotiated_type": "fee schedule", "billing_class": "professional", "service_code": []}]}]},
        {"billing_code": "470", "billing_code_type": "MS-DRG", "description": "DRG", "name": "DRG", "negotiation_arrangement": "bundle", "negotiated_rates": []},
    ],
}


@pytest.fixture(scope="module")
def raw(spark):
    text = spark.createDataFrame([(json.dumps(DOCUMENT),)], "value string")
    from pyspark.sql.types import _parse_datatype_string

    return text.select(F.from_json("value", _parse_datatype_string(SCHEMA)).alias("d")).select("d.*", F.lit("f.json").alias("source_file"))


@pytest.mark.parametrize(("outer", "n"), [(False, 5), (True, 6)])
def test_rate_rows(raw, outer, n):
    got = flatten.flatten_rates(raw, outer=outer)
    assert got.count() == n
    assert "service_code" in flatten.simplify(got).columns


def test_provider_rows(raw):
    got = {(r.provider_group_id, r.npi) for r in providers.inline_providers(raw).collect()}
    assert got == {("430.1", "1111111111"), ("430.1", "2222222222"), ("7.0", "3333333333")}


@pytest.mark.parametrize(("canonical", "how", "rows", "with_npi"), [(False, "left", 7, 4), (True, "left", 7, 6), (True, "inner", 6, 6)])
def test_provider_join(raw, canonical, how, rows, with_npi):
    own = flatten.simplify(flatten.flatten_rates(raw, outer=False))
    got = providers.join_providers(own, providers.inline_providers(raw), how, canonical)
    assert (got.count(), got.where("npi is not null").count()) == (rows, with_npi)


def test_filters_on_the_join(raw):
    got = fact(raw, Request(codes=["70010-76499"], code_type="CPT", preserve_null_arrays=False))
    assert got.count() == 6
    assert fact(raw, Request(codes=["0100U-0200U"], preserve_null_arrays=False)).count() == 1
    assert {"reporting_entity_name", "version"} <= set(got.columns)
    assert "version" not in fact(raw, Request(drop_scalars=True)).columns


def test_npi_filter_switches(spark, raw):
    own = spark.createDataFrame([("3333333333",)], "npi string")
    assert fact(raw, Request(npis=own, preserve_null_arrays=False)).count() == 2
    kept = fact(raw, Request(npis=own, preserve_null_arrays=False, npi_filter_keeps_null=True))
    assert (kept.count(), kept.where("npi is not null").count()) == (5, 2)
    none = own.where("false")
    assert fact(raw, Request(npis=none)).count() == 0
    assert fact(raw, Request(npis=none, empty_filter_passes=True, preserve_null_arrays=False)).count() == 7


def test_explode_of_codes(raw):
    own = providers.join_providers(flatten.simplify(flatten.flatten_rates(raw, outer=False)), providers.inline_providers(raw))
    assert flatten.explode_column(own.select("billing_code", "service_code"), "service_code", False).count() == 9
    assert rates(raw, Request(explode_codes=True)).count() == 8


def test_type_equals_or_contains(raw):
    assert rates(raw, Request(code_type="DRG")).count() == 0
    assert rates(raw, Request(code_type="drg", type_contains=True)).count() == 1


@pytest.mark.parametrize(("given_names", "structs", "want"), [
    (["source_file", "i|name", "i|r|p|name", "i|code"], set(), ["source_file", "name_y", "name", "code"]),
    (["a|k", "b|k"], set(), ["k", "k_x"]),
    (["s", "s|v"], {"s"}, ["v"]),
])
def test_simple_names(given_names, structs, want):
    assert list(flatten.simple_names(given_names, structs).values()) == want


@given(st.lists(st.integers(0, 4), min_size=1, max_size=6))
def test_names_without_clashes_stay(sizes):
    names = [f"p{i}|{'x|' * n}c{i}" for i, n in enumerate(sizes)]
    assert list(flatten.simple_names(names).values()) == [f"c{i}" for i in range(len(sizes))]


def test_explode_all_counts(spark):
    df = spark.createDataFrame([("a", [[1, 2], [3]], ["x", "y"]), ("b", [], ["z"])], "id string, n array<array<int>>, s array<string>")
    assert flatten.explode_all(df).count() == 3 * 2
    assert flatten.explode_all(df, outer=True).count() == 3 * 2 + 1


def test_range_filter(spark):
    df = spark.createDataFrame([("70450",), (" 70551 ",), ("0134U",), (None,), ("76499",), ("76500",)], "c string")
    got = lambda values, strict=False: [r.c for r in df.where(filters.matches(F.col("c"), values, strict)).collect()]
    for dash in "-–—":
        assert got([f"70010{dash}76499"]) == ["70450", " 70551 ", "76499"]
    assert got(["70450", "76000-76499"]) == ["70450", "76499"]
    assert got(["70450", "76000-76499"], True) == ["70450"]
    assert got([]) == []


def test_blank_rows_and_columns(spark):
    df = spark.createDataFrame([("f", " ", None), ("f", "x", None)], "source_file string, a string, b string")
    assert filters.not_blank(df).count() == 1
    assert filters.drop_null_columns(df).columns == ["source_file", "a"]


def test_canonical_key(spark):
    df = spark.createDataFrame([("7",), ("7.0",), ("430.10",), ("1.2E3",), ("abc",), (None,)], "k string")
    assert [r[0] for r in df.select(C.canonical_key(F.col("k"))).collect()] == ["7", "7", "430.1", "1200", "abc", None]


def test_plans(spark):
    plan = "struct<plan_name:string,plan_id_type:string,plan_id:string,plan_market_type:string>"
    text = json.dumps([{"plan_name": "p"}, {"plan_name": "q"}])
    assert flatten.explode_plans(spark.createDataFrame([(1, text), (2, None)], "id int, reporting_plans string")).count() == 3
    nested = spark.createDataFrame([(1, [("p", None, None, None)]), (2, [])], f"id int, reporting_plans array<{plan}>")
    assert [r.plan_name for r in flatten.explode_plans(nested).orderBy("id").collect()] == ["p", None]


def test_linked_providers(spark):
    url = "https://x.org/a/one.json?k=1"
    links = spark.createDataFrame([("f", "1", url), ("f", "", url), ("f", "3", "https://x.org/missing")], "source_file string, provider_group_id string, location string")
    name = spark.createDataFrame([(url,)], "u string").select(C.file_of_url(F.col("u"))).first()[0]
    for body in ({"provider_groups": [{"npi": [1, 2]}, {"npi": 5}]}, [{"npi": [1, 2]}]):
        content = spark.createDataFrame([(name, json.dumps(body))], "name string, value string")
        got = providers.linked_providers(links, content)
        assert {(r.provider_group_id, r.npi, r.provider_url_file) for r in got.collect()} >= {("1", "1", "one.json"), ("", "2", "one.json")}
        assert got.count() == 4
