"""Conversion requests: which rows a code or provider filter leaves, whatever columns documents have."""

from __future__ import annotations

import json

import pytest

from tariffloom.operators import filters, report, split
from tariffloom.plans.convert import Request, fact, steps
from tariffloom.sources import writers


def _docs(spark, docs):
    rows = [(f"f{k}.json", json.dumps(d)) for k, d in enumerate(docs)]
    text = spark.createDataFrame(rows, "source_file string, value string")
    from pyspark.sql import functions as F

    kind = spark.read.json(text.select("value").rdd.map(lambda r: r.value)).schema
    return text.select("source_file", F.from_json("value", kind).alias("d")).select("source_file", "d.*")


def _prices(**more):
    return {"negotiated_rates": [{"negotiated_prices": [{"negotiated_rate": 1.5, "billing_class": "x"}], **more}]}


def test_codes_without_a_code_type(spark):
    docs = _docs(spark, [{"in_network": [{"billing_code": "1", **_prices()}, {"billing_code": "2", **_prices()}]}])
    assert [r.billing_code for r in fact(docs, Request(codes=["1"])).collect()] == ["1"]
    assert fact(docs, Request(codes=["1"], code_type="CPT")).count() == 1
    with pytest.raises(ValueError, match="billing_code_type"):
        fact(docs, Request(code_type="CPT", on_missing="raise"))


def test_provider_filter_without_providers(spark):
    npis = spark.createDataFrame([("1234",)], "npi string")
    none = npis.where("false")
    plain = _docs(spark, [{"in_network": [{"billing_code": "1", **_prices()}]}])
    assert fact(plain, Request(npis=none)).count() == 0 == fact(plain, Request(npis=npis)).count()
    assert fact(plain, Request(npis=npis, on_missing="pass")).count() == 1 == fact(plain, Request(npis=none, empty_filter_passes=True)).count()
    with pytest.raises(ValueError, match="npi"):
        fact(plain, Request(npis=npis, on_missing="raise"))
    linked = _docs(spark, [{"provider_references": [{"provider_group_id": 7, "location": "https://x.org/p.json"}], "in_network": [{"billing_code": "1", **_prices(provider_references=[7])}]}])
    assert fact(linked, Request(npis=none)).count() == 0 and fact(linked).count() == 1
    own = _docs(spark, [{"in_network": [{"billing_code": "1", "npi": n, **_prices()} for n in ("1234", "9")]}])
    assert fact(own, Request(npis=none)).count() == 0 and [r.npi for r in fact(own, Request(npis=npis)).collect()] == ["1234"]
    lists = _docs(spark, [{"in_network": [{"billing_code": "1", "npi": ["1234", "9"], **_prices()}]}])
    assert fact(lists, Request(npis=npis)).count() == 1


def test_tables_before_the_joins(spark, tmp_path):
    docs = _docs(spark, [{"plan": "p", "provider_references": [{"provider_group_id": 7, "provider_groups": [{"npi": [11, 12]}]}], "in_network": [{"billing_code": "1", **_prices(provider_references=[7])}]}])
    tables = steps(docs)
    assert {k: v.count() for k, v in tables.items()} == {"rates_prejoin": 1, "providers_prejoin": 2, "structs_prejoin": 1, "fact_before_provider_data_join": 2, "fact": 2}
    assert writers.snapshots(tables, str(tmp_path)) == ["rates_prejoin", "providers_prejoin", "structs_prejoin", "fact_before_provider_data_join", "fact"]
    assert spark.read.parquet(f"{tmp_path}/providers_prejoin").count() == 2
    assert writers.snapshots(tables, str(tmp_path / "text"), ("fact",), "csv") == ["fact"]


def test_ranges_of_codes():
    assert [filters.bounds(v) for v in ("1-2", "a–b", "1—2-3", "-5", "5-", "12", "", "-1-2")] == [("1", "2"), ("a", "b"), ("1", "2-3"), None, None, None, None, ("-1", "2")]


def test_items_of_arrays_in_a_set(spark):
    df = spark.createDataFrame([(1, [3, 1, 1, 9]), (1, [9]), (1, [1]), (2, None), (2, [3, 1, 1, 9])], "k int, npis array<int>")
    got = filters.array_in_set(df, "npis", spark.createDataFrame([("1",), ("3",)], "npi string"))
    assert got.columns == ["k", "npis"] and sorted((r.k, r.npis) for r in got.collect()) == [(1, [1]), (1, [3, 1, 1]), (2, [3, 1, 1])]


def test_parts_of_documents_by_bytes(spark):
    doc = {"version": "1", "who": {"a": 1}, "in_network": [{"x": "é" * k} for k in range(6)], "other": [1, 22, 333], "empty": []}
    docs = _docs(spark, [doc, {**doc, "in_network": []}])
    parts = split.documents_by_bytes(docs, 30).orderBy("source_file", "part").collect()
    for file, want in (("f0.json", doc), ("f1.json", {**doc, "in_network": []})):
        own = [json.loads(r.value) for r in parts if r.source_file == file]
        assert [r.part for r in parts if r.source_file == file] == list(range(len(own)))
        assert own[0] == {"version": "1", "who": {"a": 1}}
        for name in ("in_network", "other", "empty"):
            assert sum((p.get(name, []) for p in own[1:]), []) == want[name]
        assert all(len(p) == 1 for p in own[1:])


def test_report_page_escapes_its_texts(spark):
    rows = [("1.5", "<b>A</b>", "70010", "Scan & more", "inst", "fee", "ffs", "1"), ("2.5", "B", "70010", "Scan & more", "inst", "fee", "ffs", "2")]
    facts = spark.createDataFrame(rows, "negotiated_rate string, provider_name string, billing_code string, description string, billing_class string, negotiated_type string, negotiation_arrangement string, npi string")
    page = report.page(*report.report(facts), title="P & Q")
    assert "<b>A</b>" not in page and "&lt;b&gt;A&lt;/b&gt;" in page and "Scan &amp; more" in page and page.count("<section") == 2
