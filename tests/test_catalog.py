"""Catalog operators, the older group conversion, and the command line."""

import json

from pyspark.sql import functions as F

from tariffloom import __main__ as cli
from tariffloom.operators import catalog

PLANS = "array<struct<plan_name:string,plan_id_type:string,plan_id:string,plan_market_type:string>>"


def test_catalog_rows(spark):
    rows = [("https://x/A.json", "A.json", "done", "/a", [("p", "", "", "")]), ("https://x/b.json", "b.json", None, None, None), ("https://y/c.json", "c.json", "failed", None, [("p", "", "", "")])]
    own = spark.createDataFrame(rows, f"file_url string, file_name string, download_status string, file_path string, reporting_plans {PLANS}")
    assert catalog.select_files(own, text="a.JSON").count() == 1
    assert catalog.select_files(own, not_status=["done"]).count() == 2
    assert catalog.select_files(own, urls=["https://x/b.json"]).first().file_name == "b.json"
    changed = catalog.set_status(own, spark.createDataFrame([("https://x/b.json", "done", None), ("https://y/c.json", None, "/c")], "file_url string, status string, file_path string"))
    assert {(r.file_name, r.download_status, r.file_path) for r in changed.collect()} == {("A.json", "done", "/a"), ("b.json", "done", None), ("c.json", "failed", "/c")}
    assert catalog.file_of_plan(own, "p").first().file_name == "A.json"
    assert {(r.download_status, r.n) for r in catalog.display(own).collect()} == {("done", 1), (None, 1), ("failed", 1)}


def test_key_scan(spark):
    docs = spark.createDataFrame([("f", json.dumps({"v": "\"a\":", "items": [{"a": 1, "b": {"a": 2}}, {"a": 3}]})), ("g", "[1]"), ("h", "no")], "file_name string, value string")
    assert {(r.array, r.key, r.n) for r in catalog.key_scan(docs).collect()} == {(None, "v", 1), (None, "items", 1), ("items", "a", 3), ("items", "b", 1)}


def test_analysis_lookups(spark):
    rows = [("f", "a", 0, True, 2), ("f", "a", 0, True, 1), ("f", "a.b", 1, False, 3), ("f", "a[0].c", 1, True, 4), ("f", "ab", 0, False, 5)]
    own = spark.createDataFrame(rows, "file_name string, path string, level int, url_in_value boolean, id int")
    assert {(r.path, r.id) for r in catalog.first_urls(own).collect()} == {("a", 1), ("a[0].c", 4)}
    assert catalog.below(own, "a").count() == 4
    assert {(r.level, r.n, r.paths) for r in catalog.level_histogram(own).collect()} == {(0, 3, 2), (1, 2, 2)}
    assert spark.range(1).select(catalog.new_keys(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("a")))).first()[0] == ["b"]


def test_group_table(spark):
    rows = [("CPT", "70450", [("1", [1, 2]), ("2", [3])]), ("CPT", "99", [("1", [1])]), ("DRG", "70450", [("1", [1])])]
    docs = spark.createDataFrame(rows, "billing_code_type string, billing_code string, rates array<struct<rate:string,npi:array<string>>>")
    npis = spark.createDataFrame([("1",), ("3",)], "npi string")
    got = catalog.group_table(docs, "CPT", ["70000-79999"], npis, ["billing_code_type", "billing_code"], ["billing_code", "npi"])
    assert [(r.billing_code, r.npi) for r in got.collect()] == [("70450", ["1", "3"])]


def test_command_line(spark, tmp_path):
    prices = [{"negotiated_rate": 10.5, "negotiated_type": "n", "billing_class": "p", "service_code": ["11"]}]
    doc = {"version": "1", "provider_references": [{"provider_group_id": 1, "provider_groups": [{"npi": [5]}]}], "in_network": [{"billing_code": c, "billing_code_type": "CPT", "description": "d", "negotiated_rates": [{"provider_references": [1], "negotiated_prices": prices}]} for c in ("70450", "99")]}
    (tmp_path / "f.json").write_text(json.dumps(doc))
    cli.main(["convert", str(tmp_path / "f.json"), str(tmp_path / "fact"), "--codes", "70000-79999"])
    rows = spark.read.parquet(str(tmp_path / "fact")).collect()
    assert [(r.billing_code, r.npi, r.version, r.negotiated_rate) for r in rows] == [("70450", "5", "1", 10.5)]
    spark.read.parquet(str(tmp_path / "fact")).withColumn("provider_name", F.lit("P")).write.parquet(str(tmp_path / "named"))
    cli.main(["report", str(tmp_path / "named"), str(tmp_path / "r")])
    assert spark.read.json(str(tmp_path / "r/providers")).first().name == "P"
    cli.main(["groups", str(tmp_path / "f.json"), str(tmp_path / "g")])
    assert spark.read.parquet(str(tmp_path / "g")).first().file_count == 1
    cli.main(["split", str(tmp_path / "f.json"), str(tmp_path / "s"), "--items", "1"])
    assert spark.read.text(str(tmp_path / "s")).count() == 2
