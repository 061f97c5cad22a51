"""Schemas, shapes, joins, reports, splitting, writers, landing and jobs, on the fixtures and on the driver's tables."""

import gzip
import json
import os
import time

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tariffloom.functions import columns as C
from tariffloom.operators import filters, flatten, joins, providers, report, schema, shape, split
from tariffloom.plans import jobs, views
from tariffloom.sources import readers, writers
from tariffloom.streaming import landing

ANALYSIS = "file_name string, file_size long, path_group string, url_in_value boolean"


def test_signature_groups(spark):
    rows = [("a", 10, "in_network[0].x", False), ("a", 10, "in_network[3].x", True), ("b", 20, "in_network[1].x", False), ("c", 5, "in_network[0].y", False)]
    got = {r.file_name: r for r in schema.groups(schema.signatures(spark.createDataFrame(rows, ANALYSIS))).collect()}
    assert [(got[k].schema_sig, got[k].is_min_file, got[k].has_urls, got[k].file_count) for k in "abc"] == [
        ("in_network[].x", True, True, 2), ("in_network[].x", False, False, 2), ("in_network[].y", True, False, 1),
    ]
    assert got["b"].min_file_name == "a" and got["a"].group_id.startswith("group_") and len(got["a"].group_id) == 18


JSON = st.recursive(st.none() | st.booleans() | st.integers(-5, 5) | st.text("ab", max_size=3), lambda c: st.lists(c, max_size=3) | st.dictionaries(st.sampled_from("xyz"), c, max_size=3), max_leaves=12)


@given(JSON)
def test_key_names_and_walk(value):
    keys = {k for k in json.dumps(value) if k in "xyz"}
    assert shape.key_names(value) == keys
    for level, path, key, text, dtype, _ in shape.walk({"top": value}):
        assert path.split(".")[-1].split("[")[0] == key and dtype in ("scalar", "list", "dict")
        assert level == path.count(".") and (text is None or json.loads(text) is not None or text == "null")


def test_walk_takes_the_richest_item():
    rows = list(shape.walk({"v": "1", "items": [{"a": 1}, {"a": 1, "b": {"c": "www.x.org"}}, {"a": 1, "d": {"e": 2}}], "none": None}))
    assert [r[1] for r in rows] == ["v", "items", "none", "items[1].a", "items[1].b", "items[1].b.c"]
    assert [r[1] for r in rows if r[5]] == ["items", "items[1].b", "items[1].b.c"]
    assert shape.richest([{"a": 1, "b": [1]}, {"a": 1, "b": [1, 2]}], older=True) == 1
    assert list(shape.walk([1])) == []


def test_landing_and_largest_payload(spark):
    docs = spark.createDataFrame([("f", json.dumps({"version": "1", "items": [1, 2, 3]})), ("g", "not json")], "file_name string, value string")
    got = {r.record_type: r.payload for r in shape.landing(docs, 2).collect()}
    assert json.loads(got["items"]) == [1, 2] and json.loads(got["version"]) == "1"
    rows = spark.createDataFrame([("f", "t", 5, 2), ("f", "t", 5, 1), ("f", "u", None, 3)], "file_name string, record_type string, payload_size int, id int")
    assert sorted((r.record_type, r.id) for r in shape.largest_payloads(rows).collect()) == [("t", 1), ("u", 3)]


def test_rare_keys(spark):
    counts = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("a", "z", 2), ("a", "w", 3), ("b", "x", 9)], "array string, key string, n long")
    assert {(r.array, r.key) for r in shape.rare_keys(counts, "array", "key", 2).collect()} == {("a", "x"), ("a", "y")}


TYPES = st.recursive(st.sampled_from([T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType()]), lambda c: c.map(T.ArrayType) | st.dictionaries(st.sampled_from("abc"), c, min_size=1).map(lambda d: T.StructType([T.StructField(k, d[k]) for k in sorted(d)])), max_leaves=6)


@given(TYPES, TYPES)
def test_merge_is_symmetric_and_wide(a, b):
    assert schema.merge(a, b) == schema.merge(b, a)
    assert schema.merge(a, a) == a
    assert schema.merge(schema.merge(a, b), a) == schema.merge(a, b)


def test_types_of_values():
    assert schema.type_of(10) == T.DoubleType() and schema.type_of(10, True) == T.IntegerType() and schema.type_of(2**40, True) == T.LongType()
    assert schema.type_of([]) == T.ArrayType(T.StringType()) and schema.type_of([1, 10.5]) == T.ArrayType(T.DoubleType())
    assert schema.type_of(True) == T.BooleanType() and schema.type_of(None) == T.StringType()


def test_schema_from_analysis_reads_the_documents(spark, tmp_path):
    text = {"version": "1", "items": [{"a": 1, "tags": ["x"]}, {"a": 2.5, "b": {"c": "u"}, "tags": []}]}
    rows = [{"path": p, "value": v} for _, p, _, v, _, _ in shape.walk(text)]
    built = schema.from_analysis(rows)
    df = spark.createDataFrame([(json.dumps(text), "f_part0001.json")], "value string, file_name string")
    got = readers.parsed(df, built).selectExpr("source_file", "version", "items[1].b.c").first()
    assert tuple(got) == ("f.json", "1", "u")
    schema.save(built, tmp_path / "s.json")
    assert schema.load(tmp_path / "s.json") == built
    assert schema.paths(built)["items[].b.c"] == "string"


def test_schema_difference(spark):
    a, b = (spark.createDataFrame(x, "path string, type string") for x in ([("p", "int"), ("q", "int"), ("s", "x")], [("q", "string"), ("r", "int"), ("s", "x")]))
    assert {(r.path, r.kind) for r in schema.difference(a, b).collect()} == {("p", "only_left"), ("q", "mismatch"), ("r", "only_right")}


def test_schema_groups_skip_conflicts(spark):
    df = spark.createDataFrame([("a", "{}"), ("b", "{}"), ("c", "{}"), ("c", "[]")], "file_name string, schema_json string")
    got = {r.file_name: r.group_id for r in schema.schema_groups(df).collect()}
    assert set(got) == {"a", "b"} and got["a"] == got["b"]


def test_zip_views(spark):
    near = spark.createDataFrame([("60302", "60301", 1.2), ("60302", "60304", 14.9), ("60302", "60999", 15.0)], "zip1 string, zip2 string, miles double").withColumn("miles", F.col("miles").cast("decimal(10,7)"))
    every = joins.with_self_pairs(near)
    xref = spark.createDataFrame([(z, z, "s") for z in ("60302", "60301", "60304", "60999")], readers.XREF)
    got = {(r.zip1, r.zip2, float(r.distance_miles)) for r in joins.zip_distances(every, xref).collect()}
    assert got == {("60302", "60301", 1.2), ("60302", "60302", 0.0), ("60302", "60304", 14.9)}
    assert joins.with_self_pairs(every).count() == every.count()
    df = spark.createDataFrame([("606011234", 501)], "p string, z int")
    assert tuple(df.select(C.zip5(F.col("p")), C.zip_padded(F.col("z"))).first()) == ("60601", "00501")


def test_catalog(spark):
    plan = "array<struct<plan_name:string,plan_id_type:string,plan_id:string,plan_market_type:string>>"
    table = spark.createDataFrame([("s", "u1", "f1.json", [("p", "x", "1", "g"), ("q", "x", "2", "g")]), ("s", "u2", "f2.json", None), ("s", "u3", "f3.json", [])], f"source_name string, file_url string, file_name string, reporting_plans {plan}")
    assert views.reporting_plans(table).count() == 2
    assert [r.file_name for r in joins.files_of_plan(table, "q").collect()] == ["f1.json"]
    new = table.union(spark.createDataFrame([("s", "u4", "f4.json", None), ("s", "u4", "f5.json", None)], table.schema))
    assert joins.insert_missing(table, new, "source_name", "file_url").count() == 1


def test_prefer_parts(spark):
    names = ["f.json.gz", "f_part0001.json.gz", "f_part00002.json.gz", "g.json", "_splitted_h.json"]
    got = joins.prefer_parts(spark.createDataFrame([(n,) for n in names], "file_name string"))
    assert {r[0] for r in got.collect()} == {"f_part0001.json.gz", "f_part00002.json.gz", "g.json"}
    assert {r[0] for r in got.select(C.original_name(F.col("file_name"))).collect()} == {"f.json.gz", "g.json"}


def test_provider_names(spark):
    head = ["NPI", "Provider Organization Name (Legal Business Name)", "Provider Last Name (Legal Name)", "Provider First Name", "Provider Middle Name", "Provider First Line Business Practice Location Address", "Provider Second Line Business Practice Location Address"]
    head += [f"Provider Business Practice Location Address {x}" for x in ("City Name", "State Name", "Postal Code", "Telephone Number")]
    rows = [("1", "Org", None, None, None, "1 Main", " ", "Oak Park", "IL", "603021234", "555"), ("2", " ", "Doe", "Jo", " ", None, None, None, None, None, None), ("3", None, " ", "", None, "", None, None, " ", None, None)]
    got = [tuple(r) for r in joins.provider_columns(spark.createDataFrame(rows, T.StructType([T.StructField(h, T.StringType()) for h in head]))).select("provider_name", "practice_location").collect()]
    assert got == [("Org", "1 Main, Oak Park, IL, 60302, Tel: 555"), ("Jo Doe", ""), ("", "")]


def test_report(spark):
    rows = [("1,234.50", "A", "70450", "CT", "x"), ("10.5", "A", "70450", "CT", "y"), ("2.5", "B", "70450", None, "x"), ("", "B", "1", "d", "x"), ("5", " ", "1", "d", "x"), ("7", "B", "99", "other " * 30, "x")]
    df = spark.createDataFrame(rows, "negotiated_rate string, provider_name string, billing_code string, description string, billing_class string").withColumn("npi", F.lit("[1, 2]"))
    base = report.base(df)
    assert base.count() == 4
    own = report.settings(base).where("provider = 'A'").orderBy("place").collect()
    assert [(r.setting, r.low, r.npi) for r in own] == [("Setting A", 10, 2), ("Setting B", 1234, 2)]
    services, page = report.report(df)
    assert {r.name for r in services.collect()} == {"CT", "Unknown service", ("other " * 15).rstrip() + "..."}
    first = {r.name: r for r in page.collect()}
    assert first["B"].services[0].low in (2, 7) and first["A"].address == "Address not listed"
    many = spark.createDataFrame([(str(i), "A", "1", "d", f"c{i:02d}") for i in range(12)], df.drop("npi").schema)
    assert report.settings(report.base(many)).count() == 8
    assert report.settings(report.base(many)).first().npi == 1


@given(st.lists(st.integers(1, 40), max_size=30), st.integers(10, 60))
def test_greedy_parts(sizes, limit):
    part, filled, want = 1, 0, []
    for n in sizes:
        if filled + n > limit and filled:
            part, filled = part + 1, 0
        filled += n
        want.append(part)
    assert want == sorted(want)


def test_split_round_trip(spark):
    docs = spark.createDataFrame([("f.json.gz", "1", list(range(10))), ("g.json", "2", [5])], "source_file string, version string, items array<int>")
    parts = split.by_items(docs, "items", 4)
    back = parts.select("source_file", F.from_json("value", "version string, items array<int>").alias("d")).select("source_file", "d.version", F.explode("d.items").alias("i"))
    assert sorted(map(tuple, back.collect())) == sorted([("f.json.gz", "1", i) for i in range(10)] + [("g.json", "2", 5)])
    assert {r[0] for r in parts.select(split.part_name(F.col("source_file"), F.col("part"))).collect()} == {"f_part00001.json.gz", "f_part00002.json.gz", "f_part00003.json.gz", "g_part00001.json"}
    rows = spark.createDataFrame([("f", i, "x" * n) for i, n in enumerate([5, 5, 5, 30, 1, 1])], "file string, pos int, value string")
    assert [r.part for r in split.by_bytes(rows, 10).orderBy("pos").collect()] == [1, 1, 2, 3, 4, 4]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(i, [i], (i,)) for i in range(10)], "i int, a array<int>, s struct<x:int>")
    writers.csv(df, str(tmp_path / "c"), rows_per_file=4)
    back = readers.csv(spark, str(tmp_path / "c"))
    assert back.count() == 10 and back.where("i = 3").first().a == "[3]"
    writers.hash_partitioned(df, str(tmp_path / "h"), "i", 3)
    assert spark.read.parquet(str(tmp_path / "h")).where("bucket between 0 and 2").count() == 10
    writers.parquet(df, str(tmp_path / "p"), rows_per_file=5)
    assert spark.read.parquet(str(tmp_path / "p")).count() == 10
    doc = json.loads(writers.search_documents(df, "i").where("id = '2'").first().document)
    assert doc["a"] == [2] and "ingested_at" in doc
    writers.manifest(tmp_path / "m" / "manifest.json", rows=10)
    assert json.loads((tmp_path / "m" / "manifest.json").read_text()) == {"rows": 10}
    assert writers.array_safe(spark.createDataFrame([(None,)], "a array<int>")).first().a == []


def test_readers(spark, tmp_path):
    with gzip.open(tmp_path / "f_part0001.json.gz", "wt") as f:
        json.dump({"version": "1", "items": [{"a": 1}]}, f)
    df = readers.documents(spark, str(tmp_path / "f_part0001.json.gz"))
    assert df.first().source_file == "f.json.gz" and readers.top_level_arrays(df) == ["items"]
    (tmp_path / "i.json").write_text(json.dumps({"reporting_structure": [{"reporting_plans": [{"plan_name": "p"}], "in_network_files": [{"location": "https://x/a/b.json?x=1", "description": "d"}, {"location": ""}]}]}))
    assert [(r.file_name, r.reporting_plans[0].plan_name) for r in readers.index_files(readers.file_index(spark, str(tmp_path / "i.json"))).collect()] == [("b.json", "p")]
    (tmp_path / "x.csv").write_text("Code ,2nd Col,code\n007,nan,None\n")
    assert readers.csv(spark, str(tmp_path / "x.csv"), sanitize=True).columns == ["code", "col_2nd_col", "code_2"]
    (tmp_path / "n.csv").write_text("NPPES_NPI,b\n1,x\n1,y\n2,\n")
    assert readers.allow_list(spark, str(tmp_path / "n.csv")).count() == 2


def test_reference_filter(spark):
    df = spark.createDataFrame([("1", "60601-1234"), ("1.0", "606011234"), ("x", "60601"), ("1", "60302")], "code string, postal string")
    got = filters.reference_filter(df, "code", [1], "postal", ["60601"])
    assert got.count() == 2 and "postal_5digit" in got.columns
    assert filters.where_column(df, "none", lambda c: c == "x").count() == 4
    assert filters.where_column(df, "none", lambda c: c == "x", "none").count() == 0
    with pytest.raises(ValueError, match="none"):
        filters.where_column(df, "none", lambda c: c == "x", "raise")


def test_urls(spark):
    df = spark.createDataFrame([(1, "see https://x.org/a?b=1 and www.y.org, HTTP://Z.org"), (2, None)], "id int, note string")
    assert df.select(C.urls(F.col("note"))).collect()[0][0] == ["https://x.org/a?b=1", "https://www.y.org,", "HTTP://Z.org"]
    assert filters.url_column(df) == "note"
    name = df.select(C.file_of_url(F.lit("https://x.org/a?b=1"))).first()[0]
    got = joins.url_contents(df, F.col("note"), spark.createDataFrame([(name, "body")], "name string, value string"))
    assert {r.id: r.url_content for r in got.collect()} == {1: {"https://x.org/a?b=1": "body"}, 2: None}


def test_dimension_and_dedupe(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "k int, description string")
    dim, fact = joins.dimension(df, "description", "d_id")
    assert dim.count() == 1 and fact.join(dim, "d_id").count() == 2 and fact.where("d_id is null").count() == 1
    assert joins.group_prices(df, ["missing"]).count() == 3


def test_older_flattening(spark):
    df = spark.createDataFrame([(1, [(1, [("x",)]), (2, [])], ["s"])], "id int, a array<struct<id:int,b:array<struct<n:string>>>>, tags array<string>")
    got = flatten.auto_flatten(df)
    assert got.columns == ["id", "id_1", "n", "tags"] and got.count() == 2
    rows = spark.createDataFrame([(1, "p", "7"), (1, "p", "3"), (2, "q", None)], "row_id int, price string, npi string")
    assert {r.row_id: r.npi for r in flatten.regroup_prices(rows, "row_id").collect()} == {1: ["3", "7"], 2: []}
    assert providers.is_rate_array(T.ArrayType(T.StructType([T.StructField("negotiated_rate", T.DoubleType())])))
    assert not providers.is_rate_array(T.ArrayType(T.StringType()))


def test_streaming_lands_once(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"v{i}") for i in range(20)], "id long, v string")
    rows.repartition(2).write.parquet(str(tmp_path / "in"))
    run = lambda state: landing.land(landing.new_files(spark, str(tmp_path / "in"), rows.schema, per_batch=1), str(tmp_path / "out"), str(tmp_path / state), ["id"]).awaitTermination()
    run("s1")
    run("s1")
    run("s2")
    assert spark.read.parquet(str(tmp_path / "out")).count() == 20


def test_jobs(tmp_path):
    for bad in ({}, {"plan_name": "a", "file_name": "b"}, {"plan_name": "a", "zipcode_distance_miles": -1.0}):
        with pytest.raises(ValueError):
            jobs.ConvertRequest(**bad)

    def convert(request, tell):
        tell("half")
        if request.file_name == "bad":
            raise RuntimeError("no such file")
        return {"rows": 1}

    own = jobs.Jobs(convert)
    good, bad = own.submit(jobs.ConvertRequest(plan_name="p")), own.submit(jobs.ConvertRequest(file_name="bad"))
    own.close()
    assert (own.status(good).status, own.status(good).result) == (jobs.Status.COMPLETED, {"rows": 1})
    assert (own.status(bad).status, own.status(bad).error) == (jobs.Status.FAILED, "no such file")
    with pytest.raises(KeyError):
        own.status("none")
    assert jobs.list_of(" a, ,b ") == ["a", "b"] and jobs.list_of(" , ") is None
    assert jobs.substituted({"base": "/d", "in": {"path": "${base}/${run}", "n": 1}}, run="r")["in"] == {"path": "/d/r", "n": 1}
    assert jobs.run_id().startswith("run_")


SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")
def test_queries_match_their_twins(spark):
    import duckdb

    from tariffloom import operator_queries  # noqa: F401
    from tariffloom.queries import ORACLE, QUERIES

    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    plain = lambda v: None if v is None or v != v else round(float(v), 4) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    for name, make in QUERIES.items():
        start = time.time()
        df = make(spark, SF)
        names = sorted(df.columns)
        got = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=str)
        if name in ORACLE:
            cur = con.execute(ORACLE[name])
            have = [d[0] for d in cur.description]
            assert sorted(have) == names, name
            want = sorted((tuple(plain(r[have.index(c)]) for c in names) for r in cur.fetchall()), key=str)
            assert got == want, name
        assert time.time() - start < 120


def test_lists_and_whole_values(spark):
    df = spark.createDataFrame([(" a1 , 2,, b 3 ",), (" , ",), (None,)], "t string")
    assert [r[0] for r in df.select(C.list_items(F.col("t"))).collect()] == [["a1", "2", "b 3"], None, None]
    texts = ['{"a":1}', '{"a":1}]', '{"a":1}}', '{"a":1},', "", " ", '{"a":', "1", '1,"b":2', "null", None]
    got = filters.complete_items(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert sorted(r.value for r in got.collect()) == sorted(['{"a":1}', "1", "null"])


def test_jdbc_round_trip_reads_where_the_database_of_the_driver_is_not(spark, tmp_path, monkeypatch):
    """An executor has none of the tables of a database in the driver's memory; in a local session they share one program, so
    that database is dropped before the rows are read."""
    import uuid
    from types import SimpleNamespace

    from pyspark.errors import PySparkException
    from py4j.protocol import Py4JJavaError

    from tariffloom import operator_queries

    spark.createDataFrame([(k, None if k == 7 else f"it's {k}", k % 25) for k in range(2500)], "s_suppkey long, s_name string, s_nationkey int").repartition(3).write.parquet(f"{tmp_path}/supplier.parquet")
    name = uuid.uuid4().hex
    monkeypatch.setattr(operator_queries, "uuid", SimpleNamespace(uuid4=lambda: SimpleNamespace(hex=name)))
    own = operator_queries.jdbc_round_trip(spark, str(tmp_path))
    with pytest.raises((PySparkException, Py4JJavaError)):  # dropping ends in an error, be it there or not
        spark._jvm.java.sql.DriverManager.getConnection(f"jdbc:derby:memory:t{name};drop=true")
    assert sorted((r.s_suppkey, r.s_name) for r in own.collect()) == [(k, None if k == 7 else f"it's {k}") for k in range(2500) if k % 25 < 10]
