"""Further queries, one for each operator that `queries` does not reach, with their DuckDB twins.

Sources and sinks are shown by a round trip: a table is written to the shared folder in the form, read by the library's
reader, and compared with the table itself.
"""

from __future__ import annotations

import atexit
import contextlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tariffloom.functions import columns as C
from tariffloom.operators import catalog, filters, flatten, joins, providers, report, schema, shape, split
from tariffloom.plans import convert, resolve, views
from tariffloom.plans.jobs import ConvertRequest
from tariffloom.queries import _FACTS, _PROX, _SHAPES, _customers, _documents, _facts, _proximity, _query, _shapes, _t
from tariffloom.session import shared_dir
from tariffloom.sources import files, readers, writers

_made: list[tuple[SparkSession, str]] = []


def _folder(spark: SparkSession, tag: str) -> str:
    """A new folder that driver and executors share; it goes when the program ends, as plans may read it until then."""
    at = f"{shared_dir(spark)}/tariffloom-{tag}-{uuid.uuid4().hex}"
    _made.append((spark, at))
    return at


@atexit.register
def _clear_away() -> None:
    for spark, at in _made:
        with contextlib.suppress(Exception):  # the session may be gone before
            path = spark._jvm.org.apache.hadoop.fs.Path(at)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _literal(spark: SparkSession, rows: list[tuple], kind: str) -> DataFrame:
    return spark.createDataFrame(rows, kind)


# --- filters -------------------------------------------------------------------------------------------------------


@_query("SELECT p_partkey, p_size FROM part WHERE p_size = 7")
def filter_equals(spark, sf):
    return _t(spark, sf, "part").where(filters.equals_value(F.col("p_size"), 7)).select("p_partkey", "p_size")


@_query("SELECT n_nationkey, n_name FROM nation WHERE n_name = 'NATION_1' OR contains(n_name, 'NATION_1')")
def filter_like_core(spark, sf):
    return _t(spark, sf, "nation").where(filters.like_core(F.col("n_name"), "NATION_1")).select("n_nationkey", "n_name")


@_query("SELECT count(*) AS skipped, CAST(0 AS BIGINT) AS none FROM region")
def filter_missing_column(spark, sf):
    own = _t(spark, sf, "region")
    n = lambda how: filters.where_column(own, "absent", lambda c: c == "x", how).select(F.lit(how).alias("how"))
    return n("skip").unionByName(n("none")).agg(F.count_if(F.col("how") == "skip").alias("skipped"), F.count_if(F.col("how") == "none").alias("none"))


@_query("SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey FROM supplier")
def cast_all_to_text(spark, sf):
    return filters.stringified(_t(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey"))


@_query("SELECT s_name, s_suppkey FROM supplier")
def keep_columns(spark, sf):
    return filters.keep_columns(_t(spark, sf, "supplier"), ["s_name", "absent", "s_suppkey"])


@_query("SELECT s_suppkey, NULL::VARCHAR AS kept FROM supplier")
def drop_null_columns(spark, sf):
    none = F.lit(None).cast("string")
    return filters.drop_null_columns(_t(spark, sf, "supplier").select("s_suppkey", none.alias("gone"), none.alias("kept")), ("kept",))


@_query("SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE c_name END AS name FROM customer")
def missing_to_null(spark, sf):
    k = F.col("c_custkey") % 5
    text = F.when(k == 0, "  ").when(k == 1, "nan").when(k == 2, "None").otherwise(F.col("c_name"))
    return _t(spark, sf, "customer").select("c_custkey", C.missing_to_null(text).alias("name"))


@_query("SELECT 'url' AS by_name, 'body' AS by_value")
def url_column_found(spark, sf):
    pages = _t(spark, sf, "pages")
    by_value = filters.url_column(pages.select("page_id", F.lit("none").alias("note"), F.concat(F.lit("see "), "url").alias("body")))
    return _literal(spark, [(filters.url_column(pages), by_value)], "by_name string, by_value string")


def _catalog(spark, sf):
    url = F.concat(F.lit("https://host"), F.pmod("o_custkey", F.lit(7)), F.lit(".org/files/F"), F.col("o_orderkey"), F.lit(".json.gz?sig=1"))
    status = F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "O", "failed")
    return _t(spark, sf, "orders").where("o_orderkey < 4000").select("o_orderkey", url.alias("file_url"), C.url_tail(url).alias("file_name"), status.alias("download_status"), F.lit(None).cast("string").alias("file_path"))


_CATALOG = """
    WITH c AS (SELECT o_orderkey, 'https://host' || (o_custkey % 7) || '.org/files/F' || o_orderkey || '.json.gz?sig=1' AS file_url, 'F' || o_orderkey || '.json.gz' AS file_name,
      CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'failed' END AS download_status FROM orders WHERE o_orderkey < 4000)
"""


@_query(_CATALOG + "SELECT o_orderkey, file_name FROM c WHERE (contains(lower(file_url), 'host3') OR contains(lower(file_name), 'host3')) AND (download_status IS NULL OR download_status NOT IN ('failed'))")
def select_files_by_text(spark, sf):
    return catalog.select_files(_catalog(spark, sf), text="HOST3", not_status=["failed"]).select("o_orderkey", "file_name")


@_query(_CATALOG + "SELECT o_orderkey FROM c WHERE file_url IN (SELECT file_url FROM c WHERE o_orderkey IN (10, 20, 30))")
def select_files_by_url(spark, sf):
    own = _catalog(spark, sf)
    urls = [r.file_url for r in own.where("o_orderkey in (10, 20, 30)").select("file_url").collect()]
    return catalog.select_files(own, urls=urls).select("o_orderkey")


@_query(_SHAPES + "SELECT file_name, path FROM a WHERE path = 'items[0].link' OR starts_with(path, 'items[0].link.') OR starts_with(path, 'items[0].link[')")
def paths_below(spark, sf):
    return catalog.below(shape.analyze(_shapes(spark, sf)), "items[0].link").select("file_name", "path")


@_query("SELECT p_partkey, string_split(p_name, ' ')[1] AS first, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE CAST(len(string_split(p_name, ' ')) AS INTEGER) END AS items FROM part")
def list_items(spark, sf):
    text = F.when(F.col("p_partkey") % 4 == 0, " , ,").otherwise(F.replace("p_name", F.lit(" "), F.lit(" ,, ")))
    return _t(spark, sf, "part").select("p_partkey", F.split("p_name", " ")[0].alias("first"), F.size(C.list_items(text)).alias("items")).withColumn("items", F.when(F.col("items") >= 0, F.col("items")))


@_query("SELECT event_id FROM events WHERE event_id % 3 <> 0")
def complete_items(spark, sf):
    text = F.when(F.col("event_id") % 3 == 0, F.concat("props", F.lit("]"))).otherwise(F.col("props"))
    return filters.complete_items(_t(spark, sf, "events").select("event_id", text.alias("value"))).select("event_id")


# --- nested documents ----------------------------------------------------------------------------------------------


@_query("SELECT * FROM (VALUES ('in_network', TRUE, 3), ('plain', FALSE, 1), ('prices', TRUE, 1), ('provider_references', FALSE, 2)) v(name, is_rate, depth)")
def array_kinds(spark, sf):
    """What the arrays of a schema are, and which of them holds the providers: by name, else by its fields."""
    kind = "struct<source_file:string,plain:array<string>,prices:array<struct<negotiated_rate:double>>,in_network:array<struct<negotiated_rates:array<struct<negotiated_prices:array<struct<x:int>>>>>>,provider_references:array<struct<provider_groups:array<int>>>>"
    raw = spark.createDataFrame([], T._parse_datatype_string(kind))
    assert providers.provider_array(raw.schema) == "provider_references"
    rows = [(n, providers.is_rate_array(raw.schema[n].dataType), flatten.nested_depth(raw.schema[n].dataType)) for n in flatten.arrays_of(raw)]
    return _literal(spark, rows, "name string, is_rate boolean, depth int")


@_query("SELECT 'groups' AS by_shape, 'provider_references' AS by_name, CAST(NULL AS VARCHAR) AS none")
def provider_array_found(spark, sf):
    of = lambda kind: providers.provider_array(T._parse_datatype_string(kind))
    groups = "array<struct<provider_groups:array<int>>>"
    row = (of(f"struct<a:array<int>,groups:{groups}>"), of(f"struct<groups:{groups},provider_references:{groups}>"), of("struct<a:array<int>>"))
    return _literal(spark, [row], "by_shape string, by_name string, none string")


@_query("SELECT 'f' || c_custkey AS source_file, c_name AS version, c_mktsegment AS \"owner|segment\", CAST(c_nationkey AS INTEGER) AS \"owner|nation\" FROM customer")
def split_top_level(spark, sf):
    """Scalars and flattened structs of documents, arrays aside; scalars go only where that is asked for."""
    own = _t(spark, sf, "customer").select(F.concat(F.lit("f"), "c_custkey").alias("source_file"), F.col("c_name").alias("version"), F.struct(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation")).alias("owner"), F.array("c_custkey").alias("in_network"))
    arrays, rest = flatten.split_top_level(own)
    assert arrays == ["in_network"] and "version" not in flatten.split_top_level(own, drop_scalars=True)[1].columns
    return rest


@_query("SELECT o_orderkey, l_suppkey AS npi FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey")
def explode_npis(spark, sf):
    line = _t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_suppkey").alias("npi"))
    own = _t(spark, sf, "orders").join(line, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", "npi")
    return flatten.explode_npis(own)


@_query("""SELECT CAST(o_orderkey AS VARCHAR) AS billing_code, l_linenumber AS line, l_linestatus AS service_code FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def explode_service_codes(spark, sf):
    rows = flatten.simplify(flatten.flatten_rates(_documents(spark, sf), explode_codes=True))
    return rows.select("billing_code", "line", "service_code")


@_query("SELECT c_custkey, o_orderkey, o_orderstatus, c_custkey AS c_custkey_1 FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderpriority = '1-URGENT'")
def auto_flatten(spark, sf):
    own = _customers(spark, sf).withColumn("own", F.struct("c_custkey"))
    return flatten.auto_flatten(own).select("c_custkey", "o_orderkey", "o_orderstatus", "c_custkey_1")


@_query("SELECT l_orderkey, min(l_returnflag) AS flag, string_agg(DISTINCT lpad(CAST(l_suppkey AS VARCHAR), 5, '0'), ',' ORDER BY lpad(CAST(l_suppkey AS VARCHAR), 5, '0')) AS npis FROM lineitem GROUP BY l_orderkey")
def regroup_prices(spark, sf):
    low = _t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.min("l_returnflag").alias("flag"))
    own = _t(spark, sf, "lineitem").join(low, "l_orderkey").select("l_orderkey", "flag", F.lpad(F.col("l_suppkey").cast("string"), 5, "0").alias("npi"))
    return flatten.regroup_prices(own, "l_orderkey").select("l_orderkey", "flag", F.array_join("npi", ",").alias("npis"))


@_query("""SELECT 'f' || (s_nationkey % 3) AS source_file, CAST(s_nationkey AS VARCHAR) AS provider_group_id, 'p' || s_nationkey || '.json' AS provider_url_file, CAST(s_suppkey AS VARCHAR) AS npi
    FROM supplier WHERE s_nationkey % 4 <> 3""")
def linked_providers(spark, sf):
    """Provider groups in files of their own, as an object or as a list; a missing file is skipped."""
    url = F.concat(F.lit("https://x.org/a/p"), "s_nationkey", F.lit(".json"))
    by = _t(spark, sf, "supplier").groupBy("s_nationkey").agg(F.collect_list("s_suppkey").alias("npi"))
    ref = by.select(F.concat(F.lit("f"), F.col("s_nationkey") % 3).alias("source_file"), F.array(F.struct(F.col("s_nationkey").alias("provider_group_id"), url.alias("location"))).alias("provider_references"))
    groups = F.array(F.struct("npi"))
    body = F.when(F.col("s_nationkey") % 2 == 0, F.to_json(groups)).otherwise(F.to_json(F.struct(groups.alias("provider_groups"))))
    content = by.where("s_nationkey % 4 <> 3").select(C.file_of_url(url).alias("name"), body.alias("value"))
    return providers.linked_providers(providers.provider_links(ref), content)


@_query("SELECT l_orderkey, l_linenumber, s_name AS npi FROM lineitem JOIN supplier ON l_suppkey = s_suppkey")
def provider_join_across_files(spark, sf):
    rates = _t(spark, sf, "lineitem").select(F.concat(F.lit("a"), F.col("l_orderkey") % 5).alias("source_file"), "l_orderkey", "l_linenumber", F.col("l_suppkey").alias("provider_references"))
    known = _t(spark, sf, "supplier").select(F.concat(F.lit("b"), F.col("s_suppkey") % 5).alias("source_file"), F.col("s_suppkey").cast("string").alias("provider_group_id"), F.col("s_name").alias("npi"))
    return providers.join_providers(rates, known, "inner", across_files=True).select("l_orderkey", "l_linenumber", "npi")


@_query("SELECT l_orderkey, l_linenumber, l_suppkey AS npi FROM lineitem WHERE l_orderkey % 2 = 0")
def provider_join_of_key_arrays(spark, sf):
    """Rates that list several provider groups: the keys are exploded first."""
    keys = _t(spark, sf, "lineitem").where("l_orderkey % 2 = 0").select(F.lit("f").alias("source_file"), "l_orderkey", "l_linenumber", F.array("l_suppkey").alias("provider_references"))
    known = _t(spark, sf, "supplier").select(F.lit("f").alias("source_file"), F.col("s_suppkey").cast("string").alias("provider_group_id"), F.col("s_suppkey").alias("npi"))
    return providers.join_providers(flatten.explode_column(keys, "provider_references", True), known).select("l_orderkey", "l_linenumber", "npi")


# --- shapes, schemas, catalog --------------------------------------------------------------------------------------


@_query(_SHAPES + "SELECT file_name, level, path FROM a")
def shape_rows_older(spark, sf):
    return shape.analyze(_shapes(spark, sf), older=True).select("file_name", "level", "path")


@_query(_SHAPES + "SELECT level, count(*) AS n, count(DISTINCT path) AS paths FROM a GROUP BY level")
def level_histogram(spark, sf):
    return catalog.level_histogram(shape.analyze(_shapes(spark, sf)))


@_query(_SHAPES + "SELECT file_name, path FROM a WHERE url")
def first_urls(spark, sf):
    twice = shape.analyze(_shapes(spark, sf)).withColumn("id", F.explode(F.array(F.lit(2), F.lit(1))))
    return catalog.first_urls(twice).where("id = 1").select("file_name", "path")


@_query("""SELECT CAST(event_id AS VARCHAR) AS file_name, CAST(NULL AS VARCHAR) AS "array", 'k' AS key, CAST(1 AS BIGINT) AS n FROM events WHERE props LIKE '{"k":%'""")
def key_scan(spark, sf):
    return catalog.key_scan(_t(spark, sf, "events").select(F.col("event_id").cast("string").alias("file_name"), F.col("props").alias("value")))


@_query("SELECT o_custkey % 50 AS k, CAST(least(count(*), 4) AS INTEGER) AS kept FROM orders GROUP BY 1")
def landing_first_items(spark, sf):
    """Top-level arrays cut to their first items."""
    docs = _t(spark, sf, "orders").groupBy((F.col("o_custkey") % 50).alias("k")).agg(F.to_json(F.struct(F.collect_list("o_orderkey").alias("items"))).alias("value"))
    cut = shape.landing(docs.select(F.col("k").cast("string").alias("file_name"), "value"), 4)
    return cut.select(F.col("file_name").cast("long").alias("k"), F.size(F.from_json("payload", "array<bigint>")).alias("kept"))


@_query("SELECT 'f' || (o_custkey % 9) AS file_name, 'r' AS record_type, 'OBJECT<a: BIGINT, b: STRING>' AS schema FROM orders GROUP BY ALL")
def schema_of_payloads(spark, sf):
    payload = F.when(F.col("o_orderkey") % 2 == 0, F.to_json(F.struct(F.col("o_orderkey").alias("a")))).otherwise(F.to_json(F.struct(F.col("o_orderstatus").alias("b"))))
    both = _t(spark, sf, "orders").select(F.concat(F.lit("f"), F.col("o_custkey") % 9).alias("file_name"), F.lit("r").alias("record_type"), payload.alias("payload"))
    return schema.inferred(both)


@_query("SELECT * FROM (VALUES ('items[].a', 'double'), ('items[].b.c', 'string'), ('items[].d[]', 'double'), ('v', 'string')) v(path, type)")
def schema_from_analysis(spark, sf):
    """The schema that the analysis rows of a document give, as paths and types."""
    doc = {"v": "1", "items": [{"a": 1, "b": {"c": "x"}, "d": [1, 2.5]}]}
    rows = shape.analyze(_literal(spark, [("f", "s", 1, json.dumps(doc))], "file_name string, source_name string, file_size long, value string"))
    kind = schema.from_analysis([r.asDict() for r in rows.select("path", "value").collect()])
    return _literal(spark, sorted(schema.paths(kind).items()), "path string, type string")


@_query("""SELECT * FROM (VALUES ('1', 'double', 'int'), ('3000000000', 'double', 'bigint'), ('1.5', 'double', 'double'), ('true', 'boolean', 'boolean'), ('"x"', 'string', 'string'), ('null', 'string', 'string'),
    ('[1,2.5]', 'array<double>', 'array<int>'), ('{"a":1}', 'struct<a:double>', 'struct<a:int>'), ('[]', 'array<string>', 'array<string>')) v(value, type, sampled)""")
def types_of_values(spark, sf):
    values = ["1", "3000000000", "1.5", "true", '"x"', "null", "[1,2.5]", '{"a":1}', "[]"]
    return _literal(spark, [(v, schema.type_of(json.loads(v)).simpleString(), schema.type_of(json.loads(v), True).simpleString()) for v in values], "value string, type string, sampled string")


@_query("SELECT 'f' || c_custkey AS file_name, 'group_' || left(sha256('s' || (c_custkey % 4)), 12) AS group_id FROM customer WHERE c_custkey % 10 <> 0")
def schema_group_ids(spark, sf):
    """Files by their schema; a file with two different schemas has none."""
    own = _t(spark, sf, "customer").select(F.concat(F.lit("f"), "c_custkey").alias("file_name"), F.concat(F.lit("s"), F.col("c_custkey") % 4).alias("schema_json"), "c_custkey")
    other = own.where("c_custkey % 10 = 0").withColumn("schema_json", F.lit("other"))
    return schema.schema_groups(own.unionByName(other))


@_query(_CATALOG + "SELECT download_status, count(*) AS n, count(DISTINCT file_name) AS names FROM c GROUP BY 1")
def catalog_status_counts(spark, sf):
    return catalog.display(_catalog(spark, sf))


@_query(_CATALOG + "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'fresh' WHEN 1 THEN download_status ELSE download_status END AS download_status, CASE o_orderkey % 3 WHEN 1 THEN '/p' END AS file_path FROM c")
def status_changes(spark, sf):
    """A conditional update: what a change leaves null stays."""
    own = _catalog(spark, sf)
    change = own.where("o_orderkey % 3 < 2").select("file_url", F.when(F.col("o_orderkey") % 3 == 0, "fresh").alias("status"), F.when(F.col("o_orderkey") % 3 == 1, "/p").alias("file_path"))
    return catalog.set_status(own, change).select("o_orderkey", "download_status", "file_path")


@_query("SELECT min('f' || lpad(CAST(o_custkey AS VARCHAR), 6, '0')) AS file_name FROM orders WHERE o_orderpriority = '5-LOW'")
def file_of_plan(spark, sf):
    plans = _t(spark, sf, "orders").groupBy(F.concat(F.lit("f"), F.lpad(F.col("o_custkey").cast("string"), 6, "0")).alias("file_name")).agg(F.collect_list(F.struct(F.col("o_orderpriority").alias("plan_name"))).alias("reporting_plans"))
    return catalog.file_of_plan(plans, "5-LOW")


@_query(_CATALOG + "SELECT o_orderkey FROM c WHERE o_orderkey % 5 = 0")
def analyzed_files(spark, sf):
    own = _catalog(spark, sf)
    analyzed = own.where("o_orderkey % 5 = 0").select("file_name", F.explode(F.array(F.lit(1), F.lit(2))).alias("level"))
    return catalog.analyzed_files(own, analyzed).select("o_orderkey")


@_query("SELECT p_brand, list_aggregate(list_sort(list_filter(list(DISTINCT p_type), lambda x: x <> 'ECONOMY')), 'string_agg', ',') AS added FROM part GROUP BY p_brand")
def new_keys(spark, sf):
    own = _t(spark, sf, "part").groupBy("p_brand").agg(F.collect_set("p_type").alias("all"))
    added = F.array_join(F.array_sort(catalog.new_keys(F.col("all"), F.array(F.lit("ECONOMY")))), ",")
    return own.select("p_brand", F.when(added != "", added).alias("added"))


# --- joins, views --------------------------------------------------------------------------------------------------


@_query("SELECT l_orderkey, l_linenumber, o_orderstatus FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderkey % 2 = 0")
def join_document_columns(spark, sf):
    """A document's own columns for its rows; several rows of a document count once."""
    structs = _t(spark, sf, "orders").where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("source_file"), "o_orderstatus")
    fact = _t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("source_file"), "l_linenumber")
    return joins.join_structs(fact, structs.unionByName(structs)).select(F.col("source_file").alias("l_orderkey"), "l_linenumber", "o_orderstatus")


@_query("SELECT l_orderkey, l_linenumber, o_orderpriority FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus = 'F'")
def join_file_catalog(spark, sf):
    index = _t(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("file_name"), "o_orderpriority")
    fact = _t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("source_file"), "l_linenumber")
    return joins.join_catalog(fact, index).select(F.col("source_file").alias("l_orderkey"), "l_linenumber", "o_orderpriority")


@_query("SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'content ' || page_id END AS body FROM pages")
def url_contents(spark, sf):
    """The content kept for the addresses of a column, as a map."""
    own = _t(spark, sf, "pages").select("page_id", F.concat(F.lit("see https://own.org/p"), "page_id", F.lit(" there")).alias("note"))
    url = F.concat(F.lit("https://own.org/p"), "page_id")
    content = own.where("page_id % 2 = 0").select(C.file_of_url(url).alias("name"), F.concat(F.lit("content "), "page_id").alias("value"))
    return joins.url_contents(own, F.col("note"), content).select("page_id", F.get(F.map_values("url_content"), F.lit(0)).alias("body"))


@_query("""SELECT 'F' || o_custkey AS file_core, o_orderstatus AS plan_name FROM orders WHERE o_orderpriority = '1-URGENT'""")
def view_reporting_plans(spark, sf):
    plan = F.struct(F.col("o_orderstatus").alias("plan_name"), F.lit("t").alias("plan_id_type"), F.lit("i").alias("plan_id"), F.lit("m").alias("plan_market_type"))
    own = _t(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").groupBy(F.concat(F.lit("F"), "o_custkey", F.lit(".json.gz")).alias("file_name")).agg(F.collect_list(plan).alias("reporting_plans"))
    views.register(catalog=own)
    return spark.sql("SELECT file_core, plan_name FROM vw_mrf_reporting_plans")


@_query(f"WITH {_PROX}, q AS (SELECT * FROM p UNION ALL SELECT DISTINCT zip1, zip1, 0 FROM p) SELECT lpad(zip1, 5, '0') AS zip1, lpad(zip2, 5, '0') AS zip2, CAST(miles AS DOUBLE) AS distance_miles FROM q WHERE miles < 15")
def view_zip_distances(spark, sf):
    near = _proximity(spark, sf)
    xref = near.select(F.col("zip1").alias("zip_code"), F.col("zip1").alias("zcta")).distinct()
    views.register(proximity=near, xref=xref)
    return spark.sql("SELECT zip1, zip2, CAST(distance_miles AS DOUBLE) AS distance_miles FROM zip_zip_distance_15mi")


@_query("SELECT CAST(c_custkey AS VARCHAR) AS NPI, lpad(left(CAST(c_custkey * 7919 AS VARCHAR), 5), 5, '0') AS zipcode FROM customer")
def view_zip_npi(spark, sf):
    master = _t(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("NPI"), (F.col("c_custkey") * 7919).cast("string").alias("Provider Business Practice Location Address Postal Code"))
    views.register(master=master)
    return spark.sql("SELECT NPI, zipcode FROM zip_npi")


@_query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE c_mktsegment END AS name, left('A long text about ' || c_name || ' in the segment ' || c_mktsegment, 30) || '...' AS short FROM customer")
def first_filled_and_shortened(spark, sf):
    text = F.concat(F.lit("A long text about "), "c_name", F.lit(" in the segment "), "c_mktsegment")
    name = C.first_filled(F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).otherwise("  "), F.lit(None).cast("string"), F.col("c_mktsegment"))
    return _t(spark, sf, "customer").select("c_custkey", name.alias("name"), C.shortened(text, 30).alias("short"))


@_query("SELECT count(*) AS rows, count(DISTINCT c_custkey) AS keys, CAST(0 AS BIGINT) AS outside, CAST(1 AS BIGINT) AS most FROM customer")
def hash_buckets(spark, sf):
    """Partition numbers are within their range, and one for each key."""
    own = _t(spark, sf, "customer").select("c_custkey", C.hash_bucket(F.col("c_custkey").cast("string"), 10).alias("b"))
    each = own.groupBy("c_custkey").agg(F.countDistinct("b").alias("n"), F.count("*").alias("rows"), F.count_if(~F.col("b").between(0, 9)).alias("bad"))
    return each.agg(F.sum("rows").alias("rows"), F.count("*").alias("keys"), F.sum("bad").alias("outside"), F.max("n").alias("most"))


@_query("SELECT c_custkey, 'x' || c_custkey || '.json' AS name FROM customer")
def names_without_prefixes(spark, sf):
    mark = F.when(F.col("c_custkey") % 3 == 0, "_ingested_").when(F.col("c_custkey") % 3 == 1, "_ingested__analyzed_").otherwise("")
    return _t(spark, sf, "customer").select("c_custkey", C.without_prefixes(F.concat(mark, F.lit("x"), "c_custkey", F.lit(".json"))).alias("name"))


@_query("SELECT * FROM (VALUES ('Zip Code', 'zip_code'), ('zip-code', 'zip_code_2'), ('2nd', 'col_2nd'), ('', 'col'), ('%%', 'col_2')) v(header, name)")
def identifiers(spark, sf):
    taken: set[str] = set()
    return _literal(spark, [(h, C.identifier(h, taken)) for h in ("Zip Code", "zip-code", "2nd", "", "%%")], "header string, name string")


@_query("SELECT o_orderkey, strftime(o_orderdate, 'run_%Y%m%d_%H%M%S') AS run FROM orders")
def run_ids(spark, sf):
    return _t(spark, sf, "orders").select("o_orderkey", C.run_id(F.col("o_orderdate")).alias("run"))


@_query(_FACTS + """, s AS (SELECT provider, service_key, bc, nt, min(rate) AS low, max(rate) AS high FROM b GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY provider, service_key ORDER BY low, bc, nt) AS place FROM s),
    m AS (SELECT provider, median((round_even(low, 0) + round_even(high, 0)) / 2) AS median_mid FROM r WHERE place <= 8 AND service_key IN (SELECT service_key FROM t) GROUP BY provider)
    SELECT provider, round(low_sum, 2) AS low_sum, round(high_sum, 2) AS high_sum, round(100.0 * present / (SELECT count(*) FROM t), 4) AS coverage_pct, round(median_mid, 2) AS median_mid FROM tot LEFT JOIN m USING (provider)""")
def report_metrics(spark, sf):
    rows = report.base(_facts(spark, sf))
    pairs = report.provider_services(rows)
    out = report.metrics(pairs, report.top_services(report.coverage(pairs), 10), report.settings(rows))
    return out.select("provider", *(F.round(c, k).alias(c) for c, k in (("low_sum", 2), ("high_sum", 2), ("coverage_pct", 4), ("median_mid", 2))))


# --- sources and sinks, by round trips -----------------------------------------------------------------------------

_ORDERS = "SELECT 'd' || o_custkey || '.json' AS source_file, o_orderkey, o_orderstatus FROM orders WHERE o_custkey < 40"


def _written_documents(spark, sf, tag: str, name=None, gz: bool = False) -> str:
    """Documents of customers as JSON texts in files of their own; name: the file of each."""
    docs = _t(spark, sf, "orders").where("o_custkey < 40").groupBy("o_custkey").agg(F.to_json(F.struct(F.collect_list(F.struct("o_orderkey", "o_orderstatus")).alias("in_network"))).alias("value"))
    at = _folder(spark, tag)
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for r in docs.collect():  # the 40 files of a small fixture
        import gzip

        body = gzip.compress(r.value.encode()) if gz else r.value.encode()
        out = fs.create(spark._jvm.org.apache.hadoop.fs.Path(f"{at}/{(name or (lambda k: f'd{k}.json'))(r.o_custkey)}"))
        out.write(bytearray(body))
        out.close()
    return at


_DOC = "in_network array<struct<o_orderkey:bigint,o_orderstatus:string>>"


@_query(_ORDERS)
def scan_documents(spark, sf):
    """Whole files with a schema; the number of a split part is no part of the document's name."""
    at = _written_documents(spark, sf, "json", lambda k: f"d{k}_part0{k:03d}.json" if k % 2 else f"d{k}.json")
    return flatten.explode_all(readers.documents(spark, at, _DOC)).select("source_file", F.col("`in_network|o_orderkey`").alias("o_orderkey"), F.col("`in_network|o_orderstatus`").alias("o_orderstatus"))


@_query(_ORDERS.replace("'.json'", "'.json.gz'"))
def scan_compressed_documents(spark, sf):
    """Compressed whole files, their schema inferred over all of them."""
    at = _written_documents(spark, sf, "gz", lambda k: f"d{k}.json.gz", gz=True)
    return flatten.explode_all(readers.documents(spark, at)).select("source_file", F.col("`in_network|o_orderkey`").alias("o_orderkey"), F.col("`in_network|o_orderstatus`").alias("o_orderstatus"))


@_query(_ORDERS)
def scan_document_texts(spark, sf):
    """Whole files as text, parsed with a schema that was saved and loaded."""
    at = _written_documents(spark, sf, "text")
    kind = T.StructType.fromJson(json.loads(T._parse_datatype_string(f"struct<{_DOC.replace(' ', ':', 1)}>").json()))
    return readers.parsed(readers.document_texts(spark, at), kind).select("source_file", F.explode("in_network").alias("i")).select("source_file", "i.*")


@_query("SELECT event_id, event_type FROM events")
def scan_ndjson(spark, sf):
    at = _folder(spark, "ndjson")
    _t(spark, sf, "events").select("event_id", "event_type").write.json(at)
    return readers.ndjson(spark, at).select("event_id", "event_type")


@_query("SELECT s_suppkey, s_name FROM supplier")
def scan_csv(spark, sf):
    at = _folder(spark, "csv")
    writers.csv(_t(spark, sf, "supplier").select(F.col("s_suppkey").alias("Supp Key"), F.col("s_name").alias("name (legal)")), at)
    own = readers.csv(spark, at, sanitize=True)
    return own.select(F.col("supp_key").cast("long").alias("s_suppkey"), F.col("name_legal").alias("s_name"))


@_query("SELECT CAST(c_custkey AS VARCHAR) AS npi, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS name FROM customer")
def scan_provider_master(spark, sf):
    at = _folder(spark, "master")
    writers.csv(_t(spark, sf, "customer").select(F.col("c_custkey").alias("NPI"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).otherwise("nan").alias("name")), at)
    return readers.provider_master(spark, at).select(F.col("NPI").alias("npi"), "name")


@_query("SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS npi FROM orders")
def scan_allow_list(spark, sf):
    at = _folder(spark, "allow")
    writers.csv(_t(spark, sf, "orders").select(F.col("o_custkey").alias("NPPES_NPI")), at)
    return readers.allow_list(spark, at)


@_query("SELECT 'https://x.org/' || o_orderkey || '.json?k=1' AS file_url, o_orderkey || '.json' AS file_name, o_orderstatus AS plan_name FROM orders WHERE o_orderkey % 3 <> 0")
def index_files(spark, sf):
    """Index documents written and read, a row for each listed file that has an address."""
    url = F.when(F.col("o_orderkey") % 3 != 0, F.concat(F.lit("https://x.org/"), "o_orderkey", F.lit(".json?k=1"))).otherwise(" ")
    plan = F.array(F.struct(F.col("o_orderstatus").alias("plan_name"), F.lit("t").alias("plan_id_type"), F.lit("i").alias("plan_id"), F.lit("m").alias("plan_market_type")))
    part = F.struct(plan.alias("reporting_plans"), F.array(F.struct(url.alias("location"), F.lit("d").alias("description"))).alias("in_network_files"))
    at = _folder(spark, "index")
    _t(spark, sf, "orders").groupBy(F.col("o_custkey") % 20).agg(F.to_json(F.struct(F.collect_list(part).alias("reporting_structure"))).alias("value")).select("value").write.text(at)
    rows = readers.index_files(spark.read.schema(readers.INDEX).json(at))
    return rows.select("file_url", "file_name", F.col("reporting_plans")[0]["plan_name"].alias("plan_name"))


@_query("SELECT c_custkey, c_name FROM customer UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_custkey % 2 = 0")
def parquet_append(spark, sf):
    at = _folder(spark, "fact")
    own = _t(spark, sf, "customer").select("c_custkey", "c_name")
    writers.parquet(own, at, rows_per_file=500)
    writers.parquet(own.where("c_custkey % 2 = 0"), at, "append")
    return spark.read.parquet(at)


@_query("SELECT CAST(o_custkey AS VARCHAR) AS o_custkey, '[' || string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) || ']' AS orders FROM orders GROUP BY o_custkey")
def csv_with_nested_text(spark, sf):
    """Arrays as JSON text in CSV files of a bounded number of rows."""
    at = _folder(spark, "nested")
    writers.csv(_t(spark, sf, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list("o_orderkey")).alias("orders")), at, rows_per_file=100)
    return readers.csv(spark, at)


@_query("SELECT c_custkey, c_name FROM customer")
def parquet_by_hash(spark, sf):
    at = _folder(spark, "buckets")
    writers.hash_partitioned(_t(spark, sf, "customer").select("c_custkey", "c_name"), at, "c_custkey", 4)
    return spark.read.parquet(at).where("bucket between 0 and 3").select("c_custkey", "c_name")


@_query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN CAST(c_nationkey AS VARCHAR) ELSE '' END AS codes FROM customer")
def array_safe(spark, sf):
    own = _t(spark, sf, "customer").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.array("c_nationkey")).alias("codes"))
    return writers.array_safe(own).select("c_custkey", F.array_join("codes", ",").alias("codes"))


@_query("SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name, TRUE AS stamped FROM supplier")
def search_documents(spark, sf):
    docs = writers.search_documents(_t(spark, sf, "supplier").select("s_suppkey", "s_name"), "s_suppkey")
    body = F.from_json("document", "s_name string, ingested_at string")
    return docs.select("id", body["s_name"].alias("s_name"), body["ingested_at"].rlike(r"^\d{4}-\d\d-\d\dT").alias("stamped"))


@_query("SELECT CAST(o_custkey AS VARCHAR) AS source_file, CAST(count(*) AS BIGINT) AS items FROM orders WHERE o_custkey < 200 GROUP BY 1")
def parts_written(spark, sf):
    """Split parts as compressed files, read again."""
    docs = _t(spark, sf, "orders").where("o_custkey < 200").groupBy(F.col("o_custkey").cast("string").alias("source_file")).agg(F.array_sort(F.collect_list("o_orderkey")).alias("in_network"))
    at = _folder(spark, "parts")
    writers.parts(split.by_items(docs, "in_network", 3), at)
    back = spark.read.text(at).select(F.col("source_file").cast("string").alias("source_file"), F.size(F.from_json("value", "in_network array<bigint>")["in_network"]).alias("n"))
    return back.groupBy("source_file").agg(F.sum("n").alias("items"))


@_query("""SELECT CAST(o_custkey AS VARCHAR) AS source_file, 'x' || any_value(o_custkey) AS owner, count(*) AS items FROM orders GROUP BY o_custkey""")
def split_with_scalars(spark, sf):
    """Documents cut by bytes: part 0 has what is no array, the others all items."""
    docs = _t(spark, sf, "orders").groupBy(F.col("o_custkey").cast("string").alias("source_file")).agg(F.concat(F.lit("x"), F.first("o_custkey")).alias("owner"), F.collect_list(F.struct("o_orderkey", "o_orderstatus")).alias("in_network"))
    parts = split.documents_by_bytes(docs, 200).withColumn("d", F.from_json("value", "owner string, in_network array<struct<o_orderkey:bigint>>"))
    owner = F.max(F.when(F.col("part") == 0, F.col("d.owner")))
    return parts.groupBy("source_file").agg(owner.alias("owner"), F.sum(F.when(F.col("part") > 0, F.size("d.in_network")).otherwise(0)).alias("items"))


# --- conversion ----------------------------------------------------------------------------------------------------


def _rate_documents(spark, sf, typed: bool = True) -> DataFrame:
    """Orders as documents with inline providers; items without a code type if not typed."""
    line = _t(spark, sf, "lineitem").where("l_orderkey < 3000")
    price = F.struct(F.col("l_extendedprice").alias("negotiated_rate"), F.col("l_returnflag").alias("billing_class"), F.lit("negotiated").alias("negotiated_type"))
    rate = F.struct(F.array(F.col("l_suppkey")).alias("provider_references"), F.array(price).alias("negotiated_prices"))
    items = line.groupBy("l_orderkey").agg(F.collect_list(rate).alias("negotiated_rates"), F.collect_set("l_suppkey").alias("suppliers"))
    own = items.join(_t(spark, sf, "orders"), F.col("o_orderkey") == F.col("l_orderkey"))
    kind = [F.col("o_orderpriority").alias("billing_code_type")] if typed else []
    item = F.struct(F.col("o_orderstatus").alias("billing_code"), *kind, "negotiated_rates")
    group = F.transform("suppliers", lambda s: F.struct(s.alias("provider_group_id"), F.array(F.struct(F.array(s).alias("npi"))).alias("provider_groups")))
    return own.select(F.concat(F.lit("f"), "l_orderkey", F.lit(".json")).alias("source_file"), F.array(item).alias("in_network"), group.alias("provider_references"))


_RATES = """SELECT 'f' || l_orderkey || '.json' AS source_file, o_orderstatus AS billing_code, round(l_extendedprice, 2) AS rate, CAST(l_suppkey AS VARCHAR) AS npi
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_orderkey < 3000"""


def _prices(fact: DataFrame) -> DataFrame:
    return fact.select("source_file", "billing_code", F.round("negotiated_rate", 2).alias("rate"), "npi")


@_query(_RATES)
def convert_documents(spark, sf):
    """The conversion: nested documents with inline providers to a row for each price and provider."""
    return _prices(convert.fact(_rate_documents(spark, sf)))


@_query(_RATES + " AND o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
def convert_codes_and_type(spark, sf):
    return _prices(convert.fact(_rate_documents(spark, sf), convert.Request(codes=["F"], code_type="1-URGENT")))


@_query(_RATES + " AND o_orderstatus = 'F'")
def convert_codes_only(spark, sf):
    """A code filter on items without a code type."""
    return _prices(convert.fact(_rate_documents(spark, sf, typed=False), convert.Request(codes=["F"], code_type="1-URGENT")))


@_query(_RATES + " AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 5)")
def convert_npis(spark, sf):
    return _prices(convert.fact(_rate_documents(spark, sf), convert.Request(npis=_t(spark, sf, "supplier").where("s_nationkey < 5").select("s_suppkey"))))


@_query("SELECT CAST(0 AS BIGINT) AS with_providers, CAST(0 AS BIGINT) AS without_providers")
def convert_npi_empty(spark, sf):
    """An empty set of providers leaves no rows, be there provider columns or not."""
    none = convert.Request(npis=_t(spark, sf, "supplier").where("false").select("s_suppkey"))
    docs = _rate_documents(spark, sf)
    n = lambda d, k: convert.fact(d, none).select(F.lit(k).alias("k"))
    return n(docs, 1).unionByName(n(docs.drop("provider_references"), 2)).agg(F.count_if(F.col("k") == 1).alias("with_providers"), F.count_if(F.col("k") == 2).alias("without_providers"))


@_query("""SELECT (SELECT count(*) FROM lineitem WHERE l_orderkey < 3000) AS rates, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem WHERE l_orderkey < 3000)) AS providers,
    (SELECT count(DISTINCT l_orderkey) FROM lineitem WHERE l_orderkey < 3000) AS documents""")
def convert_snapshots(spark, sf):
    """The tables before the joins, written and read."""
    at = _folder(spark, "snapshots")
    writers.snapshots(convert.steps(_rate_documents(spark, sf)), at)
    n = lambda name, k: spark.read.parquet(f"{at}/{name}").select(F.lit(k).alias("k"))
    every = n("rates_prejoin", 1).unionByName(n("providers_prejoin", 2)).unionByName(n("structs_prejoin", 3))
    return every.agg(*(F.count_if(F.col("k") == k).alias(c) for k, c in ((1, "rates"), (2, "providers"), (3, "documents"))))


@_query(_RATES.replace("o_orderstatus AS billing_code, ", ""))
def convert_to_scalars(spark, sf):
    """Facts with every array exploded."""
    rows = convert.scalars_only(convert.fact(_rate_documents(spark, sf)))
    return rows.select("source_file", F.round("negotiated_rate", 2).alias("rate"), "npi")


@_query("SELECT o_orderstatus AS code, count(*) AS prices FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_orderkey < 3000 AND o_orderstatus IN ('F', 'O') AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 10) GROUP BY 1")
def convert_group_table(spark, sf):
    """The older conversion of a group: leaf names, code filter, identifiers in arrays."""
    line = _t(spark, sf, "lineitem").where("l_orderkey < 3000").join(_t(spark, sf, "orders"), F.col("o_orderkey") == F.col("l_orderkey"))
    docs = line.select(F.array(F.struct(F.col("o_orderstatus").alias("billing_code"), "l_linenumber", F.array("l_suppkey").alias("npi"))).alias("in_network"))
    rows = catalog.group_table(docs, codes=["F", "O"], npis=_t(spark, sf, "supplier").where("s_nationkey < 10").select("s_suppkey"))
    return rows.groupBy(F.col("billing_code").alias("code")).agg(F.count("*").alias("prices"))


@_query(f"""WITH {_PROX}, n AS (SELECT DISTINCT s_suppkey FROM supplier JOIN p ON zip2 = CAST(s_nationkey + 1000 AS VARCHAR) WHERE zip1 = '01001' AND miles <= 9)
    SELECT 'f' || l_orderkey || '.json' AS source_file, o_orderstatus AS billing_code, round(l_extendedprice, 2) AS rate, CAST(l_suppkey AS VARCHAR) AS npi
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_orderkey < 3000 AND o_orderpriority = '5-LOW' AND o_orderstatus = 'F' AND l_suppkey IN (SELECT s_suppkey FROM n)""".replace("CAST(a.n_nationkey + 1000 AS VARCHAR) AS zip1", "'0' || CAST(a.n_nationkey + 1000 AS VARCHAR) AS zip1"))
def convert_request(spark, sf):
    """A request by plan, code and postal code: its files, its providers near, and the conversion of both."""
    plan = F.array(F.struct(F.col("o_orderpriority").alias("plan_name")))
    index = _t(spark, sf, "orders").select(F.concat(F.lit("f"), "o_orderkey", F.lit(".json")).alias("file_name"), plan.alias("reporting_plans"))
    near = _proximity(spark, sf).select(F.concat(F.lit("0"), "zip1").alias("zip1"), "zip2", F.col("miles").alias("distance_miles"))
    places = _t(spark, sf, "supplier").select(F.col("s_suppkey").alias("NPI"), (F.col("s_nationkey") + 1000).cast("string").alias("zipcode"))
    found = resolve.resolve(ConvertRequest(plan_name="5-LOW", cpt_code="F, X", zipcode="1001", zipcode_distance_miles=9), index, places, near)
    return _prices(convert.fact(resolve.documents_of(_rate_documents(spark, sf), found.files), found.request))


@_query("SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey < 10")
def jdbc_round_trip(spark, sf):
    """A table of a database, written and read by a query in fetches; the database is the one that comes with Spark.

    It lives inside one program, so the driver writes it, and the executors read a copy in the shared folder.
    """
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", "/dev/null")  # no log file beside the program
    name = f"jdbc:derby:memory:t{uuid.uuid4().hex}"
    driver = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    writers.jdbc_here(_t(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey"), f"{name};create=true", "suppliers", **driver)
    copy = writers.derby_copy(spark, name, _folder(spark, "database"))
    with contextlib.suppress(Exception):  # Derby tells by an error that a database has been dropped
        spark._jvm.java.sql.DriverManager.getConnection(f"{name};drop=true")
    own = readers.jdbc(spark, copy, 'SELECT "s_suppkey", "s_name" FROM suppliers WHERE "s_nationkey" < 10', 50, **driver)
    return own.select("s_suppkey", "s_name")


@_query("SELECT 'group_' || (o_custkey % 3) AS group_dir, CASE WHEN o_custkey % 2 = 0 THEN 'd' || o_custkey || '.json' ELSE 'd' || o_custkey || '_part00001.json' END AS file_name FROM orders WHERE o_custkey < 40 GROUP BY ALL")
def files_below_groups(spark, sf):
    """Files of group folders, split parts instead of their originals."""
    at = _folder(spark, "groups")
    keys = [r.k for r in _t(spark, sf, "orders").where("o_custkey < 40").select(F.col("o_custkey").alias("k")).distinct().collect()]
    for k in keys:
        files.write_text(f"{at}/group_{k % 3}/d{k}.json", "{}")
        if k % 2:
            files.write_text(f"{at}/group_{k % 3}/d{k}_part00001.json", "{}")
    files.write_text(f"{at}/group_0/main_schema.json", "{}")
    files.write_text(f"{at}/other/d1.json", "{}")
    return readers.files_below(spark, at, "d").select("group_dir", "file_name")


@_query("SELECT * FROM (VALUES ('a', 'struct'), ('b', 'array')) v(name, kind)")
def schema_saved(spark, sf):
    """A schema written as JSON and read again."""
    at = f"{_folder(spark, 'schema')}/schema.json"
    kind = T._parse_datatype_string("a struct<x:int>, b array<string>")
    schema.save(kind, at)
    back = schema.load(at)
    assert back == kind
    return _literal(spark, [(f.name, f.dataType.typeName()) for f in back.fields], "name string, kind string")


@_query("SELECT DISTINCT o_custkey % 5 AS k, o_orderstatus AS status FROM orders ORDER BY k, status")
def ordered_rows(spark, sf):
    """Distinct rows in order, as the catalog and the signature lists are given."""
    return _t(spark, sf, "orders").select((F.col("o_custkey") % 5).alias("k"), F.col("o_orderstatus").alias("status")).distinct().orderBy("k", "status")
