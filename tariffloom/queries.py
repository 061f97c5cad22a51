"""One query for each operator that the driver's tables can show, with its DuckDB twin.

The tables are flat, so nested inputs are built inside the query, and the twin uses the flat relation. Every output is
named; counts are long, sums double, money is rounded to cents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from tariffloom.functions import columns as C
from tariffloom.operators import filters, flatten, joins, providers, report, schema, shape, split
from tariffloom.plans import views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as nested documents: an item for each order, its lines as prices, suppliers as provider references."""
    line = _t(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.collect_list(F.struct(F.col("l_linenumber").alias("line"), F.col("l_extendedprice").alias("negotiated_rate"), F.col("l_returnflag").alias("billing_class"), F.array("l_linestatus").alias("service_code"))).alias("negotiated_prices")
    )
    own = _t(spark, sf, "orders").join(line, F.col("o_orderkey") == F.col("l_orderkey"))
    item = F.struct(F.col("o_orderkey").cast("string").alias("billing_code"), F.col("o_orderpriority").alias("billing_code_type"), F.array(F.struct("negotiated_prices")).alias("negotiated_rates"))
    return own.select(F.concat(F.lit("f"), F.pmod("o_orderkey", F.lit(97)), F.lit(".json")).alias("source_file"), F.array(item).alias("in_network"))


@_query("""
    SELECT 'f' || (o_orderkey % 97) || '.json' AS source_file, CAST(o_orderkey AS VARCHAR) AS billing_code, o_orderpriority AS billing_code_type,
      l_linenumber AS line, round(l_extendedprice, 2) AS rate, l_returnflag AS billing_class, l_linestatus AS service_code
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def nested_flatten_rates(spark, sf):
    """Documents written as JSON, parsed with their schema, flattened to a row for each price with short names."""
    docs = _documents(spark, sf)
    kind = _parse_datatype_string("in_network " + docs.schema["in_network"].dataType.simpleString())
    raw = docs.select("source_file", F.to_json(F.struct("in_network")).alias("value")).select("source_file", F.from_json("value", kind).alias("d")).select("source_file", "d.*")
    rows = flatten.simplify(flatten.flatten_rates(raw))
    return rows.select("source_file", "billing_code", "billing_code_type", "line", F.round("negotiated_rate", 2).alias("rate"), "billing_class", F.col("service_code")[0].alias("service_code"))


def _customers(spark, sf):
    orders = _t(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").groupBy("o_custkey").agg(F.collect_list(F.struct("o_orderkey", "o_orderstatus")).alias("orders"))
    own = _t(spark, sf, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    return own.select("c_custkey", F.coalesce("orders", F.array().cast(orders.schema["orders"].dataType)).alias("orders"))


@_query("SELECT c_custkey, o_orderkey, o_orderstatus FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_orderpriority = '1-URGENT'")
def explode_all_inner(spark, sf):
    return flatten.simplify(flatten.explode_all(_customers(spark, sf)))


@_query("SELECT c_custkey, o_orderkey, o_orderstatus FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderpriority = '1-URGENT'")
def explode_outer_keep(spark, sf):
    return flatten.simplify(flatten.explode_all(_customers(spark, sf), outer=True))


def _priced(spark, sf):
    rates = _t(spark, sf, "lineitem").select(F.lit("f").alias("source_file"), "l_orderkey", "l_linenumber", F.col("l_suppkey").cast("double").alias("provider_references"))
    known = _t(spark, sf, "supplier").where("s_suppkey % 2 = 0").select(F.lit("f").alias("source_file"), F.col("s_suppkey").cast("string").alias("provider_group_id"), F.col("s_name").alias("npi"))
    return rates, known


_JOINED = "SELECT l_orderkey, l_linenumber, s_name AS npi FROM lineitem {} JOIN supplier ON l_suppkey = s_suppkey AND s_suppkey % 2 = 0"


@_query(_JOINED.format("LEFT"))
def provider_left_join(spark, sf):
    return providers.join_providers(*_priced(spark, sf)).select("l_orderkey", "l_linenumber", "npi")


@_query(_JOINED.format("INNER"))
def provider_inner_join(spark, sf):
    return providers.join_providers(*_priced(spark, sf), how="inner").select("l_orderkey", "l_linenumber", "npi")


@_query("SELECT CAST(count(*) AS BIGINT) AS raw_matches, CAST((SELECT count(*) FROM lineitem JOIN supplier ON l_suppkey = s_suppkey AND s_suppkey % 2 = 0) AS BIGINT) AS canonical_matches FROM lineitem JOIN supplier ON CAST(CAST(l_suppkey AS DOUBLE) AS VARCHAR) = CAST(s_suppkey AS VARCHAR) AND s_suppkey % 2 = 0")
def canonical_key_join(spark, sf):
    rates, known = _priced(spark, sf)
    n = lambda canonical: providers.join_providers(rates, known, "inner", canonical).select(F.lit(canonical).alias("canonical"))
    return n(False).unionByName(n(True)).agg(F.count_if(~F.col("canonical")).alias("raw_matches"), F.count_if("canonical").alias("canonical_matches"))


@_query("""
    SELECT 'f' || (o_orderkey % 97) || '.json' AS source_file, o_orderkey, s_suppkey AS npi FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    JOIN supplier ON l_suppkey = s_suppkey WHERE o_orderpriority = '2-HIGH'""")
def provider_flatten_inline(spark, sf):
    """Groups of suppliers written into documents, flattened to provider rows."""
    line = _t(spark, sf, "lineitem").join(_t(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).groupBy("l_orderkey").agg(F.collect_list("s_suppkey").alias("npi"))
    own = _t(spark, sf, "orders").where("o_orderpriority = '2-HIGH'").join(line, F.col("o_orderkey") == F.col("l_orderkey"))
    ref = F.array(F.struct(F.col("o_orderkey").alias("provider_group_id"), F.array(F.struct("npi")).alias("provider_groups")))
    raw = own.select(F.concat(F.lit("f"), F.pmod("o_orderkey", F.lit(97)), F.lit(".json")).alias("source_file"), ref.alias("provider_references"))
    return providers.inline_providers(raw).select("source_file", F.col("provider_group_id").cast("long").alias("o_orderkey"), F.col("npi").cast("long").alias("npi"))


@_query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey IN (1, 2, 3))")
def filter_npi_semi(spark, sf):
    return filters.npi_filter(_t(spark, sf, "lineitem"), _t(spark, sf, "supplier").where("s_nationkey in (1, 2, 3)").select("s_suppkey"), "l_suppkey").select("l_orderkey", "l_linenumber")


_SIZE = "SELECT p_partkey, p_size FROM part WHERE "


@_query(_SIZE + "p_size BETWEEN 5 AND 9 OR p_size BETWEEN 40 AND 42")
def filter_code_range(spark, sf):
    return filters.where_column(_t(spark, sf, "part"), "p_size", lambda c: filters.matches(c, ["5-9", "40–42"])).select("p_partkey", "p_size")


@_query("SELECT p_partkey, p_brand FROM part WHERE p_brand IN ('Brand#12', 'Brand#23', 'Brand#34')")
def filter_code_exact(spark, sf):
    return _t(spark, sf, "part").where(filters.matches(F.col("p_brand"), ["Brand#12", "Brand#23", "Brand#34"])).select("p_partkey", "p_brand")


@_query(_SIZE + "p_size BETWEEN 1 AND 3 OR p_size IN (10, 20)")
def filter_code_mixed(spark, sf):
    return _t(spark, sf, "part").where(filters.matches(F.col("p_size"), ["1-3", "10", "20"])).select("p_partkey", "p_size")


@_query("SELECT p_partkey, p_type FROM part WHERE contains(lower(p_type), 'prom')")
def filter_contains_ci(spark, sf):
    return _t(spark, sf, "part").where(filters.contains_ci(F.col("p_type"), "Prom")).select("p_partkey", "p_type")


@_query("SELECT doc_id, quality, toxic FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL OR toxic IS NOT NULL")
def drop_blank_rows(spark, sf):
    own = _t(spark, sf, "documents").select("doc_id").join(_t(spark, sf, "labels"), "doc_id", "left").select("doc_id", "quality", "toxic")
    return filters.not_blank(own, ("doc_id",))


@_query("SELECT event_id, props->>'k' AS k FROM events")
def json_props_extract(spark, sf):
    return _t(spark, sf, "events").select("event_id", C.json_field(F.col("props"), "k").alias("k"))


@_query("""
    SELECT o_custkey, o_orderstatus AS plan_name, o_orderpriority AS plan_id_type, CAST(o_orderkey AS VARCHAR) AS plan_id, 'group' AS plan_market_type
    FROM orders WHERE o_orderstatus = 'F'""")
def plans_lateral_view(spark, sf):
    """Plans kept as JSON text in a catalog, a row for each."""
    plan = F.struct(F.col("o_orderstatus").alias("plan_name"), F.col("o_orderpriority").alias("plan_id_type"), F.col("o_orderkey").cast("string").alias("plan_id"), F.lit("group").alias("plan_market_type"))
    catalog = _t(spark, sf, "orders").where("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.to_json(F.collect_list(plan)).alias("reporting_plans"))
    return flatten.explode_plans(catalog)


def _shapes(spark, sf):
    """Events as documents whose keys depend on the event: one file for each user and type."""
    own = _t(spark, sf, "events").select(F.concat_ws("_", "event_type", F.pmod("user_id", F.lit(50))).alias("file_name"), "event_type", "user_id", "event_id", "props")
    item = F.when(F.pmod("user_id", F.lit(3)) == 0, F.to_json(F.struct("event_id", "props"))).when(F.pmod("user_id", F.lit(3)) == 1, F.to_json(F.struct("event_id"))).otherwise(F.to_json(F.struct("event_id", F.struct(F.lit("https://x.org/a").alias("location")).alias("link"))))
    first = own.withColumn("_n", F.row_number().over(W.partitionBy("file_name").orderBy("event_id"))).where("_n = 1")
    value = F.concat(F.lit('{"version":1,"items":['), item, F.lit("]}"))
    return first.select("file_name", F.lit("s").alias("source_name"), F.col("event_id").alias("file_size"), value.alias("value"))


_SHAPES = """
    WITH e AS (SELECT event_type || '_' || (user_id % 50) AS file_name, user_id, event_id, row_number() OVER (PARTITION BY event_type || '_' || (user_id % 50) ORDER BY event_id) AS n FROM events),
    d AS (SELECT file_name, user_id % 3 AS k, event_id AS file_size FROM e WHERE n = 1),
    a AS (
      SELECT file_name, file_size, 0 AS level, 'version' AS path, FALSE AS url FROM d UNION ALL SELECT file_name, file_size, 0, 'items', k = 2 FROM d
      UNION ALL SELECT file_name, file_size, 1, 'items[0].event_id', FALSE FROM d UNION ALL SELECT file_name, file_size, 1, 'items[0].props', FALSE FROM d WHERE k = 0
      UNION ALL SELECT file_name, file_size, 1, 'items[0].link', TRUE FROM d WHERE k = 2 UNION ALL SELECT file_name, file_size, 2, 'items[0].link.location', TRUE FROM d WHERE k = 2)
"""


@_query(_SHAPES + "SELECT file_name, level, path, split_part(split_part(path, '.', 1), '[', 1) AS top_level_key, url AS url_in_value FROM a")
def shape_analysis_rows(spark, sf):
    return shape.analyze(_shapes(spark, sf)).select("file_name", "level", "path", C.top_key(F.col("path")).alias("top_level_key"), "url_in_value")


@_query(_SHAPES + """,
    f AS (SELECT file_name, string_agg(DISTINCT regexp_replace(path, '\\[\\d+\\]', '[]', 'g'), ', ' ORDER BY regexp_replace(path, '\\[\\d+\\]', '[]', 'g')) AS schema_sig, max(file_size) AS file_size, bool_or(url) AS has_urls FROM a GROUP BY file_name),
    g AS (SELECT *, min(file_size) OVER (PARTITION BY schema_sig) AS low FROM f)
    SELECT schema_sig, file_name, file_size, file_size = low AS is_min_file, min(CASE WHEN file_size = low THEN file_name END) OVER (PARTITION BY schema_sig) AS min_file_name,
      low AS min_file_name_size, has_urls, count(*) OVER (PARTITION BY schema_sig) AS file_count, 'group_' || left(sha256(schema_sig), 12) AS group_id FROM g""")
def schema_signature_groups(spark, sf):
    return schema.groups(schema.signatures(shape.analyze(_shapes(spark, sf))))


@_query(_SHAPES + """,
    f AS (SELECT file_name, string_agg(DISTINCT regexp_replace(path, '\\[\\d+\\]', '[]', 'g'), ', ' ORDER BY regexp_replace(path, '\\[\\d+\\]', '[]', 'g')) AS schema_sig, max(file_size) AS file_size, bool_or(url) AS has_urls FROM a GROUP BY file_name),
    g AS (SELECT *, min(file_size) OVER (PARTITION BY schema_sig) AS low FROM f)
    SELECT schema_sig, min(CASE WHEN file_size = low THEN file_name END) AS min_file_name, bool_or(has_urls) AS has_urls, count(*) AS file_count FROM g GROUP BY schema_sig""")
def schema_group_summary(spark, sf):
    return schema.group_summary(schema.groups(schema.signatures(shape.analyze(_shapes(spark, sf)))))


@_query("""
    SELECT file_name, record_type, CAST(length(payload) AS INTEGER) AS payload_size, payload FROM (
      SELECT CAST(event_id AS VARCHAR) AS file_name, 'k' AS record_type, '"' || (props->>'k') || '"' AS payload FROM events WHERE (props->>'k') IS NOT NULL AND json_type(props, '$.k') = 'VARCHAR'
      UNION ALL SELECT CAST(event_id AS VARCHAR), 'k', CAST(props->'k' AS VARCHAR) FROM events WHERE json_type(props, '$.k') <> 'VARCHAR')""")
def landing_rows(spark, sf):
    """One row for each top-level key of JSON texts."""
    return shape.landing(_t(spark, sf, "events").select(F.col("event_id").cast("string").alias("file_name"), F.col("props").alias("value"))).select("file_name", "record_type", "payload_size", "payload")


@_query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS n FROM lineitem) WHERE n = 1")
def top1_per_group(spark, sf):
    own = _t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("file_name"), F.lit("line").alias("record_type"), F.col("l_extendedprice").alias("payload_size"), F.col("l_linenumber").alias("id"))
    return shape.largest_payloads(own).select(F.col("file_name").alias("l_orderkey"), F.col("id").alias("l_linenumber"), F.col("payload_size").alias("l_extendedprice"))


@_query("""
    SELECT p_brand AS array_key, word, n, CAST(rank AS INTEGER) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY n, word) AS rank FROM (SELECT p_brand, word, count(*) AS n FROM (SELECT p_brand, unnest(string_split(p_name, ' ')) AS word FROM part) GROUP BY ALL)) WHERE rank <= 5 AND n < 3""")
def rare_keys(spark, sf):
    words = _t(spark, sf, "part").select(F.col("p_brand").alias("array_key"), F.explode(F.split("p_name", " ")).alias("word"))
    return shape.rare_keys(shape.key_counts(words, "array_key", "word"), "array_key", "word").select("array_key", "word", "n", "rank")


@_query("""
    SELECT DISTINCT p_brand AS file_name, p_partkey AS item_id, p_size > 40 AS has_rare FROM (
      SELECT *, row_number() OVER (PARTITION BY p_brand, word ORDER BY (p_size > 40) DESC, p_partkey) AS n FROM (SELECT p_brand, p_partkey, p_size, unnest(list_distinct(string_split(p_name, ' '))) AS word FROM part)) WHERE n = 1""")
def items_with_new_keys(spark, sf):
    items = _t(spark, sf, "part").select(F.col("p_brand").alias("file_name"), F.lit("part").alias("record_type"), F.col("p_partkey").alias("item_id"), (F.col("p_size") > 40).alias("has_rare"), F.array_distinct(F.split("p_name", " ")).alias("keys"))
    return shape.new_key_items(items).select("file_name", "item_id", "has_rare")


def _proximity(spark, sf):
    n = _t(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    pair = n.join(n.toDF("m", "r"), F.expr("n_regionkey = r and n_nationkey <> m"))
    return pair.select((F.col("n_nationkey") + 1000).cast("string").alias("zip1"), (F.col("m") + 1000).cast("string").alias("zip2"), (F.abs(F.col("n_nationkey") - F.col("m")) * 1.5).cast("decimal(10,7)").alias("miles"))


_PROX = "p AS (SELECT CAST(a.n_nationkey + 1000 AS VARCHAR) AS zip1, CAST(b.n_nationkey + 1000 AS VARCHAR) AS zip2, CAST(abs(a.n_nationkey - b.n_nationkey) * 1.5 AS DECIMAL(10,7)) AS miles FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey <> b.n_nationkey)"


@_query(f"WITH {_PROX} SELECT zip1, zip2, CAST(miles AS DOUBLE) AS miles FROM p UNION ALL SELECT DISTINCT zip1, zip1, 0.0 FROM p")
def self_pair_insert(spark, sf):
    return joins.with_self_pairs(_proximity(spark, sf)).withColumn("miles", F.col("miles").cast("double"))


@_query(f"WITH {_PROX}, q AS (SELECT * FROM p UNION ALL SELECT DISTINCT zip1, zip1, 0 FROM p) SELECT lpad(zip1, 5, '0') AS zip1, lpad(zip2, 5, '0') AS zip2, CAST(min(miles) AS DOUBLE) AS distance_miles FROM q WHERE miles < 15 GROUP BY ALL")
def zip_distance_pairs(spark, sf):
    near = joins.with_self_pairs(_proximity(spark, sf))
    xref = near.select(F.col("zip1").alias("zip_code"), F.col("zip1").alias("zcta")).distinct()
    return joins.zip_distances(near, xref).withColumn("distance_miles", F.col("distance_miles").cast("double"))


@_query(f"WITH {_PROX} SELECT DISTINCT s_suppkey AS npi FROM supplier JOIN p ON zip2 = CAST(s_nationkey + 1000 AS VARCHAR) WHERE zip1 = '1001' AND miles <= 9")
def npis_near_zip(spark, sf):
    near = _proximity(spark, sf).withColumnRenamed("miles", "distance_miles")
    own = _t(spark, sf, "supplier").select(F.col("s_suppkey").alias("NPI"), (F.col("s_nationkey") + 1000).cast("string").alias("zipcode"))
    return joins.npis_near(own, near, "1001", 9)


@_query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderpriority = '1-URGENT')")
def anti_unanalyzed(spark, sf):
    done = _t(spark, sf, "orders").where("o_orderdate >= timestamp'1997-01-01' and o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.not_done(_t(spark, sf, "customer").select("c_custkey"), done, "c_custkey")


@_query("SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '5-LOW'")
def semi_exists_plan(spark, sf):
    plans = _t(spark, sf, "orders").groupBy("o_custkey").agg(F.collect_list(F.struct(F.col("o_orderpriority").alias("plan_name"))).alias("reporting_plans"))
    return joins.files_of_plan(plans, "5-LOW").select("o_custkey")


@_query("SELECT o_custkey, o_orderstatus, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) AS n FROM orders WHERE o_orderkey % 2 = 1) x WHERE n = 1 AND NOT EXISTS (SELECT 1 FROM orders y WHERE y.o_orderkey % 2 = 0 AND y.o_custkey = x.o_custkey AND y.o_orderstatus = x.o_orderstatus)")
def upsert_do_nothing(spark, sf):
    """The rows that an insert adds where a conflict does nothing."""
    own = _t(spark, sf, "orders").select("o_custkey", "o_orderstatus", "o_orderkey")
    first = joins.first_by(own.where("o_orderkey % 2 = 1"), ["o_custkey", "o_orderstatus"], "o_orderkey")
    return joins.insert_missing(own.where("o_orderkey % 2 = 0"), first, "o_custkey", "o_orderstatus")


@_query("""
    SELECT c_custkey, CASE WHEN nullif(trim(CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE ' ' END), '') IS NOT NULL THEN c_name
      ELSE concat_ws(' ', nullif(trim(c_mktsegment), ''), nullif(trim(''), ''), nullif(trim(n_name), '')) END AS provider_name,
      concat_ws(', ', nullif(trim(c_mktsegment), ''), nullif(trim(n_name), ''), left(nullif(trim(lpad(CAST(c_custkey AS VARCHAR), 9, '6')), ''), 5), 'Tel: ' || CAST(c_custkey AS VARCHAR)) AS practice_location
    FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def provider_display_name(spark, sf):
    own = _t(spark, sf, "customer").join(_t(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    organization = F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).otherwise(" ")
    none = F.lit(None).cast("string")
    place = C.provider_location(F.col("c_mktsegment"), none, F.col("n_name"), F.lit(" "), F.lpad(F.col("c_custkey").cast("string"), 9, "6"), F.col("c_custkey").cast("string"))
    return own.select("c_custkey", C.provider_name(organization, F.col("c_mktsegment"), F.lit(""), F.col("n_name")).alias("provider_name"), place.alias("practice_location"))


@_query("SELECT p_brand, p_type, string_agg(DISTINCT CAST(l_suppkey AS VARCHAR), ',' ORDER BY CAST(l_suppkey AS VARCHAR)) AS npis FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand, p_type")
def group_collect_npis(spark, sf):
    own = _t(spark, sf, "lineitem").join(_t(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).select("p_brand", "p_type", F.col("l_suppkey").cast("string").alias("npi"))
    return joins.group_prices(own, ["p_brand", "p_type"]).select("p_brand", "p_type", F.array_join("npi", ",").alias("npis"))


def _facts(spark, sf):
    own = _t(spark, sf, "lineitem").join(_t(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).join(_t(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    return own.select(
        F.format_string("%.2f", "l_extendedprice").alias("negotiated_rate"), F.col("s_name").alias("provider_name"), F.col("p_brand").alias("billing_code"), F.col("p_type").alias("description"),
        F.col("l_returnflag").alias("billing_class"), F.col("l_linestatus").alias("negotiated_type"), F.lit("").alias("negotiation_arrangement"), F.col("s_nationkey").cast("string").alias("npi"),
    )


_FACTS = """
    WITH b AS (SELECT s_name AS provider, p_brand || '|' || p_type AS service_key, p_brand AS code, p_type AS service, CAST(printf('%.2f', l_extendedprice) AS DOUBLE) AS rate, l_returnflag AS bc, l_linestatus AS nt, s_nationkey AS npi
      FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey),
    v AS (SELECT service_key, code, service, count(DISTINCT provider) AS coverage FROM b GROUP BY ALL),
    t AS (SELECT *, CAST(row_number() OVER (ORDER BY coverage DESC, code, service, service_key) AS INTEGER) AS rank FROM v QUALIFY rank <= 10),
    ps AS (SELECT provider, service_key, min(rate) AS low, max(rate) AS high FROM b GROUP BY ALL),
    tot AS (SELECT provider, count(*) AS present, sum(low) AS low_sum, sum(high) AS high_sum, (sum(low) + sum(high)) / 2 AS mid_sum FROM ps JOIN t USING (service_key) GROUP BY provider)
"""


@_query(_FACTS + "SELECT service_key, code, service, coverage, rank FROM t")
def report_coverage_topk(spark, sf):
    return report.top_services(report.coverage(report.provider_services(report.base(_facts(spark, sf)))), 10).select("service_key", "code", "service", "coverage", "rank")


@_query(_FACTS + """, h AS (SELECT * FROM tot ORDER BY present DESC, mid_sum, provider LIMIT 20)
    SELECT provider, present, round(low_sum, 2) AS low_sum, round(high_sum, 2) AS high_sum, CAST(row_number() OVER (ORDER BY mid_sum, provider) AS INTEGER) AS rank FROM h""")
def report_provider_totals(spark, sf):
    pairs = report.provider_services(report.base(_facts(spark, sf)))
    top = report.top_providers(report.provider_totals(pairs, report.top_services(report.coverage(pairs), 10)), 20)
    return top.select("provider", "present", F.round("low_sum", 2).alias("low_sum"), F.round("high_sum", 2).alias("high_sum"), "rank")


@_query(_FACTS + """, s AS (SELECT provider, service_key, bc, nt, min(rate) AS low, max(rate) AS high, count(DISTINCT npi) AS npi FROM b GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY provider, service_key ORDER BY low, bc, nt) AS place, count(*) OVER (PARTITION BY provider, service_key) AS n_settings FROM s)
    SELECT provider, service_key, bc AS billing_class, nt AS negotiated_type, 'Setting ' || chr(CAST(64 + place AS INTEGER)) AS setting, CAST(round_even(low, 0) AS BIGINT) AS low, CAST(round_even(high, 0) AS BIGINT) AS high, npi, n_settings FROM r WHERE place <= 8""")
def report_settings_top8(spark, sf):
    return report.settings(report.base(_facts(spark, sf))).select("provider", "service_key", "billing_class", "negotiated_type", "setting", "low", "high", "npi", "n_settings")


@_query(_FACTS + """, d AS (SELECT provider, mid_sum / avg(mid_sum) OVER () - 1 AS delta FROM tot)
    SELECT provider, round(delta, 6) AS delta, CASE WHEN delta < -0.08 THEN 'below' WHEN delta > 0.08 THEN 'above' ELSE 'near' END AS standing FROM d""")
def report_delta_vs_avg(spark, sf):
    pairs = report.provider_services(report.base(_facts(spark, sf)))
    return report.against_average(report.provider_totals(pairs, report.top_services(report.coverage(pairs), 10))).select("provider", F.round("delta", 6).alias("delta"), "standing")


@_query("""SELECT p_partkey, left(sha256(p_type), 16) AS type_id, p_type FROM part""")
def dim_fact_normalize(spark, sf):
    """A dimension with ids that are hashes, and the fact that refers to it, joined back."""
    dim, fact = joins.dimension(_t(spark, sf, "part").select("p_partkey", "p_type"), "p_type", "type_id")
    return fact.join(dim, "type_id", "left").select("p_partkey", "type_id", "p_type")


@_query(r"""SELECT page_id, u AS url, 'url_' || left(md5(u), 16) || '.json' AS file, list_extract(string_split(split_part(u, '?', 1), '/'), -1) AS tail FROM (SELECT page_id, regexp_extract(url, '(?:https?://|www\.)[A-Za-z0-9\-._~:/?#@!$&()*+,;=%]+', 0, 'i') AS u FROM pages)""")
def url_extract(spark, sf):
    u = C.first_url(F.col("url"))
    return _t(spark, sf, "pages").select("page_id", u.alias("url"), C.file_of_url(u).alias("file"), C.url_tail(u).alias("tail"))


@_query(r"""SELECT page_id, regexp_matches(html, '(?i)(https?://|www\.)[A-Za-z0-9\-._~:/?#@!$&()*+,;=%]') AS has_url, CAST(len(list_distinct(regexp_extract_all(html, '(?i)(?:https?://|www\.)[A-Za-z0-9\-._~:/?#@!$&()*+,;=%]+'))) AS INTEGER) AS n_urls FROM pages""")
def url_detect(spark, sf):
    return _t(spark, sf, "pages").select("page_id", C.has_url(F.col("html")).alias("has_url"), F.size(C.urls(F.col("html"))).alias("n_urls"))


@_query("""SELECT CAST(o_custkey AS VARCHAR) AS source_file, part, CAST(count(*) AS INTEGER) AS items, min(o_orderkey) AS first_item FROM (SELECT o_custkey, o_orderkey, CAST((row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 3 + 1 AS BIGINT) AS part FROM orders) GROUP BY ALL""")
def split_by_items(spark, sf):
    docs = _t(spark, sf, "orders").groupBy(F.col("o_custkey").cast("string").alias("source_file")).agg(F.array_sort(F.collect_list("o_orderkey")).alias("in_network"))
    parts = split.by_items(docs, "in_network", 3).withColumn("items", F.from_json("value", "in_network array<bigint>")["in_network"])
    return parts.select("source_file", "part", F.size("items").alias("items"), F.array_min("items").alias("first_item"))


@_query("""
    WITH RECURSIVE s AS (SELECT CAST(o_custkey AS VARCHAR) AS file, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k,
        length('{"o_orderkey":' || o_orderkey || ',"o_orderpriority":"' || o_orderpriority || '"}') AS n FROM orders),
    r AS (SELECT file, k, CAST(1 AS BIGINT) AS part, n AS filled, n FROM s WHERE k = 1
      UNION ALL SELECT s.file, s.k, r.part + CAST(r.filled + s.n > 160 AS BIGINT), CASE WHEN r.filled + s.n > 160 THEN s.n ELSE r.filled + s.n END, s.n FROM r JOIN s ON s.file = r.file AND s.k = r.k + 1)
    SELECT file, part, count(*) AS items, CAST(sum(n) AS BIGINT) AS bytes FROM r GROUP BY file, part""")
def split_by_bytes(spark, sf):
    """Greedy parts by bytes: where a part starts depends on the one before."""
    rows = _t(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("file"), F.col("o_orderkey").alias("pos"), F.to_json(F.struct("o_orderkey", "o_orderpriority")).alias("value"))
    return split.by_bytes(rows, 160).groupBy("file", "part").agg(F.count("*").alias("items"), F.sum(F.octet_length("value")).alias("bytes"))


@_query("""SELECT coalesce(a.path, b.path) AS path, a.type AS left_type, b.type AS right_type, CASE WHEN b.type IS NULL THEN 'only_left' WHEN a.type IS NULL THEN 'only_right' ELSE 'mismatch' END AS kind
    FROM (SELECT p_brand || p_size AS path, min(p_type) AS type FROM part WHERE p_partkey % 2 = 0 GROUP BY 1) a FULL JOIN (SELECT p_brand || p_size AS path, min(p_type) AS type FROM part WHERE p_partkey % 2 = 1 GROUP BY 1) b USING (path) WHERE a.type IS NULL OR b.type IS NULL OR a.type <> b.type""")
def schema_diff(spark, sf):
    half = lambda k: _t(spark, sf, "part").where(F.col("p_partkey") % 2 == k).groupBy(F.concat("p_brand", "p_size").alias("path")).agg(F.min("p_type").alias("type"))
    return schema.difference(half(0), half(1))


@_query("SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier")
def union_by_name(spark, sf):
    a = _t(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return joins.by_name(a, _t(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance")))


@_query("SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey FROM lineitem")
def dedupe_rows(spark, sf):
    return joins.same_rows_once(_t(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_suppkey"))


@_query("SELECT l_suppkey, l_returnflag, count(DISTINCT round(l_extendedprice, 0)) AS count_rates, round(avg(round(l_extendedprice, 0)), 4) AS avg_rates FROM lineitem GROUP BY ALL")
def distinct_rate_stats(spark, sf):
    own = report.price_stats(_t(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", F.round("l_extendedprice", 0).alias("negotiated_rate")), ["l_suppkey", "l_returnflag"])
    return own.select("l_suppkey", "l_returnflag", "count_rates", F.round("avg_rates", 4).alias("avg_rates"))


@_query("SELECT f AS file_name FROM (SELECT *, bool_or(part) OVER (PARTITION BY base) AS split FROM (SELECT f, regexp_replace(f, '_part\\d{4,5}(\\.json(\\.gz)?)$', '\\1') AS base, regexp_matches(f, '_part\\d{4,5}\\.json(\\.gz)?$') AS part FROM (SELECT 'c' || (c_custkey % 500) || CASE WHEN c_custkey % 3 = 0 THEN '_part' || lpad(CAST(c_custkey % 7 AS VARCHAR), 4 + CAST(c_custkey % 2 AS INTEGER), '0') ELSE '' END || '.json.gz' AS f FROM customer))) WHERE part OR NOT split")
def prefer_split_parts(spark, sf):
    k = F.col("c_custkey")
    part = F.when(k % 3 == 0, F.concat(F.lit("_part"), F.lpad((k % 7).cast("string"), F.lit(4), F.lit("0")))).otherwise("")
    part = F.when((k % 3 == 0) & (k % 2 == 1), F.concat(F.lit("_part"), F.lpad((k % 7).cast("string"), F.lit(5), F.lit("0")))).otherwise(part)
    return joins.prefer_parts(_t(spark, sf, "customer").select(F.concat(F.lit("c"), k % 500, part, F.lit(".json.gz")).alias("file_name")))


@_query("SELECT o_orderkey, c_name, c_mktsegment FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 = 0) ON o_custkey = c_custkey")
def enrich_provider_data(spark, sf):
    master = _t(spark, sf, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("npi"), "c_name", "c_mktsegment")
    return joins.enrich(_t(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("npi")), master).select("o_orderkey", "c_name", "c_mktsegment")


@_query("SELECT c_custkey, c_mktsegment, left(regexp_replace(lpad(CAST(c_custkey AS VARCHAR), 7, '60601'), '[^0-9]', '', 'g'), 5) AS zip_5digit FROM customer WHERE c_nationkey IN (3, 5) AND left(lpad(CAST(c_custkey AS VARCHAR), 7, '60601'), 5) IN ('60601', '60600', '60606')")
def reference_filter(spark, sf):
    own = _t(spark, sf, "customer").select("c_custkey", "c_mktsegment", F.col("c_nationkey").cast("string").alias("code"), F.lpad(F.col("c_custkey").cast("string"), 7, "60601").alias("zip"))
    return filters.reference_filter(own, "code", [3.0, 5.0], "zip", ["60601-1234", "60600", "60606"]).select("c_custkey", "c_mktsegment", "zip_5digit")


@_query("SELECT l_orderkey, CAST(count(*) AS INTEGER) AS kept FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 10) GROUP BY l_orderkey")
def array_npi_filter(spark, sf):
    own = _t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_suppkey").alias("npis"))
    kept = filters.array_in_set(own, "npis", _t(spark, sf, "supplier").where("s_nationkey < 10").select("s_suppkey"))
    return kept.select("l_orderkey", F.size("npis").alias("kept"))


_PLAN_SQL = """
    WITH prices AS (SELECT 'f' || (o_custkey % 10) AS file_name, o_orderstatus AS plan_name, l_suppkey AS npi, l_returnflag AS negotiated_type, p_brand AS billing_code, l_extendedprice AS rate
      FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey WHERE p_brand = (SELECT min(p_brand) FROM part) AND o_orderstatus = 'F')
    SELECT npi, plan_name, file_name, billing_code, negotiated_type, count(DISTINCT rate) AS count_rates, round(avg(rate), 4) AS avg_rates, s_name, CAST(s_nationkey + 1000 AS VARCHAR) AS zipcode, CAST(abs(s_nationkey - 1) AS DOUBLE) * 1.5 AS miles
    FROM prices JOIN supplier ON npi = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE abs(s_nationkey - 1) * 1.5 < 15 GROUP BY ALL"""


@_query(_PLAN_SQL)
def plan_price_nearby(spark, sf):
    """Prices of a code under a plan at providers near a place: the flagship."""
    own = _t(spark, sf, "orders").join(_t(spark, sf, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).join(_t(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    file = F.concat(F.lit("f"), F.pmod("o_custkey", F.lit(10)), F.lit("_"), F.col("o_orderstatus"))
    plans = _t(spark, sf, "orders").select(F.col("o_orderstatus").alias("plan_name"), file.alias("file_name")).distinct()
    prices = own.groupBy(file.alias("file_name"), F.col("l_returnflag").alias("negotiated_type"), F.col("p_brand").alias("billing_code"), F.col("l_extendedprice").alias("negotiated_rate"), "l_orderkey", "l_linenumber").agg(F.collect_list("l_suppkey").alias("npis"))
    code = _t(spark, sf, "part").agg(F.min("p_brand")).first()[0]
    place = _t(spark, sf, "supplier").select(F.col("s_suppkey").alias("npi"), "s_name", (F.col("s_nationkey") + 1000).cast("string").alias("zipcode"))
    near = _t(spark, sf, "nation").select((F.col("n_nationkey") + 1000).cast("string").alias("zipcode"), (F.abs(F.col("n_nationkey") - 1).cast("double") * 1.5).alias("miles")).where("miles < 15")
    out = views.plan_price_nearby(plans, prices, place, near, "F", code)
    return out.select("npi", "plan_name", F.split_part("file_name", F.lit("_"), F.lit(1)).alias("file_name"), "billing_code", "negotiated_type", "count_rates", F.round("avg_rates", 4).alias("avg_rates"), "s_name", "zipcode", "miles")


@_query("SELECT CAST(sum(n) AS BIGINT) AS items, CAST(count(*) AS BIGINT) AS files FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)")
def array_length_sum(spark, sf):
    own = _t(spark, sf, "orders").groupBy("o_custkey").agg(F.collect_list("o_orderkey").alias("in_network"))
    return split.array_lengths(own, "in_network")


@_query("SELECT c_mktsegment AS record_type, CASE WHEN max(c_custkey % 5) > 0 THEN 'array' ELSE 'scalar' END AS kind FROM customer GROUP BY 1")
def scalar_or_array(spark, sf):
    return shape.scalar_or_array(_t(spark, sf, "customer").select(F.col("c_mktsegment").alias("record_type"), (F.col("c_custkey") % 5).alias("record_index")))


@_query("SELECT o_orderkey, o_orderstatus, o_totalprice AS price FROM orders")
def ndjson_round_trip(spark, sf):
    """Documents to one JSON text an item and back."""
    docs = _t(spark, sf, "orders").groupBy("o_custkey").agg(F.collect_list(F.struct("o_orderkey", "o_orderstatus", "o_totalprice")).alias("in_network")).drop("o_custkey")
    back = flatten.to_ndjson(docs).select(F.from_json("value", "in_network struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>")["in_network"].alias("i"))
    return back.select("i.o_orderkey", "i.o_orderstatus", F.col("i.o_totalprice").alias("price"))


@_query("SELECT event_type, count(DISTINCT event_id) AS n FROM events GROUP BY event_type")
def stream_landing_incremental(spark, sf):
    """A file stream lands the events once; a second run from the same checkpoint, and one from a new one, add nothing."""
    import uuid

    from tariffloom.session import shared_dir
    from tariffloom.streaming import landing

    at = f"{shared_dir(spark)}/tariffloom-landing-{uuid.uuid4().hex}"
    static = _t(spark, sf, "events")
    for state in ("one", "one", "two"):
        stream = landing.new_files(spark, sf, static.schema, glob="events.parquet")
        landing.land(stream, f"{at}/table", f"{at}/{state}", ["event_id"]).awaitTermination()
    return spark.read.parquet(f"{at}/table").groupBy("event_type").agg(F.count("*").alias("n"))
