"""Joins with reference data: plans, providers, postal codes, catalogs. Spark picks the strategy by measured sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tariffloom.functions import columns as C


def first_by(df: DataFrame, keys: list[str], *order) -> DataFrame:
    """One row for each key, the first in the given order."""
    return df.withColumn("_row", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_row = 1").drop("_row")


def join_structs(fact: DataFrame, structs: DataFrame, key: str = "source_file") -> DataFrame:
    """Adds a document's own columns to its rows; of several rows of a document the first by all columns counts."""
    return fact.join(first_by(structs, [key], *[c for c in structs.columns if c != key]), key, "left")


def enrich(fact: DataFrame, master: DataFrame, key: str = "npi", master_key: str = "npi") -> DataFrame:
    """Adds provider columns; one master row for each key."""
    own = first_by(master, [master_key], *[c for c in master.columns if c != master_key])
    own = own.withColumn("_key", F.col(master_key).cast("string")).drop(master_key)
    return fact.join(own, fact[key].cast("string") == own["_key"], "left").drop("_key")


def provider_columns(master: DataFrame) -> DataFrame:
    """Name, location and address columns of a provider master file with its long headers."""
    p = lambda name: F.col(f"`{name}`")
    at = "Provider Business Practice Location Address"
    organization, last, first, middle = "Provider Organization Name (Legal Business Name)", "Provider Last Name (Legal Name)", "Provider First Name", "Provider Middle Name"
    line1, line2 = "Provider First Line Business Practice Location Address", "Provider Second Line Business Practice Location Address"
    return master.select(
        p("NPI").cast("string").alias("npi"),
        C.provider_name(p(organization), p(first), p(middle), p(last)).alias("provider_name"),
        C.provider_location(p(line1), p(line2), p(f"{at} City Name"), p(f"{at} State Name"), p(f"{at} Postal Code"), p(f"{at} Telephone Number")).alias("practice_location"),
        p(organization).alias("provider_org_name"), p(last).alias("provider_last_name"), p(first).alias("provider_first_name"), p(middle).alias("provider_middle_name"),
        p(line1).alias("practice_addr_line1"), p(line2).alias("practice_addr_line2"), p(f"{at} City Name").alias("practice_city"), p(f"{at} State Name").alias("practice_state"),
        F.left(C.blank_to_null(p(f"{at} Postal Code")), F.lit(5)).alias("practice_postal_code"), p(f"{at} Telephone Number").alias("practice_phone"),
    )


def join_catalog(fact: DataFrame, catalog: DataFrame) -> DataFrame:
    """Adds the file catalog's columns by file name."""
    return fact.join(catalog, fact["source_file"] == catalog["file_name"], "left")


def files_of_plan(catalog: DataFrame, plan: str) -> DataFrame:
    """Catalog rows that list a plan of this name."""
    return catalog.where(F.exists("reporting_plans", lambda p: p["plan_name"] == plan))


def not_done(rows: DataFrame, done: DataFrame, *keys: str) -> DataFrame:
    """Rows that no row of done has the keys of."""
    return rows.join(done.select(*keys), list(keys), "left_anti")


def insert_missing(table: DataFrame, new: DataFrame, *keys: str) -> DataFrame:
    """The rows of new whose keys the table does not have, one for each key: what an upsert that does nothing on a conflict adds."""
    order = [F.to_json(F.struct(*new.columns))]
    return first_by(new, list(keys), *order).join(table.select(*keys), list(keys), "left_anti").select(*new.columns)


def zip_distances(proximity: DataFrame, xref: DataFrame, miles: float = 15.0) -> DataFrame:
    """(zip1, zip2, distance_miles) of postal codes less than some miles apart, over their tabulation areas."""
    a, b = xref.select(F.col("zip_code").alias("a"), F.col("zcta").alias("zip1")), xref.select(F.col("zip_code").alias("b"), F.col("zcta").alias("zip2"))
    near = proximity.where(F.col("miles") < miles).join(a, "zip1").join(b, "zip2").groupBy("a", "b").agg(F.min("miles").alias("distance_miles"))
    return near.select(C.zip_padded(F.col("a")).alias("zip1"), C.zip_padded(F.col("b")).alias("zip2"), "distance_miles")


def with_self_pairs(proximity: DataFrame) -> DataFrame:
    """The proximity table with a row of distance 0 for each code that has none with itself."""
    codes = proximity.select("zip1").distinct()
    there = proximity.where("zip1 = zip2").select("zip1")
    zero = F.lit(0).cast(proximity.schema["miles"].dataType)
    return proximity.select("zip1", "zip2", "miles").unionByName(codes.join(there, "zip1", "left_anti").select("zip1", F.col("zip1").alias("zip2"), zero.alias("miles")))


def zip_npis(master: DataFrame) -> DataFrame:
    """(NPI, zipcode) of the provider master."""
    return master.select("NPI", F.lpad(F.substring("Provider Business Practice Location Address Postal Code", 1, 5), 5, "0").alias("zipcode"))


def npis_near(zip_npi: DataFrame, distances: DataFrame, zipcode: str, miles: float | None = None) -> DataFrame:
    """Distinct providers in the codes near a code; without a distance, those of all listed codes."""
    near = distances.where(F.col("zip1") == zipcode)
    if miles is not None:
        near = near.where(F.col("distance_miles") <= miles)
    return zip_npi.join(near.select(F.col("zip2").alias("zipcode")), "zipcode", "left_semi").select(F.col("NPI").alias("npi")).distinct()


def url_contents(df: DataFrame, url: Column, content: DataFrame) -> DataFrame:
    """Adds url_content, a map from each address in a column to the content kept under its file name; null if there is none."""
    numbered = df.select(F.monotonically_increasing_id().alias("_row"), F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_rest"), C.urls(url).alias("_urls"))
    row = numbered.select("_row", "_rest", F.explode_outer("_urls").alias("_url"))
    own = content.select(F.col("name").alias("_name"), F.col("value").alias("_value"))
    found = row.withColumn("_name", C.file_of_url(F.col("_url"))).join(own, "_name", "left")
    pair = F.when(F.col("_value").isNotNull(), F.struct(F.col("_url").alias("url"), F.col("_value").alias("value")))
    each = found.groupBy("_row").agg(F.first("_rest").alias("_rest"), F.collect_set(pair).alias("_pairs"))
    content_map = F.when(F.size("_pairs") > 0, F.map_from_entries(F.array_sort("_pairs")))
    return each.select("_rest.*", content_map.alias("url_content"))


def group_prices(df: DataFrame, keys: list[str], npi: str = "npi", codes: str = "service_code") -> DataFrame:
    """One row for each combination of the keys, with its distinct identifiers and service codes, sorted; all rows unchanged if
    a key is missing."""
    if any(k not in df.columns for k in keys):
        return df
    collect = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))) if df.schema[c].dataType.typeName() == "array" else F.array_sort(F.collect_set(c))
    return df.groupBy(*keys).agg(*(collect(c).alias(c) for c in (npi, codes) if c in df.columns))


def dimension(fact: DataFrame, column: str, id_name: str) -> tuple[DataFrame, DataFrame]:
    """(dimension: id and value, fact with the id in place of the value). Ids are hashes of the value, so they need no
    global sort and stay the same from run to run; a null has the id null."""
    key = F.when(F.col(column).isNotNull(), F.left(F.sha2(F.col(column).cast("string").cast("binary"), 256), F.lit(16)))
    table = fact.where(F.col(column).isNotNull()).select(key.alias(id_name), F.col(column)).distinct()
    return table, fact.withColumn(id_name, key).drop(column)


def prefer_parts(files: DataFrame, name: str = "file_name") -> DataFrame:
    """Files without the originals that are there as split parts too, and without those marked as split."""
    base = C.original_name(F.col(name))
    part = F.col(name).rlike(r"_part\d{4,5}\.json(\.gz)?$")
    own = files.where(~F.col(name).startswith("_splitted_")).withColumn("_part", part)
    split = F.bool_or("_part").over(W.partitionBy(base))
    return own.withColumn("_split", split).where(F.col("_part") | ~F.col("_split")).drop("_part", "_split")


def same_rows_once(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def by_name(*parts: DataFrame) -> DataFrame:
    """All rows, columns matched by name; missing ones are null."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
