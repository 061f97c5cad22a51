"""Readers: nested documents, newline-delimited JSON, reference tables, catalogs and allow-lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tariffloom.functions import columns as C

# The schema of a file index.
INDEX = "reporting_structure array<struct<reporting_plans:array<struct<plan_name:string,plan_id_type:string,plan_id:string,plan_market_type:string>>,in_network_files:array<struct<location:string,description:string>>>>"
PROXIMITY = "zip1 string, zip2 string, miles decimal(10,7)"
XREF = "zip_code string, zcta string, source string"


def documents(spark: SparkSession, paths: str | list[str], schema: T.StructType | str | None = None) -> DataFrame:
    """Whole-file JSON documents (.json, .json.gz), one row each, with source_file: the name without a part number.

    With a schema only its columns are parsed. Without, it is inferred over all files; give one for large inputs.
    """
    reader = spark.read.option("multiLine", True)
    df = (reader.schema(schema) if schema is not None else reader).json(paths)
    return df.withColumn("source_file", C.original_name(F.element_at(F.split("_metadata.file_path", "/"), -1)))


def document_texts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file_name, file_size, value) of whole files as text, for shapes that no schema names yet."""
    df = spark.read.text(paths, wholetext=True)
    return df.select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file_name"), F.col("_metadata.file_size").alias("file_size"), "value")


def parsed(texts: DataFrame, schema: T.StructType) -> DataFrame:
    """Document rows of texts (file_name, value)."""
    return texts.select(F.from_json("value", schema).alias("d"), C.original_name(F.col("file_name")).alias("source_file")).select("d.*", "source_file")


def ndjson(spark: SparkSession, paths: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """One document a line; without a schema it is inferred over all lines."""
    reader = spark.read.option("samplingRatio", 1.0)
    return (reader.schema(schema) if schema is not None else reader).json(paths)


def csv(spark: SparkSession, paths: str | list[str], schema: str | None = None, sanitize: bool = False) -> DataFrame:
    """A CSV table with a header, all text unless a schema is given; sanitize makes the headers plain column names."""
    reader = spark.read.option("header", True)
    df = reader.schema(schema).csv(paths) if schema else reader.csv(paths)
    if sanitize:
        taken: set[str] = set()
        df = df.toDF(*(C.identifier(c, taken) for c in df.columns))
    return df


def provider_master(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The provider master file, all text, spellings of missing values as null."""
    df = csv(spark, paths)
    return df.select(*(C.missing_to_null(F.col(f"`{c}`")).alias(c) for c in df.columns))


def proximity(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Distances between postal codes; codes are text, so leading zeros stay."""
    return csv(spark, paths, PROXIMITY)


def zip_xref(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return csv(spark, paths, XREF)


def allow_list(spark: SparkSession, path: str, column: str = "NPPES_NPI") -> DataFrame:
    """The distinct provider identifiers of a file, as a table for a semi join."""
    return csv(spark, path).select(F.col(column).cast("string").alias("npi")).where("npi is not null").distinct()


def file_index(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Index documents."""
    return spark.read.option("multiLine", True).schema(INDEX).json(paths)


def index_files(index: DataFrame) -> DataFrame:
    """(file_url, file_description, file_name, reporting_plans) of every listed file that has a location."""
    part = index.select(F.explode("reporting_structure").alias("s")).select("s.reporting_plans", F.explode("s.in_network_files").alias("f"))
    url = C.blank_to_null(F.col("f.location"))
    return part.select(url.alias("file_url"), F.col("f.description").alias("file_description"), C.url_tail(url).alias("file_name"), "reporting_plans").where("file_url is not null")


def provider_files(spark: SparkSession, folder: str) -> DataFrame:
    """(name, value) of linked provider files."""
    df = spark.read.text(folder, wholetext=True)
    return df.select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("name"), "value")


def jdbc(spark: SparkSession, url: str, query: str, fetch: int = 10_000, **options: str) -> DataFrame:
    """A query of a database, streamed by `fetch` rows; credentials come from the caller's environment."""
    return spark.read.format("jdbc").options(url=url, query=query, fetchsize=str(fetch), **options).load()


def files_below(spark: SparkSession, folder: str, core: str = "") -> DataFrame:
    """(file_name, group_dir, path) of files in group_* folders whose name holds core, split parts before originals.

    Spark lists the files, on whatever file system they are; their contents are not read.
    """
    from tariffloom.operators.joins import prefer_parts

    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json*").load(f"{folder}/group_*")
    rows = found.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), F.element_at(F.split("path", "/"), -2).alias("group_dir"), "path")
    return prefer_parts(rows.where(F.contains("file_name", F.lit(core)) & ~F.col("file_name").endswith("schema.json")))


def top_level_arrays(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
