"""Incremental landing of files: each file is claimed once by the stream's checkpoint, and only new keys are added."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def new_files(spark: SparkSession, folder: str, schema: T.StructType, form: str = "parquet", per_batch: int = 100, glob: str | None = None) -> DataFrame:
    """A stream of the rows of files as they arrive, so many files at a time."""
    reader = spark.readStream.format(form).schema(schema).option("maxFilesPerTrigger", per_batch)
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(folder)


def unlanded(batch: DataFrame, landed: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a batch, one for each key, whose keys are not landed yet.

    Only landed rows within the range of the batch's keys are asked, which the files' statistics answer for keys that rise
    with time; so a batch does not read all that was landed before it.
    """
    new = batch.dropDuplicates(keys)
    ends = batch.agg(*(f(k).alias(f"{n}{i}") for i, k in enumerate(keys) for n, f in (("low", F.min), ("high", F.max)))).first()
    for i, k in enumerate(keys):
        if ends[f"low{i}"] is not None:
            landed = landed.where(F.col(k).between(F.lit(ends[f"low{i}"]), F.lit(ends[f"high{i}"])))
    return new.join(landed.select(*keys), keys, "left_anti")


def land(stream: DataFrame, target: str, checkpoint: str, keys: list[str], every: str | None = None):
    """Appends rows whose keys the target does not have. Without `every` it takes what is there and ends; else it polls.

    A batch that is run again after a failure finds its keys in the target, so nothing is landed twice. Rows with a null key
    are new each time. Keys are of types that have an order.
    """

    def add(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(target)
        there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
        new = unlanded(batch, spark.read.parquet(target), keys) if there else batch.dropDuplicates(keys)
        new.write.mode("append").parquet(target)

    writer = stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def windowed_counts(stream: DataFrame, time: str, size: str, late: str, key: str) -> DataFrame:
    """Counts by time window and key, with rows later than `late` left out. Beyond batch parity; plain Spark."""
    return stream.withWatermark(time, late).groupBy(F.window(time, size), key).agg(F.count("*").alias("n"))
