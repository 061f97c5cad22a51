"""What a conversion request stands for: the files of its plan, and its providers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffloom.operators import filters, joins
from tariffloom.plans.convert import Request
from tariffloom.plans.jobs import ConvertRequest, list_of


@dataclass
class Resolved:
    """files: (file_name); request: the filters of the conversion."""

    files: DataFrame
    request: Request


def files(request: ConvertRequest, catalog: DataFrame) -> DataFrame:
    """The distinct files of the request: those that list its plan, or those whose name is or holds its file name."""
    if request.plan_name:
        own = joins.files_of_plan(catalog, request.plan_name)
    else:
        own = catalog.where(filters.like_core(F.col("file_name"), request.file_name))
    return own.select("file_name").distinct()


def npis(request: ConvertRequest, zip_npi: DataFrame, distances: DataFrame) -> DataFrame | None:
    """The request's providers: its own list first, else those near its postal code; None if it names neither.

    A postal code without providers gives an empty table, which leaves no rows: it is a filter all the same.
    """
    if own := list_of(request.npi):
        return zip_npi.sparkSession.createDataFrame([(n,) for n in own], "npi string")
    if not request.zipcode:
        return None
    code = str(request.zipcode).strip().zfill(5)
    return joins.npis_near(zip_npi, distances, code, request.zipcode_distance_miles)


def resolve(request: ConvertRequest, catalog: DataFrame, zip_npi: DataFrame, distances: DataFrame) -> Resolved:
    """catalog: (file_name, reporting_plans); zip_npi: (NPI, zipcode); distances: (zip1, zip2, distance_miles)."""
    return Resolved(files(request, catalog), Request(codes=list_of(request.cpt_code) or [], npis=npis(request, zip_npi, distances)))


def documents_of(raw: DataFrame, chosen: DataFrame, file: str = "source_file") -> DataFrame:
    """The documents whose file is chosen."""
    return raw.join(chosen.select(F.col("file_name").alias(file)), file, "left_semi")
