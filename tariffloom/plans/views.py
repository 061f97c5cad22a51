"""Named views over the reference tables, and the query of plan prices at nearby providers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffloom.operators import flatten, joins, report


def reporting_plans(catalog: DataFrame) -> DataFrame:
    """A row for each file and plan, with the file's name without its extension."""
    return flatten.explode_plans(catalog.withColumn("file_core", F.split_part("file_name", F.lit("."), F.lit(1)))).where("plan_name is not null")


def register(catalog: DataFrame | None = None, proximity: DataFrame | None = None, xref: DataFrame | None = None, master: DataFrame | None = None) -> None:
    """Registers vw_mrf_reporting_plans, zip_zip_distance_15mi and zip_npi as far as their tables are given."""
    if catalog is not None:
        reporting_plans(catalog).createOrReplaceTempView("vw_mrf_reporting_plans")
    if proximity is not None and xref is not None:
        joins.zip_distances(joins.with_self_pairs(proximity), xref).createOrReplaceTempView("zip_zip_distance_15mi")
    if master is not None:
        joins.zip_npis(master).createOrReplaceTempView("zip_npi")


def plan_price_nearby(plans: DataFrame, prices: DataFrame, providers: DataFrame, near: DataFrame, plan: str, code: str) -> DataFrame:
    """Distinct and average prices of a code under a plan at the providers near a place.

    plans: (plan_name, file_name); prices: (file_name, npis, negotiated_type, billing_code, negotiated_rate);
    providers: (npi, zipcode, ...); near: (zipcode, miles).
    """
    own = prices.where(F.col("billing_code") == code).join(plans.where(F.col("plan_name") == plan), "file_name")
    each = own.withColumn("npi", F.explode("npis"))
    stats = report.price_stats(each, ["plan_name", "file_name", "npi", "billing_code", "negotiated_type"])
    return stats.join(providers.join(near, "zipcode"), "npi")
