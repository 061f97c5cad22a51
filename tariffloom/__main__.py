"""python -m tariffloom convert|report|groups|split ...: the plans from a shell."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from tariffloom.operators import report, schema, shape, split
from tariffloom.plans.convert import Request, fact
from tariffloom.plans.jobs import list_of
from tariffloom.session import session
from tariffloom.sources import readers, writers


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="tariffloom")
    sub = p.add_subparsers(dest="command", required=True)
    c = sub.add_parser("convert", help="nested documents to a fact table")
    c.add_argument("input", nargs="+")
    c.add_argument("output")
    c.add_argument("--schema", help="a saved schema; without it, it is inferred")
    c.add_argument("--codes", help="codes and ranges, comma-separated")
    c.add_argument("--code-type")
    c.add_argument("--npi-file", help="a CSV file with a column NPPES_NPI")
    c.add_argument("--provider-join", choices=["left", "inner"], default="left")
    c.add_argument("--providers", help="the provider master CSV")
    r = sub.add_parser("report", help="the price report of a fact table")
    r.add_argument("fact")
    r.add_argument("output")
    r.add_argument("--services", type=int, default=10)
    r.add_argument("--hospitals", type=int, default=20)
    g = sub.add_parser("groups", help="signature groups of documents")
    g.add_argument("input", nargs="+")
    g.add_argument("output")
    s = sub.add_parser("split", help="documents to parts by items")
    s.add_argument("input", nargs="+")
    s.add_argument("output")
    s.add_argument("--array", default="in_network")
    s.add_argument("--items", type=int, default=10_000)
    a = p.parse_args(args)
    spark = session()
    if a.command == "convert":
        raw = readers.documents(spark, a.input, schema.load(a.schema) if a.schema else None)
        from tariffloom.operators.joins import provider_columns

        master = provider_columns(readers.provider_master(spark, a.providers)) if a.providers else None
        npis = readers.allow_list(spark, a.npi_file) if a.npi_file else None
        writers.parquet(fact(raw, Request(codes=list_of(a.codes) or [], code_type=a.code_type, npis=npis, provider_join=a.provider_join), master), a.output)
    elif a.command == "report":
        services, page = report.report(spark.read.parquet(a.fact), a.services, a.hospitals)
        services.write.mode("overwrite").json(f"{a.output}/services")
        page.write.mode("overwrite").json(f"{a.output}/providers")
    elif a.command == "groups":
        texts = readers.document_texts(spark, a.input).withColumn("source_name", F.lit(None).cast("string"))
        writers.parquet(schema.groups(schema.signatures(shape.analyze(texts))), a.output)
    else:
        writers.parts(split.by_items(readers.documents(spark, a.input), a.array, a.items), a.output)


if __name__ == "__main__":
    main()
