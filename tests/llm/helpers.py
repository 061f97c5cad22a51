"""Small tables with every awkward case: nulls anywhere, empty and long texts, ties, repeats, clashing extra columns."""

from __future__ import annotations

from pyspark.sql import types as T

LONG = " ".join(f"word{i % 997} tail{i}" for i in range(20_000))
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()
BASE = " ".join(WORDS * 2)
ROWS = [
    (1, BASE), (2, BASE), (3, BASE.replace("omega", "Omega", 1)), (4, None), (5, ""), (6, " \t\n "), (7, "one two three"), (8, "one two three"),
    (None, BASE), (9, LONG), (10, LONG + " more"), (11, "x " * 400), (11, "same id other text " + BASE), (12, "été 日本 \U0001f600 " + BASE.upper()), (None, None),
]


def documents(spark, rows=ROWS):
    """With columns whose names clash with those that operators use inside or return."""
    names = ["doc_id", "text", "lang", "source", "n_chars", "doc", "mark", "score", "token", "chunk", "key"]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), *(T.StructField(n, T.StringType()) for n in names[2:])])
    return spark.createDataFrame([(i, t, *["z"] * 9) for i, t in rows], schema)


def empty(spark):
    return documents(spark).where("false")


def write(df, folder, name="documents"):
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)
