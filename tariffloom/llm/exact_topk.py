"""Exact top-k search by inner product with vector-approximation files.

Equal vectors are one class with its k + 1 smallest ids, which is all that any query can ask of it. The approximation file
holds one byte for each component of a class: its cell between the least and the largest value of that component. A scan of
the cells alone, in blocks of classes by blocks of queries, bounds every score from both sides; what lies
below k lower bounds is out. The exact vectors of the rest are read by a join in two steps, in order of their upper bounds:
first the best of each query, then those whose bound still reaches the kth exact score. So the answer is exact, and exact
vectors travel only for the few classes that need them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tariffloom.llm.common import bounded, scoped, stage, table

#: Classes and queries of a block, the least classes of a block in small tables, cells of a component, queries bounded at once.
ROW_BLOCK, QUERY_BLOCK, LEAST_BLOCK, CELLS, AT_ONCE = 1 << 17, 1 << 14, 2048, 256, 64


def matrix(column: pa.ChunkedArray | pa.Array, kind) -> np.ndarray:
    """Rows of a list column as a matrix; all lists are equally long and hold no nulls."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    return flat.reshape(n, -1) if n else flat.reshape(0, 0)


def cells_of(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The cell of each component: a byte."""
    width = np.maximum((high - low) / CELLS, 1e-9)
    return np.clip((x - low) / width, 0, CELLS - 1).astype(np.uint8)


def bounds(q: np.ndarray, cells: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(upper bounds of the scores: queries x rows, how far below them the lower bounds are: for each query).

    A component in a cell differs from its middle by half a width at most; the rest is for rounding.
    """
    width = np.maximum((high - low) / CELLS, 1e-9)
    middle = (low + (cells + 0.5) * width).astype(np.float32)
    size = np.abs(q).astype(float)
    half = size @ (width * 0.51)
    slack = (q.shape[1] + 8) * 2.0**-22 * (size @ np.maximum(np.abs(low), np.abs(high))) + 1
    upper = q.astype(np.float32) @ middle.T
    upper += (half + slack).astype(np.float32)[:, None]
    return upper, 2 * half + 3 * slack


def kept_of_block(q_ids: np.ndarray, q: np.ndarray, only: np.ndarray, cells: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, upper bound, lower bound) of the pairs that may be among a query's k best of these rows.

    only: the id of a class with one id, else -1 with `many` below; a query's own class is left out if nobody else is in it.
    """
    out = []
    for lo in range(0, len(q), AT_ONCE):
        part = slice(lo, lo + AT_ONCE)
        upper, gap = bounds(q[part], cells, low, high)
        upper[q_ids[part][:, None] == only[None, :]] = -np.inf
        if upper.shape[1] > k:
            least = np.partition(upper, upper.shape[1] - k, axis=1)[:, upper.shape[1] - k] - gap
        else:
            least = np.full(len(upper), -np.inf)
        i, j = np.nonzero((upper >= least[:, None]) & (upper > -np.inf))
        out.append((i + lo, j, upper[i, j].astype(float), upper[i, j] - gap[i]))
    return tuple(np.concatenate(v) for v in zip(*out, strict=True))


@scoped
def top_k(rows: DataFrame, is_query, k: int, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows with the largest integer inner product for each query row.

    Components become floor(scale * x). Null vectors, vectors with null or non-finite components or with products beyond a
    long, and null ids take no part; vectors of other lengths do not meet. A query's own id is never its answer. Rows equal in
    id and vector count once, rows of one id with other vectors are queries of their own. Extra columns are left out.
    """
    x = F.col("e")
    fine = bounded(rows).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("e")).where(
        F.col("id").isNotNull() & (F.size(x) > 0) & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v * scale) >= 2.0**31))
    )
    vectors = fine.select("id", F.transform(x, lambda v: F.floor(v * scale).cast("long")).alias("v"))
    vectors = vectors.withColumn("key", F.unhex(F.md5(F.concat_ws(",", F.col("v").cast("array<string>")))))
    first = F.row_number().over(W.partitionBy("key", "id").orderBy(F.lit(0)))
    single = stage(vectors.withColumn("place", first).where("place = 1").drop("place"), "vectors")
    place = F.row_number().over(W.partitionBy("key").orderBy("id"))
    members = single.withColumn("place", place).where(F.col("place") <= k + 1)
    # at most k + 1 rows of a class come here, each class's vector in the first
    classes = members.groupBy("key").agg(F.min_by("v", "place").alias("v"), F.array_sort(F.collect_list("id")).alias("ids"))
    classes = stage(classes.withColumn("dim", F.size("v")), "classes")
    asked = single.where(is_query(F.col("id"))).select("id", "key", "v", F.size("v").alias("dim"))

    def extremes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for d in np.unique(dims).tolist():
                m = matrix(batch.column(0).filter(pa.array(dims == d)), np.int64)
                both = np.stack([m.min(0), m.max(0)])
                seen[d] = both if d not in seen else np.stack([np.minimum(seen[d][0], both[0]), np.maximum(seen[d][1], both[1])])
        for d, both in seen.items():
            yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([both[0].tolist()], pa.list_(pa.int64())), pa.array([both[1].tolist()], pa.list_(pa.int64()))], ["dim", "low", "high"])

    edges: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for r in classes.select("v", "dim").mapInArrow(extremes, "dim int, low array<long>, high array<long>").toLocalIterator():  # two vectors a length and task
        low, high = np.array(r["low"], float), np.array(r["high"], float)
        edges[r["dim"]] = (low, high) if r["dim"] not in edges else (np.minimum(edges[r["dim"]][0], low), np.maximum(edges[r["dim"]][1], high))
    edge = rows.sparkSession.sparkContext.broadcast(edges)

    def approximate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy()
            for d in np.unique(dims).tolist():
                own = batch.filter(pa.array(dims == d))
                cells = cells_of(matrix(own.column(1), float), *edge.value[d])
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(2), pa.array([c.tobytes() for c in cells], pa.binary()), own.column(3)], ["key", "dim", "cells", "only"])

    alone = F.when(F.size("ids") == 1, F.get("ids", F.lit(0)))
    file = stage(classes.select("key", "v", "dim", alone.alias("only")).mapInArrow(approximate, "key binary, dim int, cells binary, only long"), "cells")
    asked = stage(asked, "queries")
    n, m = file.count(), asked.count()
    row_blocks = max(1, -(-n // ROW_BLOCK), min(8, -(-n // LEAST_BLOCK)))
    query_blocks = max(1, -(-m // QUERY_BLOCK))
    block = lambda size, *c: F.pmod(F.xxhash64(*c), F.lit(size)).cast("int")
    every = lambda size: F.explode(F.sequence(F.lit(0), F.lit(size - 1)))
    none = lambda kind: F.lit(None).cast(kind)
    left = asked.select("dim", every(row_blocks).alias("rb"), block(query_blocks, "id", "key").alias("qb"), "id", "key", "v", none("binary").alias("cells"))
    right = file.select("dim", block(row_blocks, "key").alias("rb"), every(query_blocks).alias("qb"), F.col("only").alias("id"), "key", none("array<long>").alias("v"), "cells")

    def scan(t: pa.Table) -> pa.Table:
        query = t.column("v").is_valid().to_numpy()
        empty = pa.table({c: pa.array([], kind) for c, kind in (("id", pa.int64()), ("qkey", pa.binary()), ("key", pa.binary()), ("upper", pa.float64()), ("lower", pa.float64()))})
        if not query.any() or query.all():
            return empty
        asks, file = t.filter(pa.array(query)).combine_chunks(), t.filter(pa.array(~query)).combine_chunks()
        q_ids, q = asks.column("id").to_numpy(), matrix(asks.column("v"), np.int64)
        only = file.column("id").is_valid().to_numpy()
        known = file.column("id").fill_null(0).to_numpy()
        d = q.shape[1]
        cells = np.frombuffer(b"".join(file.column("cells").to_pylist()), np.uint8).reshape(-1, d)
        own = np.where(only, known, np.iinfo(np.int64).min)  # no id of a query: those are not shared
        i, j, upper, lower = kept_of_block(q_ids, q, own, cells, *edge.value[d], k)
        return pa.table({"id": pa.array(q_ids[i]), "qkey": asks.column("key").take(pa.array(i)), "key": file.column("key").take(pa.array(j)), "upper": pa.array(upper), "lower": pa.array(lower)})

    near = left.unionByName(right).groupBy("dim", "rb", "qb").applyInArrow(scan, "id long, qkey binary, key binary, upper double, lower double")
    of_query = W.partitionBy("id", "qkey")
    sure = F.max(F.when(F.col("place") == k, F.col("lower"))).over(of_query)  # k classes have at least this score
    near = near.withColumn("place", F.row_number().over(of_query.orderBy(F.desc("upper"), "key"))).withColumn("sure", sure)
    near = stage(near.where("sure is null or upper >= sure").drop("sure", "lower"), "candidates")

    def exact(pairs: DataFrame) -> DataFrame:
        """Pairs with their integer score and the ids of the class."""
        own = pairs.join(classes.select("key", "v", "ids"), "key").join(asked.select("id", F.col("key").alias("qkey"), F.col("v").alias("qv")), ["id", "qkey"])
        product = F.aggregate(F.zip_with("v", "qv", lambda a, b: a * b), F.lit(0).cast("long"), lambda a, b: a + b)
        return own.select("id", "qkey", product.alias("score"), "ids")

    best = stage(exact(near.where(F.col("place") <= 2 * k)), "first")
    kth = best.withColumn("place", F.row_number().over(of_query.orderBy(F.desc("score")))).where(F.col("place") == k).select("id", "qkey", F.col("score").alias("kth"))
    later = near.where(F.col("place") > 2 * k).join(kth, ["id", "qkey"], "left").where("kth is null or upper >= kth")
    found = best.unionByName(exact(later.select("id", "qkey", "key")))
    answers = found.select("id", "qkey", "score", F.explode("ids").alias("vec_id")).where("vec_id <> id")
    rank = F.row_number().over(of_query.orderBy(F.desc("score"), "vec_id"))
    return answers.withColumn("rank", rank).where(F.col("rank") <= k).select(F.col("id").alias("query_id"), "rank", "vec_id", "score")


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best rows of every embedding whose id is divisible by 50; see `top_k` for nulls, repeats and empty tables."""
    return top_k(table(spark, sf_dir, "embeddings"), lambda c: c % 50 == 0, 5)


QUERIES = {"op6_exact_topk": op6_exact_topk}
ORACLE = {
    "op6_exact_topk": """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
      SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)
    ), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
}
