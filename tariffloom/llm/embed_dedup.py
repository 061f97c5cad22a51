"""Near-duplicate embeddings by cross-polytope hashing after fast Hadamard rotations.

Each table rotates the unit vectors by three rounds of random signs and a fast Hadamard transform; the largest
component with its sign is one hash, and several make a bucket number. Multiprobe: a vector also enters the buckets of
its next largest components. Vectors of a bucket are compared in blocks by one matrix product, so every link is
verified. What no table brings together is found by an exact pass over all pairs of blocks of the file, which counts only
pairs without a common bucket: both together have every link. That pass is quadratic; its blocks are read again, not shuffled. What travels is the vector as it came (single precision where that says the same) and its buckets in 32 bits. A pair that shares several buckets counts in the first of them only, which both sides can tell from the
buckets they carry; so links are counted where they are found and no pair is ever shuffled. Only each vector's count and
one edge to the smallest id that it reaches by links of the group leave a group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffloom.llm.common import bounded, scoped, stage, table
from tariffloom.llm.graph import components

LIMIT, PROBES, BLOCK, AT_ONCE = 0.9, 4, 4096, 512
#: Components of a block of the exact pass, its least rows; into how many tasks each side of the pass is dealt at most.
FILE_BLOCK, LEAST_ROWS, SIDES = 1 << 20, 512, 128
SEED = 20240611


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row; the width is a power of two."""
    n, d = x.shape
    step = 1
    while step < d:
        y = x.reshape(n, d // (2 * step), 2, step)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(n, d)
        step *= 2
    return x / np.sqrt(d)


def width_of(dim: int) -> int:
    """The power of two that vectors are filled up to; wide enough for PROBES different choices."""
    return 1 << max(2, int(np.ceil(np.log2(max(dim, 2)))))


def hashes_for(rows: int, dim: int) -> int:
    """As many hashes as make buckets of about 32 unrelated vectors; one hash tells 2 * width directions apart."""
    return max(1, int(np.ceil(np.log(max(rows, 2) / 32) / np.log(2 * width_of(dim)))))


def tables_for(hashes: int, dim: int) -> int:
    """Tables after which 99 of 100 pairs at a cosine of LIMIT have met: each hash halves the chance of a table, a wider one
    a little more (measured for 64 to 1024 dimensions and 1 to 4 hashes, with a third of tables to spare)."""
    return int(np.ceil(1.24 * 2**hashes * (width_of(dim) / 64) ** (0.1 * hashes)))


def buckets(unit: np.ndarray, hashes: int, tables: int = 0, probes: int = PROBES) -> np.ndarray:
    """Bucket numbers of each vector within their tables: n x (tables * probes), table by table; see `tables_for`."""
    tables = tables or tables_for(hashes, unit.shape[1])
    n, d = unit.shape
    width = width_of(d)
    wide = np.zeros((n, width))
    wide[:, :d] = unit
    rng = np.random.default_rng(SEED + d)
    out = np.zeros((n, tables * probes), np.int64)
    rows = np.arange(n)
    for t in range(tables):
        code, margin, second = [], [], []
        for _ in range(hashes):
            x = wide
            for _ in range(3):
                x = hadamard(x * rng.choice([-1.0, 1.0], width))
            order = np.argsort(-np.abs(x), 1)[:, :probes]
            sign = x[rows[:, None], order] < 0
            code.append(order * 2 + sign)
            size = np.abs(x[rows[:, None], order])
            margin.append(size[:, :1] - size)
            second.append(size)
        # the probes: the best bucket, then those where one hash moves to its next choice at least cost
        combos = [[0] * hashes] + [[p if j == k else 0 for j in range(hashes)] for k in range(hashes) for p in range(1, probes)]
        cost = np.stack([sum(margin[j][:, c[j]] for j in range(hashes)) for c in combos], 1)
        value = np.stack([sum(code[j][:, c[j]] * (2 * width) ** j for j in range(hashes)) for c in combos], 1)
        pick = np.argsort(cost, 1, kind="stable")[:, :probes]
        got = value[rows[:, None], pick]
        if got.shape[1] < probes:
            got = np.concatenate([got] + [got[:, :1]] * (probes - got.shape[1]), 1)
        out[:, t * probes : (t + 1) * probes] = got
    return out


def pack(v: list[float]) -> bytes:
    """A vector in single precision if that holds it exactly, else in double."""
    x = np.array(v, np.float64) + 0.0
    with np.errstate(over="ignore"):
        small = x.astype(np.float32)
    return small.tobytes() if (small == x).all() else x.tobytes()


def unit(raw: list[bytes], dim: int) -> np.ndarray:
    """Unit vectors in double precision of packed vectors that are neither zero nor infinite."""
    return normal(vectors(raw, dim))[0]


def normal(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows scaled to length 1, whether that can be done); very small and very large ones are scaled first."""
    good = np.isfinite(x).all(1)
    x = np.where(good[:, None], x, 0.0)
    big = np.abs(x).max(1, initial=0)
    good &= big > 0
    odd = good & ((big < 1e-100) | (big > 1e100))
    x[odd] /= big[odd, None]
    size = np.sqrt((x * x).sum(1))
    return x / np.where(size > 0, size, 1)[:, None], good


def _sketch(rows: DataFrame, total: int, id_col: str, vector_col: str) -> DataFrame:
    """(id, digest, raw, codes, dim) of every vector that can link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_dim: dict[int, list[int]] = {}
            lists = batch.column(1).to_pylist()
            for i, v in enumerate(lists):
                if v is not None and None not in v and len(v):
                    by_dim.setdefault(len(v), []).append(i)
            ids = batch.column(0).to_pylist()
            for dim, own in by_dim.items():
                x, good = normal(np.array([lists[i] for i in own], np.float64) + 0.0)
                x, own = x[good], [i for i, g in zip(own, good, strict=True) if g]
                if not own:
                    continue
                # 32 bits tell buckets of a table apart: widths or hashes beyond that share some, which only adds candidates
                codes = (buckets(x, hashes_for(total, dim)) & 0xFFFFFFFF).astype("<u4")
                raw = [pack(lists[i]) for i in own]
                digest = [hashlib.blake2b(r.tobytes(), digest_size=16).digest() for r in x]
                yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in own], pa.int64()), pa.array(digest, pa.binary()), pa.array(raw, pa.binary()), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array([dim] * len(own), pa.int32())], ["id", "digest", "raw", "codes", "dim"])

    source = bounded(rows).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where("id is not null")
    return source.mapInArrow(run, "id long, digest binary, raw binary, codes binary, dim int")


def meets(x: np.ndarray, y: np.ndarray, limit: float) -> np.ndarray:
    """Whether pairs of vectors, as they came, have a cosine of at least limit: products are summed in order, in double
    precision, and divided once, so that a pair exactly at the limit is not lost to the rounding of unit vectors."""
    with np.errstate(over="ignore", under="ignore", invalid="ignore", divide="ignore"):
        dot, a, b = (np.cumsum(v, 1)[:, -1] for v in (x * y, x * x, y * y))
        size = a * b
        cosine = dot / np.sqrt(size)
    odd = ~((size > 1e-200) & (size < 1e200))  # squares too small or too large
    cosine[odd] = (normal(x[odd])[0] * normal(y[odd])[0]).sum(1)
    return cosine >= limit


def vectors(raw: list[bytes], dim: int) -> np.ndarray:
    """Packed vectors as they came, in double precision."""
    return np.stack([np.frombuffer(r, np.float32 if len(r) == 4 * dim else np.float64) for r in raw]).astype(np.float64)


def linked_pairs(x: np.ndarray, y: np.ndarray, ux: np.ndarray, uy: np.ndarray, limit: float) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of all pairs of x[i] and y[j] with a cosine of at least limit. ux, uy: their unit vectors, in either precision;
    pairs nearer to the limit than the rounding of their product are settled by `meets`."""
    slack = (x.shape[1] + 16) * float(np.finfo(ux.dtype).eps)
    product = ux @ uy.T
    i, j = np.divmod(np.flatnonzero(product.ravel() >= limit - slack), product.shape[1])
    close = np.flatnonzero(product[i, j] < limit + slack)
    keep = np.ones(len(i), bool)
    for lo in range(0, len(close), 1 << 16):
        at = close[lo : lo + (1 << 16)]
        keep[at] = meets(x[i[at]], y[j[at]], limit)
    return i[keep], j[keep]


def unite(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins the sets of i and j; root: the first place of each place's set."""
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = (v[apart] for v in (i, j, a, b))
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while ((after := root[root]) != root).any():
            root[:] = after


def least_of(root: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The smallest id of each place's set."""
    out = ids.copy()
    np.minimum.at(out, root, ids)
    return out[root]


def links_of_block(t: pa.Table, limit: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, linked vectors, smallest id reached) of a group: rows with side 0 and 1 are two blocks, all of side 0 one block."""
    ids, size, side = (t.column(c).to_numpy() for c in ("id", "size", "side"))
    raw = vectors(t.column("raw").to_pylist(), t.column("dim")[0].as_py())
    x = normal(raw)[0]
    codes = np.frombuffer(b"".join(t.column("codes").to_pylist()), "<u4").reshape(len(ids), -1)
    at, here = t.column("at")[0].as_py(), t.column("bucket")[0].as_py()
    two = bool(side.any())
    a, b = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if two else (np.arange(len(ids)),) * 2
    n, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
    for lo in range(0, len(a) if len(b) else 0, AT_ONCE):
        i, j = linked_pairs(raw[a[lo : lo + AT_ONCE]], raw[b], x[a[lo : lo + AT_ONCE]], x[b], limit)
        i, j = a[lo + i], b[j]
        if not two:
            i, j = i[i < j], j[i < j]
        mine = np.ones(len(i), bool)
        for p in range((at + 1) * PROBES):  # no common bucket in an earlier table, nor a smaller one in this
            first = p // PROBES * PROBES
            own, other = codes[i, p], codes[j, first : first + PROBES]
            mine &= ~(((other == own[:, None]).any(1)) & ((first < at * PROBES) | (own < here)))
        i, j = i[mine], j[mine]
        np.add.at(n, i, size[j])
        np.add.at(n, j, size[i])
        unite(root, i, j)
    hit = np.flatnonzero(n)
    return ids[hit], n[hit], least_of(root, ids)[hit]


_BLOCK = "dim int, block int, rows int, ids binary, sizes binary, raw binary, codes binary"


def block_of(t: pa.Table) -> pa.Table:
    """One row of the vectors of a block, end to end: in single precision if that holds them all exactly."""
    n, dim = t.num_rows, t.column("dim")[0].as_py()
    raw = t.column("raw").to_pylist()
    if len({len(r) for r in raw}) > 1:
        raw = [v.tobytes() for v in vectors(raw, dim)]
    ids, sizes = (t.column(c).to_numpy().astype("<i8").tobytes() for c in ("id", "size"))
    own = (dim, t.column("block")[0].as_py(), n, ids, sizes, b"".join(raw), b"".join(t.column("codes").to_pylist()))
    return pa.table([pa.array([v], k) for v, k in zip(own, (pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * 4), strict=True)], ["dim", "block", "rows", "ids", "sizes", "raw", "codes"])


def _unpacked(dim: int, rows: int, ids: bytes, sizes: bytes, raw: bytes, codes: bytes) -> tuple[np.ndarray, ...]:
    kind = np.float32 if len(raw) == 4 * dim * rows else np.float64
    return np.frombuffer(ids, "<i8"), np.frombuffer(sizes, "<i8"), np.frombuffer(raw, kind).reshape(rows, dim), np.frombuffer(codes, "<u4").reshape(rows, -1)


def rest_of_blocks(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...] | None, limit: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, linked vectors, smallest id reached) by pairs of two blocks, or of one where b is None, that share no bucket of any
    table. a, b: (ids, class sizes, vectors, codes)."""
    one, b = b is None, a if b is None else b
    shift = 0 if one else len(a[0])  # places: of a, then of b
    ids, size = (a[k] if one else np.concatenate([a[k], b[k]]) for k in (0, 1))
    n, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
    x, y = (v[2].astype(np.float64) for v in (a, b))
    ux, uy = (normal(v)[0].astype(np.float32) for v in (x, y))
    for lo in range(0, len(x), AT_ONCE):
        from_ = lo if one else 0  # of a block with itself, each pair once
        i, j = linked_pairs(x[lo : lo + AT_ONCE], y[from_:], ux[lo : lo + AT_ONCE], uy[from_:], limit)
        i, j = i + lo, j + from_
        if one:
            i, j = i[i < j], j[i < j]
        for start in range(0, len(i), 1 << 20):
            p, q = i[start : start + (1 << 20)], j[start : start + (1 << 20)]
            apart = np.ones(len(p), bool)
            for k in range(a[3].shape[1]):
                first = k // PROBES * PROBES
                left = np.flatnonzero(apart)
                if not len(left):
                    break
                apart[left] = ~(b[3][q[left], first : first + PROBES] == a[3][p[left], k][:, None]).any(1)
            p, q = p[apart], q[apart] + shift
            np.add.at(n, p, size[q])
            np.add.at(n, q, size[p])
            unite(root, p, q)
    hit = np.flatnonzero(n)
    return ids[hit], n[hit], least_of(root, ids)[hit]


def _rest(classes: DataFrame, limit: float) -> DataFrame:
    """(id, n, low) of the links between classes that share no bucket, by all pairs of blocks."""
    sizes = {r["dim"]: -(-r["n"] // max(LEAST_ROWS, FILE_BLOCK // r["dim"])) for r in classes.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return classes.select("id", F.lit(0).cast("long").alias("n"), F.col("id").alias("low"))
    of = classes.sparkSession.createDataFrame(sorted(sizes.items()), "dim int, blocks int")
    own = classes.join(F.broadcast(of), "dim").withColumn("block", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int"))
    own = own.select("dim", "block", "id", "size", "raw", "codes").groupBy("dim", "block").applyInArrow(block_of, _BLOCK)
    file = stage(own, "blocks")
    deal = min(SIDES, sum(sizes.values()))
    a, b = (file.select(*(F.col(c).alias(side + c) for c in file.columns)).repartition(deal) for side in ("a_", "b_"))
    # an equality of lengths would bring all blocks of a length into one task
    pairs = a.join(b, (F.abs(F.col("a_dim") - F.col("b_dim")) < 1) & (F.col("a_block") <= F.col("b_block")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                dim, at, *own = (c[row].as_py() for c in batch.columns[:7])
                _, other_at, *other = (c[row].as_py() for c in batch.columns[7:])
                got = rest_of_blocks(_unpacked(dim, *own), None if at == other_at else _unpacked(dim, *other), limit)
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in got], ["id", "n", "low"])

    return pairs.mapInArrow(run, "id long, n long, low long")


@scoped
def near_duplicates(rows: DataFrame, limit: float = LIMIT, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id and kept for every row.

    Null and zero vectors, and those with null or non-finite components, link with nothing and are kept; rows with a
    null id have null results and are kept. Equal vectors are one class and are compared once; repeated ids count as rows
    of their own and share the smallest result of their id's classes. Extra columns are left out.
    """
    total = rows.count()
    seen = stage(_sketch(rows, total, id_col, vector_col), "vectors")
    classes = stage(seen.groupBy("digest", "dim").agg(F.min("id").alias("id"), F.count("*").alias("size"), F.first("raw").alias("raw"), F.first("codes").alias("codes")), "classes")

    def seats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = pa.compute.binary_length(batch.column(2)).to_numpy(zero_copy_only=False)
            for k in np.unique(size).tolist():  # vectors of one length
                at = np.flatnonzero(size == k)
                own, tables = batch.take(pa.array(at)), k // (4 * PROBES)
                codes = np.frombuffer(b"".join(own.column(2).to_pylist()), "<u4").reshape(len(at) * tables, PROBES)
                codes = np.sort(codes, 1).astype(np.int64)
                row, place = np.nonzero(np.append(np.ones((len(codes), 1), bool), codes[:, 1:] != codes[:, :-1], 1))
                take = pa.array(row // tables)
                yield pa.RecordBatch.from_arrays([own.column(0).take(take), own.column(1).take(take), pa.array(row % tables, pa.int32()), pa.array(codes[row, place])], ["digest", "dim", "at", "bucket"])

    # small rows find the buckets that hold several vectors; each vector is then fetched once for all its buckets
    inside = classes.select("digest", "dim", "codes").mapInArrow(seats, "digest binary, dim int, at int, bucket long")
    sizes = stage(inside.groupBy("dim", "at", "bucket").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    wide = inside.join(sizes, ["dim", "at", "bucket"]).join(classes.select("digest", "id", "size", "raw", "codes"), "digest").drop("digest")
    # a large bucket: blocks by hash, and a group for each pair of blocks
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    wide = wide.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("id", "at", "bucket"), F.col("blocks")).cast("int"))
    wide = wide.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    wide = wide.withColumn("first", F.least("own", "other")).withColumn("last", F.greatest("own", "other")).withColumn("side", (F.col("own") > F.col("other")).cast("int"))

    def run(t: pa.Table) -> pa.Table:
        if t.column("first")[0].as_py() != t.column("last")[0].as_py() and len(set(t.column("side").to_pylist())) < 2:
            ids, n, low = (np.zeros(0, np.int64),) * 3
        else:
            ids, n, low = links_of_block(t, limit)
        return pa.table({"id": pa.array(ids, pa.int64()), "n": pa.array(n, pa.int64()), "low": pa.array(low, pa.int64())})

    met = wide.groupBy("dim", "at", "bucket", "first", "last").applyInArrow(run, "id long, n long, low long")
    found = stage(met.unionByName(_rest(classes, limit)), "links")
    linked = found.groupBy("id").agg(F.sum("n").alias("n"))
    part = components(found.select(F.col("id").alias("u"), F.col("low").alias("v")))
    told = stage(classes.select("id", "size", "digest", "dim").join(linked, "id", "left").join(part, "id", "left").select("digest", "dim", "size", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id")), "classes")
    by_row = seen.select("id", "digest", "dim").join(told, ["digest", "dim"]).groupBy(F.col("id").alias("vec_id")).agg(F.min("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    all_rows = rows.select(F.col(id_col).cast("long").alias("vec_id"))
    out = all_rows.join(stage(by_row, "results"), "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    n_links = F.when(F.col("vec_id").isNotNull(), F.coalesce("n_links", F.lit(0)))
    return out.select("vec_id", n_links.alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


QUERIES = {"op4_embedding_dedup": op4_embedding_dedup}
ORACLE = {
    "op4_embedding_dedup": """
    WITH RECURSIVE v AS (
      SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ), e AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
    r(id, label) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT e.y, r.label FROM r JOIN e ON r.id = e.x),
    c AS (SELECT id, min(label) AS component_id FROM r GROUP BY id), k AS (SELECT x, count(*) AS n FROM e GROUP BY x)
    SELECT t.vec_id, coalesce(k.n, 0) AS n_links, c.component_id, c.component_id = t.vec_id AS kept FROM embeddings t JOIN c ON c.id = t.vec_id LEFT JOIN k ON k.x = t.vec_id
    """,
}
