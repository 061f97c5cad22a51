"""N-gram Jaccard join by prefix filters under several global token orders.

Two sets whose Jaccard similarity is at least t share a token among the first n - ceil(t * n) + 1 of each, whatever global
order the tokens are sorted in. The first order puts tokens that stand out by frequency last (from a table of counts of fixed size), so a
common passage seldom is in a prefix; its prefix tokens are shuffled and meet. Pairs must then also share a
prefix token under each of the other orders before their sets are intersected. Texts travel compressed.

Texts with the same set are one class, known by a fingerprint, and only classes are compared. Links are found in two
steps. First every class goes to the class it shares most prefix tokens with, in groups of bounded size in which links
are verified. Classes that are connected by then need no further comparison, so a large group of near copies costs
about its size, not its square. What is left, pairs of classes in different components that share prefix
tokens, is filtered by the exact bound on their overlap and verified pair by pair; so no link between components is lost.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tariffloom.llm.common import Words, bounded, chain, drop_staged, groups, mix, packed, scoped, stage, strings, table, unpacked, windows
from tariffloom.llm.graph import components

SHINGLE, PERCENT = 5, 75
COUNT_BITS, FAN_IN = 20, 256
#: A little more than 100 / PERCENT: sizes of linked sets have at most this ratio.
STEP = 1.34
#: Members of a verification group, and tokens of all their sets; groups that a class sits in; fingerprints that a task remembers.
GROUP, ITEMS, SEATS, REMEMBERED = 256, 1 << 20, 3, 200_000
_SEEDS = [np.uint64(x) for x in (0x51ED270B9F0C4F2D, 0xD1B54A32D192ED03, 0xA0761D6478BD642F)]


class Sets:
    """The shingle sets of some documents: items (64-bit, sorted within a document), doc of each, first: as in Words."""

    def __init__(self, w: Words, k: int = SHINGLE):
        h = w.hashes()
        at = windows(w.first, k)
        item, doc = chain(h, at, k), w.doc[at]
        few = np.flatnonzero((w.count > 0) & (w.count < k))
        if len(few):  # the whole sequence as one
            whole = np.array([mix(chain(h, w.first[d : d + 1], int(w.count[d])) + np.uint64(w.count[d]))[0] for d in few], np.uint64)
            item, doc = np.append(item, whole), np.append(doc, few)
        order = np.lexsort((item, doc))
        item, doc = item[order], doc[order]
        new = np.append(True, (item[1:] != item[:-1]) | (doc[1:] != doc[:-1])) if len(item) else np.zeros(0, bool)
        self.item, self.doc = item[new], doc[new]
        docs = len(w.count)
        self.first = np.searchsorted(self.doc, np.arange(docs + 1))
        self.size = np.diff(self.first)
        total = np.zeros(docs, np.uint64)
        np.add.at(total, self.doc, mix(self.item ^ _SEEDS[0]))
        self.mark = mix(total + self.size.astype(np.uint64)).view(np.int64)

    def prefixes(self, rare: np.ndarray, order: int, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
        """(index of an item, its place in its document's order) of the prefix of every document."""
        slot = (self.item >> np.uint64(64 - COUNT_BITS)).astype(np.int64)
        key = (rare[slot].astype(np.uint64) << np.uint64(58)) | (mix(self.item ^ _SEEDS[order]) >> np.uint64(6))
        by = np.lexsort((key, self.doc))
        place = np.arange(len(by)) - self.first[self.doc]
        keep = place < (self.size - -(-percent * self.size // 100) + 1)[self.doc]
        return by[keep], place[keep]


def documents(docs: DataFrame) -> DataFrame:
    """Of (doc, text): rows (doc, n, mark: fingerprint of the set), and rows (chunk, counts) of each task's table of counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << COUNT_BITS, np.int64)
        names = ["doc", "n", "mark", "chunk", "counts"]
        for batch in batches:
            text = strings(batch.column(1))
            for lo, hi in groups(text):
                s = Sets(Words(text, lo, hi, True))
                seen += np.bincount((s.item >> np.uint64(64 - COUNT_BITS)).astype(np.int64), minlength=len(seen))
                m = hi - lo
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, m), pa.array(s.size, pa.int64()), pa.array(s.mark), pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary())], names)
        if seen.any():
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([_packed(seen)], pa.binary())], names)

    return docs.mapInArrow(run, "doc long, n long, mark long, chunk long, counts binary")


def _packed(seen: np.ndarray) -> bytes:
    kind = "<u2" if seen.max() < 1 << 16 else "<i8"
    return kind.encode() + zlib.compress(seen.astype(kind).tobytes(), 1)


def _unpacked(b: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(b[3:]), b[:3].decode()).astype(np.int64)


def rarity(told: DataFrame) -> np.ndarray:
    """For each slot, how far its count stands out: 0 for up to about what chance gives, then by powers of two."""

    def add(t: pa.Table) -> pa.Table:
        total = np.zeros(1 << COUNT_BITS, np.int64)
        for b in t.column("counts").to_pylist():
            total += _unpacked(b)
        return pa.table({"chunk": t.column("chunk").slice(0, 1), "counts": pa.array([_packed(total)], pa.binary())})

    parts = told.where("counts is not null").select("chunk", "counts")
    chunks = (parts.agg(F.max("chunk")).first()[0] or 0) + 1
    while chunks > 1:
        parts = parts.select(F.floor(F.col("chunk") / FAN_IN).alias("chunk"), "counts").groupBy("chunk").applyInArrow(add, "chunk long, counts binary")
        chunks = -(-chunks // FAN_IN)
    got = parts.collect()  # one table
    seen = _unpacked(got[0]["counts"]) if got else np.zeros(1 << COUNT_BITS, np.int64)
    usual = 4 * seen.mean() + 8
    return np.clip(np.floor(np.log2(np.maximum(seen, 1) / usual)) + 1, 0, 31).astype(np.uint8)


def postings(docs: DataFrame, rare) -> DataFrame:
    """Of texts: (token, mark) of the prefix tokens under the first order, once for each set and task.

    The token is 48 bits of its hash and 16 of its place, the largest standing for any later one: both only widen the filter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        for batch in batches:
            text = strings(batch.column(0))
            for lo, hi in groups(text):
                s = Sets(Words(text, lo, hi, True))
                new = np.zeros(hi - lo, bool)
                for i, m in enumerate(s.mark.tolist()):
                    if m not in known and s.size[i]:
                        known.add(m)
                        new[i] = True
                if len(known) > REMEMBERED:
                    known.clear()
                at, place = s.prefixes(rare.value, 0)
                own = new[s.doc[at]]
                at, place = at[own], place[own]
                d = s.doc[at]
                token = (s.item[at] & ~np.uint64(0xFFFF)) | np.minimum(place, 0xFFFF).astype(np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(s.mark[d])], ["token", "mark"])

    return docs.mapInArrow(run, "token long, mark long")


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sorted sets reach the similarity."""
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large:
        return False
    both = np.concatenate([a, b])
    both.sort()
    same = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * same >= percent * (small + large - same)


class Verifier:
    """Verified links among some classes: sets and prefixes under the further orders are made from the texts once."""

    def __init__(self, texts: pa.Array, rare: np.ndarray):
        self.sets, self.filters, self.marks = [], [], []
        for lo, hi in groups(texts):
            s = Sets(Words(texts, lo, hi, True))
            self.sets += np.split(s.item, s.first[1:-1])
            self.marks += s.mark.tolist()
            own = []
            for order in (1, 2):
                at, _ = s.prefixes(rare, order)
                cut = np.searchsorted(s.doc[at], np.arange(1, hi - lo))
                own.append([frozenset(p.tolist()) for p in np.split(s.item[at], cut)])
            self.filters += list(zip(*own, strict=True))

    def own(self, given: np.ndarray) -> np.ndarray:
        """The classes of the texts, each once. given: the class that each text was fetched for; where one id has several
        texts, those of another class are left out."""
        first: dict[int, int] = {}
        for k, (m, g) in enumerate(zip(self.marks, given.tolist(), strict=True)):
            if m == g:
                first.setdefault(m, k)
        keep = list(first.values())
        self.sets, self.filters = [self.sets[k] for k in keep], [self.filters[k] for k in keep]
        return np.array(list(first), np.int64)

    def linked(self, i: int, j: int) -> bool:
        return all(not p.isdisjoint(q) for p, q in zip(self.filters[i], self.filters[j], strict=True)) and linked(self.sets[i], self.sets[j])


def _roots(n: int) -> tuple[list[int], object]:
    up = list(range(n))

    def find(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    return up, find


def _group_links(t: pa.Table, rare: np.ndarray) -> pa.Table:
    """Edges from each class of a group to the smallest class that it is connected with by links inside the group."""
    v = Verifier(unpacked(t.column("text")), rare)
    mark = v.own(t.column("mark").to_numpy())
    n = len(mark)
    order = np.argsort([len(s) for s in v.sets], kind="stable")
    up, find = _roots(n)
    for a in range(n):
        i = int(order[a])
        for b in range(a - 1, -1, -1):
            j = int(order[b])
            if 100 * len(v.sets[j]) < PERCENT * len(v.sets[i]):
                break
            if find(i) != find(j) and v.linked(i, j):
                x, y = sorted((find(i), find(j)))
                up[y] = x
    root = [find(i) for i in range(n)]
    return pa.table({"u": pa.array(mark), "v": pa.array(mark[root])})


def _pair_links(t: pa.Table, rare: np.ndarray) -> pa.Table:
    """Edges of a group: its one row with side 0 holds the class that the others are compared with."""
    v = Verifier(unpacked(t.column("text")), rare)
    given = t.column("mark").to_numpy()
    centre = set(given[t.column("side").to_numpy() == 0].tolist())
    mark = v.own(given)
    side = np.array([0 if m in centre else 1 for m in mark.tolist()], np.int64)
    at = np.flatnonzero(side == 0)
    if not len(at):
        return pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64())})
    c = int(at[0])
    hit = [i for i in np.flatnonzero(side == 1).tolist() if v.linked(c, i)]
    return pa.table({"u": pa.array(mark[hit]), "v": pa.array(np.full(len(hit), mark[c]))})


def _seated(pairs: DataFrame) -> DataFrame:
    """(mark, low, part, side) of pairs (mark, low, n: size of the mark's set): groups of about GROUP members and ITEMS tokens at
    most, whichever is reached first, each with its centre (side 0)."""
    parts = F.greatest(F.ceil(F.count("*") / GROUP), F.ceil(F.sum("n") / ITEMS)).cast("int")
    parts = stage(pairs.groupBy("low").agg(parts.alias("parts")), "sizes")
    member = pairs.join(parts, "low").select("mark", "low", F.pmod(F.xxhash64("mark"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("side"))
    centre = parts.select(F.col("low").alias("mark"), "low", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("side"))
    return member.unionByName(centre)


@scoped
def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links, itself included) of every row.

    Null and empty texts, and texts without words, have no shingles and link with nothing. Rows with a null id take no
    part: their component is null. Rows of one id are one document with the links of all its texts. Extra columns are left out.
    """
    spark = docs.sparkSession
    source = bounded(docs).select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    known = source.where("doc is not null")
    told = stage(documents(source), "sets")
    rare = spark.sparkContext.broadcast(rarity(told))
    rows = told.where("counts is null").select("doc", "n", "mark")
    classes = told.where("counts is null and doc is not null and n > 0").groupBy("mark").agg(F.min("doc").alias("doc"), F.first("n").cast("int").alias("n"))
    classes = stage(classes, "classes")
    over = W.partitionBy("token")
    place = F.col("key").bitwiseAND(0xFFFF).cast("int").alias("place")
    post = postings(known.select("text"), rare).select(F.col("token").alias("key"), "mark", F.shiftright("token", 16).alias("token"))
    post = post.withColumn("low", F.min("mark").over(over)).withColumn("high", F.max("mark").over(over)).where("low < high")
    # tasks that met the same set have sent it once each; its rows are together by token already
    shared = stage(post.select("token", "mark", place, "low", "high").groupBy("token", "mark").agg(*(F.min(c).alias(c) for c in ("place", "low", "high"))), "shared")
    sizes = classes.select("mark", "n")

    def texts_of(seats: DataFrame) -> DataFrame:
        """Seats with the text of their class, packed."""
        named = seats.join(classes.select("mark", "doc"), "mark")
        return packed(known, "text").join(named, "doc").select("mark", "low", "part", "side", "text")

    # each class goes to the few that it shares most prefix tokens with, of those that come first or last for a token;
    # a few tokens prove nothing, but whether it is near to those does not matter, as the members of a group are compared too
    ends = shared.select("mark", F.explode(F.array("low", "high")).alias("low")).where("mark <> low")
    ties = ends.groupBy("mark", "low").agg(F.count("*").alias("c")).join(sizes, "mark").where(F.col("c") * 24 >= F.col("n"))
    best = F.row_number().over(W.partitionBy("mark").orderBy(F.desc("c"), "low"))
    chosen = stage(ties.withColumn("place", best).where(F.col("place") <= SEATS).select("mark", "low", "n"), "chosen")
    seats = stage(_seated(chosen), "seats")
    edge = "u long, v long"
    near = texts_of(seats).groupBy("low", "part").applyInArrow(lambda t: _group_links(t, rare.value), edge)
    first = stage(near.where("u <> v"), "near")
    label = stage(components(first), "labels")

    # what is left: pairs across components
    named = shared.join(label.withColumnRenamed("id", "mark"), "mark", "left").select("token", "mark", "place", F.coalesce("component", "mark").alias("label"))
    several = named.withColumn("a", F.min("label").over(over)).withColumn("b", F.max("label").over(over)).where("a <> b").drop("a", "b")
    several = stage(several.join(sizes, "mark"), "across")
    drop_staged(shared)
    left, right = (several.select("token", *(F.col(c).alias(f"{c}{k}") for c in ("mark", "n", "place", "label"))) for k in (1, 2))
    # sets of a pair differ in size by less than STEP, so a token's rows meet by classes of size: each with its own and the next smaller
    size = lambda n: F.floor(F.log(F.col(n).cast("double")) / float(np.log(STEP))).cast("int")
    left = left.withColumn("about", F.explode(F.array(size("n1"), size("n1") - 1)))
    pair = left.join(right.withColumn("about", size("n2")), ["token", "about"]).where("mark1 <> mark2 and label1 <> label2 and (n1 > n2 or (n1 = n2 and mark1 > mark2))").where(F.col("n2") * 100 >= F.col("n1") * PERCENT)
    overlap = F.ceil((F.col("n1") + F.col("n2")) * PERCENT / (100 + PERCENT))
    # what lies before a common token in one and after it in the other bounds the overlap: no row of a pair that links fails
    pair = pair.where(F.least("place1", "place2") + F.least(F.col("n1") - F.col("place1"), F.col("n2") - F.col("place2")) >= overlap)
    # the prefixes are longer than these two sizes need for one common token: where they need `least` more, as many more
    # are common. A third of that is asked for, from prefixes as much longer; all of it would make many more rows.
    prefix = lambda n: F.col(n) - F.ceil(F.col(n) * PERCENT / 100) + 1
    least = F.ceil((F.least(prefix("n1") - F.col("n1"), prefix("n2") - F.col("n2")) + overlap) / 3)
    pair = pair.where((F.col("place1") < F.col("n1") - overlap + least) & (F.col("place2") < F.col("n2") - overlap + least))
    pair = pair.groupBy("mark1", "mark2", "n1", "n2").agg(F.count("*").alias("c"), F.max("place1").alias("p1"), F.max("place2").alias("p2"))
    bound = F.col("c") + F.least(F.col("n1") - F.col("p1") - 1, F.col("n2") - F.col("p2") - 1)
    pair = pair.where((F.col("c") >= least) & (bound >= overlap))
    pair = stage(pair.select(F.col("mark2").alias("mark"), F.col("mark1").alias("low"), F.col("n2").alias("n")), "pairs")
    seats = stage(_seated(pair), "seats")
    far = texts_of(seats).groupBy("low", "part").applyInArrow(lambda t: _pair_links(t, rare.value), edge)
    second = stage(far, "far")

    # documents: classes of one set, links between classes, and texts of one id
    same = rows.where("doc is not null and n > 0").join(classes.withColumnRenamed("doc", "low_doc"), "mark").select("doc", "low_doc")
    by_mark = classes.select("mark", F.col("doc").alias("id"))
    to_doc = first.unionByName(second).join(by_mark.withColumnRenamed("mark", "u").withColumnRenamed("id", "du"), "u").join(by_mark.withColumnRenamed("mark", "v").withColumnRenamed("id", "dv"), "v")
    edges = to_doc.select(F.col("du").alias("u"), F.col("dv").alias("v")).unionByName(same.where("doc <> low_doc").select(F.col("doc").alias("u"), F.col("low_doc").alias("v")))
    found = components(edges).withColumnRenamed("id", "doc")
    return rows.join(found, "doc", "left").select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "doc").alias("component_id"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))


QUERIES = {"op3_ngram_jaccard": op3_ngram_jaccard}
ORACLE = {
    "op3_ngram_jaccard": r"""
    WITH RECURSIVE d AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
    ), s AS (
      SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM d WHERE len(w) > 0)
    ), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
    l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
    e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
    r(doc, label) AS (SELECT doc_id, doc_id FROM d UNION SELECT e.y, r.label FROM r JOIN e ON r.doc = e.x)
    SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.label) AS component_id FROM d JOIN r ON r.doc = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
    """,
}
