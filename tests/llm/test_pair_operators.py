"""Near-duplicates, substring dedup, exact search and the pipeline against brute force and on awkward rows."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from helpers import BASE, ROWS, WORDS, documents, empty, write

from tariffloom.llm import embed_dedup, exact_topk, graph, jaccard, substring


def _near_copies(n: int, edits: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    base = [rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(120)]
    out = []
    for _ in range(n):
        w = base.copy()
        for _ in range(rng.randrange(edits)):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def _rows(seed: int):
    rng = random.Random(seed)
    texts = _near_copies(60, 8, seed) + _near_copies(40, 14, seed + 1)
    passage = " ".join(f"common{i}" for i in range(40))
    texts += [f"{passage} " + " ".join(f"own{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 60))) for _ in range(40)]
    texts += texts[:10]
    rng.shuffle(texts)
    return [(100 + i, t) for i, t in enumerate(texts)]


def _sets(text):
    w = (text or "").encode().lower().split()
    return frozenset(zip(*[w[j:] for j in range(5)], strict=False)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def _components(nodes, linked):
    up = {i: i for i in nodes}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in linked:
        x, y = sorted((find(a), find(b)))
        up[y] = x
    return {i: find(i) for i in nodes}


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_join(spark, seed, monkeypatch):
    monkeypatch.setattr(jaccard, "GROUP" if seed == 1 else "ITEMS", 16 if seed == 1 else 600)
    monkeypatch.setattr(jaccard, "SEATS", 1)
    rows = _rows(seed) + [r for r in ROWS if r[0] != 11]
    got = jaccard.join(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    sets = [(i, _sets(t)) for i, t in rows if i is not None]
    links = [(i, j) for k, (i, a) in enumerate(sets) for j, b in sets[:k] if a and b and 100 * len(a & b) >= 75 * len(a | b)]
    want = _components([i for i, _ in sets], links)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want
    assert {r.doc_id: r.n_shingles for r in got if r.doc_id is not None} == {i: len(s) for i, s in sets}
    assert all(r.component_id is None for r in got if r.doc_id is None)


def test_jaccard_awkward_tables(spark):
    got = jaccard.join(documents(spark)).collect()
    assert len(got) == len(ROWS)
    by_id = defaultdict(set)
    for r in got:
        by_id[r.doc_id].add(r.component_id)
    assert by_id[1] == by_id[2] == by_id[3] == {1} and by_id[7] == by_id[8] == {7} and by_id[5] == {5}
    assert jaccard.join(empty(spark)).count() == 0


def test_sizes_of_linked_sets_are_neighbours():
    """Whatever two sizes can link, the larger set's size class or the next smaller one is the smaller set's."""
    n = np.arange(1, 5000)
    about = np.floor(np.log(n.astype(float)) / np.log(jaccard.STEP)).astype(int)
    least = -(-n * jaccard.PERCENT // 100)
    assert ((about - about[least - 1]) <= 1).all() and (about >= about[least - 1]).all()


def test_jaccard_with_a_token_in_very_many_classes(spark):
    """A passage that all texts share, of very different lengths: no link is made up and none is lost."""
    rng = random.Random(5)
    passage = " ".join(f"common{i}" for i in range(12))
    texts = [f"{passage} " + " ".join(f"own{rng.randrange(10**6)}" for _ in range(5 + k % 180)) for k in range(1500)]
    texts += [t + " end" for t in texts[:40]]
    rows = list(enumerate(texts))
    got = {r.doc_id: r.component_id for r in jaccard.join(documents(spark, rows)).collect()}
    sets = [_sets(t) for t in texts]
    by = defaultdict(set)
    for i, s in enumerate(sets):
        for g in s:
            by[g].add(i)
    own = [{j for g in s if len(by[g]) < 100 for j in by[g]} for s in sets]
    short = [i for i, s in enumerate(sets) if len(s) < 30]
    links = [(i, j) for i, s in enumerate(sets) for j in (own[i] | (set(short) if i in short else set())) if j < i and 100 * len(s & sets[j]) >= 75 * len(s | sets[j])]
    assert got == _components(range(len(texts)), links)


def test_jaccard_one_id_with_several_texts(spark):
    a, b = _near_copies(2, 3, 11), _near_copies(2, 3, 12)
    got = jaccard.join(documents(spark, [(1, a[0]), (5, a[1]), (5, b[0]), (9, b[1]), (7, " ".join(WORDS[:9]))])).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(1, 1), (5, 1), (9, 1), (7, 7)}
    got = jaccard.join(documents(spark, [(5, a[0]), (5, b[0]), (9, b[1]), (8, a[1].replace("edit", "other"))])).collect()
    assert {r.component_id for r in got} == {5}


def _kept(rows):
    first = {}
    words = [((i, t), (t or "").encode().split()) for i, t in rows]
    for (i, _), w in words:
        for k in range(len(w) - 12 if i is not None else 0):
            key = tuple(w[k : k + 13])
            first[key] = min(first.get(key, i), i)
    out = []
    for (i, _), w in words:
        gone = set()
        for k in range(len(w) - 12 if i is not None else 0):
            if first[tuple(w[k : k + 13])] < i:
                gone |= set(range(k, k + 13))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("settle", [60, 10**6])
def test_substring_dedup(spark, monkeypatch, settle):
    monkeypatch.setattr(substring, "SETTLED_AT", settle)
    rows = _rows(3) + ROWS + [(500, "x y " * 300), (501, "x y " * 20), (502, BASE + " " + BASE)]
    got = substring.dedup(documents(spark, rows).repartition(3), carry=("mark", "doc"))
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept", "mark", "doc"]
    assert sorted(((r.doc_id, r.n_words, r.n_removed, substring.sha(r.kept)) for r in got.collect()), key=str) == _kept(rows)
    assert substring.dedup(empty(spark)).count() == 0


def test_cover_meets_every_shift():
    for shift in range(substring.PERIOD):
        assert any((k % 7 in substring.COVER) and ((k + shift) % 7 in substring.COVER) for k in range(7))


VECTORS = "vec_id long, embedding array<float>, label int, id string, score string"


def _vectors(spark, seed=5):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(30, 32))
    x = np.concatenate([c + 0.12 * rng.normal(size=(20, 32)) for c in centres] + [rng.normal(size=(300, 32))]).astype(np.float32)
    x[1] = x[0]
    rows = [(i, v.tolist(), 0, "z", "z") for i, v in enumerate(x)]
    odd = [(5000, None, 0, "z", "z"), (5001, [0.0] * 32, 0, "z", "z"), (5002, [None] + [1.0] * 31, 0, "z", "z"), (5003, [float("nan")] * 32, 0, "z", "z"), (5050, [float("inf")] * 32, 0, "z", "z"), (None, x[3].tolist(), 0, "z", "z"), (5004, [], 0, "z", "z")]
    return spark.createDataFrame(rows + odd, VECTORS), x, len(odd)


def test_embedding_links(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "BLOCK", 16)
    monkeypatch.setattr(embed_dedup, "AT_ONCE", 5)
    df, x, odd = _vectors(spark)
    got = {r.vec_id: r for r in embed_dedup.near_duplicates(df).collect()}
    assert len(got) == len(x) + odd
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = (u @ u.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    found = np.array([got[i].n_links for i in range(len(x))])
    assert (found <= near.sum(1)).all() and found.sum() >= 0.98 * near.sum()
    want = _components(range(len(x)), zip(*np.nonzero(near), strict=True))
    assert np.mean([got[i].component_id == want[i] for i in range(len(x))]) > 0.98
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in (5000, 5001, 5002, 5003, 5004, 5050))
    assert got[0].n_links >= 1 and not got[1].kept
    assert embed_dedup.near_duplicates(df.where("false")).count() == 0


def test_exact_top_k(spark, monkeypatch):
    monkeypatch.setattr(exact_topk, "ROW_BLOCK", 64)
    monkeypatch.setattr(exact_topk, "QUERY_BLOCK", 4)
    df, x, _ = _vectors(spark)
    got = defaultdict(list)
    for r in exact_topk.top_k(df, lambda c: c % 50 == 0, 5).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    whole = np.floor(x.astype(float) * 256).astype(np.int64)
    assert set(got) == set(range(0, len(x), 50))
    for q, rows in got.items():
        s = whole @ whole[q]
        order = [i for i in np.lexsort((np.arange(len(x)), -s)) if i != q][:5]
        assert sorted(rows) == [(k + 1, i, s[i]) for k, i in enumerate(order)]
    assert exact_topk.top_k(df.where("false"), lambda c: c % 50 == 0, 5).count() == 0
    assert exact_topk.top_k(df.where("vec_id = 0"), lambda c: c % 50 == 0, 5).count() == 0


def test_exact_top_k_of_copies_ties_and_repeats(spark):
    """A large class of equal vectors, ids with several vectors, equal scores, other lengths and values beyond the range."""
    rng = np.random.default_rng(9)
    rows = [(i, [0.5, 0.25, -0.125, 1.0]) for i in range(0, 400, 3)] + [(i, rng.integers(-3, 4, 4).astype(float).tolist()) for i in range(1, 400, 3)]
    rows += [(i, (rng.integers(-3, 4, 4) / 8).tolist()) for i in range(2, 400, 3)]
    rows += [(50, [9.0, 9.0, 9.0, 9.0]), (50, [8.0, 8.0, 8.0, 8.0]), (50, [8.0, 8.0, 8.0, 8.0]), (700, [1.0, 2.0]), (701, [2.0, 1.0]), (750, [1e30, 0.0, 0.0, 0.0]), (800, [])]
    got = defaultdict(list)
    df = spark.createDataFrame([(i, v, 0, "z", "z") for i, v in rows], VECTORS)
    for r in exact_topk.top_k(df, lambda c: c % 50 == 0, 5).collect():
        got[r.query_id].append((r.rank, r.score, r.vec_id))
    whole = sorted({(i, tuple(int(np.floor(x * 256)) for x in np.float32(v))) for i, v in rows if v and max(map(abs, v)) < 1e6})
    want = defaultdict(list)
    for q, a in whole:
        if q % 50 == 0:
            s = sorted(((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in whole if i != q and len(b) == len(a)))[:5]
            want[q] += [(k + 1, -x, i) for k, (x, i) in enumerate(s)]
    assert {q: sorted(v) for q, v in got.items()} == {q: sorted(v) for q, v in want.items()}


def test_bounds_hold():
    rng = np.random.default_rng(4)
    x, q = rng.integers(-4000, 4000, (500, 48)), rng.integers(-4000, 4000, (40, 48))
    low, high = x.min(0).astype(float), x.max(0).astype(float)
    upper, gap = exact_topk.bounds(q, exact_topk.cells_of(x, low, high), low, high)
    exact = q @ x.T
    assert (upper >= exact).all() and (upper - gap[:, None] <= exact).all() and np.median(gap) < 0.2 * exact.std()


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(1, 40)]
    star = [(100, i) for i in range(101, 140)]
    got = {r.id: r.component for r in graph.components(spark.createDataFrame([*path, *star, (7, 7), (200, 150), (150, 200)], "u long, v long")).collect()}
    assert set(got) == {*range(1, 41), *range(100, 140), 150, 200}
    assert all(got[i] == 1 for i in range(1, 41)) and all(got[i] == 100 for i in range(100, 140)) and got[200] == 150
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_pipeline_stages(spark, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    pytest.importorskip("public_tokenizers")
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    rows = [(i, f"clean{i} " * 3 + BASE.replace("mu", f"m{i}") + f" tail{i} " * 40) for i in range(60)]
    rows += [(100 + i, f"you moron {i} " + " ".join(random.Random(i).sample(WORDS, 20))) for i in range(60)]
    rows += [(300, rows[0][1]), (301, "password = abcdefghijklmnop and more words here"), (302, None)]
    docs = documents(spark, rows).selectExpr("doc_id", "text", "lang", "source", "cast(length(text) as long) as n_chars")
    folder = write(docs, tmp_path)
    write(spark.createDataFrame([(i, 1, int(100 <= i < 200)) for i, _ in rows[:120]], "doc_id long, quality int, toxic int"), tmp_path, "labels")
    now = docs
    kept = {}
    for k, (name, step) in enumerate(corpus_pipeline.STAGES):
        out = step(spark, now, folder)
        if k < 4:
            assert out.columns == columns
        out.write.parquet(f"{tmp_path}/{k}.parquet")
        now = spark.read.parquet(f"{tmp_path}/{k}.parquet")
        kept[name] = {r.doc_id: r for r in now.collect()}
    assert set(range(60)) <= set(kept["toxicity"]) and len([i for i in kept["toxicity"] if 100 <= i < 160]) <= 6
    assert 300 not in kept["ngram_jaccard"] and 301 in kept["ngram_jaccard"]
    assert "abcdefghijklmnop" not in kept["secret_scan"][301].text
    want = {(r.doc_id, r.piece, r.ids_crc32) for r in corpus_pipeline.run(spark, folder).collect()}
    assert want == {(r.doc_id, r.piece, r.ids_crc32) for r in now.collect()}


def test_vectors_survive_the_way():
    for v in ([0.5, -0.0, 3.0], [0.1, 1e300, 1.0], [1e-200, 2e-200, 0.0]):
        raw = embed_dedup.pack(v)
        assert len(raw) == (12 if v[0] == 0.5 else 24)
        x = np.array(v) / np.abs(v).max()
        assert np.abs(embed_dedup.unit([raw], 3)[0] - x / np.linalg.norm(x)).max() < 1e-15


@pytest.mark.parametrize("dim", [64, 128, 384])
@pytest.mark.parametrize("hashes", [1, 2, 3, 4])
def test_recall_of_buckets_holds_with_more_hashes(hashes, dim):
    """Pairs at the least cosine that links share a bucket, however many hashes a bucket number has."""
    rng = np.random.default_rng(1)
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    a, r = unit(rng.normal(size=(400, dim))), rng.normal(size=(400, dim))
    b = 0.9 * a + np.sqrt(1 - 0.81) * unit(r - (r * a).sum(1, keepdims=True) * a)
    x, y = embed_dedup.buckets(a, hashes), embed_dedup.buckets(b, hashes)
    tables = embed_dedup.tables_for(hashes, dim)
    met = [any(len(np.intersect1d(p[k : k + 4], q[k : k + 4])) for k in range(0, 4 * tables, 4)) for p, q in zip(x, y, strict=True)]
    assert np.mean(met) >= 0.98


def test_hashes_follow_rows_and_width():
    assert [embed_dedup.hashes_for(n, 64) for n in (10, 4_000, 5_000, 10**6, 10**8)] == [1, 1, 2, 3, 4]
    assert embed_dedup.hashes_for(10**8, 384) == 3 and embed_dedup.tables_for(4, 384) > embed_dedup.tables_for(4, 64)


def test_pipeline_on_awkward_and_empty_tables(spark, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    pytest.importorskip("public_tokenizers")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard", "substring_dedup", "secret_scan", "best_fit_packing"]
    base = documents(spark, [*ROWS, (20, "y " * 400), (20, "y " * 400), (20, "another text of the same id")]).selectExpr("doc_id", "text", "lang", "source", "cast(length(text) as long) as n_chars", "score", "'u' as predicted", "'u' as row")
    labels = spark.createDataFrame([(1, 1, 0), (9, 0, 0)], "doc_id long, quality int, toxic int")
    for name, docs in (("rows", base), ("none", base.where("false"))):
        folder = write(docs, tmp_path / name)
        write(labels, tmp_path / name, "labels")
        now, seen = docs, []
        for k, (_, step) in enumerate(corpus_pipeline.STAGES):
            out = step(spark, now, folder)
            assert k == 4 or out.columns == docs.columns
            out.write.parquet(f"{tmp_path}/{name}/{k}.out")
            now = spark.read.parquet(f"{tmp_path}/{name}/{k}.out")
            seen.append(now.count())
        if name == "none":
            assert seen == [0] * 5
            assert corpus_pipeline.run(spark, folder).count() == 0
            continue
        # 2, 3, 12 and a text of 11 are copies of 1, 8 of 7, 10 of 9; 20 has two texts and an equal row; rows without an id stay
        after = {r.doc_id for r in spark.read.parquet(f"{tmp_path}/{name}/1.out").collect()}
        assert seen[0] == len(ROWS) + 3 and after == {1, 4, 5, 6, 7, 9, 20, None} and seen[1] == 10
        kept = spark.read.parquet(f"{tmp_path}/{name}/1.out").where("doc_id = 20")
        assert kept.count() == 2 and kept.where("score = 'z' and predicted = 'u' and row = 'u'").count() == kept.count()
        assert seen[1] == seen[2] == seen[3] <= seen[4] == corpus_pipeline.run(spark, folder).count()


def test_embedding_links_that_no_table_brings_together(spark, monkeypatch):
    """With one table of three hashes few pairs share a bucket; every link is found all the same, in blocks of any cut."""
    monkeypatch.setattr(embed_dedup, "hashes_for", lambda rows, dim: 3)
    monkeypatch.setattr(embed_dedup, "tables_for", lambda hashes, dim: 1)
    monkeypatch.setattr(embed_dedup, "FILE_BLOCK", 16 * 24)
    monkeypatch.setattr(embed_dedup, "LEAST_ROWS", 7)
    monkeypatch.setattr(embed_dedup, "AT_ONCE", 5)
    rng = np.random.default_rng(5)
    x = np.repeat(rng.normal(size=(12, 24)), 8, 0) + 0.3 * rng.normal(size=(96, 24))
    x[40] = x[41]
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(200, [1.0, 0.0]), (201, [1.0, 0.1])]
    got = {r.vec_id: r for r in embed_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    u = x / np.linalg.norm(x, axis=1)[:, None]
    link = u @ u.T >= 0.9
    part = np.arange(96)
    for _ in range(96):
        part = np.where(link, part[None, :], 96).min(1)
    codes = embed_dedup.buckets(u, 3, 1)
    together = (codes[:, None, :, None] == codes[None, :, None, :]).any((2, 3))
    assert (link & ~together).sum() > 20
    assert [got[k].n_links for k in range(96)] == (link.sum(1) - 1).tolist()
    assert [got[k].component_id for k in range(96)] == part.tolist()
    assert (got[200].n_links, got[201].component_id) == (1, 200)


def test_embedding_links_exactly_at_the_limit(spark):
    """9 / 10 in exact numbers, where the product of unit vectors rounds below it; 44 / (7 * 52 ** 0.5) stays apart."""
    x = [([-3.0, 4.0, 5.0], [0.0, 1.0, 1.0]), ([-3.0, 5.0, 4.0], [0.0, 2.0, 2.0]), ([6.0, 3.0, 2.0], [6.0, 0.0, 4.0])]
    assert all(a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.9 > (a / np.sqrt(a @ a)) @ (b / np.sqrt(b @ b)) for a, b in (map(np.array, v) for v in x[:2]))
    for (a, b), n in zip(x, (1, 1, 0), strict=True):
        df = spark.createDataFrame([(1, a), (2, b)], "vec_id long, embedding array<double>")
        assert [r.n_links for r in embed_dedup.near_duplicates(df).collect()] == [n, n]


def test_embedding_links_of_one_vector_to_two_that_are_apart(spark):
    """3 links with 1 and 2, which do not link: all are one component, though 3 has its smallest neighbour in 1."""
    turn = np.deg2rad([-25, 25, 0])
    rows = [(k + 1, [float(np.cos(t)), float(np.sin(t)), 0.0]) for k, t in enumerate(turn)]
    got = embed_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("vec_id").collect()
    assert [(r.n_links, r.component_id) for r in got] == [(1, 1), (1, 1), (2, 1)]
