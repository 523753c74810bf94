"""Vector searches against brute force, and the pipeline stage by stage."""

from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from longreg.llm import components, hnsw, mixing, mtree, ngram_join, queries
from longreg.llm.components import connected_components
from longreg.sources.tables import stage

from ..conftest import SF
from .frames import empty, odd_documents


def vectors(spark, sf=SF):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    return np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)


def results(frame):
    out = defaultdict(list)
    for r in sorted(frame.collect()):
        assert r.rank == len(out[r.query_id]) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return dict(out)


def products(ids, rows, k, modulus):
    whole = np.floor(64 * rows).astype(int)
    want = {}
    for at in np.flatnonzero(ids % modulus == 0):
        score = whole @ whole[at]
        order = [i for i in np.lexsort((ids, -score)) if i != at][:k]
        want[ids[at]] = [(ids[i], score[i]) for i in order]
    return want


def test_exact_top_k(spark):
    assert results(queries.op6_mtree_top_k(spark, SF)) == products(*vectors(spark), 20, 20)


def test_exact_top_k_with_ties_over_several_shards(spark):
    rng = np.random.default_rng(0)
    rows = rng.integers(-2, 3, (400, 3)) / 64
    frame = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "vec_id long, embedding array<double>")
    got = mtree.highest_products(frame, F.col("vec_id") % 20 == 0, 20, per_shard=90, per_block=7)
    assert results(got) == products(np.arange(400), rows, 20, 20)


def test_queries_go_through_a_tree_together(monkeypatch):
    rng, opened = np.random.default_rng(1), []
    rows = np.unique(rng.integers(-60, 60, (3000, 8)).astype(float), axis=0)
    rows[:5] *= 2.0 ** 20  # norms far apart
    tree, asked = mtree.MTree(rows), np.r_[rows[::30], np.zeros((1, 8))]
    pop = mtree.heapq.heappop
    monkeypatch.setattr(mtree.heapq, "heappop", lambda heap: opened.append(heap[0][2]) or pop(heap))
    for query, (at, scores) in zip(asked, tree.highest(asked, 21), strict=True):
        every = rows @ query
        assert sorted(at) == np.flatnonzero(every >= np.sort(every)[-21]).tolist() and (scores == every[at]).all()
    assert len(opened) == len({id(page) for page in opened})


def test_neighbours_are_mostly_the_nearest(spark):
    sf = "/root/testdata/sf0.1"
    ids, rows = vectors(spark, sf)
    unit = rows / np.linalg.norm(rows, axis=1)[:, None]
    got, hits = results(queries.op9_hnsw_neighbours(spark, sf)), 0
    for at in np.flatnonzero(ids % 50 == 0):
        score = unit @ unit[at]
        best = [ids[i] for i in np.lexsort((ids, -score)) if i != at][:5]
        hits += len({i for i, _ in got[ids[at]]} & set(best))
        for i, s in got[ids[at]]:
            assert abs(s - score[np.searchsorted(ids, i)]) < 1e-12
    assert hits >= 0.9 * 5 * len(got)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [None, 1.0]), (4, [float("nan"), 1.0]),
            (5, [float("inf"), 1.0]), (6, [1.0]), (None, [1.0, 1.0]), (7, []), (50, [2.0, 0.0]), (9, [2.0, 0.0]), (8, [2.0, 0.0])]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")
    asked = F.col("vec_id") % 50 == 0
    near = hnsw.nearest_neighbours(frame, asked).collect()
    assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in near) == Counter(  # the two rows of id 0 find each other
        [(0, n, i, 1.0) for n, i in enumerate((0, 8, 9, 50), 1)] * 2 + [(50, n, i, 1.0) for n, i in enumerate((0, 0, 8, 9), 1)])
    top = mtree.highest_products(frame, asked, 3).collect()
    assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in top if r.query_id == 0) == Counter([(0, 1, 8, 8192), (0, 2, 9, 8192), (0, 3, 50, 8192)] * 2)
    for search in (hnsw.nearest_neighbours, mtree.highest_products):
        assert search(frame.where("false"), asked).count() == 0


def test_repeated_ids_and_other_lengths_lose_nothing(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 1.0]), (1, [9.0, 9.0]), (3, [5.0, 5.0]), (20, [2.0]), (5, [3.0]), (7, [1.0, 1.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for per_shard in (1, 8192):
        got = results(mtree.highest_products(frame, F.col("vec_id") % 20 == 0, 20, per_shard=per_shard, per_block=1))
        assert got == {0: [(1, 110592), (3, 61440), (1, 12288)], 20: [(5, 24576)]}


def test_components(spark):
    rng = np.random.default_rng(4)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 200, (150, 2))] + [(i, i + 1) for i in range(300, 420)] + [(500, 500)]
    root = {x: x for link in links for x in link}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    linked = {x for a, b in links if a != b for x in (a, b)}
    got = dict(connected_components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {x: find(x) for x in linked}


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation ")


def test_plans_of_the_pipeline_stay_small(spark, monkeypatch):
    seen, rounds = [], []

    def staged(df, name):
        seen.append(scans(df))
        return stage(df, name)

    monkeypatch.setattr(components, "stage", staged)
    links = stage(spark.createDataFrame([(i, i + 1) for i in range(20)], "a long, b long"), "chain")
    assert connected_components(links).count() == 21
    assert max(seen) <= 4
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert scans(mixing.apply_mix(docs, mixing.mix_documents(docs))) <= 4
    # No key is shared by many, so nothing is left to search or to connect after the pairs.
    monkeypatch.setattr(ngram_join, "connected_components", lambda df: rounds.append(df) or connected_components(df))
    few = spark.createDataFrame([(i, f"a b c d e f g h i j k l m n o p q r s t {i // 2 * 'z'} w{i}") for i in range(8)], "doc_id long, text string")
    ngram_join.similar_groups(few).count()
    assert len(rounds) == 1


def test_keys_of_many_are_counted_without_a_join(spark):
    met = stage(spark.createDataFrame([(k, c, 9, 40) for k in range(4) for c in range(40)] + [(9, 99, 9, 40)],
                                      "key long, cls long, size long, classes long"), "met-by-hand")
    few, many = ngram_join._under_many(met, 4)
    assert few.count() == 0 and many.count() == 160 and many.where("cls = 99").count() == 0
    # One join, that of every row with its key's most central class.
    assert ngram_join._to_central(many)._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for at, (name, work) in enumerate(corpus_pipeline.STAGES):
        out = work(spark, docs, SF)
        out.write.parquet(str(tmp_path / str(at)))
        docs = spark.read.parquet(str(tmp_path / str(at)))
        counts.append(docs.count())
        if at < 4:
            assert docs.columns == columns
        if at == 1:
            assert max(Counter(r.doc_id for r in docs.collect()).values()) == 1
    assert counts[0] > counts[1] > counts[2] == counts[3]
    ran = corpus_pipeline.run(spark, SF)
    pieces = lambda df: Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in df.collect())
    assert pieces(ran) == pieces(docs)


def test_stages_on_odd_documents(spark):
    for docs in (odd_documents(spark), empty(spark)):
        for _, work in corpus_pipeline.STAGES:
            work(spark, docs, SF).count()
