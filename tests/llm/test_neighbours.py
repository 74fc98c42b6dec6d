import math

import numpy as np
from pyspark.sql import functions as F

from pathloom.llm.neighbours import Forest, leaf_blocks, nearest_neighbours
from pathloom.llm.queries import op10_neighbours


def plain(rows, is_query, nearest=10):
    """All rows compared with all queries."""
    good = sorted({(i, tuple(v)) for i, v in rows if i is not None and v is not None
                   and all(x is not None and math.isfinite(x) for x in v) and any(v)})
    out = []
    for q, a in good:
        if is_query(q):
            best = {}
            for i, b in good:
                if i != q:
                    far = math.sqrt(sum((x - y) ** 2 for x, y in zip(a, b)))
                    best[i] = min(best.get(i, far), far)
            for rank, (far, i) in enumerate(sorted((f, i) for i, f in best.items())[:nearest], 1):
                out.append((q, rank, i, far))
    return out


def test_query_finds_nearly_all(spark, small):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    want = plain(rows, lambda i: i % 100 == 0)
    found = op10_neighbours(spark, small).collect()
    assert {(r.query_id, r.rank) for r in found} == {w[:2] for w in want}
    hits = {(r.query_id, r.vec_id) for r in found} & {(w[0], w[2]) for w in want}
    assert len(hits) >= 0.9 * len(want)
    vectors = dict(rows)
    for r in found:
        far = math.sqrt(sum((x - y) ** 2 for x, y in zip(vectors[r.query_id], vectors[r.vec_id])))
        assert abs(far - r.score) <= 1e-12


def test_recall_of_the_forest_in_a_larger_table(spark):
    rng = np.random.default_rng(1)
    data = rng.normal(size=(9000, 24))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<double>")
    found = nearest_neighbours(table, F.col("vec_id") % 300 == 0, search=500).collect()
    hits = 0
    for q in range(0, 9000, 300):
        far = ((data - data[q]) ** 2).sum(axis=1)
        far[q] = np.inf
        hits += len(set(np.argsort(far)[:10].tolist()) & {r.vec_id for r in found if r.query_id == q})
    assert len(found) == 300 and hits >= 270


def test_search_order_and_leaves():
    data = np.random.default_rng(2).normal(size=(400, 8))
    forest = Forest(data, trees=3, leaf=20)
    leaves = forest.leaves_of(data)
    sizes = dict(zip(*(x.tolist() for x in np.unique(leaves, return_counts=True))))
    for i in range(0, 400, 40):
        found = forest.search(data[i], sizes, 1)
        assert found[0] in leaves[i].tolist()
        assert len(forest.search(data[i], sizes, 10**9)) == len(sizes)


def test_odd_vectors_ties_and_hot_copies(spark):
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [1.0, None]), (5, [float("inf"), 1.0]), (None, [1.0, 1.0]),
            (100, [2.0, 0.0]), (100, [2.0, 0.0])] + [(200 + i, [0.5, 0.5]) for i in range(300)] + [(7, [-0.0, 3.0])]
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, leaf string")
    found = [tuple(r) for r in nearest_neighbours(table, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()]
    assert found == plain(rows, lambda i: i % 100 == 0)
    few = table.where("vec_id IN (0, 7)")
    assert [r.vec_id for r in nearest_neighbours(few, F.col("vec_id") == 0).collect()] == [7]
    assert nearest_neighbours(table.limit(0), F.col("vec_id") == 0).collect() == []
    assert nearest_neighbours(few, F.col("vec_id") == 55).collect() == []


def test_blocks_of_leaves():
    sizes = {0: 3, 1: 4, 2: 5, 3: 25, 5: 2, 6: 8, 7: 1}
    assert leaf_blocks(sizes, [0, 6], 10) == {0: (0, 1), 1: (0, 1), 2: (1, 1), 3: (2, 3), 5: (5, 1), 6: (6, 1), 7: (6, 1)}
    assert leaf_blocks({}, [0], 10) == {}
