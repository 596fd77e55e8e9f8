import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from waymark.llm.neighbours import nearest


def brute(rows, k):
    fine = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for q, v in fine:
        if q % 100 == 0:
            near = {(math.sqrt(float(((np.array(v) - np.array(w)) ** 2).sum())), i) for i, w in fine if i != q and len(w) == len(v)}
            out[q] = sorted(near)[:k]
    return out


def check(spark, rows, k, least, **sizes):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, rank int")
    got = {}
    for r in sorted(nearest(df, F.col("vec_id") % 100 == 0, k, **sizes).collect()):
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    want = brute(rows, k)
    assert set(got) == {q for q in want if want[q]}
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in got)
    assert hits >= least * sum(map(len, want.values()))
    assert all(len(got[q]) == len(want[q]) and got[q] == sorted(got[q]) for q in got)


def test_recall_on_clusters_over_shards(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + 0.2 * rng.normal(size=16)).tolist()) for i in range(3000)]
    check(spark, rows, 10, 0.95, shard_size=700, group_size=11)


def test_copies_and_edges(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(400)] + [(1000 + i, rng.normal(size=3).tolist()) for i in range(300)]
    rows += [(5000, None), (5100, []), (5200, [0.0, 0.0, 0.0]), (5300, [1.0, None, 2.0]), (5400, [1.0, math.nan, 2.0]), (5500, [math.inf, 1.0, 1.0])]
    rows += [(None, [1.0, 1.0, 1.0]), (1000, rows[400][1]), (6000, [1.0, 1.0]), (6001, [2.0, 1.0]), (6100, [1.0, 1.0, 1.0, 1.0])]
    check(spark, rows, 10, 0.99, shard_size=100)
    df = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert nearest(df, F.col("vec_id") % 100 == 0).count() == 0


def test_ids_with_two_vectors(spark):
    rows = [(100, [1.0, 0.0]), (100, [0.0, 1.0]), (7, [1.0, 0.1]), (8, [0.1, 1.0]), (7, [0.0, 5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = nearest(df, F.col("vec_id") % 100 == 0, 3).orderBy("rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in got] == [(100, 1, 7), (100, 2, 8)] and all(abs(r.score - 0.1) < 1e-12 for r in got)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="driver tables are not here")
def test_recall_on_the_given_vectors_over_several_shards(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    rows = table.collect()
    matrix, ids = np.array([r.embedding for r in rows], np.float64), np.array([r.vec_id for r in rows])
    want = {}
    for q in np.flatnonzero(ids % 100 == 0):
        far = np.sqrt(((matrix - matrix[q]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((ids, far)) if ids[i] != ids[q]][:10]
        want[int(ids[q])] = {int(ids[i]) for i in order}
    for shard_size in (500, None):
        got = {}
        for r in nearest(table, F.col("vec_id") % 100 == 0, shard_size=shard_size).collect():
            got.setdefault(r.query_id, set()).add(r.vec_id)
        assert sum(len(got[q] & w) for q, w in want.items()) >= 0.97 * 10 * len(want)
