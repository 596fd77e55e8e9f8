import hashlib
import math
import random
import re
import string
import zlib
from collections import Counter

import numpy as np
import pytest

from waymark.llm.importance import bucket_features, importance_sample, suffix_array
from waymark.llm.queries import op11_importance

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def grams(text, low, high):
    w = words(text)
    return [" ".join(w[i : i + k]) for k in range(low, high + 1) for i in range(len(w) - k + 1)]


def buckets(text, low, high, n):
    return [zlib.crc32(g.encode()) % n for g in grams(text, low, high)]


def expected(docs, target, low=1, high=1, n=10_000, percent=10, least=20, seed="2024"):
    s = Counter(b for _, t in docs for b in buckets(t, low, high, n))
    t = Counter(b for x in target for b in buckets(x, low, high, n))
    big_s, big_t, out = sum(s.values()), sum(t.values()), []
    for key, text in docs:
        found = buckets(text, low, high, n)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (big_s + n) / ((s[b] + 1) * (big_t + n)))) for b in found)
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(words(text)), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    drawn = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], -1 if r[0] is None else r[0]))
    for i, r in enumerate(drawn[: len(drawn) * percent // 100]):
        r[5] = i + 1
    return sorted(map(tuple, out), key=str)


def texts(seed, count):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["The", "é漢", "I'm", "x_y", "ÀB"]
    return [rng.choice([" ", "  ", ", ", "\n"]).join(rng.choice(vocabulary) for _ in range(rng.choice([0, 3, 30, 90]))) for _ in range(count)]


def test_suffix_array_orders_and_counts_shared_words():
    rng = random.Random(0)
    for depth in (1, 2, 3, 5):
        owner = np.sort(np.array([rng.randrange(6) for _ in range(80)]))
        ids = np.array([rng.randrange(3) for _ in range(80)])
        order, shared = suffix_array(ids, owner, depth)

        def suffix(i):
            return [int(ids[j]) for j in range(i, min(i + depth, 80)) if owner[j] == owner[i]]

        ordered = [suffix(i) for i in order]
        assert ordered == sorted(ordered)
        for k in range(1, 80):
            same = next((d for d, (a, b) in enumerate(zip(ordered[k - 1], ordered[k], strict=False)) if a != b), min(len(ordered[k - 1]), len(ordered[k])))
            assert shared[k] == same


@pytest.mark.parametrize("low,high", [(1, 1), (1, 3), (2, 2)])
def test_features_equal_brute_force(low, high):
    every = [*texts(1, 60), None, "", "A a B", "é\x85x"]
    owner, found, many = bucket_features(every, low, high, 997)
    assert many.tolist() == [len(words(t)) for t in every]
    for i, t in enumerate(every):
        assert sorted(found[owner == i].tolist()) == sorted(buckets(t, low, high, 997))


@pytest.mark.parametrize("options", [{}, {"low": 1, "high": 3, "buckets": 500, "percent": 37, "least_words": 5, "seed": "a"}])
def test_sample_equals_brute_force(spark, options):
    docs, target = [(i % 250 if i % 50 else None, t) for i, t in enumerate(texts(2, 300))] + [(7, None)], texts(3, 40) + [None, ""]
    got = importance_sample(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame([(t,) for t in target], "text string"), **options)
    names = {"buckets": "n", "least_words": "least"}
    want = expected(docs, target, **{names.get(k, k): v for k, v in options.items()})
    rows = sorted(map(tuple, got.collect()), key=str)
    assert [r[:5] for r in rows] == [w[:5] for w in want]
    # rows of one id and one score may take each other's rank
    assert sorted((r[4], r[0] is None or r[0], r[5] or 0) for r in rows) == sorted((w[4], w[0] is None or w[0], w[5] or 0) for w in want)


def test_edges(spark):
    docs = spark.createDataFrame([("a", "x " * 25, 1, 2), ("a", "x " * 25, 1, 2), (None, None, 3, 4), ("b", "", 5, 6)], "id string, body string, rank_ int, text_ int")
    target = spark.createDataFrame([("x y",)], "body string")
    rows = importance_sample(docs, target, "id", "body", percent=100).collect()
    assert sorted(r.rank_ for r in rows if r.rank_) == [1, 2] and {r.weight_ for r in rows if r.id != "a"} == {0}
    assert importance_sample(docs.limit(0), target, "id", "body").count() == 0
    assert importance_sample(docs, target.limit(0), "id", "body").count() == 4
    with pytest.raises(ValueError):
        importance_sample(docs, target, "rank_", "body")


def test_query(spark, tmp_path):
    docs, target = list(enumerate(texts(5, 120))), texts(6, 20)
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = op11_importance(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, out.collect()), key=str) == [(w[0], *w[2:]) for w in expected(docs, target)]
