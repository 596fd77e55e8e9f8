import hashlib
import random
import zlib

from waymark.llm.periodic import find_runs, periodic_runs, z_function
from waymark.llm.queries import op12_periodic


def brute_runs(word, least):
    """Every maximal stretch with each period; equal stretches keep the smallest period."""
    n, found = len(word), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and word[j] == word[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def periodic_word(rng, n, letters):
    word = []
    while len(word) < n:
        part = [rng.randrange(letters) for _ in range(rng.randint(1, 12))]
        word += part * rng.randint(1, 6)
    return word[:n]


def test_z_function():
    rng = random.Random(0)
    for _ in range(200):
        word = periodic_word(rng, rng.randint(1, 40), 2)
        z = z_function(word)
        for i in range(1, len(word)):
            reach = 0
            while i + reach < len(word) and word[reach] == word[i + reach]:
                reach += 1
            assert z[i] == reach


def test_runs_equal_brute_force():
    rng = random.Random(1)
    for least in (1, 2, 3, 5, 12):
        for k in range(400):
            word = periodic_word(rng, rng.randint(0, 90), rng.choice([1, 2, 3, 30]))
            assert find_runs(word, least) == brute_runs(word, max(least, 2)), (least, word)


def test_classic_words():
    assert find_runs([0] * 5000) == [(0, 5000, 1)]
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    assert find_runs(b, 2) == brute_runs(b, 2)
    assert find_runs([1, 2] * 4000 + [3]) == [(0, 8000, 2)]
    assert find_runs(list(range(1000)) * 2) == [(0, 2000, 1000)]


def expected(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words, 12)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (
        len(runs),
        *(best and (best[0], best[1], best[2], 1000 * best[1] // best[2]) or (None,) * 4),
        hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest(),
    )


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(4)
    texts = [None, "", "   \n", "a", "a " * 30, "a\x1cb\u2003c " * 9, " \x0b x\ty " * 20]
    for _ in range(150):
        n, letters = rng.randint(1, 250), rng.choice([2, 3, 500])
        texts.append(rng.choice([" ", "  ", "\n"]).join(f"w{x}" for x in periodic_word(rng, n, letters)))
        texts.append(" ".join(f"w{rng.randrange(900)}" for _ in range(n)))
    rows = [(i, t) for i, t in enumerate(texts)] * 2
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, op12_periodic(spark, str(tmp_path)).collect()), key=lambda r: r[0])
    assert len(got) == len(rows) and sum(1 for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 10 == 0) > 15
    for row in got:
        assert row[1:] == expected(row[0], texts[row[0]]), texts[row[0]]


def test_frames(spark):
    df = spark.createDataFrame([(None, "x " * 40, 1, "c"), (1, None, 2, "d")], "id long, text string, runs_ int, Words string")
    rows = periodic_runs(df).collect()
    assert [(r.words_, r.collapsed_, len(r.runs_), r.Words) for r in rows] == [(40, "x", 1, "c"), (0, "", 0, "d")]
    assert periodic_runs(df.limit(0)).count() == 0
    long = spark.createDataFrame([("ab c " * 60_000 + "end",)], "body string")
    row = periodic_runs(long, "body").first()
    assert (row.collapsed_, [tuple(r) for r in row.runs_]) == ("ab c end", [(0, 120_000, 2)])
