import random

from pyspark.sql import functions as F

from waymark.llm.toxicity import Matcher, drawn, quotations, score, train


def distance(a, b):
    """Edits between two words; a swap of neighbouring letters is one."""
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(rows[-1][j] + 1, row[-1] + 1, rows[-1][j - 1] + (x != y)))
            if i > 1 and j > 1 and x == b[j - 2] and y == a[i - 2]:
                row[-1] = min(row[-1], rows[-2][j - 2] + 1)
        rows.append(row)
    return rows[-1][-1]


def test_matcher_against_edit_distance():
    rng = random.Random(9)
    terms = ["idiot$", "trash$", "loweis", "abc$", "scumm$", "trick$", "vequ", "grobianis"]
    matcher = Matcher(terms)
    words = {t.rstrip("$") for t in terms}
    for _ in range(6000):
        w = list(rng.choice(sorted(words)))
        for _ in range(rng.randint(0, 2)):
            i = rng.randrange(len(w) + 1)
            w[i : i + rng.randint(0, 1)] = rng.choice(["", "a", "t", "ck"])
        if len(w) > 2 and rng.random() < 0.3:
            i = rng.randrange(len(w) - 1)
            w[i], w[i + 1] = w[i + 1], w[i]
        w = "".join(w) + rng.choice(["", "", "is"])
        want = {}
        for t in terms:
            if t.endswith("$"):
                d = distance(w, t[:-1])
                if d == 0 or (d == 1 and len(t) > 5):
                    want[t] = d
            else:
                d = min(distance(w[:i], t) for i in range(len(w) + 1))
                if d == 0 or (d == 1 and len(t) >= 8):
                    want[t] = d
        assert dict(matcher.match(w)) == want, w


def corpus(n, rng):
    plain = ["the", "of", "house", "water", "green", "walking", "sometimes", "and", "there"]
    bad = ["scumbag", "worthless", "grobis", "grobian", "grober"]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
        toxic = rng.random() < 0.2
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(bad)
        elif rng.random() < 0.2:
            words.insert(2, f'"{rng.choice(bad)}"')
        rows.append((i, " ".join(words), 1.0))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_quality_and_edges(spark):
    rng = random.Random(3)
    rows, labels = corpus(900, rng)
    extra = [(9000, None, 1.0), (9001, "", 1.0), (9002, "you worthles thing " + "house " * 30000, 1.0), (None, "the house", 1.0), (3, rows[3][1], 1.0)]
    docs = spark.createDataFrame(rows + extra, "doc_id long, text string, score double")
    marks = spark.createDataFrame([*labels, (5, None), (None, 1)], "doc_id long, toxic int")
    out = score(docs, train(docs, marks)).collect()
    assert len(out) == len(rows) + len(extra) and all(0 <= r.toxic_score_ <= 1 for r in out)
    by = {r.doc_id: r.toxic_score_ for r in out}
    right = sum((by[i] >= 0.5) == bool(t) for i, t in labels)
    assert right >= 0.97 * len(labels)
    assert by[9002] > 0.5 and by[9000] == by[9001] < 0.5
    none = score(docs, train(docs, marks.limit(0))).collect()
    assert all(r.toxic_score_ < 0.5 for r in none) and score(docs.limit(0), train(docs.limit(0), marks)).count() == 0


def test_draw_is_the_first_by_hash_and_reads_few_rows(spark):
    ids = spark.range(20_000).select("id", F.lit(True).alias("toxic"))
    want = sorted(r.id for r in ids.orderBy(F.shiftrightunsigned(F.xxhash64("id"), 1), "id").limit(50).collect())
    assert sorted(r.id for r in drawn(ids, 50, 20_000).collect()) == want
    assert drawn(ids.limit(20), 50, 20).count() == 20


def test_quotation_and_separators():
    text = 'he said "you scum-bag" and don\'t. scum/bag'
    assert list(quotations(text, "scum")) == [True, False]
