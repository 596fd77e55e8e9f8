import random
import re


from waymark.llm.decontaminate import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=13, share=20):
    wins = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        if item is not None and n:
            for i in range(len(w) - n + 1):
                wins.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    out = []
    for key, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in {len(x) for x in wins}:
            for i in range(len(w) - n + 1):
                if (got := wins.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= got
        out.append((key, len(w), len(hit), sorted(found), bool(hit) and share * len(hit) >= len(w)))
    return sorted(out, key=repr)


def run(spark, docs, items):
    d = spark.createDataFrame([(k, t, "x", 1) for k, t in docs], "doc_id long, text string, words string, row int")
    b = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate(d, b).select("doc_id", "n_words", "n_hit", "items", "contaminated").collect()
    return sorted((tuple(r) for r in rows), key=repr)


def test_edge_cases(spark):
    rng = random.Random(5)
    vocab = ["a", "b", "Cé", "dÉ", "e1", "漢"]
    item = " ".join(rng.choice(vocab) for _ in range(30))
    short = "only five words are here"
    docs = [
        (1, None), (2, ""), (3, item), (3, item), (4, "x " * 40 + item.replace(" ", ", ") + " y" * 700), (None, item.upper()),
        (5, "pre only FIVE-words are\there post"), (6, " ".join(item.split()[3:15])), (7, "a " * 500), (8, item + " " + item),
        (9, " ".join(item.split()[3:17])), (9, "another text with the same id"),
    ]
    items = [(10, item), (9, item), (11, short), (12, None), (13, "..."), (None, "a a a"), (14, "a " * 20), (14, "a " * 14)]
    assert run(spark, docs, items) == brute(docs, items)
    assert run(spark, docs, []) == brute(docs, [])
    assert run(spark, [], items) == []


def test_random_small_vocabulary(spark):
    rng = random.Random(1)
    items = [(i, " ".join(rng.choice("abc") for _ in range(rng.choice([4, 12, 13, 14, 25])))) for i in range(12)]
    docs = [(i, " ".join(rng.choice("abc") for _ in range(rng.choice([0, 3, 12, 13, 60, 300])))) for i in range(150)]
    docs += [(1000 + i, f"{docs[i][1]} {items[i % 12][1]} {docs[i + 1][1]}") for i in range(60)]
    assert run(spark, docs, items) == brute(docs, items)
