import random
import re
from collections import defaultdict

import xxhash

from waymark.llm.lines import dedup_lines


def signed(text):
    return int.from_bytes(xxhash.xxh64_intdigest(text.encode(), 42).to_bytes(8, "little"), "little", signed=True)


def brute(docs, min_docs=3):
    """docs: (id, text) -> text after deduplication, row by row. Templates are tuples of tokens with a hole."""
    where, lines = defaultdict(set), []
    for key, text in {d for d in docs if d[1] is not None}:
        for i, line in enumerate(text.split("\n")):
            tokens = ["<*>" if re.search("[0-9]", t) else t for t in line.split(" ") if t]
            if not tokens:
                continue
            doc, n = (key is not None, key or 0, signed(text)), len(tokens)
            p = min(n, 8)
            cuts = [j * n // p for j in range(p + 1)]
            own = [(-1, tuple(tokens))]
            if p >= 5:
                own += [(j, (*tokens[: cuts[j]], None, *tokens[cuts[j + 1] :])) for j in range(p) if cuts[j + 1] > 3]
            own = [(n, tuple(tokens[:3]), *o) for o in own]
            lines.append((doc, i, own))
            for o in own:
                where[o].add(doc)
    chosen = defaultdict(set)
    for doc, i, own in lines:
        recurring = [o for o in own if len(where[o]) >= min_docs]
        if recurring:
            chosen[max(recurring, key=lambda o: (len(where[o]), -o[2]))].add((doc, i))
    drops = defaultdict(set)
    for places in chosen.values():
        for d, i in places - {min(places)}:
            drops[d].add(i)
    out = []
    for key, text in docs:
        if text is not None:
            lost = drops[(key is not None, key or 0, signed(text))]
            text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in lost)
        out.append((key, text))
    return sorted(out, key=repr)


def test_against_brute_force(spark):
    rng = random.Random(8)
    words = ["the", "of", "and", "to", "x1", "22", "é", "word", "line", "long"]
    pool = [" ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 5, 7, 9, 20]))) for _ in range(60)]
    pool += [f"This work is licensed under version {i} of the public licence by {rng.choice(words)} today" for i in range(12)]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(rng.choice([1, 3, 8])))) for i in range(80)]
    docs += [(3, docs[3][1]), (3, "other text"), (None, docs[5][1]), (None, None), (500, None), (501, ""), (502, "\n\n \n"), (503, "\n".join(pool * 30)), (504, "a " * 30000)]
    df = spark.createDataFrame([(k, t, 1, "z") for k, t in docs], "doc_id long, text string, line int, template string")
    got = dedup_lines(df)
    assert got.columns == [*df.columns, "lines_in_", "lines_out_"]
    rows = got.collect()
    assert sorted(((r.doc_id, r.text) for r in rows), key=repr) == brute(docs)
    assert all(r.lines_out_ <= r.lines_in_ for r in rows)
    assert dedup_lines(df.limit(0)).count() == 0


def test_variable_fields_and_first_copy(spark):
    docs = [(i, f"Own words number {i} of document {'abcdefgh'[i]} alone\nReleased under licence 2.{i} by all of the many good authors here") for i in range(5)]
    out = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert "Released" in out[0] and all("Released" not in out[i] for i in range(1, 5))


def test_families_of_one_leaf_do_not_hide_each_other(spark):
    kinds = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota", "kappa", "mu", "nu"]
    docs = [(i, f"own words of {k} here\nPlease read our {k} policy before you go on") for i, k in enumerate(kinds)]
    docs += [(100 + i, "Please read our fine print with some care today friend") for i in range(30)]
    out = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert sum("policy" in t for t in out.values()) == 1 and sum("fine print" in t for t in out.values()) == 1
    assert all("own words" in out[i] for i in range(len(kinds))[:1])


def test_short_lines_have_a_variable_field_from_five_tokens(spark):
    docs = [(i, f"posted by our editor {'abcdef'[i]}\nseen by {'abcdef'[i]} twice\n{'abcdef'[i]} seen by us today") for i in range(6)]
    out = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert sum("posted by" in t for t in out.values()) == 1
    assert sum("twice" in t for t in out.values()) == 6 and sum("today" in t for t in out.values()) == 6


def test_clashing_names(spark):
    df = spark.createDataFrame([(1, "a b", 1, 2, 3, 4)], "doc_id long, text string, key__ int, row__ int, drops__ int, lines_in_ int")
    out = dedup_lines(df)
    assert out.columns == ["doc_id", "text", "key__", "row__", "drops__", "lines_in_", "lines_out_"]
    assert out.first() == (1, "a b", 1, 2, 3, 1, 1)
