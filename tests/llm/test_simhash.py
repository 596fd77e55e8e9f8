import random

import numpy as np
import xxhash

from waymark.llm.common import components
from waymark.llm.simhash import codeword_keys, fingerprint, golay_tables, keep_one, link, link_keys, simhash_groups


def brute_print(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in "\t\n\v\f\r" else c for c in low).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints):
    """prints: list of (doc_id, unsigned fingerprint) -> component per row."""
    distinct = sorted({p for _, p in prints})
    root = {p: p for p in distinct}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, p in enumerate(distinct):
        for q in distinct[:i]:
            if (p ^ q).bit_count() <= 4:
                root[find(p)] = find(q)
    least = {}
    for d, p in prints:
        if d is not None:
            r = find(p)
            least[r] = min(d, least.get(r, d))
    return [(d, p, least.get(find(p))) for d, p in prints]


def test_fingerprint_against_brute_force():
    texts = [None, "", " \t\n", "One", "one two three", "A b C d", "a b c d e f g " * 30, "É x y　z é Q W", "x" * 5000]
    for t in texts:
        assert fingerprint(None if t is None else t.encode()) & (2**64 - 1) == brute_print(t)


def test_golay_code_is_perfect():
    _, error_of, offsets = golay_tables()
    assert len(set(error_of.tolist())) == 2048
    v = np.arange(1 << 23, step=997, dtype=np.int64)
    keys, on = codeword_keys(v)
    for bit in range(23):
        other, other_on = codeword_keys(v ^ (1 << bit))
        shared = ((keys[:, :, None] == other[:, None, :]) & on[:, :, None] & other_on[:, None, :]).any(axis=(1, 2))
        assert shared.all()


def test_every_pair_within_four_bits_shares_a_key():
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(3000)]
    near = [b ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, 4))) for b in base]
    signed = np.array(base + near, dtype=np.uint64).view(np.int64)
    rows, keys = link_keys(signed)
    of = {}
    for r, k in zip(rows.tolist(), keys.tolist(), strict=True):
        of.setdefault(r, set()).add(k)
    assert all(of[i] & of[len(base) + i] for i in range(len(base)))


def test_groups_with_edges(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["a", "b", "c", "dd", "É"]) for _ in range(rng.choice([0, 1, 3, 4, 30, 80]))) for _ in range(120)]
    long = " ".join(rng.choice(["a", "b", "c", "dd", "É"]) for _ in range(4000)).split()
    for i in range(40):
        copy = list(long)
        copy[rng.randrange(4000)] = f"w{i}"
        texts.append(" ".join(copy))
    docs = [(i + 5, t) for i, t in enumerate(texts)] + [(3, texts[0]), (5, texts[0]), (None, texts[9]), (7000, None), (None, "only null"), (7001, "x " * 30000)]
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in docs], "doc_id long, text string, print int, rep int")
    want = sorted(brute_groups([(d, brute_print(t)) for d, t in docs]), key=repr)
    for block in (1024, 7):
        got = simhash_groups(df, block=block).collect()
        assert sorted(((r.doc_id, r.print & (2**64 - 1), r.component_id) for r in got), key=repr) == want
    assert simhash_groups(df.limit(0)).count() == 0


def test_planted_near_fingerprints(spark):
    rng = random.Random(2)
    prints = {}
    for i in range(300):
        p = rng.getrandbits(64)
        for j in range(3):
            prints.setdefault(p, i * 3 + j)
            p ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5)))
    rows = [(int(np.uint64(p).astype(np.int64)), d) for p, d in prints.items()]
    found = {r.node: r.component for r in components(link(spark.createDataFrame(rows, "print long, rep long"))).collect()}
    want = {d: c for d, _, c in brute_groups([(d, p) for p, d in prints.items()])}
    assert {d: found.get(d, d) for d in want} == want


def near_texts(rng):
    """Three texts whose fingerprints chain: the first and the last are further apart than a link."""
    words = [f"w{rng.randrange(10**6)}" for _ in range(800)]
    chain = [" ".join(words)]
    while len(chain) < 3:
        words = [*words, *(f"v{rng.randrange(10**6)}" for _ in range(12))]
        print_ = brute_print(" ".join(words))
        if 2 < (print_ ^ brute_print(chain[-1])).bit_count() <= 4 and (len(chain) < 2 or (print_ ^ brute_print(chain[0])).bit_count() > 4):
            chain.append(" ".join(words))
        elif (print_ ^ brute_print(chain[-1])).bit_count() > 4:
            words = chain[-1].split(" ")
    return chain


def test_a_row_without_id_links_its_neighbours(spark):
    chain = near_texts(random.Random(5))
    docs = [(1, chain[0]), (2, chain[2]), (None, chain[1]), (9, "alone in the world")]
    got = simhash_groups(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.component_id) for r in got), key=repr) == sorted([(1, 1), (2, 1), (None, 1), (9, 9)], key=repr)


def test_keep_one_with_clashing_names_and_null_ids(spark):
    chain = near_texts(random.Random(5))
    rows = [(2, chain[2], "a", 1), (1, chain[0], "b", 2), (None, chain[1], "c", 3), (None, "lone", "d", 4), (4, None, "e", 5), (4, None, "e", 5)]
    kept = keep_one(spark.createDataFrame(rows, "doc_id long, text string, id string, row int"))
    assert kept.columns == ["doc_id", "text", "id", "row"]
    assert sorted(r.id for r in kept.collect()) == ["b", "d", "e"]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(1000, 2000 + i) for i in range(50)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(51)) and all(got[2000 + i] == 1000 for i in range(50))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
