import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from waymark.llm.passages import LEAST, REACH, _classes, compact_windows, digests, grow, may_match, mix, passage_classes, shingles, similar, sketches


def test_compact_windows_against_brute_force():
    rng = np.random.default_rng(4)
    for least in (3, 5):
        many = np.array([0, 2, 7, 40, 3, 25])
        hashes = mix(rng.integers(0, 1 << 62, many.sum(), dtype=np.uint64))
        want, at = set(), 0
        for n in many.tolist():
            part = hashes[at : at + n].tolist()
            for i in range(n):
                for j in range(i + least - 1, n):
                    c = min(range(i, j + 1), key=part.__getitem__)
                    left = max([k + 1 for k in range(c) if part[k] < part[c]], default=0)
                    right = min([k - 1 for k in range(c + 1, n) if part[k] < part[c]], default=n - 1)
                    want.add((at + c, min(c - left, 64), min(right - c, 64)))
            at += n
        got = compact_windows(hashes, many, least)
        assert set(zip(*(x.tolist() for x in got), strict=True)) == want


def test_shingles_do_not_depend_on_place():
    texts = [b"", b"a b c", b"One two\tthree FOUR five six", b"x  one two three four five six y z"]
    parts = {}
    for at, found, many in shingles(texts):
        ends = np.cumsum(many)
        for i, n in enumerate(many.tolist()):
            parts[at + i] = found[ends[i] - n : ends[i]].tolist()
    assert parts[0] == parts[1] == [] and len(parts[2]) == 2 and parts[3][1:3] == parts[2]


def test_similar_passages():
    rng = np.random.default_rng(1)
    a = rng.integers(1, 65000, (4, 129)).astype("<u2")
    b = rng.integers(1, 65000, (4, 129)).astype("<u2")
    b[0, 50:96] = a[0, 50:96]
    b[1, 50:89] = a[1, 50:89]
    b[2, 40:64], b[2, 69:110] = a[2, 40:64], a[2, 68:109]
    assert similar(a, b).tolist() == [True, False, True, False]


def brute_linked(x, y, least=LEAST):
    """Whether two texts share an exact run of least + 4 words."""
    n = least + 4
    x, y = x.lower().split(), y.lower().split()
    runs = {tuple(x[i : i + n]) for i in range(len(x) - n + 1)}
    return any(tuple(y[i : i + n]) in runs for i in range(len(y) - n + 1))


def test_planted_passages(spark):
    rng = random.Random(5)

    def prose(n):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(n))

    passages = [prose(rng.randint(50, 120)) for _ in range(6)]
    docs = [(i, prose(rng.randint(0, 300))) for i in range(60)]
    docs += [(100 + i, f"{prose(rng.randint(0, 80))} {passages[i % 6]}\n{prose(rng.randint(0, 80))}") for i in range(30)]
    edited = passages[0].split()
    edited[len(edited) // 3] = "changed"
    docs += [(200, f"{prose(30)} {' '.join(edited)} {prose(40)}"), (201, prose(20) + " " + " ".join(passages[1].split()[:30]))]
    docs += [(300, docs[3][1]), (301, f"{docs[59][1]} {docs[59][1]}"), (302, docs[70][1]), (303, docs[70][1]), (3, docs[5][1])]
    docs += [(400, None), (401, ""), (402, None), (None, docs[71][1]), (403, prose(40)), (404, prose(20_000)), (405, "the " * 3000)]
    docs += [(406, docs[-2][1][5000:6000])]
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in docs], "doc_id long, text string, of int, rep int")
    rows = passage_classes(df)
    got = rows.collect()
    assert len(got) == len(docs)

    n = len(docs)
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if docs[i][1] and docs[j][1] and (brute_linked(docs[i][1], docs[j][1]) or (docs[i][0] == 200 and docs[j][0] == 100) ):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    want = sorted(((d, least.get(find(i))) for i, (d, _) in enumerate(docs)), key=repr)
    assert sorted(((r.doc_id, r.class_id) for r in got), key=repr) == want
    assert {r.doc_id for r in got if r.repeated} >= {200, 302, 303, 100, 404, 406} and not {r.doc_id for r in got if r.repeated} & {400, 401, 405, 403, 10}
    assert sorted(passage_classes(df, block=3).collect(), key=repr) == sorted(got, key=repr)
    assert passage_classes(df.limit(0)).count() == 0


def test_common_minima_change_no_result(spark, monkeypatch):
    from waymark.llm import passages

    rng = random.Random(31)

    def prose(n):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))

    shared = [prose(60), prose(70)]
    docs = [(i, f"{prose(rng.randint(0, 60))} {shared[i % 2]} {prose(rng.randint(0, 60))}") for i in range(40)] + [(100 + i, prose(150)) for i in range(20)] + [(200, prose(80) * 2)]
    docs += [(300 + i, docs[0][1]) for i in range(10)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = sorted(map(tuple, passage_classes(df).collect()))
    monkeypatch.setattr(passages, "ASKED", 1)
    monkeypatch.setattr(passages, "COMMON", 20)
    monkeypatch.setattr(passages, "MOST_COMMON", 1000)
    base = df.withColumn("of", F.xxhash64("text"))
    found = passages.common_minima(base)
    assert len(found) and (np.diff(found) > 0).all()
    assert sorted(map(tuple, passage_classes(df).collect())) == want
    every = base.select("of", "text").mapInArrow(passages._windows, passages.WINDOWS).select("min").distinct().collect()
    monkeypatch.setattr(passages, "common_minima", lambda docs: np.sort(np.array([r[0] for r in every], np.int64)))
    assert sorted(map(tuple, passage_classes(df).collect())) == want


def chain_links(grids, reps, more=False):
    n = len(grids)
    columns = [pa.array([7] * n), pa.array([0] * n), pa.array([more] * n), pa.array(reps), pa.array([-1] * n, pa.int32()), pa.array([g.tobytes() for g in grids], pa.binary())]
    batch = pa.RecordBatch.from_arrays(columns, ["min", "block", "more", "rep", "side", "around"])
    return [r for out in _classes(iter([batch])) for r in out.to_pylist()]


def test_links_are_found_through_members_of_a_class():
    rng = np.random.default_rng(2)
    a = np.zeros(2 * REACH + 1, "<u2")
    a[REACH - 23 : REACH + 23] = rng.integers(1, 65000, 46)
    b = a.copy()
    b[REACH - 20 : REACH - 15] = rng.integers(1, 65000, 5)
    c = b.copy()
    c[REACH + 10 : REACH + 15] = rng.integers(1, 65000, 5)
    assert similar(a[None], b[None])[0] and similar(b[None], c[None])[0] and not similar(a[None], c[None])[0]
    assert [(r["a"], r["b"]) for r in chain_links([a, b, c], [1, 2, 3])] == [(1, 2), (2, 3)]
    found = chain_links([a, b, c, b], [1, 2, 3, 4])
    assert {frozenset((r["a"], r["b"])) for r in found} >= {frozenset((1, 2)), frozenset((1, 4))}
    assert any(3 in (r["a"], r["b"]) for r in found)
    # a block of a crowded key passes every distinct row on
    found = chain_links([a, b, c, b], [1, 2, 3, 4], True)
    assert [(r["a"], r["b"]) for r in found if r["around"] is None] == [(2, 4)]
    assert sorted(r["a"] for r in found if r["around"] is not None) == [1, 2, 3]


def test_rows_without_id_link_others(spark):
    rng = random.Random(21)

    def prose(n):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))

    one, two, alone = prose(80), prose(80), prose(90)
    docs = [(1, f"{prose(40)} {one}"), (2, f"{two} {prose(40)}"), (3, prose(200)), (None, f"{one} {prose(60)} {two}"), (None, prose(100)), (None, alone), (None, f"{alone} {prose(5)}")]
    docs += [(None, docs[3][1])] * 3
    got = passage_classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert len(got) == len(docs)
    found = {r.doc_id: (r.class_id, r.repeated) for r in got if r.doc_id is not None}
    assert found == {1: (1, True), 2: (1, True), 3: (3, False)}
    assert sorted(((r.class_id, r.repeated) for r in got if r.doc_id is None), key=repr) == [(1, True)] * 4 + [(None, False)] + [(None, True)] * 2


def test_sketches_let_every_similar_pair_through():
    rng = np.random.default_rng(6)
    rows, others = [], []
    for k in range(30_000):
        left, right = [(64, 64), (0, 64), (64, 0), (int(rng.integers(0, 65)), int(rng.integers(0, 65)))][k % 4]
        if left + right + 1 < LEAST:
            left = 64
        a = np.zeros(2 * REACH + 1, "<u2")
        a[REACH - left : REACH + right + 1] = rng.integers(1, 65000, left + right + 1)
        b = a.copy()
        misses = int(rng.integers(0, (left + right + 1) // 9 + 2))
        at = int(rng.integers(REACH - left, max(REACH - left + 1, REACH + right + 2 - misses)))
        if k % 3 == 0:
            b[at : at + misses] = rng.integers(1, 65000, len(b[at : at + misses]))
        elif k % 3 == 1:
            places = rng.choice(np.arange(REACH - left, REACH + right + 1), min(misses, left + right + 1), replace=False)
            b[places] = rng.integers(1, 65000, len(places))
        else:
            shift = int(rng.integers(-2, 3))
            b[at:] = np.roll(a, shift)[at:]
            b[at : at + misses] = rng.integers(1, 65000, len(b[at : at + misses]))
            outside = a == 0
            b[outside] = 0
        rows.append(a)
        others.append(b)
    a, b = np.array(rows), np.array(others)
    hit = np.flatnonzero(similar(a, b))
    jaccard = np.array([len(set(a[i]) & set(b[i]) - {0}) / len((set(a[i]) | set(b[i])) - {0}) for i in hit])
    passed = may_match(sketches(a), sketches(b))
    assert (jaccard >= 0.8).sum() > 10_000 and passed[hit[jaccard >= 0.8]].all()
    c = rng.integers(1, 65000, a.shape).astype("<u2")
    assert may_match(sketches(c), sketches(c[::-1])).mean() < 0.06


def test_chain_of_edits_does_not_depend_on_blocks(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(50)]
    docs = []
    for i, at in enumerate([None, 1, 48, 2, 47]):
        words = [*words] if at is None else [*words[:at], f"edit{i}", *words[at + 1 :]]
        docs.append((i, " ".join(words)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted(map(tuple, passage_classes(df).collect()))
    assert sorted(map(tuple, passage_classes(df, block=1).collect())) == got


def test_edited_passages_against_brute_force_jaccard(spark):
    rng = random.Random(11)

    def prose(n):
        return ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n)]

    def sets(words):
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    docs, want = [], {"replaced": [], "inserted": [], "deleted": []}
    for n in range(300):
        size = rng.choice([52, 56, 60])
        one, at, kind = prose(size), rng.randint(size // 3, 2 * size // 3), list(want)[n % 3]
        two = one[:at] + ([] if kind == "deleted" else prose(1)) + one[at + (kind != "inserted") :]
        x, y = sets(one), sets(two)
        assert len(x & y) / len(x | y) >= 0.8
        want[kind].append(2 * n)
        docs += [(2 * n, " ".join(prose(30) + one + prose(30))), (2 * n + 1, " ".join(prose(20) + two + prose(40)))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in passage_classes(df).collect()}
    assert all(found[d] in (d, d - d % 2) for d in found)
    for kind, firsts in want.items():
        assert sum(found[d] == found[d + 1] for d in firsts) >= 0.97 * len(firsts), kind


def test_large_groups_grow_to_the_components_of_all_pairs():
    rng = np.random.default_rng(9)
    rows, reps = [], []
    for family in range(12):
        base = rng.integers(1, 65000, 129).astype("<u2")
        for member in range(int(rng.integers(1, 9))):
            row = base.copy()
            row[:20] = rng.integers(1, 65000, 20)
            at = int(rng.integers(50, 100))
            row[at : at + 5] = rng.integers(1, 65000, 5)
            row[: int(rng.integers(0, 30))] = 0
            rows.append(row)
            reps.append(family * 3 + member % 3)
    grid, reps = np.array(rows), np.array(reps)
    order = np.argsort(reps, kind="stable")
    grid, reps = grid[order], reps[order]
    n = len(grid)

    def components(links):
        root = {r: r for r in reps.tolist()}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for x, y in links:
            root[find(x)] = find(y)
        return {frozenset(r for r in root if find(r) == k) for k in {find(r) for r in root}}

    for side in (np.full(n, -1), np.arange(n) % 2):
        pairs = [(i, j) for i in range(n) for j in range(i) if side[0] < 0 or side[i] != side[j]]
        x, y = (np.array(p) for p in zip(*pairs, strict=True))
        hit = similar(grid[x], grid[y])
        want = components(zip(reps[x[hit]].tolist(), reps[y[hit]].tolist(), strict=True))
        a, b = grow(reps, digests(grid, np.zeros(n, np.int64)), side, sketches(grid), grid)
        links = list(zip(np.concatenate(a).tolist(), np.concatenate(b).tolist(), strict=True))
        assert components(links) == want and len(links) < len(set(reps.tolist()))


def test_similar_windows_meet_and_a_crowd_of_others_does_not(spark):
    from waymark.llm.passages import meeting_rows, meetings

    rng = np.random.default_rng(12)
    rows, others = [], []
    for k in range(12_000):
        left, right = [(64, 64), (0, 64), (64, 0), (int(rng.integers(0, 65)), int(rng.integers(0, 65)))][k % 4]
        if left + right + 1 < LEAST:
            left = 64
        a = np.zeros(2 * REACH + 1, "<u2")
        inside = slice(REACH - left, REACH + right + 1)
        a[inside] = rng.integers(1, 65000, left + right + 1)
        if k % 3 == 0:  # a word is repeated around the centre
            a[max(REACH - left, REACH - int(rng.integers(0, 50))) : REACH + min(right, int(rng.integers(0, 50))) + 1] = a[REACH]
        b = np.roll(a, int(rng.integers(-2, 3))) if k % 2 else a.copy()
        for _ in range(int(rng.integers(0, 4))):
            at = int(rng.integers(REACH - left, REACH + right + 1))
            b[at : at + int(rng.integers(1, 8))] = rng.integers(1, 65000)
        b[REACH - left + (k % 5) :][: int(rng.integers(0, 4))] = 0 if k % 7 == 0 else 9
        b[a == 0] = 0
        b[REACH] = a[REACH]
        rows.append(a)
        others.append(b)
    a, b = np.array(rows), np.array(others)
    hit = np.flatnonzero(similar(a, b))
    key = np.arange(len(a))
    at, found, asks = meetings(np.concatenate([key, key]), np.concatenate([a, b]))
    of, asked = at % len(a), at < len(a)
    # what a row of the first asks for, its partner has
    wanted, had = set(zip(of[asks & asked].tolist(), found[asks & asked].tolist())), set(zip(of[~asked].tolist(), found[~asked].tolist()))
    met = {i for i, _ in wanted & had}
    assert len(hit) > 4_000 and met.issuperset(hit.tolist())

    # 600 windows that end alike and 600 in which one word is repeated before others come, with two similar ones of each
    crowd = np.zeros((1200, 2 * REACH + 1), "<u2")
    crowd[:600, : REACH + 7] = rng.integers(1, 65000, (600, REACH + 7))
    crowd[:600, REACH : REACH + 7] = np.arange(1, 8)
    crowd[600:, REACH:] = rng.integers(1, 65000, (600, REACH + 1))
    for i in range(600, 1200):
        crowd[i, REACH : REACH + 4 + i % 25] = 1
    crowd[[1, 601]] = crowd[[0, 600]]
    crowd[[1, 601], [30, 100]] = 5
    df = spark.createDataFrame([(7, i, bytearray(g.tobytes())) for i, g in enumerate(crowd)], "min long, rep long, around binary")
    meeting, met = meeting_rows(df)
    got = meeting.collect()
    groups = {}
    for r in got:
        groups.setdefault(r.min, set()).add(r.rep)
    assert len(got) == met.count() and any({0, 1} <= g for g in groups.values()) and any({600, 601} <= g for g in groups.values())
    assert sum(len(g) ** 2 for g in groups.values()) < 0.02 * len(crowd) ** 2
