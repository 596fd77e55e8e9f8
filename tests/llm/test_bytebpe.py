import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from waymark.llm import bytebpe
from waymark.llm.bytebpe import Ranks, decode, decode_span, encode, read_ranks
from waymark.llm.queries import op13_byte_bpe, ranks_path

tiktoken = pytest.importorskip("tiktoken")
TOKENS = read_ranks(ranks_path())
RANKS = Ranks(TOKENS)
LIBRARY = tiktoken.Encoding("own", pat_str=bytebpe.PATTERN, mergeable_ranks={t: i for i, t in enumerate(TOKENS)}, special_tokens={})


def ids(texts):
    found, counts = RANKS.encode(texts)
    return [f.tolist() for f in np.split(found, np.cumsum(counts)[:-1])]


def test_pattern_is_the_vocabulary_s():
    import public_tokenizers

    assert bytebpe.PATTERN == public_tokenizers.PATTERN


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("'strvelmd ab1\n\t\x1c\x85\u2028é漢!"), st.characters(exclude_categories=["Cs"])), max_size=40), min_size=1, max_size=8))
def test_ids_equal_the_library(texts):
    assert ids(texts) == [LIBRARY.encode_ordinary(t) for t in texts]


def test_every_code_point_in_every_company():
    points = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    for k in range(0, len(points), 100_000):
        texts = [f"a{chr(c)}1{chr(c)} {chr(c)}!{chr(c)}" for c in points[k : k + 100_000 : 3]]
        assert ids(texts) == LIBRARY.encode_ordinary_batch(texts, num_threads=4)


def test_scan_is_associative(monkeypatch):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab'sre  \n1!") for _ in range(rng.randint(0, 60))) for _ in range(200)]
    whole = ids(texts)
    for block in (2, 3, 7):
        monkeypatch.setattr(bytebpe, "BLOCK", block)
        assert ids(texts) == whole


def test_long_slices_and_cuts(monkeypatch):
    rng = random.Random(3)
    for word in ("a" * 5000, "ab" * 2000 + "xyz" * 900, "".join(rng.choice("etaoin") for _ in range(4000)), "漢" * 900):
        assert ids([word]) == [LIBRARY.encode_ordinary(word)]
    monkeypatch.setattr(bytebpe, "TOGETHER", 50)
    for _ in range(300):
        text = "".join(rng.choice("ab'sre   \n1!") for _ in range(400))
        assert "".join(bytebpe._cuts(text)) == text
        assert sum(ids(bytebpe._cuts(text)), []) == LIBRARY.encode_ordinary(text)
    assert bytebpe._cuts("  " * 200) == ["  " * 200]


def test_frames(spark):
    texts = [None, "", " ", "it's  the\n\n end ", "é漢\U0001f600 x" * 300, "dup", "dup", "word " * 30000]
    df = spark.createDataFrame([(i, t, [1], "x") for i, t in enumerate(texts)], "doc_id long, text string, ids array<int>, decoded_ string")
    rows = decode(encode(df, TOKENS), TOKENS).orderBy("doc_id").collect()
    assert [r.ids_ for r in rows] == [None if t is None else LIBRARY.encode_ordinary(t) for t in texts]
    assert [r.decoded_ for r in rows] == [None if t is None else t.encode() for t in texts]
    assert all(r.ids == [1] for r in rows)
    for r in rows:
        if r.text:
            assert r.offsets_ == np.cumsum([0, *(len(TOKENS[i]) for i in r.ids_)])[:-1].tolist()
    assert encode(df.limit(0), TOKENS).count() == 0


def test_spans(spark):
    text = "the quick brown föx, it's 漢 done"
    spans = [(a, b) for a in range(-1, 40, 3) for b in range(0, 45, 4)]
    df = spark.createDataFrame([(text, a, b) for a, b in spans] + [(None, 0, 1), ("", 0, 1), (text, None, 2)], "text string, a int, b int")
    got = [r.decoded_ for r in decode_span(encode(df, TOKENS), TOKENS, "a", "b").collect()]
    assert got == [text.encode()[max(a, 0) : max(b, max(a, 0))] for a, b in spans] + [None, b"", None]


def test_query(spark, tmp_path):
    texts = {1: "don't  stop\n", 2: None, 3: "", 4: "föö 12 " * 50}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for r in op13_byte_bpe(spark, str(tmp_path)).collect():
        expected = LIBRARY.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(expected)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, expected)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_a_vocabulary_without_all_bytes_is_refused():
    with pytest.raises(ValueError):
        Ranks([b"a"])
