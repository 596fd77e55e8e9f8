import itertools
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from waymark.llm.pieces import BPE, BYTE, NORMAL, UNIGRAM, UNKNOWN, Codec, PieceModel, decode, encode, read_model
from waymark.llm.queries import tokenizer_path

sentencepiece = pytest.importorskip("sentencepiece")
MODEL = read_model(tokenizer_path())
CODEC = Codec(MODEL)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())


def ids(codec, text):
    import numpy as np

    return np.frombuffer(codec.encode(text), "<i4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from("abcdeinorst  \n.xX10é漢_-"), st.characters(exclude_categories=["Cs"])), max_size=80))
def test_bpe_ids_equal_the_merge_procedure(text):
    assert CODEC.decode(ids(CODEC, text)) == text
    if "▁" not in text and "\0" not in text:
        assert ids(CODEC, text) == LIBRARY.encode(text)


def test_bpe_on_long_runs_and_words():
    rng = random.Random(0)
    words = ["the", "tion", "ing", "über", "ção", "x" * 9, "1234567", "....", "漢字", "--->", "http://a.b/c"]
    for _ in range(300):
        text = rng.choice(["", " ", "  ", "\n"]).join(rng.choice(words) for _ in range(30))
        assert ids(CODEC, text) == LIBRARY.encode(text) and CODEC.decode(ids(CODEC, text)) == text
    assert ids(CODEC, "a" * 3000) == LIBRARY.encode("a" * 3000)


def test_long_runs_that_no_piece_joins(spark):
    texts = ["\U0001f600" * 5000, "".join(chr(0x4E00 + i) for i in range(5000)), "\u1200" * 5000 + "the", "ab" + "\U0001f600漢" * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = decode(encode(df, MODEL), MODEL).orderBy("doc_id").collect()
    assert [r.decoded_ for r in rows] == texts
    assert [r.ids_ for r in rows] == [LIBRARY.encode(t) for t in texts]


def test_unigram_viterbi_against_every_segmentation():
    rng = random.Random(1)
    pieces = ["".join(p) for n in (1, 2, 3) for p in itertools.product("ab▁", repeat=n) if rng.random() < 0.6 or n == 1]
    model = PieceModel(["<unk>", *pieces], [0.0, *[-rng.random() * len(p) for p in pieces]], [UNKNOWN] + [NORMAL] * len(pieces), UNIGRAM, False)
    model = PieceModel(model.pieces + [f"<0x{b:02X}>" for b in range(256)], model.scores + [0.0] * 256, model.types + [BYTE] * 256, UNIGRAM, False)
    codec, score = Codec(model), dict(zip(model.pieces, model.scores, strict=True))

    def best(text):
        if not text:
            return 0.0
        return max(score[text[:n]] + best(text[n:]) for n in (1, 2, 3) if text[:n] in score and len(text) >= n)

    for _ in range(60):
        text = "".join(rng.choice("ab ") for _ in range(10))
        got = ids(codec, text)
        assert codec.decode(got) == text
        assert abs(sum(model.scores[i] for i in got) - best(text.replace(" ", "▁"))) < 1e-9
    assert codec.decode(ids(codec, "aéb▁a")) == "aéb▁a"


def test_frames(spark):
    texts = [None, "", " ", "Hello  world\n ab\t漢 é  ", "x " * 20000, "dup", "dup"]
    df = spark.createDataFrame([(i, t, [1]) for i, t in enumerate(texts)], "doc_id long, text string, ids array<int>")
    rows = decode(encode(df, MODEL), MODEL).orderBy("doc_id").collect()
    assert [r.decoded_ for r in rows] == texts
    assert [r.ids_ for r in rows] == [None if t is None else LIBRARY.encode(t) for t in texts]
    assert encode(df.limit(0), MODEL).count() == 0 and MODEL.kind == BPE
