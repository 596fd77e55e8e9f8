"""The registered queries themselves, over the given documents, against plain recounts of their digest columns."""

import hashlib
import os
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from waymark.llm.queries import QUERIES

from . import test_lines as lines
from . import test_secrets as secrets
from . import test_simhash as simhash
from .test_neighbours import brute

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def documents():
    return {r["doc_id"]: r for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}


def run(spark, name):
    return QUERIES[name](spark, SF).collect()


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_every_query_is_named_for_its_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_op2(spark, documents):
    sentencepiece = pytest.importorskip("sentencepiece")
    from waymark.llm.queries import tokenizer_path

    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    rows = run(spark, "op2_sentencepiece")
    assert len(rows) == len(documents)
    for r in rows:
        ids = library.encode(documents[r.doc_id]["text"])
        assert (r.n_pieces, r.ids_sha256, r.exact) == (len(ids), sha(",".join(map(str, ids))), True)
        assert r.decoded_sha256 == sha(documents[r.doc_id]["text"])


def test_op3(spark, documents):
    known = {d["lang"] for d in documents.values() if d["lang"] and not fold(d["doc_id"])}
    rows = run(spark, "op3_language")
    assert len(rows) == len(documents) and all(r.held_out == fold(r.doc_id) and r.lang_pred in known | {"und"} and 0 <= r.score <= 1 for r in rows)
    judged = [r for r in rows if r.held_out and documents[r.doc_id]["lang"]]
    assert sum(r.lang_pred == documents[r.doc_id]["lang"] for r in judged) >= 0.9 * len(judged)


def test_op4(spark, documents):
    for r in run(spark, "op4_secrets"):
        spans = secrets.base(documents[r.doc_id]["text"])
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[0] == k for s in spans) for k in ("assign", "access", "hex")]
        assert r.base_sha256 == sha(",".join(f"{k}:{s}:{e}" for k, s, e in spans))
        told = [tuple(s.rsplit(":", 2)) for s in r.spans.split(",") if s]
        assert {(k, str(s), str(e)) for k, s, e in spans} <= set(told)


def test_op5(spark, documents):
    rows = run(spark, "op5_toxicity")
    assert len(rows) == len(documents) and {r.doc_id for r in rows} == set(documents)
    assert all(r.held_out == fold(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_op7(spark, documents):
    prints = [(d, simhash.brute_print(x["text"])) for d, x in documents.items()]
    want = {d: (f"{p % 2**64:016x}", c) for d, p, c in simhash.brute_groups(prints)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in run(spark, "op7_simhash")} == want


def test_op8(spark, documents):
    kept = dict(lines.brute([(d, x["text"]) for d, x in documents.items()]))
    for r in run(spark, "op8_lines"):
        text = documents[r.doc_id]["text"]
        assert r.n_lines == text.count("\n") + 1 and r.text_sha256 == sha(kept[r.doc_id])
        assert r.n_kept <= r.n_lines


def test_op9(spark, documents):
    rows = run(spark, "op9_passages")
    assert len(rows) == len(documents)
    same = {}
    for d, x in documents.items():
        if len(x["text"].split()) >= 50:
            same.setdefault(x["text"], []).append(d)
    found = {r.doc_id: r for r in rows}
    for copies in same.values():
        assert len({found[d].class_id for d in copies}) == 1 and all(found[d].repeated for d in copies if len(copies) > 1)
    members = {}
    for r in rows:
        members.setdefault(r.class_id, set()).add(r.doc_id)
        assert r.repeated or r.class_id == r.doc_id
    assert all(min(m) == c for c, m in members.items())


def test_op10(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in pq.read_table(f"{SF}/embeddings.parquet").to_pylist()]
    want, got = brute(rows, 10), {}
    for r in sorted(run(spark, "op10_neighbours")):
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == set(want)
    vector = {i: np.array(v, np.float64) for i, v in rows if v}
    for q, near in got.items():
        assert [n[0] for n in near] == list(range(1, len(want[q]) + 1))
        assert all(abs(s - float(np.sqrt(((vector[q] - vector[i]) ** 2).sum()))) < 1e-12 for _, i, s in near)
    assert sum(len({i for _, i, _ in got[q]} & {i for _, i in want[q]}) for q in want) >= 0.9 * sum(map(len, want.values()))
