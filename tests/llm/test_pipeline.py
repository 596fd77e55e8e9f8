import random


from waymark.llm.pieces import Codec, read_model
from waymark.llm.queries import tokenizer_path

from . import test_decontaminate as decon
from . import test_lines as lines
from . import test_simhash as simhash


def test_pipeline_against_brute_force(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(11)
    vocab = {"en": "the of and ing tion her was is that with".split(), "de": "der die und ich sch ung ein nicht mit von".split()}
    item = " ".join(rng.choice(vocab["en"]) for _ in range(40))
    docs = []
    for i in range(90):
        lang = rng.choice(["en", "de"])
        text = "\n".join(" ".join(rng.choice(vocab[lang]) for _ in range(rng.randint(4, 25))) for _ in range(rng.randint(1, 6)))
        docs.append((i, text, lang, "s", len(text)))
    docs += [(200 + i, docs[i][1], docs[i][2], None, 1) for i in range(5)]
    docs += [(300, docs[7][1] + " der", "de", "s", 0), (301, docs[8][1] + " " + item, "en", "s", 0), (302, item, None, "s", 0)]
    docs += [(400, None, "en", "s", None), (401, "", "en", "s", 0), (402, "12 34", "de", "s", 5), (403, "1 2\nder die", "de", "s", 5)]
    docs += [(5, docs[5][1], docs[5][2], "s", 1), (None, docs[6][1], "en", "s", 1), (None, "der die und ich und der von mit", None, "s", 1)]
    docs += [(500 + i, f"der die und\n{docs[i][1]}\nreleased under version {i} of the licence", "de", "s", 1) for i in range(10)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "token_ids"]

    kept = [(d, t) for d, t, *_ in docs if t and any(c.isalpha() for c in t)]
    kept = lines.brute(kept)
    groups = {}
    for (d, t), (_, p, c) in zip(kept, simhash.brute_groups([(d, simhash.brute_print(t)) for d, t in kept]), strict=True):
        groups.setdefault((c, p if c is None else 0), []).append((d is None, d or 0, lines.signed(t), (d, t)))
    kept = [min(g, key=lambda x: x[:3])[3] for g in groups.values()]
    kept = [(d, t) for d, t, *_ in (decon.brute([x], [(1, item)])[0][:1] + (x[1],) for x in kept if not decon.brute([x], [(1, item)])[0][4])]
    codec = Codec(read_model(tokenizer_path()))
    import numpy as np

    want = sorted(((d, t, len(t), np.frombuffer(codec.encode(t), "<i4").tolist()) for d, t in kept), key=repr)
    assert sorted(((r.doc_id, r.text, r.n_chars, r.token_ids) for r in out.collect()), key=repr) == want


def test_empty_tables(spark, tmp_path):
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "lines", "near_duplicates", "benchmark", "tokens"]


CLASHES = ["has_letter_", "token_ids", "id__", "row__", "lang_pred_", "lang_score_", "ids_", "spans_", "Lines_In_", "lines_out_", "id_", "row_", "text_", "key", "print", "root", "word"]


def test_columns_that_clash_pass_unchanged(spark, tmp_path):
    import corpus_pipeline

    texts = {1: "the of and ing is that\nlicence one", 2: "der die und ich sch\nlicence one", 3: "her was with that the\nlicence one", 4: None, 5: "1 2"}
    columns = ", ".join(f"{c} int" for c in CLASHES)
    rows = [(i, t, "en" if i % 2 else "de", "s", 1, *range(i, i + len(CLASHES))) for i, t in texts.items()]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {columns}")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "no such words here")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == docs.columns, name
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == [*docs.columns, "token_ids_"]
    got = {r.doc_id: r for r in out.collect()}
    assert sorted(got) == [1, 2, 3]
    for i, r in got.items():
        assert [r[c] for c in CLASHES] == list(range(i, i + len(CLASHES)))
