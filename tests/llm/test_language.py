import random

from waymark.llm.language import count_phrases, identify, parsers, predict, training_sample


def brute_phrases(text, sample, known):
    text = [c if c in known else None for c in text]
    i = n = 0
    while i < len(text):
        j = i
        while j < len(text) and None not in text[i : j + 1] and "".join(text[i : j + 1]) in sample:
            j += 1
        i, n = max(j, i + 1), n + 1
    return n


def test_phrase_counts_against_brute_force():
    rng = random.Random(4)
    samples = (("a", "".join(rng.choice("abcd") for _ in range(300))), ("b", "".join(rng.choice("abxyé") for _ in range(200))))
    class_of, tables, _ = parsers(samples)
    texts = ["".join(rng.choice("abcdxyé?漢") for _ in range(rng.choice([1, 2, 50, 900]))) for _ in range(60)]
    got = count_phrases(texts, class_of, tables)
    for t, row in zip(texts, got.tolist(), strict=True):
        assert row == [brute_phrases(t, s, set(s)) for _, s in samples]


def test_large_alphabets_count_every_character():
    rng = random.Random(8)
    han, hangul = [chr(0x4E00 + i) for i in range(3000)], [chr(0xAC00 + i) for i in range(2500)]
    samples = tuple((n, "".join(rng.choice(letters) if rng.random() < 0.7 else letters[0] for _ in range(4000))) for n, letters in (("ko", hangul), ("zh", han)))
    class_of, tables, _ = parsers(samples)
    texts = [s[i : i + 200] + rng.choice("x漢") for _, s in samples for i in range(0, 3000, 700)]
    got = count_phrases(texts, class_of, tables)
    for t, row in zip(texts, got.tolist(), strict=True):
        assert row == [brute_phrases(t, s, set(s)) for _, s in samples]
    assert sum(t.owner.nbytes + t.target.nbytes + t.base.nbytes for t in tables) < 2_000_000
    rare = ["".join(rng.choice(letters[-500:]) for _ in range(60)) for letters in (hangul, han)]
    assert predict(rare, [True, True], samples)[0] == ["ko", "zh"]


def test_edges():
    assert predict([None, "", "12 !", "ab"], [False, False, False, True], ()) == (["und"] * 4, [0.0] * 4)
    labels, scores = predict(["abab" * 20_000, "xyx", "12"], [True, True, False], (("a", "abab"), ("b", "xyxy")))
    assert labels == ["a", "b", "und"] and scores[2] == 0 and all(0 <= s <= 1 for s in scores)


def test_held_out_accuracy_and_columns(spark):
    rng = random.Random(2)
    vocab = {"en": ["the", "of", "and", "ing", "tion", "her"], "de": ["der", "und", "ich", "sch", "ung"], "fr": ["le", "et", "eau", "que", "oi"]}
    rows = [(i, " ".join(rng.choice(vocab[lang]) for _ in range(40)), lang, i) for i, lang in enumerate(rng.choices(list(vocab), k=300))]
    rows += [(1000, None, "en", 1), (1001, "...", "de", 1), (None, "the of and the", None, 1), (5, rows[5][1], rows[5][2], 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    out = identify(df, training_sample(df, "doc_id", "text", "lang"))
    assert out.columns == [*df.columns, "lang_pred_", "lang_score_"]
    got = out.collect()
    assert len(got) == len(rows)
    assert all(r.lang_pred_ == r.lang for r in got if r.doc_id is not None and r.doc_id < 1000)
    assert {r.lang_pred_ for r in got if r.doc_id in (1000, 1001)} == {"und"}
    assert identify(df.limit(0), {}).count() == 0
