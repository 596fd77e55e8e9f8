import random
import re

from waymark.llm.secrets import KINDS, find_secrets, scan

ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(KINDS[k], s, e) for s, k, e in sorted(found)]


def test_base_spans_against_plain_patterns():
    rng = random.Random(6)
    bits = ["password", "PassWd", "ſecret", "secret", "toKen", "api_key", "apiKey", "=", ":", " ", '"', "'", "AKIA", "AKIAX" + "A1" * 6, "0af" * 12, "abcdefgh", "é", "漢", "\n", "-", "x", "=="]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.choice([3, 8, 20])))
        assert [s for s in scan(text.encode()) if s[0] in KINDS[:3]] == base(text), text


def test_weak_parts_need_a_complement():
    def kinds(t):
        return [k for k, _, _ in scan(t.encode())]

    assert kinds("see https://example.com/x for more, user = bob") == []
    assert kinds("pwd = hunter22") == []
    assert kinds("user = bob é pwd = hunter22") == ["identifier", "value"]
    assert kinds("pwd: hunter22 at https://db.example.com:5432") == ["value", "endpoint"]
    assert kinds("user = bob" + " x" * 200 + " pwd = hunter22") == []
    assert kinds("AKIA" + "A" * 16 + " access_key = q1w2e3r4") == ["access", "value"]
    spans = scan("é user = bob, pwd = hunter22".encode())
    assert spans == [("identifier", 2, 12), ("value", 14, 28)]


def test_weak_parts_with_prefixes_short_values_and_wide_characters():
    def kinds(t):
        return [k for k, _, _ in scan(t.encode())]

    assert kinds("aws_access_key_id = AKIA" + "A" * 16 + "\naws_secret_access_key = wJalrXUtnFEMI/K7MDENG") == ["access", "value"]
    assert kinds("DB_USER=bob\nDB_HOST=db.example.com\ndb_pwd=q1w2e3r4") == ["identifier", "endpoint", "value"]
    assert kinds("user=bob AccessKey: q1w2e3r4") == kinds("user=bob privatekey=q1w2e3r4") == ["identifier", "value"]
    assert kinds("username=bob password=hunter2") == ["identifier", "value"]
    assert kinds("password=hunter2") == [] and kinds("superuser=bob password=hunter2") == []
    assert kinds("user = bob " + "漢" * 150 + " pwd = hunter22") == ["identifier", "value"]
    assert kinds("user = bob " + "漢" * 250 + " pwd = hunter22") == []


def test_frames(spark):
    texts = [None, "", "token = abcdefgh1", "token = abcdefgh1", "é " * 5000 + "0" * 40, "user=bob pwd=abcdefgh " * 20000]
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, kind string")
    rows = {r.doc_id: [tuple(s) for s in r.spans_] for r in find_secrets(df).collect()}
    assert rows[0] == rows[1] == [] and rows[2] == rows[3] == [("assign", 0, 17)] and rows[4] == [("hex", 10000, 10040)]
    assert len(rows[5]) == 40000
    assert find_secrets(df.limit(0)).count() == 0
