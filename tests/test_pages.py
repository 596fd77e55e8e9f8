"""Page parser, selectors and extractors."""

import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from waymark.operators.detail_pages import EXTRACTORS, address_of, blocks, detail_fields, list_entries
from waymark.sources.html import RAW_TEXT, TEXT, VOID, attribute, parse, select, step_test, text_of, with_nodes, written_chars


class Tree(HTMLParser):
    """The same tree by the standard library's events."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes, self.stack = [], []

    def add(self, tag, attrs, text):
        if tag == TEXT and self.nodes and self.nodes[-1][0] == TEXT and self.nodes[-1][1] == (self.stack[-1] if self.stack else -1):
            self.nodes[-1][3] += text
            return
        self.nodes.append([tag, self.stack[-1] if self.stack else -1, attrs, text])

    def handle_starttag(self, tag, attrs):
        self.add(tag, {k: v or "" for k, v in attrs}, None)
        if tag not in VOID:
            self.stack.append(len(self.nodes) - 1)

    def handle_startendtag(self, tag, attrs):
        self.add(tag, {k: v or "" for k, v in attrs}, None)

    def handle_endtag(self, tag):
        names = [self.nodes[i][0] for i in self.stack]
        if tag in names:
            del self.stack[len(names) - 1 - names[::-1].index(tag) :]

    def handle_data(self, data):
        raw = self.stack and self.nodes[self.stack[-1]][0] in ("script", "style")
        self.add(RAW_TEXT if raw else TEXT, {}, data)


def random_page(rng):
    parts = []
    for _ in range(rng.randint(0, 40)):
        tag = rng.choice(["div", "p", "b", "ul", "li", "a", "br", "img"])
        parts.append(rng.choice([
            f"<{tag}>", f"</{tag}>", f'<{tag} class="x y{rng.randint(0, 3)}" id=n{rng.randint(0, 9)}>', f"<{tag} data-a='1 > 2' hidden>", "text &amp; more", " é漢 ", "\n",
            "<script>if (a < b) { '</p>' }</script>", "<br/>",
        ]))
    return "".join(parts)


def test_parser_equals_the_standard_library_s_events():
    rng = random.Random(1)
    for _ in range(400):
        text = random_page(rng)
        tree = Tree()
        tree.feed(text)
        tree.close()
        got = parse(text)
        merged = []
        for last, parent, _depth, tag, attrs, words in got:
            if merged and tag == TEXT and merged[-1][0] == TEXT and merged[-1][1] == parent:
                merged[-1][3] += words
            else:
                merged.append([tag, parent, attrs, words])
        if len(merged) == len(got):
            assert merged == tree.nodes, text
        else:
            assert [(m[0], m[3]) for m in merged] == [(m[0], m[3]) for m in tree.nodes], text


def test_numbering():
    rng = random.Random(2)
    for _ in range(200):
        nodes = parse(random_page(rng))
        for i, (last, parent, depth, *_rest) in enumerate(nodes):
            below = {i}
            for j in range(i + 1, len(nodes)):
                if nodes[j][1] in below:
                    below.add(j)
            assert max(below) == last and below == set(range(i, last + 1))
            assert depth == (nodes[parent][2] + 1 if parent >= 0 else 0)


def test_broken_pages():
    assert parse("") == [] and [n[3] for n in parse("a < b")] == [TEXT] and "".join(n[5] for n in parse("a < b")) == "a < b"
    assert [n[3] for n in parse("<p>x<!-- <b>no</b> --><!DOCTYPE y></div>z")] == ["p", TEXT, TEXT]
    assert [n[3] for n in parse("<script>never ended <p>")] == ["script", RAW_TEXT]
    assert [n[3] for n in parse("<!-- never ended <p>")] == []
    assert parse("<A HREF=x Class='q  r'>")[0][3:5] == ["a", {"href": "x", "class": "q  r"}]


def test_selectors(spark):
    html = '<nav><ul><li><a href="/1">one <b>x</b></a></li><li><a>two</a></li></ul></nav><div class="ad big"><a href="/3"> three </a></div><div class="menu-item">m</div>'
    df = spark.createDataFrame([(1, html, "keep"), (2, None, "k"), (3, "", "k")], "page_id long, html string, Nodes string")
    pages = with_nodes(df.select("page_id", "html"))
    n = F.col("nodes")

    def found(selector):
        row = pages.where("page_id = 1").select(F.transform(select(n, selector), lambda a: text_of(n, a)).alias("t")).first()
        return row.t

    assert found("nav li a") == ["onex", "two"] and found("a[href]") == ["onex", "three"] and found("div.ad a") == ["three"] and found("div~menu|nothing") == ["m"]
    assert found("nav nav") == [] and found("* b") == ["x"] and found(".big") == ["three"] and found("p") == []
    hrefs = pages.where("page_id = 1").select(F.transform(select(n, "a"), lambda a: attribute(a, "href")).alias("h")).first().h
    assert hrefs == ["/1", None, "/3"]
    rows = {r.page_id: r for r in pages.select("page_id", F.size("nodes").alias("size"), n.isNull().alias("none")).collect()}
    assert rows[2].none and rows[3].size == 0
    assert with_nodes(df.limit(0)).count() == 0
    assert set(with_nodes(df).columns) == {"page_id", "nodes"}
    for bad in ("", "a:b", "a..b"):
        with pytest.raises(ValueError):
            step_test(bad)


GOOD = """<p>메뉴정보</p><ul><li><p>삼겹살 추천</p><p>12,000원</p></li><li><p>물</p><p>0원</p></li></ul><ul><li>영업시간: 11:00 - 22:00 라스트오더: 21:00</li></ul><img src="https://i/1">
<p class="desc">오래된 고기 무한리필 식당입니다</p><script>"latitude": 37.5, "longitude": 127.0</script><a href="/list.dc?query=a">서울</a><a href="/list.dc?query=a">강남구</a> 02-123-4567
성인 고기 무한리필 12,900원"""


def test_one_failure_spoils_one_field(spark):
    broken = {
        "menu": ("12,000원", ",원"),
        "hours": ("11:00 - 22:00", "31:00 - 22:70"),
        "images": ("https://i/1", "data:x"),
        "review": ("오래된 고기 무한리필 식당입니다", "짧다"),
        "coordinates": ("37.5", "17.5"),
        "address": (">서울</a><a href=\"/list.dc?query=a\">강남구", ">맛집</a><a href=\"/list.dc?query=a\">추천"),
        "refill": ("12,900원", "900원"),
    }
    rows = [("good", GOOD), ("empty", ""), ("none", None)] + [(k, GOOD.replace(*v)) for k, v in broken.items()]
    out = {r.page_id: r for r in detail_fields(spark.createDataFrame(rows, "page_id string, html string")).collect()}
    good = out["good"]
    assert good.errors == [] and good.menu.value[0].name == "삼겹살 추천" and [m.price_numeric for m in good.menu.value] == [12000, 0] and good.address.value == "서울 강남구"
    assert good.hours.value.last_order == "21:00" and good.contact.value.phone == "02-123-4567" and good.refill.value["items"][0].price == 12900
    for name in broken:
        row = out[name]
        assert [e.split(":")[0] for e in row.errors] == [name], (name, row.errors)
        for other in EXTRACTORS:
            if other not in (name, "price"):
                assert row[other].error is None
                if not (name == "review" and other == "refill"):
                    assert row[other].value == good[other].value, (name, other)
    assert out["empty"].errors == [] and out["none"].errors == [] and out["none"].menu.value is None


def test_addresses(spark):
    cases = [
        (["서울특별시", "강남구", "테헤란로", "12번지"], "서울특별시 강남구 테헤란로 12번지"), (["강남구", "서울", "역삼동"], "서울 강남구 역삼동"), (["12번지"], ""), ([], ""),
        (["마포구", "마포구 합정동"], "마포구 마포구 합정동"), (["경기도 부천시", "경기도"], "경기도 부천시"), (["시장길", "3길"], "시장길 3길"),
    ]
    df = spark.createDataFrame([(p, a) for p, a in cases], "parts array<string>, want string")
    for r in df.select("parts", "want", address_of(F.col("parts")).alias("got")).collect():
        assert r.got == r.want, r


def test_lists(spark):
    text = '{"poi_section":{"list":[{"v_rid":"1","nm":"a","lat":1.5},{"v_rid":"","nm":"b"},{"nm":"c"},{"v_rid":"2","nm":" "}]}}'
    df = spark.createDataFrame([(text,), ("no json",), (None,), ("{}",)], "j string")
    got = [r.e for r in df.select(list_entries(F.col("j"), F.lit("k"), F.lit("r")).alias("e")).collect()]
    assert len(got[0]) == 1 and len(got[0][0]) == 19 and got[0][0].review_count == 0 and got[0][0].lat == 1.5 and got[1:] == [None, None, None]
    html = '<a class="PoiBlock" href="?rid=7&x" data-lat="1" data-lng="z"><h2>3. n</h2><p class="Score"><span>8</span></p></a><a class="PoiBlock"><h2>x</h2></a>'
    row = with_nodes(spark.createDataFrame([(html,)], "html string")).select(blocks(F.col("nodes")).alias("b")).first().b
    assert len(row) == 1 and (row[0].place_id, row[0].name, row[0].lat, row[0].lng, row[0].score, row[0].rating) == ("7", "n", None, None, 8, None)


def test_written_characters_are_those_of_the_page(spark):
    article = "<h1>a &amp;&am</h1><p>&lt;b> &quot;<br>R&D &#39;<script>var x = 1;</script><!-- no --></p>"
    df = spark.createDataFrame([(1, f"<html>&amp;<article>{article}</article>x</html>"), (2, "<p>x</p>"), (3, None)], "page_id int, html string")
    nodes = F.col("nodes")
    chars = written_chars(nodes, F.get(select(nodes, "article"), F.lit(0)))
    got = {r.page_id: r.n for r in with_nodes(df).select("page_id", chars.alias("n")).collect()}
    assert got == {1: len("a &amp;&am" "&lt;b> &quot;" "R&D &#39;"), 2: 0, 3: None}
