"""Pages as numbered elements: a tag-stack parser, and selectors, texts and attributes as column expressions.

The parser numbers elements and texts of a page in the order in which they begin. `last` is the greatest number inside
an element, so what lies inside is an interval test on numbers, and descendant selectors (`nav li a`) are interval
joins of the page's nodes with themselves. A page is one row and its nodes one array, so selecting shuffles nothing and
stays in the JVM; `explode` the array for a table of elements.

What the parser does: a closing tag ends the innermost open element of its name and all inside it, one without an open
element is ignored; what is still open at the end ends there; opening tags close nothing; void elements are empty.
Texts of script and style are raw (`#raw`, no entities, no part of an element's text), other texts are `#text`, with
entities resolved. Comments and declarations are left out. Attribute names are in lower case, of two the later counts.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.functions.columns import let

#: Elements without content, and those whose content is no markup.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style")
TEXT, RAW_TEXT = "#text", "#raw"
NODE = "pre:int,last:int,parent:int,depth:int,tag:string,attrs:map<string,string>,classes:array<string>,text:string,written:int"
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.IGNORECASE) for tag in RAW}


def parse(page: str, written: list[int] | None = None) -> list[list]:
    """Nodes [last, parent, depth, tag, attributes, text] of a page; a node's number is its place. The parent of a root is -1.
    written receives the number of characters of each node's text as it stands in the page, entities unresolved."""
    nodes: list[list] = []
    stack: list[int] = []

    def add(tag: str, attributes: dict[str, str], text: str | None, size: int = 0) -> None:
        nodes.append([len(nodes), stack[-1] if stack else -1, len(stack), tag, attributes, text])
        if written is not None:
            written.append(size)

    def close(depth: int) -> None:
        for i in stack[depth:]:
            nodes[i][0] = len(nodes) - 1
        del stack[depth:]

    at = 0
    while at < len(page):
        found = TAG.search(page, at)
        start = found.start() if found else len(page)
        if start > at:
            add(TEXT, {}, entities.unescape(page[at:start]), start - at)
        if not found:
            break
        at = found.end()
        if not found[2]:
            continue
        tag = found[2].lower()
        if found[1]:
            open_ = next((k for k in range(len(stack) - 1, -1, -1) if nodes[stack[k]][3] == tag), None)
            if open_ is not None:
                close(open_)
            continue
        add(tag, {a[1].lower(): entities.unescape(a[2] or a[3] or a[4] or "") for a in ATTRIBUTE.finditer(found[3])}, None)
        if tag in RAW:
            end = RAW_END[tag].search(page, at)
            stop = end.start() if end else len(page)
            stack.append(len(nodes) - 1)
            if stop > at:
                add(RAW_TEXT, {}, page[at:stop], stop - at)
            close(len(stack) - 1)
            at = end.end() if end else len(page)
        elif tag not in VOID and not found[3].rstrip().endswith("/"):
            stack.append(len(nodes) - 1)
    close(0)
    return nodes


def _strings(lists: list[list[str]]) -> tuple[pa.Array, pa.Array]:
    return pa.array(np.cumsum([0, *map(len, lists)]), pa.int32()), pa.array([x for each in lists for x in each], pa.string())


def _column(pages: list[str | None]) -> pa.Array:
    """The nodes of all pages as one Arrow list of structs."""
    written: list[int] = []
    parsed = [parse(p, written) if p else [] for p in pages]
    flat = [node for page in parsed for node in page]
    numbers = [pa.array([node[i] for node in flat], pa.int32()) for i in (0, 1, 2)]
    pre = pa.array([i for page in parsed for i in range(len(page))], pa.int32())
    starts, keys = _strings([list(node[4]) for node in flat])
    attributes = pa.MapArray.from_arrays(starts, keys, _strings([list(node[4].values()) for node in flat])[1])
    classes = pa.ListArray.from_arrays(*_strings([node[4].get("class", "").split() for node in flat]))
    fields = [pre, *numbers, pa.array([node[3] for node in flat], pa.string()), attributes, classes, pa.array([node[5] for node in flat], pa.string()), pa.array(written, pa.int32())]
    struct = pa.StructArray.from_arrays(fields, [f.split(":")[0] for f in re.split(r",(?![^<]*>)", NODE)])
    offsets = pa.array(np.cumsum([0, *map(len, parsed)]), pa.int32())
    return pa.ListArray.from_arrays(offsets, struct, mask=pa.array([p is None for p in pages], pa.bool_()))


def with_nodes(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages with the column `nodes` in place of the text. Null pages have null nodes, empty ones none."""
    pages = pages.drop("nodes") if html != "nodes" else pages
    kept = [f for f in pages.schema.fields if f.name != html]
    names = [f.name for f in kept]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), _column(part.column(html).to_pylist())], [*names, "nodes"])

    return pages.mapInArrow(run, T.StructType([*kept, T.StructField("nodes", T._parse_datatype_string(f"array<struct<{NODE}>>"))]))


def step_test(step: str) -> Callable[[Column], Column]:
    """Test of one step: `tag`, `.class`, `tag.class`, `[attribute]`, `tag~part` (a class that holds one of a|b|c); `*` is any element."""
    found = re.fullmatch(r"([\w#*]*)(?:\.([\w-]+))?(?:~([\w|-]+))?(?:\[([\w-]+)\])?", step)
    if not found or not step:
        raise ValueError(f"not a selector step: {step!r}")
    tag, name, part, attribute = found.groups()

    def test(node: Column) -> Column:
        out = node["tag"] == tag if tag and tag != "*" else ~node["tag"].startswith("#")
        if name:
            out = out & F.array_contains(node["classes"], name)
        if part:
            out = out & F.exists(node["classes"], lambda c: c.rlike(part))
        if attribute:
            out = out & F.map_contains_key(node["attrs"], attribute)
        return out

    return test


def within_node(node: Column, outer: Column) -> Column:
    """Whether a node lies inside another one of its page."""
    return (node["pre"] > outer["pre"]) & (node["pre"] <= outer["last"])


def select(nodes: Column, selector: str, inside: Column | None = None) -> Column:
    """Elements in the order of the page that a selector finds: steps apart by spaces, each inside one found for the step before."""

    def follow(outer: Column | None, steps: list[str]) -> Column:
        test = step_test(steps[0])
        if outer is None:
            found = F.filter(nodes, test)
        else:
            found = F.filter(nodes, lambda n: test(n) & F.exists(outer, lambda o: within_node(n, o)))
        return let(found, lambda f: follow(f, steps[1:])) if len(steps) > 1 else found

    return follow(None if inside is None else F.array(inside), selector.split())


def children(nodes: Column, outer: Column, tag: str) -> Column:
    """Elements of a tag right below an element."""
    return F.filter(nodes, lambda n: (n["parent"] == outer["pre"]) & (n["tag"] == tag))


def text_of(nodes: Column, outer: Column, strip: bool = True) -> Column:
    """All text inside an element; strip: each piece without white space around it."""
    pieces = F.transform(F.filter(nodes, lambda n: (n["tag"] == TEXT) & within_node(n, outer)), lambda n: n["text"])
    return F.array_join(F.transform(pieces, lambda p: F.regexp_replace(p, r"^\s+|\s+$", "")) if strip else pieces, "")


def written_chars(nodes: Column, outer: Column) -> Column:
    """Characters of all text inside an element as the page writes them, entities unresolved."""
    inside = F.filter(nodes, lambda n: (n["tag"] == TEXT) & within_node(n, outer))
    return F.aggregate(inside, F.lit(0).cast("long"), lambda sum_, n: sum_ + n["written"])


def page_text(nodes: Column) -> Column:
    """All text of a page."""
    return F.array_join(F.transform(F.filter(nodes, lambda n: n["tag"] == TEXT), lambda n: n["text"]), "")


def scripts(nodes: Column) -> Column:
    """Raw texts of scripts and styles, a line apart."""
    return F.array_join(F.transform(F.filter(nodes, lambda n: n["tag"] == RAW_TEXT), lambda n: n["text"]), "\n")


def attribute(node: Column, name: str) -> Column:
    return F.try_element_at(node["attrs"], F.lit(name))
