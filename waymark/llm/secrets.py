"""Secret scans with multipart credential linking.

Strong spans stand by themselves: keyword assignments (weak secrets if their value is too short), access identifiers and long hexadecimal runs. Weak parts
(identifiers, secrets and endpoints that are common in harmless text) are reported only if a complementary part
lies within the same scope, `reach` code points between their ends:

* a weak secret needs an identifier or an endpoint,
* a weak identifier and an endpoint need a secret, weak or strong.

Linking is an interval join per text: the parts of each role are sorted, and a part looks up its nearest
neighbour on either side, so a text with n parts costs n log n and no pairs are built.

Patterns run over UTF-8 bytes (they match ASCII only); offsets are turned into code points before parts are linked. Defined results: null texts are empty; spans are ordered by start, then kind in the order of `KINDS`;
repeated rows are kept; a span that two rules find is listed once; an empty table gives an empty one; other columns pass
unchanged, but for one named `spans_`, which is replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import append_columns

#: The patterns of strong spans, and the least length of what counts.
ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([a-z0-9+/_.=-]+)")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{32,}")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16
KEYWORDS = (b"passw", b"secret", b"token", b"apikey", b"api_key")
#: Weak parts, on lower-cased bytes: kind, what must occur at all, pattern.
WEAK = (
    ("identifier", (b"user", b"login", b"client_id", b"clientid", b"access_key", b"accesskey", b"account"), re.compile(rb"(?<![a-z0-9])(?:user(?:_?(?:name|id))?|login(?:_?(?:name|id))?|client_?id|access_?key_?id|account(?:_?(?:name|id))?)[\"']?\x20*[:=]\x20*[\"']?([a-z0-9_.@+-]{3,})")),
    ("value", (b"pwd", b"pass", b"auth", b"private_key", b"privatekey", b"access_key", b"accesskey", b"credential", b"bearer"), re.compile(rb"(?<![a-z0-9])(?:pwd|pass|auth|private_?key|access_?key|credentials?)[\"']?\x20*[:=]\x20*[\"']?([a-z0-9+/_.=@!#$%-]{6,})|(?<![a-z0-9])bearer\x20+([a-z0-9._-]{12,})")),
    ("endpoint", (b"://", b"host", b"endpoint", b"server"), re.compile(rb"(?<![a-z0-9])[a-z][a-z0-9+.-]*://[a-z0-9.-]+(?::[0-9]+)?|(?<![a-z0-9])(?:host(?:name)?|endpoint|server)[\"']?\x20*[:=]\x20*[\"']?[a-z0-9-]+(?:\.[a-z0-9-]+)+(?::[0-9]+)?")),
)
KINDS = ("assign", "access", "hex", "identifier", "value", "endpoint")
ROLE = {"assign": "secret", "access": "identifier", "hex": "secret", "identifier": "identifier", "value": "secret", "endpoint": "endpoint"}
NEEDS = {"identifier": ("secret",), "value": ("identifier", "endpoint"), "endpoint": ("secret",)}
REACH = 200


def strong_spans(data: bytes, low: bytes) -> list[tuple[int, int, str]]:
    found = []
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(low) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if b"AKIA" in data:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(data) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(data)]
    return found


def weak_spans(low: bytes) -> list[tuple[int, int, str]]:
    found = []
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), m.end(), "value") for m in ASSIGN.finditer(low) if m.end(2) - m.start(2) < ASSIGN_LEAST]
    return found + [
        (m.start(), m.end(), kind)
        for kind, hints, pattern in WEAK
        if any(h in low for h in hints)
        for m in pattern.finditer(low)
    ]


def linked(strong: list[tuple[int, int, str]], weak: list[tuple[int, int, str]], reach: int) -> list[tuple[int, int, str]]:
    """Weak parts with a complementary part in reach. Parts that overlap a strong span are that span's business."""
    starts = sorted(strong)
    edges = [s for s, _, _ in starts]
    furthest, most = [], 0
    for _, e, _ in starts:
        most = max(most, e)
        furthest.append(most)

    def covered(s: int, e: int) -> bool:
        i = bisect_left(edges, e)
        return i > 0 and furthest[i - 1] > s

    weak = [w for w in weak if not covered(w[0], w[1])]
    by_role: dict[str, list[tuple[int, int]]] = {}
    for s, e, kind in strong + weak:
        by_role.setdefault(ROLE[kind], []).append((s, e))
    index = {}
    for role, spans in by_role.items():
        spans.sort()
        reached, last = [], 0
        for _, e in spans:
            last = max(last, e)
            reached.append(last)
        index[role] = ([s for s, _ in spans], reached)

    def near(role: str, s: int, e: int) -> bool:
        if role not in index:
            return False
        firsts, reached = index[role]
        i = bisect_left(firsts, e)
        return (i < len(firsts) and firsts[i] - e <= reach) or (i > 0 and s - reached[i - 1] <= reach)

    return [w for w in weak if any(near(role, w[0], w[1]) for role in NEEDS[w[2]])]


def scan(data: bytes, reach: int = REACH) -> list[tuple[str, int, int]]:
    """(kind, start, end) of one text given as UTF-8, offsets in code points."""
    low = data.lower()
    strong = strong_spans(data, low)
    weak = weak_spans(low)
    if not strong and not weak:
        return []
    if not data.isascii():
        at, count, place = 0, 0, {}
        for p in sorted({x for s, e, _ in strong + weak for x in (s, e)}):
            count += len(data[at:p].decode())
            at = p
            place[p] = count
        strong, weak = ([(place[s], place[e], k) for s, e, k in spans] for spans in (strong, weak))
    spans = strong + linked(strong, weak, reach)
    return [(k, s, e) for s, e, k in sorted(spans, key=lambda x: (x[0], KINDS.index(x[2])))]


def find_secrets(docs: DataFrame, text: str = "text", reach: int = REACH) -> DataFrame:
    """docs with spans_, an array of (kind, start, end), appended."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = batch.column(text).cast(pa.binary()).to_pylist()
        found = [[{"kind": k, "start": s, "end": e} for k, s, e in scan(t, reach)] if t else [] for t in texts]
        return [pa.array(found, pa.list_(span))]

    return append_columns(docs, "spans_ array<struct<kind:string,start:int,end:int>>", make)
