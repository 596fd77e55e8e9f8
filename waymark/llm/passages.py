"""Substring deduplication by compact windows.

A text is the sequence of hashes of its five-word shingles. Under each of `HASHES` hash functions, all passages of
at least `LEAST` shingles are grouped by the position of their minimum: these groups are the nodes of the Cartesian
tree over the hashes whose subtree has at least `LEAST` positions, a compact window (left, centre, right) each.
Two similar passages share the minimum under a hash with a probability of their similarity, so their windows meet
under the same (function, minimum), which is the key: all functions miss a pair of similarity 0.8 once in 600 times.

Windows whose key occurs in one text only are dropped as they stream by; the windows of a key that is common in a part
of the texts stay without that look and are dealt to many tasks. The others are joined on it, with the
interval condition that what both windows cover can hold a passage, and verified on the shingles around the centre:
a stretch of at least `LEAST` positions that holds the centre and whose similarity (common / all shingles, allowing
shifts of two words) is 0.8 or more. Of windows that a text repeats with equal shingles, one is kept.

Under one key, classes of texts are grown breadth-first: each window of a class is compared with all windows of texts
that no class has reached yet, which gives a spanning forest of the links among the texts. Sketches of the shingles
around the centre come first: 128-bit masks whose difference is bounded for windows that share a passage, by a bound
that grows with the shorter window. Keys with
more than `BLOCK` windows are dealt to blocks that first keep one of equal windows; texts that other keys have linked
by then count as one, and windows meet where they have a shingle in one place: a window asks for more of its shingles than
a passage may miss, the uncommon ones first, in each stretch that a passage has to cover, so no two that share one fail to
meet. Where more than `BLOCK` meet, every two blocks of them are compared in a task of their own.
Equal texts are one text throughout, and texts are the nodes, whatever ids their rows have. A document's class is the
connected component over verified links, named by the smallest doc_id in it.

Defined results: texts of fewer than `LEAST` + 4 words, empty and null ones have no passages and are classes of
their own (class_id null where doc_id is); rows without id link others as all do, and a class of such rows alone has a
null class_id; a passage that repeats within one text links nothing; repeated rows and ids stay; an empty table gives
an empty one; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, forget, materialise, small_side

#: Words of a shingle, shingles of a passage (50 words), hash functions, and least similarity.
SHINGLE, LEAST, HASHES, SIMILARITY = 5, 46, 4, 0.8
#: Shingles kept on each side of a centre for verification, and shifts in words that are allowed.
REACH, SHIFTS = 64, (-2, -1, 0, 1, 2)
#: Windows of a minimum that are compared in one task; bytes of text hashed together.
BLOCK, TOGETHER = 4096, 1 << 22
#: Shingles of a section of the sketches, rows of a group beyond which tiles of sketches are compared, rows of a tile, and of what is
#: sketched, hashed and verified at once.
SECTION, LARGE, TILE, CHUNK = LEAST // 4, 64, 64, 16_384
#: Of this many texts one is asked for minima that are common; least windows of one there, most such minima for each task
#: of a shuffle, and tasks that one is dealt to.
ASKED, COMMON, MOST_COMMON, SALTS = 64, 32, 8, 64
#: A passage covers one of the stretches around the centre that begin at every `STEP`-th place; shingles meet in cells of
#: `CELL` places, up to `FAR` places from the centre.
STEP, CELL, FAR = 6, 8, LEAST + max(SHIFTS)
#: Low bits of a key that hold the position while sliding.
PLACE = np.uint64((1 << 23) - 1)

_rng = np.random.default_rng(20)
BYTES = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = int(_rng.integers(0, 1 << 62)) * 4 + 3
SEEDS = _rng.integers(0, 1 << 63, 64, dtype=np.uint64)
PLACES = _rng.integers(0, 1 << 63, 2 * REACH + 1, dtype=np.uint64)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        size = max(n, TOGETHER + (1 << 16))
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def word_hashes(buffer: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word of lower-cased UTF-8."""
    raw = np.frombuffer(buffer, np.uint8)
    up, down = powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(BYTES[raw] * up[: len(raw)], out=sums[1:])
    gap = np.ones(len(raw) + 2, bool)
    gap[1:-1] = SPACE[raw]
    starts = np.flatnonzero(gap[:-2] & ~gap[1:-1])
    ends = np.flatnonzero(~gap[1:-1] & gap[2:]) + 1
    return mix((sums[ends] - sums[starts]) * down[starts]), starts


def pieces(text: bytes) -> list[bytes]:
    """A long text cut at white space into parts that are hashed one by one."""
    out, at = [], 0
    while len(text) - at > TOGETHER:
        cut = max(text.rfind(b, at, at + TOGETHER) for b in (b" ", b"\n", b"\t"))
        if cut <= at:
            found = [i for b in (b" ", b"\n", b"\t") if (i := text.find(b, at + 1)) > 0]
            cut = min(found, default=len(text))
        out.append(text[at:cut])
        at = cut
    return [*out, text[at:]]


def shingles(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, shingle hashes of some texts end to end, their counts), a bounded number of bytes at a time."""

    def rolled(words: np.ndarray) -> np.ndarray:
        out = np.zeros(max(0, len(words) - SHINGLE + 1), np.uint64)
        for j in range(SHINGLE):
            out = out * np.uint64(0x9E3779B97F4A7C15) + words[j : j + len(out)]
        return mix(out)

    at = 0
    while at < len(texts):
        if len(texts[at]) > TOGETHER:
            words = np.concatenate([word_hashes(p)[0] for p in pieces(texts[at].lower())])
            found = rolled(words)
            yield at, found, np.array([len(found)])
            at += 1
            continue
        end, size = at, 0
        while end < len(texts) and size + len(texts[end]) <= TOGETHER:
            size += len(texts[end]) + 1
            end += 1
        part = [t.lower() for t in texts[at:end]]
        words, starts = word_hashes(b" ".join(part))
        firsts = np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in part]))
        many = np.maximum(np.diff(firsts) - SHINGLE + 1, 0)
        every = rolled(words)
        keep = np.repeat(firsts[:-1] - np.cumsum(many) + many, many) + np.arange(many.sum())
        yield at, every[keep], many
        at = end


def compact_windows(hashes: np.ndarray, many: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centres of all compact windows over texts end to end, and how far each reaches left and right (REACH at most)."""
    n = len(hashes)
    ends = np.repeat(np.cumsum(many), many)
    starts = ends - np.repeat(many, many)
    usable = np.flatnonzero(np.arange(n) + least <= ends)
    if not len(usable):
        return np.zeros((3, 0), np.int64)
    centres = []
    for low in range(0, n, 1 << 22):  # positions fit in PLACE
        part = usable[(usable >= low) & (usable < low + (1 << 22))]
        if not len(part):
            continue
        span = hashes[low : min(n, part[-1] + least)]
        keys = np.full(-(-len(span) // least) * least, np.iinfo(np.uint64).max, np.uint64)
        keys[: len(span)] = (span & ~PLACE) | np.arange(len(span), dtype=np.uint64)
        rows = keys.reshape(-1, least)
        before = np.minimum.accumulate(rows, axis=1).ravel()
        after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        least_of = np.minimum(after[part - low], before[part - low + least - 1])
        centres.append((least_of & PLACE).astype(np.int64) + low)
    centre = np.unique(np.concatenate(centres))
    # the nearest smaller hash on either side is an ancestor in the tree, so it is a centre as well
    key, first, last = (hashes[centre] & ~PLACE).tolist(), starts[centre].tolist(), (ends[centre] - 1).tolist()
    places = centre.tolist()
    left, right, stack = list(first), list(last), []
    for i, place in enumerate(places):
        while stack and (first[stack[-1]] != first[i] or key[stack[-1]] > key[i]):
            j = stack.pop()
            if first[j] == first[i]:
                right[j] = place - 1
        if stack:
            left[i] = places[stack[-1]] + 1
        stack.append(i)
    return centre, np.minimum(centre - np.array(left), REACH), np.minimum(np.array(right) - centre, REACH)


WINDOWS = "min long, of long, centre int, reach int"


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(of, text) -> keyed compact windows of every text; reach is left * 256 + right."""
    for batch in batches:
        of = np.asarray(batch.column(0))
        texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
        for at, found, many in shingles(texts):
            start = np.cumsum(many) - many
            for f in range(HASHES):
                hashed = mix(found ^ SEEDS[f])
                centre, left, right = compact_windows(hashed, many, LEAST)
                if not len(centre):
                    continue
                text = np.searchsorted(start, centre, side="right") - 1
                key = mix(hashed[centre] ^ SEEDS[48]).view(np.int64)
                columns = [key, of[at + text], (centre - start[text]).astype(np.int32), (left * 256 + right).astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["min", "of", "centre", "reach"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (min, of, centre, reach, salt) sorted by the first three: those of minima that two texts have or that are
    common (a salt from 0 on), once each. Holds one text's rows of one minimum."""
    pending, open_min = None, None
    for batch in batches:
        now = [np.asarray(c) for c in batch.columns[:4]] + [np.asarray(batch.column(4)) >= 0]
        if pending is not None:
            now = [np.concatenate(x) for x in zip(pending, now, strict=True)]
        key, of, centre = now[:3]
        if not len(key):
            continue
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (of[1:] != of[:-1]) | (centre[1:] != centre[:-1])
        now = [c[new] for c in now]
        key, of, common = now[0], now[1], now[4]
        cuts = np.flatnonzero(key[1:] != key[:-1]) + 1
        first, last = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(key)]])
        several = (of[first] != of[last - 1]) | common[first]
        if open_min is not None and key[0] == open_min:
            several[0] = True
        emit = np.repeat(several, last - first)
        open_min, pending = (key[-1], None) if several[-1] else (None, [c[first[-1] :] for c in now])
        if emit.any():
            yield pa.RecordBatch.from_arrays([pa.array(c[emit]) for c in now[:4]], batch.schema.names[:4])


def _around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rep, text, windows) -> a row per window with 16-bit shingles around its centre; positions outside it are 0."""
    width = 2 * REACH + 1
    for batch in batches:
        reps, windows = np.asarray(batch.column(0)), batch.column(2)
        parts, offsets = windows.flatten(), np.asarray(windows.offsets)
        offsets = offsets - offsets[0]
        columns = [np.asarray(parts.field(i)) for i in range(3)]
        for at, found, many in shingles(batch.column(1).cast(pa.binary()).to_pylist()):
            short = (found % np.uint64(65_535)).astype(np.uint16) + np.uint16(1)
            low, high = offsets[at], offsets[at + len(many)]
            key, centre, reach = (c[low:high] for c in columns)
            left, right = reach >> 8, reach & 255
            text = np.repeat(np.arange(len(many)), np.diff(offsets[at : at + len(many) + 1]))
            place = (np.cumsum(many) - many)[text] + centre
            for a in range(0, len(key), 8192):
                steps = np.arange(-REACH, REACH + 1)
                inside = (steps >= -left[a : a + 8192, None]) & (steps <= right[a : a + 8192, None])
                grid = np.where(inside, short[np.clip(place[a : a + 8192, None] + steps, 0, len(short) - 1)], 0).astype("<u2")
                mine = mix(key[a : a + 8192].view(np.uint64)) + text[a : a + 8192].astype(np.uint64)
                one = np.unique(digests(grid, mine), return_index=True)[1]
                rows = pa.array([r.tobytes() for r in grid[one]], pa.binary(2 * width)).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(key[a + one]), pa.array(reps[at + text[a + one]]), rows], ["min", "rep", "around"])


def digests(grid: np.ndarray, group: np.ndarray) -> np.ndarray:
    """A hash of each row of shingles and its group."""
    sums = [(grid[i : i + CHUNK] * PLACES).sum(axis=1, dtype=np.uint64) for i in range(0, len(grid), CHUNK)]
    return mix(np.concatenate([np.zeros(0, np.uint64), *sums]) ^ mix(group.astype(np.int64).view(np.uint64)))


def similar(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of shingles around common centres hold a common passage."""
    same = np.zeros(a.shape, bool)
    for s in SHIFTS:
        x, y = (a[:, max(0, -s) : a.shape[1] - max(0, s)], b[:, max(0, s) : b.shape[1] - max(0, -s)])
        same[:, max(0, -s) : a.shape[1] - max(0, s)] |= x == y
    same &= a != 0
    # common / all >= s over n aligned positions means common >= n * 2s / (1 + s)
    found = np.zeros(len(a), bool)
    some = np.flatnonzero(np.count_nonzero(same, axis=1) >= LEAST * 2 * SIMILARITY / (1 + SIMILARITY) - 1e-3)
    gain = same[some].astype(np.float32) - np.float32(2 * SIMILARITY / (1 + SIMILARITY))
    right = np.cumsum(gain[:, REACH:], axis=1)
    left = np.concatenate([np.zeros((len(some), 1), np.float32), np.cumsum(gain[:, REACH - 1 :: -1], axis=1)], axis=1)
    best = np.maximum.accumulate(right[:, ::-1], axis=1)[:, ::-1]
    need = np.clip(LEAST - 1 - np.arange(REACH + 1), 0, REACH)
    found[some] = (left + best[:, need]).max(axis=1) >= -1e-3
    return found


#: Of the places that two windows share, a ninth may be without a partner, on each side, as all other places of a passage
#: are misses themselves; a shift makes a window reach two words further, and moves that many over each edge of a stretch.
_shared_places = np.minimum(np.arange(2 * REACH + 2) + max(SHIFTS), 2 * REACH + 1)
MOST_BITS = np.array([2 * (n - math.ceil(n * 2 * SIMILARITY / (1 + SIMILARITY)) + 2 * max(SHIFTS)) for n in _shared_places.tolist()], np.uint8)


def sketches(grid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each stretch of three sections around a row's centre: a bit in 128 (two words) for each of its shingles, and a
    count that no sketch may differ by where the row's window does not cover the stretch; and the bits by which
    sketches of this row may differ, which grow with its window."""
    parts = [_sketches(grid[i : i + CHUNK]) for i in range(0, max(1, len(grid)), CHUNK)]
    return tuple(np.concatenate(p, axis=1) for p in zip(*parts, strict=True))


def _sketches(grid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sketches of rows that are worked on at once."""
    near = grid[:, REACH - 3 * SECTION : REACH + 3 * SECTION + 1]
    place = near.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(57)
    bit = (near != 0).astype(np.uint64) << (place & np.uint64(63))
    # three sections, the centre, three sections; a stretch is four neighbours of these
    cuts = [0, SECTION, 2 * SECTION, 3 * SECTION, 3 * SECTION + 1, 4 * SECTION + 1, 5 * SECTION + 1]
    upper = place >> np.uint64(6) != 0
    words = [np.bitwise_or.reduceat(np.where(upper == w, bit, np.uint64(0)), cuts, axis=1) for w in (False, True)]
    filled = np.add.reduceat((near != 0).astype(np.uint8), cuts, axis=1)
    masks = np.stack([np.bitwise_or.reduce(w[:, right : right + 4], axis=1) for right in range(4) for w in words])
    short = np.stack([filled[:, right : right + 4].sum(axis=1) <= 3 * SECTION - max(SHIFTS) for right in range(4)])
    return masks, short.astype(np.uint8) * np.uint8(60), MOST_BITS[np.count_nonzero(grid, axis=1)][None]


def may_match(a: tuple[np.ndarray, np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Whether sketches of two rows leave a common passage possible: one of LEAST shingles or more that holds the centre
    covers three whole sections next to each other and the centre, in both rows."""
    (x, out_x, most_x), (y, out_y, most_y) = a, b
    most = np.minimum(most_x[0], most_y[0])
    out = np.zeros(np.broadcast_shapes(x.shape[1:], y.shape[1:]), bool)
    for part in range(4):
        bits = np.bitwise_count(x[2 * part] ^ y[2 * part]) + np.bitwise_count(x[2 * part + 1] ^ y[2 * part + 1])
        out |= bits + out_x[part] + out_y[part] <= most
    return out


def grow(reps: np.ndarray, same: np.ndarray, side: np.ndarray, sketch: tuple[np.ndarray, np.ndarray, np.ndarray], grid: np.ndarray) -> tuple[list, list]:
    """Links of a spanning forest of the texts of one large group.

    Classes of texts grow one by one: each row of a class's texts is compared with all rows of texts that no class
    has, a tile of sketches at a time, and a text that one row reaches brings all its rows. Rows of one side (0 or 1)
    are not compared with each other.
    """
    a, b = [], []
    owner, value = np.unique(reps, return_inverse=True)[1], np.unique(same, return_inverse=True)[1]
    order = np.argsort(owner, kind="stable")
    ends = np.cumsum(np.bincount(owner))
    alive, fresh = np.ones(len(reps), bool), np.ones(value.max() + 1, bool)

    def take(text: int) -> list[int]:
        """Bring a text into the class: its rows, but for those that equal one already compared."""
        rows = order[ends[text - 1] if text else 0 : ends[text]]
        alive[rows] = False
        rows = rows[fresh[value[rows]]]
        rows = rows[np.unique(value[rows], return_index=True)[1]]
        fresh[value[rows]] = False
        return rows.tolist()

    while alive.any():
        fresh[:] = True
        front = take(owner[np.argmax(alive)])
        while front and alive.any():
            tile, front, left = front[:TILE], front[TILE:], np.flatnonzero(alive)
            near = may_match(tuple(x[:, tile, None] for x in sketch), tuple(x[:, None, left] for x in sketch))
            if side[0] >= 0:
                near &= side[tile][:, None] != side[left]
            at, to = np.nonzero(near)
            f, rows = np.array(tile)[at], left[to]
            by_text = np.argsort(owner[rows], kind="stable")
            f, rows, most = f[by_text], rows[by_text], 1
            while len(rows):  # a few rows of each text at first, as one that matches is enough
                text = owner[rows]
                first = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
                now = np.arange(len(rows)) - np.repeat(first, np.diff(np.append(first, len(rows)))) < most
                x, y = f[now], rows[now]
                hit = np.concatenate([similar(grid[x[s : s + CHUNK]], grid[y[s : s + CHUNK]]) for s in range(0, len(x), CHUNK)])
                met, which = np.unique(owner[y[hit]], return_index=True)
                a.append(reps[x[hit][which]])
                b.append(reps[y[hit][which]])
                for text in met.tolist():
                    front += take(text)
                on = ~now & alive[rows]
                f, rows, most = f[on], rows[on], 4 * most
    return a, b


def forest(group: np.ndarray, reps: np.ndarray, side: np.ndarray, grid: np.ndarray) -> tuple[list, list]:
    """Links of a spanning forest of the similar rows of each group; groups are runs.

    Of small groups, one row of each at a time is compared with what no class of its group has reached.
    """
    same, sketch = digests(grid, group), sketches(grid)
    a, b = [], []
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(group)))
    for s, n in zip(starts[sizes > LARGE].tolist(), sizes[sizes > LARGE].tolist(), strict=True):
        x, y = grow(reps[s : s + n], same[s : s + n], side[s : s + n], tuple(k[:, s : s + n] for k in sketch), grid[s : s + n])
        a += x
        b += y
    unseen, front = np.flatnonzero(np.repeat((sizes > 1) & (sizes <= LARGE), sizes)), np.zeros(0, np.int64)
    while len(unseen):
        start = np.flatnonzero(np.append(True, group[unseen[1:]] != group[unseen[:-1]]))
        live, count = group[unseen[start]], np.diff(np.append(start, len(unseen)))
        head, root = unseen[start], np.ones(len(live), bool)
        front = front[np.isin(group[front], live)]
        owner, at = np.unique(group[front], return_index=True)
        place = np.searchsorted(live, owner)
        head[place], root[place] = front[at], False
        front = np.delete(front, at)
        others = np.ones(len(unseen), bool)
        others[start[root]] = False
        rows, heads = unseen[others], np.repeat(head, count)[others]
        hit = may_match(tuple(k[:, rows] for k in sketch), tuple(k[:, heads] for k in sketch))
        hit &= (side[rows] < 0) | (side[rows] != side[heads])
        some = np.flatnonzero(hit)
        for s in range(0, len(some), CHUNK):
            part = some[s : s + CHUNK]
            hit[part] = similar(grid[heads[part]], grid[rows[part]])
        apart = hit & (reps[rows] != reps[heads])
        a.append(reps[heads[apart]])
        b.append(reps[rows[apart]])
        # of equal rows, one is compared with the others
        fresh = rows[hit & (same[rows] != same[heads])]
        front = np.concatenate([front, fresh[np.unique(same[fresh], return_index=True)[1]]])
        unseen = rows[~hit]
    return a, b


_places = np.arange(-FAR, FAR + 1)
STRETCHES = [np.flatnonzero((_places >= -i) & (_places <= max(0, LEAST - STEP - i)) & (_places != 0)) for i in range(0, LEAST, STEP)]
#: Places that one stretch of a passage may miss: a passage with less than LEAST places on one side of its centre is no longer
#: than LEAST - 1 + REACH, and of one with more on both sides, one side holds half the misses at most.
MOST_MISSES = max((LEAST - 1 + REACH) // 9, (2 * REACH + 1) // 9 // 2)


def meetings(key: np.ndarray, grid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, whether the row asks) once each: rows of one key that hold a common passage have a key in common for which
    one of them asks.

    Each row is found under its shingles in their cells. It asks, in each stretch, for one shingle more than a passage may
    miss there, counting the places outside its window as missed: for shingles other than the centre's, which
    repeated words have in common, and for those of the places that many stretches share before others.
    """
    near = grid[:, REACH - FAR : REACH + FAR + 1]
    far, code, base = np.abs(_places), near.astype(np.uint64) << np.uint64(8), mix(key.view(np.uint64))

    def keys(row: np.ndarray, place: np.ndarray, shift: int) -> np.ndarray:
        return mix(base[row] ^ (code[row, place] | ((_places[place] + shift + REACH) // CELL).astype(np.uint64)))

    most = np.minimum(np.maximum(np.count_nonzero(grid, axis=1), LEAST) // 9, MOST_MISSES)
    rank = np.where(near == grid[:, REACH, None], 200 - far, np.where(far < LEAST // 2, LEAST // 2 - far, far))
    rank = np.where(near == 0, 255, rank).astype(np.uint8)
    ask = np.zeros(near.shape, bool)
    for stretch in STRETCHES:
        part = rank[:, stretch]
        need = most - np.count_nonzero(part == 255, axis=1) + 1
        chosen = np.zeros(part.shape, bool)
        np.put_along_axis(chosen, np.argsort(part, axis=1, kind="stable"), np.arange(len(stretch)) < need[:, None], axis=1)
        ask[:, stretch] |= chosen
    at, asked = np.nonzero(near), np.nonzero(ask)
    row = np.concatenate([asked[0], asked[0], at[0]])
    every = np.concatenate([keys(*asked, min(SHIFTS)), keys(*asked, max(SHIFTS)), keys(*at, 0)])
    asks = np.arange(len(row)) < 2 * len(asked[0])
    order = np.lexsort((~asks, every, row))
    row, every, asks = row[order], every[order], asks[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (every[1:] != every[:-1])
    return row[new], every[new].view(np.int64), asks[new]


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(min, rep, around, row) -> the keys under which a row meets others."""
    for batch in batches:
        grid = np.frombuffer(b"".join(batch.column(2).to_pylist()), "<u2").reshape(-1, 2 * REACH + 1)
        at, key, asks = meetings(np.asarray(batch.column(0)), grid)
        reps, rows = np.asarray(batch.column(1)), np.asarray(batch.column(3))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (key, reps[at], rows[at], asks)], ["key", "rep", "row", "asks"])


def meeting_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(min, rep, around): the rows of crowded minima under each key where one asks for another's; and these keys (min, row)."""
    rows = rows.select("min", "rep", "around", F.xxhash64("min", "rep", "around").alias("row"))
    every = materialise(rows.mapInArrow(_meetings, "key long, rep long, row long, asks boolean"))
    keys = every.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high"), F.max("asks").alias("asked"))
    met = every.join(materialise(keys.where("low <> high AND asked").select("key")), "key", "left_semi")
    met = materialise(met.select(F.col("key").alias("min"), "row"))
    forget(every)
    return met.join(rows.drop("min"), "row").select("min", "rep", "around"), met


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (min, block, rep): links (a, b) of each group's forest. If `more`: links of equal rows, then one of each."""

    def work(key: np.ndarray, more: np.ndarray, reps: np.ndarray, side: np.ndarray, grid: np.ndarray) -> pa.RecordBatch:
        group = np.concatenate([[0], np.cumsum((key[1:] != key[:-1]).any(axis=1).astype(np.int64), dtype=np.int64)])
        whole = np.flatnonzero(~more)
        a, b = forest(group[whole], reps[whole], side[whole], grid[whole])
        kept: dict[tuple[int, bytes], int] = {}
        first = np.array([kept.setdefault((group[i], grid[i].tobytes()), i) for i in np.flatnonzero(more)], np.int64)
        apart = reps[first] != reps[more]
        a.append(reps[first[apart]])
        b.append(reps[more][apart])
        forward = np.unique(first)
        a.append(reps[forward])
        b.append(np.full(len(forward), -1, np.int64))
        heads = np.concatenate([np.zeros(sum(map(len, a[:-1])), np.int64), key[forward, 0]])
        grids = [None] * (len(heads) - len(forward)) + [g.tobytes() for g in grid[forward]]
        columns = [pa.array(np.concatenate(a)), pa.array(np.concatenate(b)), pa.array(heads), pa.array(grids, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["a", "b", "min", "around"])

    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([np.asarray(batch.column(0)), np.asarray(batch.column(1)).astype(np.int64)], axis=1)
        grid = np.frombuffer(b"".join(batch.column("around").to_pylist()), "<u2").reshape(-1, 2 * REACH + 1)
        now = [key, np.asarray(batch.column("more").to_pylist(), bool), np.asarray(batch.column("rep")), np.asarray(batch.column("side")), grid]
        if rest is not None:
            now = [np.concatenate(x) for x in zip(rest, now, strict=True)]
        last = int(np.flatnonzero((now[0] != now[0][-1]).any(axis=1)).max(initial=-1)) + 1
        rest = [x[last:] for x in now]
        if last:
            yield work(*(x[:last] for x in now))
    if rest is not None:
        yield work(*rest)


LINKS = "a long, b long, min long, around binary"


def common_minima(docs: DataFrame) -> np.ndarray:
    """Minima with so many windows that no task should get all of them, guessed from a part of the texts; sorted, and at most
    `MOST_COMMON` for each task of a shuffle. The guess only decides how rows are dealt."""
    asked = docs.where(F.pmod(F.xxhash64("of", F.lit(1)), F.lit(ASKED)) == 0)
    counts = materialise(asked.select("of", "text").mapInArrow(_windows, WINDOWS).groupBy("min").agg(F.count("*").alias("n")))
    every = counts.agg(F.sum("n")).first()[0] or 0
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # no more than MOST_COMMON * tasks minima can have so large a share each
    found = counts.where(F.col("n") >= max(COMMON, every / (MOST_COMMON * tasks))).select("min").collect()
    forget(counts)
    return np.sort(np.array([r[0] for r in found], np.int64))


def _dealt(common):
    """The windows of texts with the task among `SALTS` that a window of a common minimum goes to, -1 for any other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = common.value
        for batch in _windows(batches):
            key, of = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            place = np.minimum(np.searchsorted(known, key), max(0, len(known) - 1))
            hit = known[place] == key if len(known) else np.zeros(len(key), bool)
            salt = np.where(hit, (mix(of.view(np.uint64)) % np.uint64(SALTS)).astype(np.int32), -1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(salt)], [*batch.schema.names, "salt"])

    return run


def passage_links(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """Verified links (a, b) between texts, by their hashes. docs: doc_id (may be null), of (hash of the text), text."""
    # a common minimum is had by several texts without looking, so its windows need not meet in one task
    common = docs.sparkSession.sparkContext.broadcast(common_minima(docs))
    windows = docs.select("of", "text").mapInArrow(_dealt(common), f"{WINDOWS}, salt int")
    shared = windows.repartition("min", "salt").sortWithinPartitions("min", "of", "centre").mapInArrow(_shared, WINDOWS)
    shared = materialise(shared)
    # a text is read from the row with its smallest id; one that only rows without id have, from any of them
    reps = docs.groupBy("of").agg(F.min("doc_id").alias("id"))
    mine = shared.groupBy("of").agg(F.collect_set(F.struct("min", "centre", "reach")).alias("windows")).join(reps, "of")
    mine = mine.select(F.col("of").alias("rep"), "id", "windows")
    texts = docs.join(mine, (F.col("of") == F.col("rep")) & (F.col("doc_id") == F.col("id"))).select("rep", "text", "windows")
    unnamed = docs.where("doc_id IS NULL").dropDuplicates(["of"]).select("of", "text")
    unnamed = unnamed.join(mine.where("id IS NULL"), F.col("of") == F.col("rep")).select("rep", "text", "windows")
    texts = texts.unionByName(unnamed)
    around = texts.mapInArrow(_around, "min long, rep long, around binary")

    def blocks_of(rows: DataFrame) -> DataFrame:
        crowded = rows.groupBy("min").count().where(F.col("count") > block)
        return small_side(materialise(crowded.select("min", F.ceil(F.col("count") / block).cast("int").alias("blocks"))))

    dealt = around.join(blocks_of(shared), "min", "left").select(
        "min",
        F.when(F.col("blocks").isNull(), 0).otherwise(F.pmod(F.xxhash64("rep"), F.col("blocks"))).cast("long").alias("block"),
        F.col("blocks").isNotNull().alias("more"),
        "rep",
        F.lit(-1).alias("side"),
        "around",
    )

    def classes(rows: DataFrame) -> DataFrame:
        return rows.repartition("min", "block").sortWithinPartitions("min", "block", "rep").mapInArrow(_classes, LINKS)

    found = materialise(classes(dealt))
    linked = materialise(found.where("around IS NULL").select("a", "b").distinct())
    # the crowded minima: texts that other minima have linked are one text, so that only new links are looked for
    again = found.where("around IS NOT NULL").select("min", "a", "around")
    roots = materialise(components(linked))
    again = again.join(small_side(roots), F.col("a") == F.col("node"), "left")
    again = materialise(again.select("min", F.coalesce("component", "a").alias("rep"), "around").distinct())
    # of those still crowded, windows meet under keys that only few of them have
    still = blocks_of(again)
    meeting, met = meeting_rows(again.join(still, "min", "left_semi"))
    again = again.join(still, "min", "left_anti").unionByName(meeting)
    own = F.when(F.col("blocks").isNull(), 0).otherwise(F.pmod(F.xxhash64("around"), F.col("blocks")).cast("int"))
    others = F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    again = again.join(blocks_of(met), "min", "left").withColumn("own", own).withColumn("other", F.explode(others))
    pair = F.shiftleft(F.greatest("own", "other").cast("long"), 32) + F.least("own", "other")
    side = F.when(F.col("own") == F.col("other"), -1).when(F.col("own") < F.col("other"), 0).otherwise(1)
    again = again.select("min", pair.alias("block"), F.lit(False).alias("more"), "rep", side.alias("side"), "around")
    more = materialise(classes(again).select("a", "b").distinct())
    return linked.unionByName(more)


def passage_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per input row: key, class_id, repeated (the text shares a passage with another document)."""
    base = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("of"), F.col(text).alias("text"))
    long_enough = F.coalesce(F.size(F.split(F.trim("text"), "[ \\t-\\r]+")) >= LEAST + SHINGLE - 1, F.lit(False))
    named = base.select("doc_id", "of", long_enough.alias("long"))
    reps = named.where("long").groupBy("of").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    found = components(passage_links(base, block))
    rooted = materialise(
        reps.join(found, F.col("of") == F.col("node"), "left").select(
            "of", "least", F.coalesce("component", "of").alias("root"), (F.col("node").isNotNull() | (F.col("copies") > 1)).alias("twice")
        )
    )
    least = materialise(rooted.groupBy("root").agg(F.min("least").alias("class")))
    classes = materialise(rooted.join(small_side(least), "root").select(F.col("of").alias("of__"), "class", "twice"))
    out = named.join(classes, F.col("long") & (F.col("of") == F.col("of__")), "left")
    return out.select(F.col("doc_id").alias(key), F.coalesce("class", "doc_id").alias("class_id"), F.coalesce("twice", F.lit(False)).alias("repeated"))
