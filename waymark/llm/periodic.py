"""Periodic runs in the words of a text: every maximal repetition, found by divide and conquer.

Words (separated by ASCII white space) are interned per text. A segment is halved at its midpoint; two Z-functions,
one over the right half and the whole segment, one over both reversed, give for every period how far the words
around the midpoint agree with those a period further on, to either side. Where the two reaches together make up the
period, a repetition crosses the midpoint, extended as far as the segment goes. One that could be extended beyond
the segment is left to the enclosing midpoint that splits it, so nothing is extended twice. Equal intervals
keep their smallest period. Halving goes on only where a segment holds a repeated group of words half as long as
the shortest run; every run has one (groups are told apart by 64-bit hashes: a collision costs time, no result).

A text of n words takes n log n steps and memory for one text; texts are rows and are never shuffled.

Defined results: a null text counts as empty; empty texts have no runs and collapse to an empty text; repeated rows
stay; an empty table gives an empty one; words that differ in case or in a character differ. Other columns pass
unchanged; columns of the input that have the names of the new ones (`words_`, `runs_`, `collapsed_`) are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import append_columns

#: Shortest run in words.
LEAST = 12
#: Odd multiplier of the hashes of word groups.
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def z_function(word: list[int]) -> np.ndarray:
    """At each place, how many elements from there on agree with the beginning."""
    n = len(word)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        reach = min(right - i, z[i - left]) if i < right else 0
        if i + reach >= right:
            while i + reach < n and word[reach] == word[i + reach]:
                reach += 1
            left, right = i, i + reach
        z[i] = reach
    return np.array(z, np.int64)


def _crossing(word: list[int], low: int, middle: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, periods) of the repetitions in word[low:high] that hold a whole period on one side of the middle."""
    left, right = word[low:middle], word[middle:high]
    forward = z_function(right + [-1] + left + right)[len(right) + 1 :]
    back = left[::-1]
    backward = z_function(back + [-1] + right[::-1] + back)[len(left) + 1 :][::-1]
    # forward[i]: words from low + i on that agree with those from the middle; backward[i]: before low + i + 1, with those before the middle
    half = middle - low
    p = np.arange(1, high - middle + 1)
    after, before = np.append(forward[half + 1 :], 0), backward[half + p - 1]
    good = before + after >= p
    found = [(middle - before[good], middle + p[good] + after[good], p[good])]
    p = np.arange(1, half + 1)
    after, before = forward[half - p], np.append(backward[half - 1 - p[:-1]], 0)
    good = before + after >= p
    found.append((middle - p[good] - before[good], middle + after[good], p[good]))
    return tuple(np.concatenate(parts) for parts in zip(*found, strict=True))


def _next_equal(word: np.ndarray, size: int) -> np.ndarray:
    """For each place, the next one at which the same group of size words begins; the number of words if there is none."""
    places = len(word) - size + 1
    with np.errstate(over="ignore"):
        mixed = (word.astype(np.uint64) + np.uint64(1)) * MULTIPLIER
        mixed ^= mixed >> np.uint64(29)
        group = np.zeros(places, np.uint64)
        for k in range(size):
            group = (group ^ mixed[k : k + places]) * MULTIPLIER
            group ^= group >> np.uint64(32)
    order = np.argsort(group, kind="stable")
    same = group[order[1:]] == group[order[:-1]]
    out = np.full(places, len(word))
    out[order[:-1][same]] = order[1:][same]
    return out


def find_runs(word: list[int], least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all maximal runs of at least `least` words and two periods, by start, then period."""
    n, size = len(word), max(1, (least + 1) // 2)
    if n < max(least, 2):
        return []
    next_equal = _next_equal(np.array(word), size)
    if next_equal.min() >= n:
        return []
    found: dict[tuple[int, int], int] = {}
    segments = [(0, n)]
    while segments:
        low, high = segments.pop()
        if high - low < max(least, 2) or next_equal[low : high - size + 1].min() > high - size:
            continue
        middle = (low + high) // 2
        segments += [(low, middle), (middle, high)]
        starts, ends, periods = _crossing(word, low, middle, high)
        long = ends - starts >= least
        for start, end, period in zip(starts[long].tolist(), ends[long].tolist(), periods[long].tolist(), strict=True):
            if start == low > 0 and word[start - 1] == word[start - 1 + period]:
                continue
            if end == high < n and word[end] == word[end - period]:
                continue
            if period < found.get((start, end), period + 1):
                found[start, end] = period
    return sorted(((start, end - start, period) for (start, end), period in found.items()), key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, of each run only the first period."""
    if runs:
        change = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            change[start + period] += 1
            change[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
    return b" ".join(words)


def periodic_runs(docs: DataFrame, text: str = "text", least: int = LEAST) -> DataFrame:
    """docs with words_ (their number), runs_ (by start, then period) and collapsed_ appended."""
    entry = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        counts, every, texts = [], [], []
        for value in batch.column(text).to_pylist():
            words = value.encode().split() if value else []  # bytes split at ASCII white space only
            seen: dict[bytes, int] = {}
            runs = find_runs([seen.setdefault(w, len(seen)) for w in words], least)
            counts.append(len(words))
            every.append([dict(zip(("start", "length", "period"), run, strict=True)) for run in runs])
            texts.append(collapse(words, runs))
        return [pa.array(counts, pa.int64()), pa.array(every, pa.list_(entry)), pa.array(texts, pa.string())]

    return append_columns(docs, "words_ bigint, runs_ array<struct<start:bigint,length:bigint,period:bigint>>, collapsed_ string", make, by=text)
