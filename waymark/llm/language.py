"""Language identification by cross-parsing entropy.

For each language a suffix automaton of a bounded labelled sample is built. A text is cut greedily into the
longest phrases that occur in the sample; the language that needs the fewest phrases wins, phrases counted in
units of log2(sample length) per character, so that samples of unequal length compare fairly. A character that
a sample lacks costs a phrase of the longest sample and a trifle, so no label gains by a short sample. The automaton is
completed (a missing transition ends the phrase and starts the next at the root). Its transitions, at most three
a character of the sample, lie in one array in which each state has a base at which no two states collide, so a
language costs about a megabyte whatever its alphabet, and many pieces of texts step through it together.

Bounds of the model (parameters): per label at most `docs_each` documents, `clip` characters of each and
`chars_each` in all; of all labels together `chars_total`, shared equally, so that no label is left out (labels are
languages: a model and a pass for each). Every character of the samples counts.
Prediction reads whole texts; texts are cut into pieces of `PIECE` characters, which adds at most one phrase per
cut to every language alike.

Defined results: null texts and texts without a letter get `und` and score 0, as do all texts if nothing could
be learned; ties go to the language first in code order; repeated rows are kept; an empty table gives an empty one; all
input columns are passed on, but for those that have the names of the two new ones, which are replaced.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import append_columns, free_name, held_out

UNKNOWN = "und"
PIECE = 1024
#: Characters that are stepped through together.
TOGETHER = 1 << 22
#: What a character that a sample lacks costs beside a phrase of the longest sample, in bits: decides where all is equal.
STRANGE = 1e-6
#: Bases of a state that are tried at once.
TRIED = 256
#: Class of any character outside the samples of all languages.
OTHER = 0


def training_sample(
    docs: DataFrame, key: str, text: str, label: str, docs_each: int = 40, clip: int = 1500, chars_each: int = 24_000, chars_total: int = 512 * 24_000
) -> dict[str, str]:
    """Label -> sample text, from labelled rows outside the held-out fold; rows are drawn by hash of id and text.

    Every label is learned: where chars_each of each would be more than chars_total, all get an equal share.
    """
    rows = docs.where(~held_out(key) & F.col(label).isNotNull() & F.col(text).rlike("\\p{L}"))
    rows = rows.select(F.col(label).alias("label"), F.xxhash64(F.col(key), F.col(text)).alias("draw"), F.col(text).alias("sample"))
    each = max(1, min(chars_each, chars_total // max(1, rows.select("label").distinct().count())))
    ranked = rows.select("label", "draw").withColumn("rank", F.row_number().over(Window.partitionBy("label").orderBy("draw")))
    drawn = ranked.where(F.col("rank") <= docs_each).select("label", "draw")
    chosen = rows.join(F.broadcast(drawn.distinct()), ["label", "draw"]).select("label", "draw", F.substring("sample", 1, min(clip, each)).alias("sample"))
    out: dict[str, str] = {}
    for row in sorted(chosen.distinct().collect()):
        out[row.label] = (out.get(row.label, "") + row.sample.lower() + "\n")[:each]
    return out


def suffix_automaton(sequence: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence; state 0 is the root."""
    nexts: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in sequence:
        new = len(nexts)
        nexts.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and symbol not in nexts[p]:
            nexts[p][symbol] = new
            p = link[p]
        if p >= 0:
            q = nexts[p][symbol]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                clone = len(nexts)
                nexts.append(dict(nexts[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and nexts[p].get(symbol) == q:
                    nexts[p][symbol] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return nexts


@dataclass
class Parser:
    """Completed automaton: state s reads class c at base[s] + c; the entry counts only if s owns it."""

    base: np.ndarray
    owner: np.ndarray
    target: np.ndarray
    root: np.ndarray

    def step(self, state: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Next states, the places where no transition was found, and the phrases that end there."""
        at = self.base[state] + symbol
        following = self.target[at]
        missing = np.flatnonzero(self.owner[at] != state)
        started = self.root[symbol[missing]]
        ended = (state[missing] != 0).astype(np.int32) + (started == 0)
        following[missing] = started
        return following, missing, ended


def parser(nexts: list[dict[int, int]], classes: int) -> Parser:
    """Lay out an automaton: states with several transitions take the first base that fits, the others fill the gaps."""
    root = np.zeros(classes, np.int32)
    root[list(nexts[0])] = list(nexts[0].values())
    size = sum(map(len, nexts)) + 2 * classes
    owner, target, base = np.full(size, -1, np.int32), np.zeros(size, np.int32), np.zeros(len(nexts), np.int32)

    def room(least: int) -> None:
        nonlocal owner, target
        if least > len(owner):
            more = max(least, 2 * len(owner)) - len(owner)
            owner, target = np.append(owner, np.full(more, -1, np.int32)), np.append(target, np.zeros(more, np.int32))

    def place(state: int, at: int) -> None:
        base[state] = at
        symbols = np.fromiter(nexts[state], np.int64) + at
        owner[symbols], target[symbols] = state, list(nexts[state].values())

    several = sorted((s for s in range(1, len(nexts)) if len(nexts[s]) > 1), key=lambda s: (-len(nexts[s]), s))
    low, many = 0, 0
    for state in several:
        symbols = np.array(sorted(nexts[state]))
        if len(symbols) != many:
            low, many = 0, len(symbols)
        while True:
            room(low + TRIED + 2 * classes)
            bases = low + np.flatnonzero(owner[low + symbols[0] : low + symbols[0] + TRIED] < 0)
            for symbol in symbols[1:]:
                bases = bases[owner[bases + symbol] < 0]
            if len(bases):
                place(state, int(bases[0]))
                break
            low += TRIED
    single = np.array([s for s in range(1, len(nexts)) if len(nexts[s]) == 1], np.int64)
    room(classes + int((owner >= 0).sum()) + len(single) + classes)
    free = np.flatnonzero(owner[classes:] < 0)[: len(single)] + classes
    symbols = np.array([next(iter(nexts[s])) for s in single], np.int64)
    base[single], owner[free], target[free] = free - symbols, single, [next(iter(nexts[s].values())) for s in single]
    room(int(base.max(initial=0)) + classes)
    return Parser(base, owner, target, root)


@lru_cache(maxsize=2)
def parsers(samples: tuple[tuple[str, str], ...]) -> tuple[np.ndarray, list[Parser], np.ndarray]:
    """Class of each code point, a parser per language, and the bits that a phrase costs in each."""
    common = [c for c, _ in Counter("".join(s for _, s in samples)).most_common()]
    class_of = np.full(0x110000, OTHER, np.int32)
    for i, c in enumerate(common):
        class_of[ord(c)] = i + 1
    made = []
    for _, sample in samples:
        coded = class_of[np.frombuffer(sample.encode("utf-32-le"), np.uint32)]
        made.append(parser(suffix_automaton(coded.tolist()), len(common) + 1))
    return class_of, made, np.log2([len(s) + 1 for _, s in samples])


def count_phrases(texts: list[str], class_of: np.ndarray, tables: list[Parser]) -> np.ndarray:
    """Phrases of each text (rows) in each language (columns)."""
    sizes = np.array([len(t) for t in texts], np.int64)
    coded = class_of[np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)]
    pieces = -(-sizes // PIECE)
    owner = np.repeat(np.arange(len(texts)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = (np.cumsum(sizes) - sizes)[owner] + nth * PIECE
    size = np.minimum(PIECE, sizes[owner] - nth * PIECE)
    order = np.argsort(-size, kind="stable")
    start, owner, size = start[order], owner[order], size[order]
    running = np.searchsorted(-size, -np.arange(int(size.max(initial=0))), side="left")
    phrases = np.zeros((len(texts), len(tables)), np.int64)
    at = [np.zeros(len(owner), np.int32) for _ in tables]
    ended = [np.zeros(len(owner), np.int32) for _ in tables]
    for step, n in enumerate(running.tolist()):
        symbol = coded[start[:n] + step]
        for table, state, count in zip(tables, at, ended, strict=True):
            state[:n], missing, phrases_there = table.step(state[:n], symbol)
            count[missing] += phrases_there
    for k, (state, count) in enumerate(zip(at, ended, strict=True)):
        phrases[:, k] = np.bincount(owner, count + (state > 0), len(texts)).astype(np.int64)
    return phrases


def count_strange(texts: list[str], class_of: np.ndarray, tables: list[Parser]) -> np.ndarray:
    """Characters of each text, none of which is empty, that each language's sample lacks."""
    coded = class_of[np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)]
    starts = np.cumsum([0] + [len(t) for t in texts[:-1]])
    return np.stack([np.add.reduceat((table.root == 0).astype(np.int32)[coded], starts) for table in tables], axis=1)


def predict(texts: list[str | None], letters: list[bool], samples: tuple[tuple[str, str], ...]) -> tuple[list[str], list[float]]:
    """Language and score of each text."""
    labels, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    names = [n for n, _ in samples]
    class_of, tables, bits = parsers(samples) if names else (None, [], None)
    some = [i for i, ok in enumerate(letters) if ok] if names else []
    while some:
        total, n = 0, 0
        while n < len(some) and (n == 0 or total + len(texts[some[n]]) <= TOGETHER):
            total += len(texts[some[n]])
            n += 1
        part, some = some[:n], some[n:]
        lowered = [texts[i].lower() for i in part]
        strange = count_strange(lowered, class_of, tables)
        cost = count_phrases(lowered, class_of, tables) * bits + strange * (bits.max() - bits + STRANGE)
        best = cost.argmin(axis=1)
        for row, i in enumerate(part):
            least = cost[row, best[row]]
            rest = np.delete(cost[row], best[row]).min(initial=np.inf)
            labels[i], scores[i] = names[best[row]], float(1 - least / (least + rest)) if np.isfinite(rest) else 1.0
    return labels, scores


def identify(docs: DataFrame, samples: dict[str, str], text: str = "text", names: tuple[str, str] = ("lang_pred_", "lang_score_")) -> DataFrame:
    """docs with the language and its score appended under two names; columns that have these names are replaced."""
    model = tuple(sorted(samples.items()))

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        labels, scores = predict(batch.column(text).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), model)
        return [pa.array(labels, pa.string()), pa.array(scores, pa.float64())]

    helper = free_name(docs, "has_letter_")
    lettered = docs.drop(*names).withColumn(helper, F.coalesce(F.col(text).rlike("\\p{L}"), F.lit(False)))
    return append_columns(lettered, f"`{names[0]}` string, `{names[1]}` double", make).drop(helper)
