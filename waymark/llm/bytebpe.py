"""Byte-level BPE encoding and decoding.

Pre-tokenisation runs without regular expressions over whole batches. Every character gets a symbol: its class
(letter, number, other, blank) from one table over all code points, told apart further by what the next characters
are, since the pattern looks ahead past white space and at the letters of a contraction. A symbol is a function
from the state of the scan (inside a run, after a joining space, inside a contraction, ...) to the next one, and
the first character of a text a function that forgets the state. Functions compose associatively and only a few
dozen compositions exist, so the scan is a prefix scan over their numbers by a multiplication table: prefixes inside
blocks, then over the blocks' totals, then both together. State and symbol say where a slice begins.

The slices are an Arrow array over the batch's own bytes; its distinct values are looked up, and merged pair by
pair where they are no token themselves (lowest rank first, then leftmost; kept in a bounded table). Ids go back to
all slices by index arithmetic. The byte offset of every token stays with the ids: decoding copies each token's
bytes to its offset, and any span of a text can be decoded by its offsets alone.

The pattern is fixed (see `PATTERN`). Texts longer than `TOGETHER` characters are cut before a single space that a
non-blank follows: a slice begins there whatever came before.

Defined results: null gives null ids and offsets, an empty text none; repeated rows stay; an empty table gives an
empty one; ties between equal pairs go to the leftmost. Other columns pass unchanged; columns of the input that have
the names of the new ones (`ids_`, `offsets_`, `decoded_`) are replaced.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import itertools
import unicodedata
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import append_columns

#: What the scan implements (fixed value of the public vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters with the property White_Space besides the separators' categories (fixed values).
CONTROL_SPACES = (9, 10, 11, 12, 13, 0x85)
#: Characters that are scanned together, and the length of a block of the scan.
TOGETHER, BLOCK = 1 << 19, 256
#: Slices kept with their ids per worker (some 40 MB), the longest kept, and the longest that is merged by plain passes.
KEPT, KEPT_BYTES, SHORT = 200_000, 64, 128
#: Rank of a pair that is no token.
NEVER = 1 << 30

# classes of characters
LETTER, NUMBER, OTHER, SPACE, BLANK, QUOTE = range(6)
# symbols: the classes, blanks told apart by whether a non-blank follows, quotes by the contraction they may begin
S_LETTER, S_NUMBER, S_OTHER, S_JOINING, S_LAST_BLANK, S_BLANK, S_SHORT, S_LONG = range(8)
# states: inside a run of letters, numbers, others, blanks; after a joining space; after a whole slice; 1 or 2 letters short of a contraction
IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_BLANKS, JOINING, FRESH, ONE_MORE, TWO_MORE = range(8)


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether a slice begins at the symbol's character."""
    if symbol == S_LETTER:
        if state in (ONE_MORE, TWO_MORE):
            return (FRESH if state == ONE_MORE else ONE_MORE), False
        return IN_LETTERS, state not in (IN_LETTERS, JOINING)
    if symbol == S_NUMBER:
        return IN_NUMBERS, state not in (IN_NUMBERS, JOINING)
    if symbol in (S_OTHER, S_SHORT, S_LONG):
        if symbol == S_OTHER or state in (IN_OTHERS, JOINING):
            return IN_OTHERS, state not in (IN_OTHERS, JOINING)
        return (ONE_MORE if symbol == S_SHORT else TWO_MORE), True
    if symbol == S_BLANK:
        return IN_BLANKS, state != IN_BLANKS
    return (JOINING if symbol == S_JOINING else FRESH), True


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number of each symbol's function (symbol + 8: at the start of a text), products, their values, where slices begin."""
    functions = [tuple(_step(q, s)[0] for q in range(8)) for s in range(8)]
    functions += [(_step(FRESH, s)[0],) * 8 for s in range(8)]
    known = {f: i for i, f in enumerate(dict.fromkeys([tuple(range(8)), *functions]))}
    todo = list(known)
    while todo:
        f = todo.pop()
        for g in functions:
            if (h := tuple(g[q] for q in f)) not in known:
                known[h] = len(known)
                todo.append(h)
    every = list(known)
    product = np.array([[known[tuple(g[q] for q in f)] for g in every] for f in every], np.uint16)
    begins = np.array([[_step(q, s)[1] for s in range(8)] + [True] * 8 for q in range(8)])
    return np.array([known[f] for f in functions], np.uint16), product, np.array(every, np.uint8), begins


def prefixes(numbers: np.ndarray) -> np.ndarray:
    """Number of the composition of all functions up to and with each position."""
    product = _tables()[1]
    size, flat = len(product), product.ravel()
    if len(numbers) <= 4:
        out = numbers.copy()
        for i in range(1, len(out)):
            out[i] = product[out[i - 1], out[i]]
        return out
    block = min(BLOCK, max(2, int(len(numbers) ** 0.5)))
    rows = -(-len(numbers) // block)
    padded = np.zeros(rows * block, np.uint16)  # number 0 is the identity
    padded[: len(numbers)] = numbers
    inside = np.ascontiguousarray(padded.reshape(rows, block).T).astype(np.intp)
    for j in range(1, block):
        inside[j] = flat[inside[j - 1] * size + inside[j]]
    before = np.concatenate([[0], prefixes(inside[-1].astype(np.uint16))[:-1]]).astype(np.intp)
    return flat[before * size + inside].T.ravel()[: len(numbers)].astype(np.uint16)


@lru_cache(1)
def _classes() -> np.ndarray:
    """Class of every code point."""
    kind = {"L": LETTER, "N": NUMBER, "Z": BLANK}
    out = np.fromiter((kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    out[list(CONTROL_SPACES)], out[32], out[39] = BLANK, SPACE, QUOTE
    return out


def slice_starts(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whether a slice begins at each character of texts laid end to end; starts: first characters of non-empty texts."""
    number, _, value, begins = _tables()
    n = len(codes)
    kinds = _classes()[codes]
    first = np.zeros(n + 1, bool)
    first[starts] = first[n] = True
    blank = (kinds == SPACE) | (kinds == BLANK)
    free = np.empty(n, bool)  # no non-blank of the same text follows
    free[:-1] = blank[1:]
    free |= first[1:]
    symbols = kinds.copy()
    symbols[blank & free] = S_BLANK
    symbols[(kinds == SPACE) & ~free] = S_JOINING
    symbols[(kinds == BLANK) & ~free] = S_LAST_BLANK
    at = np.flatnonzero(kinds == QUOTE)
    if len(at):
        padded = np.concatenate([codes, [0, 0]])
        ended = np.concatenate([first, [True]])
        one, two = np.where(ended[at + 1], 0, padded[at + 1]), np.where(ended[at + 1] | ended[at + 2], 0, padded[at + 2])
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        symbols[at] = np.where(short, S_SHORT, np.where(long, S_LONG, S_OTHER))
    symbols[starts] += 8
    reached = prefixes(number[symbols])
    before = np.empty(n, np.uint8)
    before[:1], before[1:] = FRESH, value[:, FRESH][reached[:-1]]
    return begins.ravel()[before.astype(np.intp) * 16 + symbols]


def _cuts(text: str) -> list[str]:
    """A text in pieces of about TOGETHER characters, cut before single spaces that a non-blank follows."""
    pieces, at = [], 0
    while len(text) - at > TOGETHER:
        end = at + TOGETHER
        while True:
            end = text.find(" ", end, len(text) - 1)
            if end < 0 or _classes()[ord(text[end + 1])] not in (SPACE, BLANK):
                break
            end += 1
        if end < 0:
            break
        pieces.append(text[at:end])
        at = end
    return [*pieces, text[at:]]


class Ranks:
    """Tokens in the order of their ranks; a token's id is its rank."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        if missing := 256 - len({t for t in tokens if len(t) == 1}):
            raise ValueError(f"the ranks lack {missing} of the 256 bytes")
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.kept: dict[bytes, bytes] = {}

    @cached_property
    def id_of(self) -> dict[bytes, int]:
        """Id of each token; only encoding needs it."""
        return {t: i for i, t in enumerate(self.tokens) if t}

    @cached_property
    def packed(self) -> dict[bytes, bytes]:
        """Id of each token as a packed 32-bit integer."""
        return {t: i.to_bytes(4, "little") for t, i in self.id_of.items()}

    def merge(self, word: bytes) -> list[int]:
        """Ids of a slice that is no token: the pair with the lowest rank is joined, the leftmost first."""
        get = self.id_of.get
        if len(word) > SHORT:
            return self._merge_long(word)
        cuts = list(range(len(word) + 1))
        pairs = [get(word[i : i + 2], NEVER) for i in range(len(word) - 1)]
        while pairs and (low := min(pairs)) < NEVER:
            i = pairs.index(low)
            del pairs[i], cuts[i + 1]
            if i < len(pairs):
                pairs[i] = get(word[cuts[i] : cuts[i + 2]], NEVER)
            if i:
                pairs[i - 1] = get(word[cuts[i - 1] : cuts[i + 1]], NEVER)
        return [self.id_of[word[a:b]] for a, b in itertools.pairwise(cuts)]

    def _merge_long(self, word: bytes) -> list[int]:
        """The same for long slices, by a heap of pairs over a linked list."""
        n, get = len(word), self.id_of.get
        end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or end[j] != stop:
                continue
            alive[j], end[i], after[i] = False, stop, after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := get(word[i : end[after[i]]])) is not None:
                    heapq.heappush(heap, (r, i, end[after[i]]))
            if before[i] >= 0 and (r := get(word[before[i] : stop])) is not None:
                heapq.heappush(heap, (r, before[i], stop))
        return [self.id_of[word[i : end[i]]] for i in range(n) if alive[i]]

    def ids(self, word: bytes) -> bytes:
        """Ids of a slice as packed 32-bit integers."""
        found = self.packed.get(word) or self.kept.get(word)
        if found is None:
            found = np.array(self.merge(word), "<i4").tobytes()
            if len(word) <= KEPT_BYTES:
                if len(self.kept) >= KEPT:
                    self.kept.clear()
                self.kept[word] = found
        return found

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each text has."""
        lengths = np.array([len(t) for t in texts], np.int64)
        joined = "".join(texts)
        if not joined:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        data = joined.encode()
        starts = np.cumsum(lengths) - lengths
        at = np.flatnonzero(slice_starts(codes, starts[lengths > 0]))
        if len(data) == len(codes):
            offsets = at
        else:
            width = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
            offsets = (np.cumsum(width) - width)[at]
        offsets = np.append(offsets, len(data)).astype(np.int64)
        slices = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        coded = slices.dictionary_encode()
        which = coded.indices.to_numpy()
        found = [self.ids(w) for w in coded.dictionary.to_pylist()]
        many = np.array([len(f) for f in found], np.int64) // 4
        flat = np.frombuffer(b"".join(found), "<i4")
        each = many[which]
        last = np.cumsum(each)
        out = flat[np.repeat((np.cumsum(many) - many)[which] - (last - each), each) + np.arange(last[-1])]
        text_ends = np.searchsorted(at, starts + lengths)
        counted = np.concatenate([[0], last])[text_ends]
        return out, np.diff(counted, prepend=0)

    def decode(self, ids: np.ndarray, offsets: np.ndarray, total: int) -> bytes:
        """Each token's bytes copied to its offset, total bytes in all."""
        each = self.lengths[ids]
        ends = np.cumsum(each)
        inside = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - each, each)
        out = np.zeros(total, np.uint8)
        out[np.repeat(offsets, each) + inside] = self.bytes[np.repeat(self.first[ids], each) + inside]
        return out.tobytes()


_loaded: dict[str, Ranks] = {}


def _ranks(name: str, shared) -> Ranks:
    """The worker's tables of a broadcast vocabulary; its kept slices live as long as the worker."""
    if name not in _loaded:
        _loaded.clear()
        _loaded[name] = Ranks(shared.value)
    return _loaded[name]


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank of a file with a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens = [b""] * (1 + max(int(rank) for _, rank in pairs))
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def _share(df: DataFrame, tokens: list[bytes]):
    """The vocabulary (its size is that of the file, whatever the table) sent once to each executor."""
    return df.sparkSession.sparkContext.broadcast(tokens), hashlib.sha256(repr(tokens).encode()).hexdigest()


def _groups(texts: list[str | None]):
    """(rows, pieces, row of each piece) of about TOGETHER characters at a time."""
    pieces, rows, size = [], [], 0
    for i, text in enumerate(texts):
        for piece in _cuts(text) if text and len(text) > TOGETHER else [text or ""]:
            pieces.append(piece)
            rows.append(i)
            size += len(piece)
            if size >= TOGETHER:
                yield pieces, rows
                pieces, rows, size = [], [], 0
    if pieces:
        yield pieces, rows


def encode(docs: DataFrame, tokens: list[bytes], text: str = "text") -> DataFrame:
    """docs with ids_ (array of int) and offsets_ (the byte of the text at which each token begins) appended."""
    shared, name = _share(docs, tokens)

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        ranks, texts = _ranks(name, shared), batch.column(text).to_pylist()
        many, parts = np.zeros(len(texts), np.int64), [np.zeros(0, np.int32)]
        for pieces, rows in _groups(texts):
            ids, counts = ranks.encode(pieces)
            parts.append(ids)
            np.add.at(many, rows, counts)
        ids = np.concatenate(parts)
        ends = np.concatenate([[0], np.cumsum(many)])
        bytes_ = np.concatenate([[0], np.cumsum(ranks.lengths[ids])])
        offsets = (bytes_[:-1] - np.repeat(bytes_[ends[:-1]], many)).astype(np.int32)
        mask = pa.array([t is None for t in texts], pa.bool_())
        at = pa.array(ends.astype(np.int32))
        return [pa.ListArray.from_arrays(at, pa.array(ids), mask=mask), pa.ListArray.from_arrays(at, pa.array(offsets), mask=mask)]

    return append_columns(docs, "ids_ array<int>, offsets_ array<int>", make, by=text, size=1 << 20)


def decode(coded: DataFrame, tokens: list[bytes], ids: str = "ids_", offsets: str = "offsets_") -> DataFrame:
    """coded with decoded_ (binary: the bytes of the text) appended."""
    shared, name = _share(coded, tokens)

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        ranks, found, at = _ranks(name, shared), batch.column(ids), batch.column(offsets)
        there = found.is_valid().to_pylist()
        each = np.diff(np.asarray(found.offsets))
        values = np.asarray(found.flatten())
        sizes = np.zeros(len(found), np.int64)
        ends = np.cumsum(each)
        bytes_ = np.concatenate([[0], np.cumsum(ranks.lengths[values])])
        sizes = bytes_[ends] - bytes_[ends - each]
        starts = np.cumsum(sizes) - sizes
        data = ranks.decode(values, np.repeat(starts, each) + np.asarray(at.flatten()), int(sizes.sum()))
        return [pa.array([data[a : a + n] if ok else None for a, n, ok in zip(starts.tolist(), sizes.tolist(), there, strict=True)], pa.binary())]

    return append_columns(coded, "decoded_ binary", make, by=ids, size=1 << 18)


def decode_span(coded: DataFrame, tokens: list[bytes], start: str, stop: str, ids: str = "ids_", offsets: str = "offsets_") -> DataFrame:
    """coded with decoded_ (binary): bytes start to stop (columns, stop exclusive) of the text, from the tokens that hold them.

    A null start, stop or list of ids gives null; a span that reaches out of the text is cut to it.
    """
    shared, name = _share(coded, tokens)

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        ranks = _ranks(name, shared)
        rows = zip(*(batch.column(c).to_pylist() for c in (ids, offsets, start, stop)), strict=True)

        def one(found, at, a, b):
            if found is None or a is None or b is None:
                return None
            a, left = max(0, a), np.searchsorted(at, max(0, a), "right") - 1
            held = found[max(0, left) : int(np.searchsorted(at, b))]
            return b"".join(ranks.tokens[i] for i in held)[a - at[max(0, left)] :][: max(0, b - a)] if held else b""

        return [pa.array([one(*row) for row in rows], pa.binary())]

    return append_columns(coded, "decoded_ binary", make)
