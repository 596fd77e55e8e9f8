"""SentencePiece encoding and decoding.

An Aho-Corasick automaton over the pieces reads the text once; at each position its output links give every
piece that ends there, and each relaxes the best segmentation up to that position.

* Unigram models: the best segmentation has the largest sum of piece scores (Viterbi).
* BPE models: the sum of ranks is not what the model means. A segmentation is the BPE one exactly if merging
  leaves each two neighbours apart, so the relaxation admits a piece only after a neighbour it is compatible
  with; one segmentation survives at each position, and the ids equal those of the merge procedure.

No piece crosses the start of a run of spaces or a line break (checked when the model is read; otherwise texts
are taken whole), so units between them are encoded independently and common units are kept in a bounded table.
Characters without a piece become byte pieces. A literal U+2581, which stands for a space inside pieces, is also
written as bytes, so that decoding gives back every text exactly.

Defined results: null gives null, an empty text no pieces, an empty table an empty one; among equal sums of scores the
segmentation found first stays, which ends in the longer piece; repeated rows and other columns pass unchanged, but for columns that have the name of a new one (`ids_`, `decoded_`), which are replaced.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import append_columns

SPACE = "▁"
#: Piece types and model types of the model file (fixed values).
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Units kept with their ids per worker, and the longest that is kept.
KEPT_UNITS, KEPT_LENGTH = 250_000, 48


def _fields(data: bytes):
    """(number, value) of each field of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or varint()
            yield tag >> 3, data[at : at + size]
            at += size


@dataclass
class PieceModel:
    """Pieces, scores and settings of a model file."""

    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    types: list[int] = field(default_factory=list)
    kind: int = UNIGRAM
    prefix: bool = True

    @classmethod
    def parse(cls, data: bytes) -> PieceModel:
        model = cls()
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                model.pieces.append(piece.get(1, b"").decode())
                model.scores.append(float(np.frombuffer(piece.get(2, b"\0\0\0\0"), "<f4")[0]))
                model.types.append(piece.get(3, NORMAL))
            elif number == 2:
                model.kind = dict(_fields(value)).get(3, UNIGRAM)
            elif number == 3:
                settings = dict(_fields(value))
                model.prefix = bool(settings.get(3, 1))
                if settings.get(1, b"identity") != b"identity" or settings.get(4, 1):
                    raise ValueError("only models without normalisation are supported")
        if USER in model.types:
            raise ValueError("user-defined pieces are not supported")
        if model.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        return model

    def name(self) -> str:
        """A digest that tells models apart."""
        return hashlib.sha256(repr(self).encode()).hexdigest()


class Codec:
    """Encoder and decoder of one model."""

    def __init__(self, model: PieceModel):
        import ahocorasick

        self.model = model
        normal = {p: i for i, (p, t) in enumerate(zip(model.pieces, model.types, strict=True)) if t == NORMAL and p}
        self.id_of = normal
        self.bytes_at = [0] * 256
        self.unknown = model.types.index(UNKNOWN) if UNKNOWN in model.types else 0
        self.has_bytes = BYTE in model.types
        for i, (p, t) in enumerate(zip(model.pieces, model.types, strict=True)):
            if t == BYTE:
                self.bytes_at[int(p[3:5], 16)] = i
        self.automaton = ahocorasick.Automaton()
        for p, i in normal.items():
            self.automaton.add_word(p, (len(p), i))
        self.automaton.make_automaton()
        self.letters = {c for p in normal for c in p}
        self.joined = {p[i : i + 2].replace(SPACE, " ") for p in normal for i in range(len(p) - 1)}
        inner = any(SPACE in p[1:] and p.strip(SPACE) for p in normal)
        lines = any("\n" in p for p in normal)
        self.units = re.compile(".+" if inner else " *[^ ]+| +" if lines else " *[^ \n]+|\n| +", re.DOTALL).findall
        self.kept: dict[str, bytes] = {}
        self.apart: dict[int, bool] = {}
        self.text_of = [
            bytes([int(p[3:5], 16)]) if t == BYTE else p.replace(SPACE, " ").encode() if t == NORMAL else b""
            for p, t in zip(model.pieces, model.types, strict=True)
        ]

    def _merged(self, text: str) -> list[int]:
        """BPE by the merge procedure itself: best score first, then leftmost."""
        parts, get, scores = list(text), self.id_of.get, self.model.scores
        while True:
            best = None
            for i in range(len(parts) - 1):
                found = get(parts[i] + parts[i + 1])
                if found is not None and (best is None or scores[found] > best[0]):
                    best = (scores[found], i)
            if best is None:
                return [get(p, -1) for p in parts]
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]

    def _compatible(self, left: int, right: int) -> bool:
        if len(self.apart) > 2 * KEPT_UNITS:
            self.apart.clear()
        pieces = self.model.pieces
        known = self.apart[left << 32 | right] = self._merged(pieces[left] + pieces[right]) == [left, right]
        return known

    def _best(self, text: str) -> list[int] | None:
        """Ids of the best segmentation of a text whose characters all occur in pieces; None if there is none."""
        n = len(text)
        last, came = [-1] * (n + 1), [0] * (n + 1)
        reached = [True] + [False] * n
        if self.model.kind == BPE:
            known = self.apart.get
            for end, (size, piece) in self.automaton.iter(text):
                end += 1
                if reached[end]:
                    continue
                start = end - size
                if reached[start]:
                    if start:
                        apart = known(last[start] << 32 | piece)
                        if apart is False or (apart is None and not self._compatible(last[start], piece)):
                            continue
                    reached[end], last[end], came[end] = True, piece, start
        else:
            scores, best = self.model.scores, [0.0] * (n + 1)
            for end, (size, piece) in self.automaton.iter(text):
                start = end + 1 - size
                if reached[start]:
                    score = best[start] + scores[piece]
                    if not reached[end + 1] or score > best[end + 1]:
                        reached[end + 1], best[end + 1], last[end + 1], came[end + 1] = True, score, piece, start
        if not reached[n]:
            return None
        ids, at = [], n
        while at:
            ids.append(last[at])
            at = came[at]
        return ids[::-1]

    def _bytes(self, char: str) -> list[int]:
        return [self.bytes_at[b] for b in char.encode()] if self.has_bytes else [self.unknown]

    def _piecewise(self, run: str) -> list[int]:
        """A run that no piece boundary splits; characters that pieces hold only together fall back to bytes."""
        ids = self._best(run)
        if ids is None and self.model.kind == BPE:
            ids = []
            parts = self._merged(run)
            at = 0
            for i in parts:
                size = len(self.model.pieces[i]) if i >= 0 else 1
                ids += [i] if i >= 0 else self._bytes(run[at])
                at += size
        elif ids is None:
            single = [i for i, c in enumerate(run) if c not in self.id_of]
            ids, at = [], 0
            for i in [*single, len(run)]:
                ids += (self._best(run[at:i]) or []) + (self._bytes(run[i]) if i < len(run) else [])
                at = i + 1
        return ids

    def unit(self, unit: str) -> bytes:
        """Ids of one unit as packed 32-bit integers. Last characters that no piece joins to the one before stand alone."""
        end, joined = len(unit), self.joined
        while end > 1 and unit[end - 1] != " " and unit[end - 2 : end] not in joined:
            end -= 1
        if end == len(unit):
            return self._whole(unit)
        get, whole = self.kept.get, self._whole
        return b"".join([get(part) or whole(part) for part in (unit[:end], *unit[end:])])

    def _whole(self, unit: str) -> bytes:
        """Ids of a unit, cut wherever no piece joins a character to the one before."""
        ids: list[int] = []
        run = before = ""
        for c in unit:
            if run and before + c not in self.joined:
                ids += self._piecewise(run)
                run = ""
            before = c
            if c == SPACE or (c != " " and c not in self.letters) or (c == " " and SPACE not in self.letters):
                if run:
                    ids += self._piecewise(run)
                ids += self._bytes(c)
                run = ""
            else:
                run += SPACE if c == " " else c
        if run:
            ids += self._piecewise(run)
        packed = np.array(ids, "<i4").tobytes()
        if len(unit) <= KEPT_LENGTH:
            if len(self.kept) >= KEPT_UNITS:
                self.kept.clear()
            self.kept[unit] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """Ids of a text as packed 32-bit integers."""
        if not text:
            return b""
        get, unit = self.kept.get, self.unit
        return b"".join([get(u) or unit(u) for u in self.units(" " + text if self.model.prefix else text)])

    def decode(self, ids: list[int]) -> str:
        """The text of a list of ids."""
        text = b"".join([self.text_of[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.model.prefix and text[:1] == " " else text


_codecs: dict[str, Codec] = {}


def _codec(name: str, model) -> Codec:
    """The worker's codec of a broadcast model; built once, its table of units lives as long as the worker."""
    if name not in _codecs:
        _codecs.clear()
        _codecs[name] = Codec(model.value)
    return _codecs[name]


def read_model(path: str) -> PieceModel:
    with open(path, "rb") as f:
        return PieceModel.parse(f.read())


def encode(docs: DataFrame, model: PieceModel, text: str = "text", name_of_ids: str = "ids_") -> DataFrame:
    """docs with the ids (array of int) appended under a name."""
    shared, name = docs.sparkSession.sparkContext.broadcast(model), model.name()

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        codec = _codec(name, shared)
        packed = [None if t is None else codec.encode(t) for t in batch.column(text).to_pylist()]
        offsets = np.concatenate([[0], np.cumsum([len(p or b"") // 4 for p in packed])]).astype(np.int32)
        values = pa.array(np.frombuffer(b"".join(p or b"" for p in packed), "<i4"))
        mask = pa.array([p is None for p in packed], pa.bool_())
        return [pa.ListArray.from_arrays(pa.array(offsets), values, mask=mask)]

    return append_columns(docs, f"`{name_of_ids}` array<int>", make)


def decode(coded: DataFrame, model: PieceModel, ids: str = "ids_") -> DataFrame:
    """coded with decoded_ (string) appended."""
    shared, name = coded.sparkSession.sparkContext.broadcast(model), model.name()

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        codec, column = _codec(name, shared), batch.column(ids)
        values, ends = np.asarray(column.values), np.asarray(column.offsets)
        texts = [
            codec.decode(values[a:b].tolist()) if there else None
            for a, b, there in zip(ends[:-1].tolist(), ends[1:].tolist(), column.is_valid().to_pylist(), strict=True)
        ]
        return [pa.array(texts, pa.string())]

    return append_columns(coded, "decoded_ string", make)
