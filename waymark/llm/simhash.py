"""SimHash near-duplicates linked by Golay-code fuzzy hashing.

Fingerprints: XXH64 (seed 42) of every 4-word shingle, a bit set where over half of the hashes have it.

Linking at 4 or fewer differing bits: the 64 bits are cut into segments of 22, 21 and 21 bits. If some segment
is free of errors, its value is a common key. Otherwise every segment has an error, so at most one has two, and
in some pair of segments both have exactly one. The perfect (23, 12) Golay code maps each segment to codewords:
a vector lies within 3 bits of one codeword, and where it lies at exactly 3, five more codewords lie at 4. Of two
vectors one bit apart one has even weight; it emits its own codeword, the odd one emits all of its (1 or 6), and
they share at least one. A key is the pair of 12-bit codeword indices. So no link is missed.

Rows that share a key are compared exactly. Keys with more rows than a block are cut into blocks, and pairs of
blocks are compared in tasks of their own; a block comparison emits a spanning forest of its links, never all
pairs. Equal fingerprints are merged before all this.

Defined results: null and empty texts have fingerprint zero, linked like any other; repeated rows and ids are
kept; component_id is the smallest non-null doc_id reachable, over rows without an id as well (null if there is
none); an empty table gives an empty result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, forget, materialise, renamed, small_side

SHINGLE, SEED, MAX_BITS = 4, 42, 4
#: Bits of the three segments, and rows of a key that are compared at once.
SEGMENTS, BLOCK = (22, 21, 21), 1024
#: Shingles hashed at once, which bounds a worker's memory for long texts.
CHUNK = 1 << 16
#: Generator polynomial of the (23, 12) Golay code (fixed value).
GOLAY = 0xAE3


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """SimHash of one text, given as UTF-8."""
    import xxhash

    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    starts, ends = (starts[: len(words) - size + 1], ends[size - 1 :]) if len(words) >= size else (starts[:1], ends[-1:])
    ones = np.zeros(64, np.int64)
    hash64 = xxhash.xxh64_intdigest
    for at in range(0, len(starts), CHUNK):
        spans = zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist(), strict=True)
        hashes = np.array([hash64(joined[s:e], SEED) for s, e in spans], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = 2 * ones > len(starts)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        prints = pa.array([fingerprint(t) for t in texts], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), prints], ["doc_id", "row", "print"])


@lru_cache(maxsize=1)
def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of 12-bit halves, the error of each syndrome, and the 5 codeword offsets at distance 4 from a weight-3 error."""

    def syndrome(v: np.ndarray) -> np.ndarray:
        v = v.copy()
        for bit in range(22, 10, -1):
            v ^= np.where(v >> bit & 1, GOLAY << (bit - 11), 0)
        return v

    single = 1 << np.arange(23)
    pairs = np.array([single[i] | single[j] for i in range(23) for j in range(i)])
    triples = np.array([single[i] | single[j] | single[k] for i in range(23) for j in range(i) for k in range(j)])
    errors = np.concatenate([[0], single, pairs, triples])
    error_of = np.zeros(2048, np.int64)
    error_of[syndrome(errors)] = errors
    every = np.arange(4096, dtype=np.int64) << 11
    codewords = every | syndrome(every)
    sevens = codewords[np.bitwise_count(codewords) == 7]
    offsets = np.zeros((2048, 5), np.int64)
    for t in triples:
        offsets[syndrome(np.array([t]))[0]] = sevens[(sevens & t) == t]
    return np.concatenate([syndrome(every), syndrome(np.arange(2048))]), error_of, offsets


def codeword_keys(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the codewords that each 23-bit vector emits (n, 6), and which of them count."""
    syndromes, error_of, offsets = golay_tables()
    s = syndromes[v >> 11] ^ syndromes[4096 + (v & 2047)]
    error = error_of[s]
    own = v ^ error
    keys = np.concatenate([own[:, None], own[:, None] ^ offsets[s]], axis=1) >> 11
    more = (np.bitwise_count(error) == 3) & (np.bitwise_count(v) & 1 == 1)
    return keys, np.concatenate([np.ones((len(v), 1), bool), np.repeat(more[:, None], 5, axis=1)], axis=1)


def link_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every blocking key of 64-bit fingerprints."""
    v = prints.view(np.uint64)
    parts, at = [], 0
    for width in SEGMENTS:
        parts.append((v >> np.uint64(at) & np.uint64((1 << width) - 1)).astype(np.int64))
        at += width
    rows = [np.arange(len(v))] * 3
    keys = [(i << 32) | p for i, p in enumerate(parts)]
    coded = [codeword_keys(p) for p in parts]
    for n, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
        (a, a_on), (b, b_on) = coded[i], coded[j]
        on = a_on[:, :, None] & b_on[:, None, :]
        both = (a[:, :, None] << 12) | b[:, None, :]
        rows.append(np.nonzero(on)[0])
        keys.append(((3 + n) << 32) | both[on])
    return np.concatenate(rows), np.concatenate(keys)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints, reps = (np.asarray(batch.column(i)) for i in (0, 1))
        for at in range(0, len(prints), 8192):
            rows, keys = link_keys(prints[at : at + 8192])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(prints[at : at + 8192][rows]), pa.array(reps[at : at + 8192][rows])], ["key", "print", "rep"]
            )


def forest(prints: np.ndarray, reps: np.ndarray) -> tuple[list, list]:
    """Edges of a spanning forest of the links among these rows."""
    v = prints.view(np.uint64)
    left = np.arange(len(v))
    a, b = [], []
    while len(left) > 1:
        root, left, front = left[0], left[1:], left[:1]
        while len(front) and len(left):
            near = np.zeros(len(left), bool)
            for f in front:
                near |= np.bitwise_count(v[left] ^ v[f]) <= MAX_BITS
            front, left = left[near], left[~near]
            a += [reps[root]] * len(front)
            b += reps[front].tolist()
    return a, b


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by (key, i, j); a group holds at most two blocks."""

    def edges(key: np.ndarray, prints: np.ndarray, reps: np.ndarray) -> pa.RecordBatch:
        cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(key)]])
        a, b = [], []
        pairs = starts[ends - starts == 2]
        close = pairs[np.bitwise_count(prints[pairs].view(np.uint64) ^ prints[pairs + 1].view(np.uint64)) <= MAX_BITS]
        a += reps[close].tolist()
        b += reps[close + 1].tolist()
        for s, e in zip(starts[ends - starts > 2].tolist(), ends[ends - starts > 2].tolist(), strict=True):
            x, y = forest(prints[s:e], reps[s:e])
            a += x
            b += y
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    rest = None
    for batch in batches:
        now = [np.stack([np.asarray(batch.column(i)).astype(np.int64) for i in range(3)], axis=1), *(np.asarray(batch.column(i)) for i in (3, 4))]
        if rest is not None:
            now = [np.concatenate(x) for x in zip(rest, now, strict=True)]
        if not len(now[0]):
            continue
        last = int(np.flatnonzero((now[0] != now[0][-1]).any(axis=1)).max(initial=-1)) + 1
        rest = [x[last:] for x in now]
        if last:
            yield edges(*(x[:last] for x in now))
    if rest is not None and len(rest[0]):
        yield edges(*rest)


def link(prints: DataFrame, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) between reps of distinct fingerprints (print, rep) that differ in at most 4 bits; a spanning forest of each block."""
    keys = prints.select("print", "rep").mapInArrow(_keys, "key long, print long, rep long")
    crowded = keys.groupBy("key").count().where(F.col("count") > block)
    crowded = materialise(crowded.select("key", F.ceil(F.col("count") / block).cast("int").alias("blocks")))
    placed = keys.join(small_side(crowded), "key", "left").withColumn(
        "own", F.when(F.col("blocks").isNull(), 0).otherwise(F.pmod(F.xxhash64("print"), F.col("blocks")).cast("int"))
    )
    others = F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = placed.withColumn("other", F.explode(others)).select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "print", "rep"
    )
    return placed.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(_links, "a long, b long").distinct()


def simhash_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per input row: key, row (hash of the text), print (signed 64-bit fingerprint), component_id.

    The nodes of the graph are fingerprints, whatever ids their rows have. What is aggregated by fingerprint is
    written before it is joined back, so that a crowded fingerprint is no group of an aggregate in the join's stage.
    """
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("row"))
    prints = materialise(texts.mapInArrow(_fingerprints, "doc_id long, row long, print long"))
    nodes = materialise(prints.groupBy("print").agg(F.min("doc_id").alias("least")))
    found = materialise(components(link(nodes.select("print", F.col("print").alias("rep")), block)))
    rooted = nodes.join(small_side(found), F.col("print") == F.col("node"), "left").select(
        F.col("print").alias("of"), F.coalesce("component", "print").alias("root"), "least"
    )
    rooted = materialise(rooted)
    least = materialise(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    groups = materialise(rooted.join(small_side(least), "root").select("of", "component_id", "root"))
    forget(nodes, found, rooted, least)
    out = prints.join(small_side(groups), F.col("print") == F.col("of"))
    return out.select(F.col("doc_id").alias(key), "row", "print", "component_id", "root")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with one row of each group: the smallest id, then the smallest hash of the text. Columns are unchanged."""
    groups = simhash_groups(docs.select(key, text), key, text)
    named = F.col(key).isNull().alias("unnamed")
    first = groups.groupBy("root").agg(F.min(F.struct(named, F.col(key).alias("id"), F.col("row").alias("row"))).alias("first"))
    id_, row = renamed(docs, "id", "row")
    first = materialise(first.select(F.col("first.id").alias(id_), F.col("first.row").alias(row)))
    kept = docs.join(small_side(first), F.col(key).eqNullSafe(F.col(id_)) & F.xxhash64(text).eqNullSafe(F.col(row)))
    return kept.dropDuplicates([id_, row]).select(*docs.columns)
