"""Importance resampling towards a target distribution: hashed n-grams of whole texts weigh documents.

Texts are read in portions of a partition. The words of a portion (digits, letters with A-Z in lower case, and all
characters beyond ASCII) are interned to ids; a suffix array over the ids, ordered as deep as the longest n-gram,
puts all occurrences of an n-gram side by side, so that the runs of its table of common prefixes are the distinct
n-grams of the portion. Each run is hashed once and its bucket scattered back to the run's occurrences.

Bucket counts of both tables are added up within a task before they are shuffled: a task passes on at most `buckets`
rows, whatever it read. The gain of each bucket (its log ratio of smoothed shares) goes to all tasks as one array of
`buckets` numbers, and a second pass over the texts adds up the gains of each document's features. A Gumbel number
drawn from a hash of the id is added, and the documents with the highest scores are drawn, which is sampling without
replacement in proportion to the weights. Ranks come from a range partitioning by score: rows are numbered within
their range, and a range begins where the counts of the ranges before it end, so no task holds all rows.

Defined results: a null text has no words, an empty one neither (weight 0); a null id is hashed as empty text and
comes before others among equal scores; equal scores go to the smaller id, repeated rows are ranked one after another
in any order; an empty target or an empty table of documents weighs by the smoothing alone. The result holds the key
and the new columns; the key must not have the name of one of them. Other columns of docs are not read.
"""

from __future__ import annotations

import string
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import append_columns, materialise, portions

NEW = ("words_", "features_", "weight_", "score_", "rank_")
#: Bytes of words after A-Z have become lower-case, and that mapping.
LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())
IN_WORD = np.array([b >= 0x80 or chr(b) in string.digits + string.ascii_lowercase for b in range(256)])


def words_of(texts: list[str | None]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words, the id of each word of the texts end to end, and the text that it belongs to."""
    coded = [(t or "").encode() for t in texts]
    data = np.frombuffer(b" ".join(coded).translate(LOWER), np.uint8)
    inside = IN_WORD[data]
    edges = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(starts):
        return [], np.zeros(0, np.int64), np.zeros(0, np.int64)
    offsets = np.append(0, np.cumsum(ends - starts))
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
    found = words.dictionary_encode()
    first = np.cumsum([0, *(len(c) + 1 for c in coded)])
    return found.dictionary.to_pylist(), found.indices.to_numpy().astype(np.int64), np.searchsorted(first, starts, "right") - 1


def suffix_array(ids: np.ndarray, owner: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of the next `depth` words of their text, and how many of these each shares with the place before."""
    n = len(ids)
    rank, width = ids + 1, 1

    def later(values: np.ndarray, by: int) -> np.ndarray:
        """The value `by` places on in the same text, 0 beyond its end."""
        out = np.zeros(n, np.int64)
        if by < n:
            out[: n - by] = np.where(owner[by:] == owner[: n - by], values[by:], 0)
        return out

    while width < depth:
        rank = np.unique(rank * (rank.max() + 1) + later(rank, width), return_inverse=True)[1] + 1
        width *= 2
    order = np.argsort(rank, kind="stable")
    shared, equal = np.zeros(n, np.int64), np.ones(n - 1, bool)
    for k in range(depth):
        ahead = later(ids + 1, k)[order] if k else (ids + 1)[order]
        equal &= (ahead[1:] == ahead[:-1]) & (ahead[1:] > 0)
        shared[1:] += equal
    return order, shared


def bucket_features(texts: list[str | None], low: int, high: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket) of each run of low to high consecutive words, and the number of words of each text."""
    words, ids, owner = words_of(texts)
    many = np.bincount(owner, minlength=len(texts))
    if not len(ids):
        return owner, ids, many
    order, shared = suffix_array(ids, owner, high)
    left = np.cumsum(many)[owner] - np.arange(len(ids))  # words from a place to the end of its text
    owners, found = [], []
    for k in range(low, high + 1):
        whole = left[order] >= k
        head = shared < k
        heads = order[head & whole]
        grams = [b" ".join([words[i] for i in ids[a : a + k]]) for a in heads.tolist()] if k > 1 else [words[i] for i in ids[heads].tolist()]
        hashed = np.array([zlib.crc32(g) % buckets for g in grams], np.int64)
        places = order[whole]
        owners.append(owner[places])
        found.append(hashed[np.cumsum(head[whole]) - 1])
    return np.concatenate(owners), np.concatenate(found), many


def bucket_counts(texts: DataFrame, text: str, low: int, high: int, buckets: int) -> DataFrame:
    """(bucket, n) of all features of the texts, at most `buckets` rows; one that no feature has is left out."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for whole in batches:
            for batch in portions(whole, text, 1 << 21):
                total += np.bincount(bucket_features(batch.column(text).to_pylist(), low, high, buckets)[1], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    return texts.select(text).mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, text: str, low: int, high: int, buckets: int) -> np.ndarray:
    """Per bucket the floor of 1000 times the log ratio of its smoothed shares in target and docs."""
    both = bucket_counts(docs, text, low, high, buckets).select(F.lit(0).alias("side"), "bucket", "n")
    both = both.unionByName(bucket_counts(target, text, low, high, buckets).select(F.lit(1).alias("side"), "bucket", "n"))
    counts = np.zeros((2, buckets))
    for row in both.collect():  # at most two rows a bucket
        counts[row.side, row.bucket] = row.n
    s, t = counts
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def _numbered(rows: DataFrame, first: int, order: list) -> DataFrame:
    """rows with rank_: 1, 2, 3 ... in the order for the `first` first ones, null for the others; no task holds all rows."""
    spark = rows.sparkSession
    dealt = materialise(rows.repartitionByRange(*order).withColumn("range_", F.spark_partition_id()))
    before, begins = 0, []
    for row in sorted(dealt.groupBy("range_").count().collect()):  # one row a partition
        if before < first:
            begins.append((row[0], before))
        before += row[1]
    known = F.broadcast(spark.createDataFrame(begins, "range_ int, begins_ long"))
    place = F.row_number().over(Window.partitionBy("range_").orderBy(*order))
    ranked = dealt.join(known, "range_").withColumn("rank_", F.col("begins_") + place)
    ranked = ranked.withColumn("rank_", F.when(F.col("rank_") <= first, F.col("rank_")))
    others = dealt.join(known, "range_", "left_anti").withColumn("rank_", F.lit(None).cast("long"))
    return ranked.select(*rows.columns, "rank_").unionByName(others.select(*rows.columns, "rank_"))


def importance_sample(
    docs: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    low: int = 1,
    high: int = 1,
    buckets: int = 10_000,
    percent: int = 10,
    least_words: int = 20,
    seed: str = "2024",
) -> DataFrame:
    """One row per document: key, words_, features_, weight_, score_ and rank_ (1, 2, 3 ... of the drawn, else null).

    Features are all runs of low to high consecutive words; of the documents with at least least_words words, percent
    in a hundred are drawn. target holds texts in a column of the same name.
    """
    if key.lower() in (*NEW, "row_"):
        raise ValueError(f"the key must not be named {key}")
    docs = docs.select(F.col(key), F.col(text).alias("text_")) if key != text else docs.select(F.col(key), F.col(key).alias("text_"))
    target = target.select(F.col(text).alias("text_"))
    shared = docs.sparkSession.sparkContext.broadcast(bucket_gains(docs, target, "text_", low, high, buckets))

    def weigh(batch: pa.RecordBatch) -> list[pa.Array]:
        owner, found, many = bucket_features(batch.column("text_").to_pylist(), low, high, buckets)
        order = np.argsort(owner, kind="stable")
        sums = np.append(0, np.cumsum(shared.value[found[order]]))
        ends = np.searchsorted(owner[order], np.arange(len(many) + 1))
        return [pa.array(a.astype(np.int64)) for a in (many, np.diff(ends), np.diff(sums[ends]))]

    weighed = append_columns(docs, "words_ bigint, features_ bigint, weight_ bigint", weigh, by="text_", without="text_")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    drawn = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    scored = weighed.withColumn("score_", F.col("weight_") + drawn).withColumn("row_", F.monotonically_increasing_id())
    scored = materialise(scored)
    long = scored.where(F.col("words_") >= least_words)
    order = [F.col("score_").desc(), F.col(key).asc_nulls_first(), F.col("row_").asc()]
    ranked = _numbered(long, long.count() * percent // 100, order)
    short = scored.where(F.col("words_") < least_words).withColumn("rank_", F.lit(None).cast("long"))
    return ranked.unionByName(short).drop("row_")
