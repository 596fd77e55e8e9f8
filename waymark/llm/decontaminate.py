"""Benchmark decontamination by winnowing, in DataFrame functions only.

Both sides keep the smallest hash of k consecutive words in every run of w consecutive k-grams (ties: the
rightmost). With k + w - 1 = window, two texts that share any window keep the same k-gram of it, so joining the
fingerprints finds every shared window. A match fixes a diagonal (document position minus item position); it is
then extended over the whole overlap, comparing words, which makes the result exact whatever the hashes do.

Defined results: null and empty texts have no words; rows are judged one by one, repeated rows and repeated ids
alike; items with a null id are skipped; an item shorter than the window is one window of its own length; an
empty benchmark leaves every document clean, an empty table of documents gives an empty one. Extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, let, materialise, sliding, small_side

#: Words of a window, and of a hashed k-gram at most.
WINDOW, GRAM = 13, 5
#: Low bits of a packed fingerprint: the position, inverted so that the rightmost of equal hashes is least.
POSITION = (1 << 28) - 1
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words_of(text: Column) -> Column:
    """Lower-cased words; an empty array for null."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def winnow(words: Column, window: int, gram: int = GRAM) -> Column:
    """Packed fingerprints of a word array that guarantee a common one in any shared run of window words."""
    k = min(gram, window)

    def packed(hashes: Column) -> Column:
        grams = sliding(hashes, k, lambda a, b: F.xxhash64(a, b), exact=True)
        placed = F.transform(
            F.slice(grams, 1, F.size(hashes) - (k - 1)),
            lambda g, i: g.bitwiseAND(F.lit(~POSITION)).bitwiseOR(F.lit(POSITION) - i.cast("long")),
        )
        least = let(placed, lambda p: sliding(p, window - k + 1, lambda a, b: F.least(a, b), exact=False))
        return F.array_distinct(F.slice(least, 1, F.size(hashes) - (window - 1)))

    empty = F.array().cast("array<bigint>")
    seeded = F.transform(words, lambda w: F.xxhash64(F.lit(window), w))
    return F.when(F.size(words) >= window, let(seeded, packed)).otherwise(empty)


def _split(packed: str) -> tuple[Column, Column]:
    col = F.col(packed)
    return col.bitwiseAND(F.lit(~POSITION)), (F.lit(POSITION) - col.bitwiseAND(F.lit(POSITION))).cast("int")


def fingerprint_hits(docs: DataFrame, items: DataFrame, window: int, gram: int) -> DataFrame:
    """(key, row, n_words, item_id, diagonal): one row without an item for each document, and one for each match.

    One pass over the texts: a document's fingerprints and a null that stands for the document are exploded
    together; only that null and fingerprints that the index holds go on.
    """
    sizes = sorted(r[0] for r in items.select("size").distinct().collect())  # at most `window` values
    parts = [
        items.where(F.col("size") == n).select("item_id", F.explode(winnow(F.col("item_words"), n, gram)).alias("f"))
        for n in sizes
    ]
    itself = F.array(F.lit(None).cast("bigint"))
    counted = docs.select("key", "row", words_of(F.col("text")).alias("words")).select(
        "key",
        "row",
        F.size("words").alias("n_words"),
        F.concat(itself, *[winnow(F.col("words"), n, gram) for n in sizes]).alias("fs"),
    )
    rows = counted.select("key", "row", "n_words", F.explode("fs").alias("f"))
    if not parts:
        return rows.select("key", "row", "n_words", F.lit(None).cast("string").alias("item_id"), F.lit(0).alias("diagonal"))
    print_of, at_of = _split("f")
    index = reduce(DataFrame.unionByName, parts)
    index = index.select("item_id", print_of.alias("print"), at_of.alias("at_item")).distinct()
    rows = rows.select("key", "row", "n_words", print_of.alias("print"), at_of.alias("at_doc"))
    hits = rows.join(small_side(index), "print", "left").where("print IS NULL OR item_id IS NOT NULL")
    return hits.select("key", "row", "n_words", "item_id", (F.col("at_doc") - F.col("at_item")).alias("diagonal"))


def _starts(hit: Column, words: Column) -> Column:
    """Document positions where a window of the hit's item begins on its diagonal."""
    low = F.greatest(F.lit(0), -hit["diagonal"])
    high = F.least(F.size(hit["item_words"]), F.size(words) - hit["diagonal"]) - hit["size"]
    inside = F.filter(
        F.sequence(low, high),
        lambda i: F.slice(words, i + hit["diagonal"] + 1, hit["size"]) == F.slice(hit["item_words"], i + 1, hit["size"]),
    )
    return F.when(high >= low, F.transform(inside, lambda i: i + hit["diagonal"])).otherwise(F.array().cast("array<int>"))


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    share: int = 20,
) -> DataFrame:
    """One row per input row: key, row (hash of the text), n_words, n_hit, items (sorted strings), contaminated.

    A document is contaminated if some word is hit and at least one word in `share` is. Only texts with a
    matching fingerprint are tokenised a second time.
    """
    base = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("row"), F.col(text).alias("text"))
    items = benchmark.select(F.col(item_key).cast("string").alias("item_id"), words_of(F.col(item_text)).alias("item_words"))
    items = items.withColumn("size", F.least(F.size("item_words"), F.lit(window)))
    items = items.where("size > 0 AND item_id IS NOT NULL").distinct()
    rows = materialise(fingerprint_hits(base, items, window, gram))

    hits = rows.where("item_id IS NOT NULL").select("key", "row", "item_id", "diagonal").distinct().join(items, "item_id")
    hits = hits.groupBy(F.col("key").alias("hit_key"), F.col("row").alias("hit_row")).agg(
        F.collect_list(F.struct("item_id", "diagonal", "item_words", "size")).alias("hits")
    )
    texts = base.join(hits, F.col("key").eqNullSafe(F.col("hit_key")) & (F.col("row") == F.col("hit_row")))
    texts = texts.select("hit_key", "hit_row", "hits", words_of(F.col("text")).alias("words"))
    found = F.transform(
        "hits",
        lambda h: F.struct(h["item_id"].alias("item_id"), _starts(h, F.col("words")).alias("starts"), h["size"].alias("size")),
    )
    found = texts.select("hit_key", "hit_row", F.filter(found, lambda f: F.size(f["starts"]) > 0).alias("found"))
    spans = F.transform("found", lambda f: F.flatten(F.transform(f["starts"], lambda s: F.sequence(s, s + f["size"] - 1))))
    found = found.select(
        "hit_key",
        "hit_row",
        F.size(F.array_distinct(F.flatten(spans))).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.transform("found", lambda f: f["item_id"]))).alias("items"),
    ).dropDuplicates(["hit_key", "hit_row"])
    every = rows.where("item_id IS NULL").select("key", "row", F.col("n_words").cast("long").alias("n_words"))
    out = every.join(found, F.col("key").eqNullSafe(F.col("hit_key")) & (F.col("row") == F.col("hit_row")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select(
        F.col("key").alias(key),
        "row",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
    )
