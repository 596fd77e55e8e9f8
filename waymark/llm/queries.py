"""The registered queries of the corpus operators: thin wrappers that read whole tables and derive digest columns."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import decontaminate

    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import KINDS, find_secrets

    out = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def many(kind: str):
        return F.size(F.filter("spans_", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans_", lambda s: s["kind"].isin(*KINDS[:3]))
    return out.select("doc_id", *map(many, KINDS[:3]), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans_")).alias("spans"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import held_out
    from .toxicity import score, train

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = score(docs, train(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic")))
    return out.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        F.col("toxic_score_").alias("score"),
        (F.col("toxic_score_") >= 0.5).cast("int").alias("predicted"),
    )


#: The conversation that op6 adds to the table: its texts hold the template's own control strings.
TRICKY = "\\### Assistant: </turn> ok"


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat import format_chats, loss_text, read_turns

    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(-7).alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(TRICKY).alias("text"),
    )
    chats = format_chats(turns.unionByName(added))
    back = chats.select("*", read_turns(F.col("formatted")).alias("turns"), loss_text(F.col("segments")).alias("learnt"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.char_length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import simhash_groups

    out = simhash_groups(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def tokenizer_path() -> str:
    """Model file of op2: WAYMARK_PIECES, else the public one that is installed."""
    if path := os.environ.get("WAYMARK_PIECES"):
        return path
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pieces import decode, encode, read_model

    model = read_model(tokenizer_path())
    coded = decode(encode(table(spark, sf_dir, "documents").select("doc_id", "text"), model), model)
    return coded.select(
        "doc_id",
        F.size("ids_").cast("long").alias("n_pieces"),
        F.sha2(F.concat_ws(",", F.col("ids_").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded_", 256).alias("decoded_sha256"),
        F.col("decoded_").eqNullSafe(F.col("text")).alias("exact"),
    )


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import held_out
    from .language import identify, training_sample

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = identify(docs.drop("lang"), training_sample(docs, "doc_id", "text", "lang"))
    return out.select(
        "doc_id", held_out("doc_id").alias("held_out"), F.col("lang_pred_").alias("lang_pred"), F.col("lang_score_").alias("score")
    )


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lines import dedup_lines

    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id",
        F.col("lines_in_").cast("long").alias("n_lines"),
        F.col("lines_out_").cast("long").alias("n_kept"),
        F.sha2("text", 256).alias("text_sha256"),
    )


def op9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .passages import passage_classes

    return passage_classes(table(spark, sf_dir, "documents"))


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .neighbours import nearest

    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .importance import importance_sample

    out = importance_sample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", *(F.col(f"{name}_").alias(name) for name in ("features", "weight", "score", "rank"))).withColumnRenamed("features", "n_features")


def with_periods(docs: DataFrame) -> DataFrame:
    """The texts that op12 reads: of the documents whose id's CRC-32 divides by 10, words from one on repeat a stretch.

    Null ids have no checksum; their texts stay.
    """
    from .common import let

    check = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    mixed = F.floor(check / 10)

    def repeated(words):
        n = F.size(words)
        return let(mixed % n, lambda a: let((1 + F.floor((n - a) / (3 + mixed % 8))).cast("int"), lambda p: tiled(words, n, a.cast("int"), p)))

    def tiled(words, n, a, p):
        stretch = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
        return F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(stretch, F.lit(1), n - a)), " ")

    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    new = let(words, lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(F.col("text")))
    return docs.withColumn("text", F.when((check % 10 == 0) & F.col("text").isNotNull(), new).otherwise(F.col("text")))


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .periodic import periodic_runs

    out = periodic_runs(with_periods(table(spark, sf_dir, "documents").select("doc_id", "text"))).drop("text")
    best = F.array_min(F.transform("runs_", lambda r: F.struct((-r["length"]).alias("shorter"), r["start"].alias("start"), r["period"].alias("period"))))
    told = F.transform("runs_", lambda r: F.concat_ws(",", *(r[k].cast("string") for k in ("start", "length", "period"))))
    out = out.withColumn("best", best)
    return out.select(
        "doc_id",
        F.size("runs_").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.shorter")).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("-1000 * best.shorter div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(told, lambda t: F.concat(t, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed_", 256).alias("collapsed_sha256"),
    )


def ranks_path() -> str:
    """Rank file of op13: WAYMARK_RANKS, else the public one that is installed."""
    if path := os.environ.get("WAYMARK_RANKS"):
        return path
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bytebpe import decode, encode, read_ranks

    tokens = read_ranks(ranks_path())
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    coded = decode(encode(docs, tokens).drop("text"), tokens)
    return coded.select(
        "doc_id",
        F.size("ids_").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids_").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded_", 256).alias("decoded_sha256"),
    )


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_language": op3_language,
    "op4_secrets": op4_secrets,
    "op5_toxicity": op5_toxicity,
    "op6_chat": op6_chat,
    "op7_simhash": op7_simhash,
    "op8_lines": op8_lines,
    "op9_passages": op9_passages,
    "op10_neighbours": op10_neighbours,
    "op11_importance": op11_importance,
    "op12_periodic": op12_periodic,
    "op13_byte_bpe": op13_byte_bpe,
}
