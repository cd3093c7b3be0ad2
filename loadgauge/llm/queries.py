"""The operators as queries over the sample tables, and the SQL that some of them are checked against."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import byte_bpe, chat_format as chat, license_scan, line_dedup, near_dup, ngram_lm, secret_scan, token_count, toxicity
from .common import read
from .decontaminate import contamination
from .exact_dedup import exact_dedup
from .lexical_search import ranked
from .sql import SQL
from .whitening import whitened

#: Tokens a training window holds.
TOKEN_LIMIT = 512
#: Score from which on a document is toxic.
TOXIC = 0.5

Query = Callable[[SparkSession, str], DataFrame]


def sha_of_list(items: str) -> Column:
    return F.sha2(F.array_join(items, ",").cast("binary"), 256)


def op1_lm_score(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents").select("doc_id", "text").withColumn("held_out", ngram_lm.fold(F.col("doc_id"), 7) == 2)
    model = ngram_lm.fit(docs.where("NOT held_out"), order=3)
    made = ngram_lm.score(docs, model, keep=["doc_id", "held_out"])
    return made.select("row.doc_id", "row.held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score", "perplexity")


def op2_chat_format(spark: SparkSession, d: str) -> DataFrame:
    said = F.lit("\\### Assistant: </turn> ok")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    layout = chat.canonical_turns(read(spark, d, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra))
    turns = layout.select("row.conv_id", "row.turn", F.inline("turns"))
    made = chat.format_turns(turns, "conv_id", "turn")
    back = made.select("*", chat.parse_turns(F.col("formatted")).alias("turns"), chat.learned_text(F.col("formatted"), F.col("loss")).alias("learned"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        F.col("conversation").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op3_near_dup(spark: SparkSession, d: str) -> DataFrame:
    found = near_dup.near_groups(read(spark, d, "documents").select("doc_id", "text"), size=3, percent=85)
    return found.select("row.doc_id", "n_shingles", "component_id", (F.col("row.doc_id") == F.col("component_id")).alias("kept"))


def op4_secret_scan(spark: SparkSession, d: str) -> DataFrame:
    found = secret_scan.secret_spans(read(spark, d, "documents").select("doc_id", "text"))
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    base = [r.kind for r in secret_scan.BASE]
    return found.select(
        "row.doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(secret_scan.joined(of(*base)).cast("binary"), 256).alias("base_sha256"),
        secret_scan.joined(F.col("spans")).alias("spans"),
    )


def op5_byte_bpe(spark: SparkSession, d: str) -> DataFrame:
    made = byte_bpe.encode(read(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep=["doc_id"], decode=True)
    return made.select("row.doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_decontaminate(spark: SparkSession, d: str) -> DataFrame:
    found = contamination(read(spark, d, "documents"), read(spark, d, "benchmark"), keep=["doc_id"])
    return found.select("row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), sha_of_list("items").alias("items_sha256"), "contaminated")


def toxic_network(docs: DataFrame, labels: DataFrame) -> toxicity.Network | None:
    """Learned from the labels of the documents that aren't held out."""
    return toxicity.fit(docs, labels.where(ngram_lm.fold(F.col("doc_id"), 5) != 0))


def op7_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents").select("doc_id", "text")
    made = toxicity.toxicity(docs, toxic_network(docs, read(spark, d, "labels")), keep=["doc_id"])
    held_out = ngram_lm.fold(F.col("row.doc_id"), 5) == 0
    return made.select("row.doc_id", held_out.alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))


def op8_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    found = line_dedup.line_dedup(read(spark, d, "documents").select("doc_id", "text", "source"))
    return found.select("row.doc_id", "n_lines", "n_removed", F.char_length("text").cast("long").alias("n_chars"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op9_token_count(spark: SparkSession, d: str) -> DataFrame:
    made = token_count.token_counts(read(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.json"), keep=["doc_id"])
    return made.select("row.doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op10_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    found = exact_dedup(read(spark, d, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op11_lexical_search(spark: SparkSession, d: str) -> DataFrame:
    found = ranked(read(spark, d, "documents").select("doc_id", "text"), read(spark, d, "benchmark"))
    return found.select("item.item_id", "rank", "doc_id", "score")


def op12_license_scan(spark: SparkSession, d: str) -> DataFrame:
    found = license_scan.license_marks(read(spark, d, "documents"), keep=["doc_id"])
    base = F.filter("marks", lambda m: m["kind"] == "base")
    names = lambda marks: F.array_join(F.array_sort(F.array_distinct(F.transform(marks, lambda m: m["label"]))), ",")
    place = F.transform(base, lambda m: m["word"])
    return found.select(
        "row.doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(place).alias("first_word"),
        F.array_max(place).alias("last_word"),
        names(base).alias("base_labels"),
        names(F.col("marks")).alias("labels"),
        "score",
    )


def op13_embedding_whitening(spark: SparkSession, d: str) -> DataFrame:
    made, white = whitened(read(spark, d, "embeddings"))
    explained = F.array(*[F.lit(float(x)) for x in white.explained]) if len(white.explained) else F.array().cast("array<double>")
    each = made.select("row.vec_id", "deviation", F.posexplode(F.arrays_zip("whitened", explained.alias("explained"))).alias("at", "part"))
    return each.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(white.n).cast("long").alias("n"),
        "deviation",
        "part.whitened",
        "part.explained",
        F.lit(white.identity_error).alias("identity_error"),
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_lm_score, op2_chat_format, op3_near_dup, op4_secret_scan, op5_byte_bpe, op6_decontaminate, op7_toxicity, op8_line_dedup, op9_token_count,
        op10_exact_dedup, op11_lexical_search, op12_license_scan, op13_embedding_whitening,
    )
}
