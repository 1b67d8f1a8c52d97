"""One query per operator over the whole documents table, and the pipeline."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from logwarden.llm import bytebpe, infill, langid, lmscore, mixing, neardup, overlap, pseudonyms, quality, sharding, syncmers, tokenfiles, whiten
from logwarden.llm.common import n_words, remainder
from logwarden.llm.oracles import ORACLES
from logwarden.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.edited_pairs(documents(spark, sf_dir))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    held_out = remainder(F.col("doc_id"), 4) == 2
    found = langid.identify(docs.select("doc_id", "text"), docs.filter(~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.judged(docs, labels, F.col("quality") == 1)


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf_dir)).drop("class")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = documents(spark, sf_dir).select("doc_id", "source", n_words(F.col("text")).alias("words"))
    rows = mixing.mixed(sized, F.col("words"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    tokenfiles.write(documents(spark, sf_dir), path, public_tokenizers.path("word_bpe_49k.json"))
    rows = tokenfiles.read(spark, path)
    digests = rows.select(
        "part", "segment", "before", "doc_id", (F.length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )
    placed = digests.join(tokenfiles.segment_starts(spark, path), ["part", "segment"])
    return placed.select("doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = documents(spark, sf_dir).select("doc_id", "text")
    rows = bytebpe.decode(bytebpe.encode(docs, path, public_tokenizers.PATTERN), path)
    return rows.select(
        "doc_id",
        (F.length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = documents(spark, sf_dir).select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    found = sharding.sharded(rows, "doc_id", ["text_crc32", "size"])
    return found.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op9_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pseudonyms.pseudonymised(documents(spark, sf_dir).select("doc_id", "text"), corpus_pipeline.PSEUDONYM_KEY)
    return found.select("doc_id", F.size("spans").alias("n_found"), "spans", "text")


def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.score(documents(spark, sf_dir), remainder(F.col("doc_id"), 5) == 1)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model = whiten.whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
    shares = [v / model.trace for v in model.values.tolist()] if model else []
    each = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return each.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(model.n if model else 0).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(F.array(*[F.lit(s) for s in shares]).cast("array<double>"), F.col("place")).alias("explained"),
        F.lit(model.identity_error if model else 0.0).alias("identity_error"),
    )


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = infill.restore(infill.transform(documents(spark, sf_dir).select("doc_id", "text")))
    digests = [F.sha2(c, 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op13_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.joined(documents(spark, sf_dir)).drop("class")


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        op1_fingerprints,
        op2_language,
        op3_quality,
        op4_near_duplicates,
        op5_mixing,
        op6_token_files,
        op7_byte_bpe,
        op8_sharding,
        op9_pseudonyms,
        op10_lm_scores,
        op11_whitening,
        op12_infill,
        op13_overlap,
    )
} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    found = dict(ORACLES)
    if corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
