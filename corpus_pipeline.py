"""From raw documents to token ids: five stages, each written and read again as Parquet."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logwarden.llm import bytebpe, langid, mixing, neardup, pseudonyms
from logwarden.llm.common import free_name, n_words, remainder, set_aside
from logwarden.session import scratch, shared_folder
from logwarden.sources.folders import delete_folder

# Of the queries over synthetic tables only. A real key belongs to the caller.
PSEUDONYM_KEY = b"synthetic tables"


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages; learns from ``lang`` of three quarters of them."""
    models = langid.fit(docs.filter(remainder(F.col("doc_id"), 4) != 2))
    rows, columns = set_aside(docs, langid.ADDED)
    return langid.predict(rows, models).filter(~F.col("rejected")).select(*columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group.

    Rows with the same doc_id and text stay once: the one with the least hash of its plain
    columns. Rows without doc_id belong to no group and all stay.
    """
    found = neardup.near_duplicates(docs).filter("kept and doc_id is not null").select("doc_id").distinct()
    plain = [F.col(f.name) for f in docs.schema.fields if isinstance(f.dataType, T.AtomicType)]
    row = F.min_by(F.struct(*docs.columns), F.xxhash64(*plain)).alias("row")
    once = docs.join(found, "doc_id", "left_semi").groupBy("doc_id", "text").agg(row).select("row.*")
    return once.unionByName(docs.filter("doc_id is null")).select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal data."""
    rows, columns = set_aside(docs, ("spans",))
    return pseudonyms.pseudonymised(rows, PSEUDONYM_KEY).select(*columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    rows, columns = set_aside(docs, (*mixing.ADDED, "copy"))
    return mixing.emitted(mixing.mixed(rows, n_words(F.col("text")))).select(*columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit integers) in place of the texts, and ``n_tokens``.

    Where the table has columns ``ids`` or ``n_tokens``, these stay and the new ones take free names.
    """
    ids, n_tokens = free_name(docs, "ids"), free_name(docs, "n_tokens")
    rows = bytebpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, ids=ids)
    return rows.withColumn(n_tokens, (F.length(ids) / 4).cast("bigint"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("languages", languages),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mix", mix),
    ("tokens", tokens),
]

# Models, signatures and merges cannot be said in SQL; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents table. Of what they write, the last one's result stays."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES:
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            delete_folder(spark, before)
        before = f"{folder}/{name}"
    return docs
