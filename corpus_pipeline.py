"""Corpus preparation: quality filter, near-duplicate removal, personal data, packing. Each stage is one operator of saleloom.llm."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleloom.llm import packing, quality, set_join, surrogates
from saleloom.llm.queries import PII_KEY, WORD_BPE, table
from saleloom.operators.work import freeze

SEQUENCE_TOKENS = 2048
SHINGLE_WORDS, SIMILARITY_PERCENT = 5, 80
BROADCAST_ROWS = 2_000_000  # rows to remove are broadcast up to so many rows (16 MB)

# SQL can express none of the stages: a fitted model, links by 64-bit set hashes, keyed surrogates, a solved packing.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality posterior is at least one half; empty ones go. The model is fitted on ``labels``."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model, host=F.col("source"), path=F.col("lang"))
    return scored.where("keep").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked or equal documents (5-word shingles, Jaccard 0.8) the row with the smallest id.

    Rows decide, not ids: rows of one id with unrelated texts all stay, and copies without an id are removed like others
    (a known id goes before a null one, then the first row). Documents without words stay, repeated rows of one id once.
    """
    rows = freeze(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    groups = set_join.link_components(rows, SHINGLE_WORDS, SIMILARITY_PERCENT, id_col="__row")
    groups = freeze(groups.withColumnRenamed("doc_id", "__row"), "groups")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "__row"))["__row"].alias("first")

    shared = groups.where("n_shingles > 0").groupBy("component_id").count().where("count > 1").select("component_id")
    linked = groups.where("n_shingles > 0").join(shared, "component_id").select("__row", "component_id")
    linked = freeze(linked.join(rows.select("__row", "doc_id"), "__row"), "linked")
    kept = linked.groupBy("component_id").agg(first)
    removed = linked.join(kept, "component_id").where("__row <> first").select("__row")

    wordless = rows.where("doc_id is not null").join(groups.where("n_shingles = 0").select("__row"), "__row", "left_semi")
    text = F.col("text").cast("string")
    once = wordless.groupBy("doc_id", text.alias("text")).agg(F.min("__row").alias("__row"))
    again = wordless.select("__row").join(once.select("__row"), "__row", "left_anti")

    removed = freeze(removed.union(again), "removed")
    if removed.count() <= BROADCAST_ROWS:
        removed = F.broadcast(removed)
    return rows.join(removed, "__row", "left_anti").select(*docs.columns)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by surrogates; ``n_chars`` counts the new text."""
    done = surrogates.replace_entities(docs, PII_KEY)
    return done.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their place in sequences of 2048 ids."""
    return packing.pack_documents(docs, WORD_BPE, end_id=0, capacity=SEQUENCE_TOKENS, compact=True)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", replace_personal_data),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = freeze(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
