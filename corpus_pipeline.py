"""A training-data pipeline of five stages, each over all that its predecessor kept.

In every stage an empty table gives an empty table, columns beyond those of documents are kept by all but the last whatever their
names, rows that repeat others fare as these do unless the stage says otherwise, and very long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Callable
from math import sqrt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covoxel.llm.common import crc_of_id, stored
from covoxel.llm.jaccard import jaccard_classes
from covoxel.llm.langid import DIMENSIONS, UNDETERMINED, identify, learn
from covoxel.llm.lines import line_dedup
from covoxel.llm.mixing import mix
from covoxel.llm.packing import pack
from covoxel.llm.queries import vocabulary

#: The cosine of unrelated profiles varies around 0 by 1 / sqrt(dimensions), whatever the text's length; a text is rejected if its
#: nearest language is no nearer than 2.5 times that. Texts of fewer letters have too few n-grams to be near any language, and stay.
LEAST_SCORE, LETTERS = 2.5 / sqrt(DIMENSIONS), 30


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: null texts, texts without a letter, and those of LETTERS or more that are as far from every
    learned language as chance. (Of 10,000 documents in the learned languages none of these lengths is, of texts in five other scripts 95 in 100.) Ties
    between languages don't matter here. Where no row has a language to learn from, all go."""
    profiles = learn(docs.where(crc_of_id() % 5 != 0))
    known = identify(docs.select(F.struct(*docs.columns).alias("doc"), "text"), profiles)
    few = F.length(F.regexp_replace("text", r"\P{L}", "")) < LETTERS
    return known.where((F.col("lang_pred") != UNDETERMINED) & ((F.col("score") >= LEAST_SCORE) | few)).select("doc.*")


def remove_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages of lines go from the texts. A document of which nothing is left goes, too: all it held
    stands elsewhere, whole. n_chars follows the text. Null and empty texts stay; rows that repeat an id and a text are one document."""
    out = line_dedup(docs.withColumn("__columns", F.struct(*[c for c in docs.columns if c != "text"])))
    out = out.where(~F.col("all_removed"))
    chars = F.length("text").cast("long")
    return out.select(*[F.col("text") if c == "text" else chars.alias(c) if c == "n_chars" else F.col(f"__columns.`{c}`").alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: that with the least doc_id, and of rows that repeat
    it the one with the least text. Rows that repeat an id with unlike texts are documents of their own. Documents
    without an id stay."""
    twice = stored(docs.where("doc_id is not null").groupBy(F.col("doc_id").alias("__twice")).count().where("count > 1").select("__twice"), "pipeline")
    if twice.isEmpty():
        groups = stored(jaccard_classes(docs, words=5, percent=80).where("doc_id is not null and component_id <> doc_id").select(F.col("doc_id").alias("__gone")).distinct(), "pipeline")
        return docs.join(groups, F.col("doc_id") == F.col("__gone"), "left_anti")
    keyed = docs.withColumn("__key", F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", "text")))
    groups = stored(jaccard_classes(keyed.select(F.col("__key").alias("doc_id"), "text"), words=5, percent=80).where("doc_id is not null").select(F.col("doc_id").alias("__key"), F.col("component_id").alias("__group")).distinct(), "pipeline")
    first = keyed.select("__key", "doc_id", "text").join(groups, "__key").groupBy("__group").agg(F.min(F.struct("doc_id", "text", "__key")).alias("x"))
    first = stored(first.select("x.__key"), "pipeline")
    left = keyed.where("doc_id is null").unionByName(keyed.join(first, "__key", "left_semi"))
    again = left.join(twice, F.col("doc_id") == F.col("__twice"), "left_semi")
    once = again.groupBy("__key").agg(F.min(F.struct(*docs.columns)).alias("x")).select("x.*")
    return left.join(twice, F.col("doc_id") == F.col("__twice"), "left_anti").drop("__key").unionByName(once)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come to their target weights: documents that the mix doesn't take go, those it takes more than once
    are repeated. A null source is a source; rows that repeat an id fare alike; a null text weighs nothing and goes or stays by
    its hash."""
    taken = mix(docs.select(F.struct(*docs.columns).alias("doc"), "doc_id", "text", "source"))
    times = F.sequence(F.lit(1).cast("long"), F.col("copies"))
    return taken.where("copies > 0").withColumn("copy", F.explode(times)).select("doc.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 4096 tokens. A null or empty text is its end alone; every row is packed. A very long
    text is cut into pieces; of pieces of one length the order follows a hash, then id, start and tokens."""
    return pack(docs, vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", remove_lines),
    ("jaccard_join", near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Language profiles and tokenization can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each returns is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
