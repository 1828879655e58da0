"""Quality rules, near duplicates, repeated passages, packing: documents to training sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.llm.common import read, stored
from terrafold.llm.jaccard import shingle_classes
from terrafold.llm.packing import pack_documents
from terrafold.llm.quality import keep_documents
from terrafold.llm.substring import remove_repeats

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Numbers from here on stand for rows without a doc_id.
LATE = 1 << 62
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, each row as it is.

    Null and empty texts, which have no words, go. Repeated rows stay or go together, since a verdict is of the text and
    language alone; so do ties. Texts of any length are judged whole. An empty table gives no rows. Here and in the
    later stages, other columns than those of documents go first, whatever their names.
    """
    return keep_documents(docs.select(*COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8): that with the smallest doc_id.

    Repeated rows are one document; of rows that tie in doc_id and text but not in language or source, any one stays.
    Rows with a null doc_id stay if they link to no document with one; of such that link, one stays. Null and empty texts link with nothing and stay.
    Long texts count with all their shingles. An empty table gives no rows.
    """
    # a row without a doc_id is told by its text, behind all that have one
    own = F.coalesce("doc_id", F.xxhash64("text").bitwiseAND(LATE - 1) + LATE)
    keyed = docs.select(*COLUMNS, own.alias("own_id"))
    first = shingle_classes(keyed.select(F.col("own_id").alias("doc_id"), "text")).filter("doc_id = component_id").select(F.col("doc_id").alias("first_id")).distinct()
    return keyed.join(first, F.col("own_id") == F.col("first_id"), "left_semi").dropDuplicates(["own_id", "text"]).select(*COLUMNS)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 50 words or more that a document with a smaller doc_id has; emptied ones go.

    Repeated rows stay as many as they are, all with the same text left. Rows with a null doc_id, and null or empty
    texts, stay as they are. Of words, single spaces between them are left where some went. Ties cannot occur:
    only a strictly smaller doc_id takes words. Texts of any length are cut whole. An empty table gives no rows.
    """
    docs = docs.select(*COLUMNS)
    cut = remove_repeats(docs)
    lost = cut.filter("n_removed > 0").select("key", F.col("text").alias("left"), (F.col("n_removed") == F.col("n_words")).alias("empty")).dropDuplicates(["key"])
    keyed = docs.withColumn("key", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))
    both = keyed.join(lost, "key", "left").filter("not coalesce(empty, false)")
    text = F.coalesce("left", "text")
    return both.select("doc_id", text.alias("text"), "lang", "source", F.when(F.col("left").isNull(), F.col("n_chars")).otherwise(F.length("left").cast("long")).alias("n_chars"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their places in sequences of at most 2048 tokens.

    Every row is packed, repeated ones too; a null or empty text is one piece of its end token; a null doc_id stays
    null; longer texts are cut into pieces; pieces of equal length tie, and any of them takes a place; an empty table
    gives no rows.
    """
    return pack_documents(docs.select(*COLUMNS)).drop("ids")


STAGES: list[tuple[str, Stage]] = [("quality_rules", rules), ("jaccard_join", near_duplicates), ("substring_dedup", passages), ("best_fit_packing", packed)]

#: Tokenisers and the searches of the stages have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder; each result is written in the shared folder and read by the next."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
