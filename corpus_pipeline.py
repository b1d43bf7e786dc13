"""A corpus made ready in stages, each written as Parquet and read again by the next.

Documents judged toxic go; of equal texts, and of near-duplicate groups of five-word shingles, one stays;
sources are mixed to their weights, with repeats; what is left is packed into sequences of 1024 tokens.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdtide.llm.common import Scratch, one_row_each, table, without_rows
from crowdtide.llm.exact_duplicates import exact_duplicates
from crowdtide.llm.mixing import first_words, mix_sources, word_count
from crowdtide.llm.near_duplicates import near_duplicates
from crowdtide.llm.packing import pack
from crowdtide.llm.queries import tokenizer
from crowdtide.llm.toxicity import score_toxicity

#: Chunks of text that a worker of the last stage remembers: less than alone, for the stages before it have filled the heap.
REMEMBERED = 200_000

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays under the cut; repeated rows stay as they are."""
    scores = score_toxicity(docs, table(spark, sf_dir, "labels"))
    return without_rows(docs, scores.where("predicted = 1"), "doc_id", "text")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, white space aside."""
    kept = exact_duplicates(docs).where("kept").select("id", "text_hash")
    return one_row_each(docs, kept, "doc_id", "text")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its five-word shingles."""
    kept = near_duplicates(docs, size=5).where("kept").select("id", "text_hash")
    return one_row_each(docs, kept, "doc_id", "text")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, once or twice.

    Where the budget ends inside a document, that copy has only the words taken. A copy has the document's
    id. Documents without words, which take nothing of the budget, stay once.
    """
    documents, copies = mix_sources(docs)
    alike = copies.groupBy("id", "text_hash", "taken").agg(F.count("*").alias("copies"))
    empty = documents.where("size = 0").groupBy("id", "text_hash").agg(F.count("*").alias("copies"))
    every = alike.union(empty.select("id", "text_hash", F.lit(0).cast("long"), "copies")).groupBy("id", "text_hash")
    takes = every.agg(F.collect_list(F.struct("taken", "copies")).alias("takes"))  # whole and cut: few values
    mixed = one_row_each(docs, takes, "doc_id", "text").withColumn("_take", F.explode("_chosen.takes"))
    mixed = mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_take.copies"))))
    cut = F.col("_take.taken") < word_count(F.col("text"))
    text = F.when(cut, first_words(F.col("text"), F.col("_take.taken"))).otherwise(F.col("text"))
    mixed = mixed.withColumns({"text": text, "_cut": cut})
    chars = F.when(F.col("_cut"), F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return mixed.withColumn("n_chars", chars).select(*docs.columns)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the sequences."""
    return pack(docs, tokenizer(), remembered=REMEMBERED)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix),
    ("packing", pack_tokens),
]

#: Scores and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = scratch.keep(docs, f"stage-{number}")
    return docs
