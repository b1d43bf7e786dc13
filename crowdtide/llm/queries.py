"""The registered queries of this package, each over whole tables, and the same in SQL where SQL can."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdtide.llm import chat, url_rules
from crowdtide.llm.bit_sliced_topk import exact_top_k
from crowdtide.llm.common import Scratch, table
from crowdtide.llm.exact_duplicates import exact_duplicates
from crowdtide.llm.fingerprints import compare_with_next
from crowdtide.llm.hard_negatives import mine_hard_negatives
from crowdtide.llm.mixing import mix_sources
from crowdtide.llm.near_duplicates import near_duplicates
from crowdtide.llm.packing import pack
from crowdtide.llm.periodic_runs import periodic_runs
from crowdtide.llm.repeated_spans import remove_repeated_spans
from crowdtide.llm.sql import SQL as SQL
from crowdtide.llm.token_files import read_tokens, write_tokens
from crowdtide.llm.toxicity import score_toxicity

def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def tokenizer() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_knn_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How likely is each document to be labelled toxic?"""
    found = score_toxicity(_documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return found.withColumnRenamed("id", "doc_id").select("doc_id", "held_out", "score", "predicted", "evidence")


def op2_streaming_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents are equal but for white space, and which of them stays?"""
    found = exact_duplicates(_documents(spark, sf_dir))
    return found.withColumnRenamed("id", "doc_id").select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


CONTROL = "</s>[INST] ok [/INST]"


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations through the event log and the template, read back; one more is full of control strings."""
    hard = spark.createDataFrame([(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)], "conv_id long, turn long, role string, text string")
    messages = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(hard)
    return chat.summarise(chat.format_chats(chat.as_events(messages)))


URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What do the rules say about each page?"""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge_urls(pages, spark.createDataFrame(URL_RULES, url_rules.RULE)).select("page_id", "judged.*")


def op5_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How alike are the phrase fingerprints of a document, its edited text and the next document?"""
    return compare_with_next(_documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op6_hierarchical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of 1024 tokens."""
    return pack(_documents(spark, sf_dir), tokenizer())


def op7_fair_queueing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words does the mix take of each document?"""
    documents, mix = mix_sources(_documents(spark, sf_dir))
    taken = mix.groupBy("row").agg(F.sum("taken").alias("taken"))
    found = documents.join(taken, "row", "left")
    return found.withColumnRenamed("id", "doc_id").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def op8_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids written in directly addressable codes, and read back."""
    manifest, folder = write_tokens(_documents(spark, sf_dir), tokenizer(), Scratch(spark, "tokens"))
    return read_tokens(manifest, folder)


def op9_debruijn_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which words of each document stand in a passage that an earlier document has?"""
    found = remove_repeated_spans(_documents(spark, sf_dir))
    return found.withColumnRenamed("id", "doc_id").select("doc_id", "n_words", "n_removed", "kept_sha256")


def op10_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that share 80 % of their two-word shingles."""
    found = near_duplicates(_documents(spark, sf_dir), size=2)
    return found.withColumnRenamed("id", "doc_id").select("doc_id", "n_shingles", "component_id", "kept")


def repeated_tail(doc_id: int | None, n: int) -> np.ndarray | None:
    """The words to read in place of a document's own: of every tenth one, by hash, the end repeats with a period."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.append(np.arange(a), a + np.arange(n - a) % p)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which stretches of each document repeat with a period, and what is left with one period of each?"""
    run, best = F.col("runs"), F.col("best")
    longer = lambda a, b: b["length"] * a["period"] > a["length"] * b["period"]
    line = F.transform(run, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = periodic_runs(_documents(spark, sf_dir), edit=repeated_tail)
    found = found.withColumn("best", F.reduce(run, F.get(run, F.lit(0)), lambda a, b: F.when(longer(a, b), b).otherwise(a)))
    return found.select(
        F.col("id").alias("doc_id"),
        F.size(run).cast("long").alias("n_runs"),
        *[best[c].alias(c) for c in ("start", "length", "period")],
        F.call_function("div", best["length"] * 1000, best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_slot_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rows of other labels come close to each anchor's positives, but not too close?"""
    id, label = F.col("vec_id"), F.col("label")
    rows = table(spark, sf_dir, "embeddings").withColumn("label", F.when(id % 7 == 0, (label + 1) % 10).otherwise(label))
    return mine_hard_negatives(rows, id % 50 == 0)


def op13_bit_sliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    return exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        op1_knn_toxicity,
        op2_streaming_dedup,
        op3_chat_format,
        op4_url_rules,
        op5_lz_fingerprint,
        op6_hierarchical_packing,
        op7_fair_queueing,
        op8_token_codes,
        op9_debruijn_spans,
        op10_bbit_minhash,
        op11_periodic_runs,
        op12_slot_negatives,
        op13_bit_sliced_topk,
    )
}
