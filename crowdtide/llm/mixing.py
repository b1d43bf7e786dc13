"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations alone.

Sources are served at rates in proportion to their weights until the budget is reached. A document, in
its source's shuffled order, is done at the virtual time ``words of its source up to it / weight``; a
repeat follows after the whole source. The copies are sorted by that time over the whole cluster, and the
list is cut where the words served reach the budget.

A source is cut into slices of its shuffled order, so the running sums of a source with a third of all
rows are many small windows; slices and ranges are reduced to one sum each before they meet.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crowdtide.llm.common import Scratch, parts, row_keys

WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a slice of a source's shuffled order, about.
SLICE_ROWS = 20_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def first_words(text: Column, count: Column) -> Column:
    """So many words of a text, joined by single spaces."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lit(1), count.cast("int")), " ")


def source_targets(sized: DataFrame, weights: tuple[float, ...], share: float, epochs: int) -> DataFrame:
    """(source, place, weight, source_size, level, target), one row per source.

    Sources by code point, null last, take the weights in turn. The budget is ``share`` of all words; a
    source gets words by weight until it has ``epochs`` times its own, and what is over is shared again.
    With sources in order of the virtual time at which they run out, the level that is reached when the
    first k of them have run out is one division. The right k is the first for which source k + 1 ends
    beyond it; further on it only falls.
    The windows without a key go over one row per source.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    turn = F.get(F.array(*(F.lit(float(w)) for w in weights)), (F.col("place") % len(weights)).cast("int"))
    per = per.withColumn("place", place).withColumn("weight", turn).withColumn("full", F.col("source_size") * F.lit(float(epochs)))
    order = Window.orderBy(F.col("full") / F.col("weight"), "place")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    everyone = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = F.sum("source_size").over(everyone) * F.lit(share) - F.coalesce(F.sum("full").over(earlier), F.lit(0.0))
    per = per.withColumn("reached", rest / (F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))))
    fits = F.when(F.col("reached") <= F.col("full") / F.col("weight"), F.col("reached"))
    level = F.coalesce(F.max(fits).over(everyone), F.max(F.col("full") / F.col("weight")).over(everyone))
    per = per.withColumn("level", level)
    return per.select("source", "place", "weight", "source_size", "level", F.least("full", F.col("level") * F.col("weight")).alias("target"))


def mix_sources(
    docs: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    epochs: int = 2,
    seed: int = 17,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> tuple[DataFrame, DataFrame]:
    """The sized documents, and the mix.

    Documents: (row, id, text_hash, size, source_size, target), one per row of ``docs``; size counts words,
    null as 0. Mix: (row, id, text_hash, epoch, finish, position, taken), sorted over the whole cluster:
    each copy that is served at all, its place in words and the words taken of it, which are fewer than
    its size only for the document of each source in service when the budget ends. The shuffle depends on
    seed and id, then on the text, so repeated runs agree; fully repeated rows are documents of their own. A null
    source is a source. An empty table gives two empty tables.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    _, text_key = row_keys(docs, id, text)
    sized = docs.select(F.monotonically_increasing_id().alias("row"), docs[id].cast("long").alias("id"), text_key.alias("text_hash"), docs[source].alias("source"), word_count(docs[text]).alias("size"))
    # Any well mixed hash would do; this one other engines have too.
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("id").cast("string")))
    sized = scratch.keep(sized.withColumn("shuffled", digest), "sized")
    targets = scratch.keep(source_targets(sized, weights, share, epochs), "targets")
    rows, words = sized.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    budget = math.floor(words * share)

    digits = max(0, math.ceil(math.log2(max(1, rows / SLICE_ROWS)) / 4))
    sliced = sized.join(targets, sized["source"].eqNullSafe(targets["source"])).drop("source")
    sliced = scratch.keep(sliced.withColumn("slice", F.substring("shuffled", 1, digits)), "sliced")
    before = F.coalesce(F.sum("words").over(Window.partitionBy("place").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    slices = sliced.groupBy("place", "slice").agg(F.sum("size").alias("words")).select("place", "slice", before.alias("before"))
    inside = Window.partitionBy("place", "slice").orderBy("shuffled", "id", "text_hash", "row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = sliced.join(slices, ["place", "slice"]).withColumn("end", F.col("before") + F.sum("size").over(inside))

    copies = upto.withColumn("epoch", F.explode(F.array(*(F.lit(i) for i in range(epochs)))))
    copies = copies.withColumn("end", F.col("end") + F.col("epoch") * F.col("source_size")).withColumn("finish", F.col("end") / F.col("weight"))
    # The tolerance keeps the last word of a target that is whole but for rounding.
    served = F.least("size", F.floor(F.col("level") * F.col("weight") + 1e-6) - (F.col("end") - F.col("size")))
    copies = copies.withColumn("served", served).where("served > 0")
    order = ["finish", "place", "epoch", "shuffled", "id", "text_hash", "row"]
    ordered = copies.select(*order, "served").repartitionByRange(parts(spark), *order).withColumn("range", F.spark_partition_id())
    ordered = scratch.keep(ordered.sortWithinPartitions(*order), "ordered")
    # One row per range in the window without a key.
    sums = ordered.groupBy("range").agg(F.sum("served").alias("words"))
    sums = sums.select("range", F.coalesce(F.sum("words").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    running = F.sum("served").over(Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    mix = ordered.join(sums, "range").withColumn("position", F.col("ahead") + running - F.col("served"))
    mix = mix.withColumn("taken", F.least("served", F.lit(budget) - F.col("position"))).where("taken > 0")
    documents = sliced.select("row", "id", "text_hash", "size", "source_size", "target")
    return documents, mix.select("row", "id", "text_hash", "epoch", "finish", "position", "taken")
