"""Exact duplicates from a stream, with state that never expires.

Documents arrive as rows of a landing table: digest of the normalised text, id, length and a locator of
the content, but not the text. A streaming aggregate keeps, for each digest, the row that stays so far
and how many there are, in RocksDB on the executors' disks, saved with every batch to the shared folder;
without a watermark nothing expires. Rows of one digest are combined in each task first, so a text that
makes up a third of all rows reaches its state as one row per task.

Equal digests are only hits. Each hit's full bytes are then compared with those of the row that stays,
found by its locator; should a digest ever stand for several texts, its rows are grouped by their bytes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdtide.llm.common import SPACES, Scratch, row_keys

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: Further settings of the query: RocksDB takes its memory from one bounded pool per executor.
STATE = {
    PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "300",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Many small stores: each would set some megabytes of disk aside.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
#: Hits that are compared with one copy of the text that stays.
SPREAD = 500


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACES.decode(), "")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def first_of_each(arrivals: DataFrame) -> DataFrame:
    """For a stream of (digest, points, id, text_hash, row): the row that stays per digest, and the count."""
    order = F.struct((-F.col("points")).alias("less"), F.col("id").isNull().alias("none"), "id", "text_hash", "row")
    return arrivals.groupBy("digest").agg(F.min(order).alias("stays"), F.count("*").alias("n"))


def run_stream(spark: SparkSession, landing: DataFrame, path: str, scratch: Scratch, files: int) -> DataFrame:
    """All files of the landing table through the stateful query; the last value of each digest.

    Each micro-batch writes the digests that it changed under its own number, so a batch that is run
    again replaces what it wrote.
    """
    changes = scratch.folder("changes")

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{changes}/batch={number}")

    arrivals = spark.readStream.schema(landing.schema).option("maxFilesPerTrigger", files).parquet(path)
    before = {k: spark.conf.get(k, None) for k in STATE}
    try:
        for k, v in STATE.items():
            spark.conf.set(k, v)
        query = (
            first_of_each(arrivals).writeStream.outputMode("update").foreachBatch(save).trigger(availableNow=True)
            .option("checkpointLocation", scratch.folder("progress")).start()
        )
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    schema = "digest string, stays struct<less:int,none:boolean,id:long,text_hash:long,row:long>, n long, batch int"
    seen = spark.read.schema(schema).parquet(changes)
    return seen.groupBy("digest").agg(F.max_by(F.struct("stays", "n"), "batch").alias("v")).select("digest", "v.stays", "v.n")


def exact_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] = sha256, files: int = 64
) -> DataFrame:
    """(id, text_hash, row, keep_id, group_size, kept, text_sha256) for each row of ``docs``.

    Texts are equal when identical without the characters of ``SPACES``; null counts as empty. Of equal
    texts the longest original stays, then the smallest id (a row without one last), then the smallest
    ``text_hash`` and ``row``, so of fully repeated rows one. An empty table gives no rows. ``files`` of
    the landing table make a micro-batch.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "exact")
    _, text_key = row_keys(docs, id, text)
    whole = docs.select(docs[id].cast("long").alias("id"), text_key.alias("text_hash"), normalised(docs[text]).alias("body"), F.length(F.coalesce(docs[text], F.lit(""))).alias("points"))
    narrow = whole.select(digest(F.col("body")).alias("digest"), "id", "text_hash", "points", F.monotonically_increasing_id().alias("row"))
    if digest is not sha256:
        narrow = whole.select(digest(F.col("body")).alias("digest"), "id", "text_hash", "points", F.monotonically_increasing_id().alias("row"), sha256(F.col("body")).alias("sha"))
    landing = scratch.keep(narrow, "landing")
    if landing.isEmpty():
        states = spark.createDataFrame([], "digest string, stays struct<less:int,none:boolean,id:long,text_hash:long,row:long>, n long")
    else:
        states = scratch.keep(run_stream(spark, landing, scratch.folder("landing"), scratch, files), "states")

    # Full bytes of every hit against those of the row that stays.
    groups = states.where("n > 1").select("digest", F.col("stays.id").alias("s_id"), F.col("stays.text_hash").alias("s_hash"), F.ceil(F.col("n") / SPREAD).cast("int").alias("salts"))
    stays = F.col("id").eqNullSafe(F.col("s_id")) & (F.col("text_hash") == F.col("s_hash"))
    bodies = whole.select(digest(F.col("body")).alias("digest"), "id", "text_hash", "body", "points").join(groups, "digest")
    bodies = scratch.keep(bodies.select("digest", "id", "text_hash", "body", "points", "salts", stays.alias("stays")), "hits")
    first = bodies.where("stays").dropDuplicates(["digest"]).select("digest", F.col("body").alias("first"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    hits = bodies.where("not stays").withColumn("salt", F.pmod(F.xxhash64("id", "text_hash"), "salts").cast("int"))
    differ = hits.join(first, ["digest", "salt"]).where("body != first").select("digest").distinct()
    differ = scratch.keep(differ, "differ")

    sha = F.col("digest") if digest is sha256 else F.col("sha")
    out = landing.join(states, "digest")
    clear = out.join(differ, "digest", "left_anti")
    kept = clear.select("id", "text_hash", "row", F.col("stays.id").alias("keep_id"), F.col("n").alias("group_size"), (F.col("row") == F.col("stays.row")).alias("kept"), sha.alias("text_sha256"))
    if differ.isEmpty():
        return kept
    # A digest of several texts: the same rule over rows that share their bytes.
    body = bodies.join(differ, "digest").select("digest", "id", "text_hash", "body").distinct()
    rows = landing.join(body, ["digest", "text_hash"]).where(landing["id"].eqNullSafe(body["id"]))
    rows = rows.select("digest", "body", landing["id"], "text_hash", "points", "row", sha.alias("sha"))
    order = F.struct((-F.col("points")).alias("less"), F.col("id").isNull().alias("none"), "id", "text_hash", "row")
    regrouped = rows.groupBy("digest", "body").agg(F.min(order).alias("stays"), F.count("*").alias("n"))
    again = rows.join(regrouped, ["digest", "body"]).select(
        "id", "text_hash", "row", F.col("stays.id").alias("keep_id"), F.col("n").alias("group_size"), (F.col("row") == F.col("stays.row")).alias("kept"), F.col("sha").alias("text_sha256")
    )
    return kept.union(again)
