"""Exact deduplication as a stateful stream over arriving documents.

The stream keeps one state row per digest, in RocksDB on the executors' disks and
without expiry: how many documents had it, and of the one that stays its stable
identifier (the largest doc_id) and content locator (file, row in the file). No
text enters the state. Documents combine by digest before the shuffle, so a third
of all rows in one group reaches its state as one row a task. A restart with the
same checkpoint goes on from the state; later files only add to it.

A hit, a digest held by more than one document, is checked on full bytes: within
each digest the least and the greatest normalised text must be the same string.
Where they are not (a collision), the group is split by the text itself.

Texts are equal when identical after lower-casing A-Z. Null texts count as empty.
Of equal texts the largest doc_id stays (null is the smallest; of rows that also
share doc_id, the last by file and row). An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, shared_path, text_or_empty
from .near import HOT, join_per_key

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Memory of all state stores of an executor together; what is beyond is on its disk.
STATE_MB = 128
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def normalised(docs: DataFrame) -> DataFrame:
    """The id, the content locator, the normalised text and its digest."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-2**63)).alias("id"),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"),
        # lower() of a text of ASCII alone is the same and much faster
        F.when(F.octet_length(text_or_empty()) == F.length(text_or_empty()), F.lower(text_or_empty())).otherwise(F.translate(text_or_empty(), UPPER, LOWER)).alias("norm"),
    ).withColumn("digest", F.sha2(F.col("norm").cast("binary"), 256))


def stream_state(spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
    """Run the stream over the files of ``path`` that ``checkpoint`` has not seen, then read its state:
    digest, n, keep (id, file, row)."""
    settings = {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
        "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": str(STATE_MB),
        "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else each of many small stores reserves MBs
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        schema = spark.read.parquet(path).schema
        # a pattern that only ``path`` matches: a stream reads folders or patterns, and a table may be one file
        arriving = normalised(spark.readStream.schema(schema).parquet(f"{path[:-1]}[{path[-1]}]"))
        state = arriving.groupBy("digest").agg(F.count("*").alias("n"), F.max(F.struct("id", "file", "row")).alias("keep"))
        query = state.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        stored = spark.read.format("statestore").load(checkpoint)
        n, keep = stored.schema["value"].dataType.fieldNames()
        return cut(stored.select(F.col("key.digest").alias("digest"), F.col(f"value.{n}").alias("n"), F.col(f"value.{keep}").alias("keep")), "state")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def dedup_files(spark: SparkSession, path: str, checkpoint: str | None = None) -> DataFrame:
    """Per row of the files: id, file, row, digest, n and keep of its group, kept."""
    state = stream_state(spark, path, checkpoint or shared_path(spark, "dedup-stream"))
    rows = normalised(spark.read.parquet(path))
    total = int(state.agg(F.sum("n")).first()[0] or 0)
    # digests with a large share of the rows are few and known to every task, which combines their texts before
    # the shuffle; the texts of the others meet by digest
    hits = state.where("n > 1").select("digest", "n")
    hot, cold = hits.where(F.col("n") * HOT >= total).select("digest"), hits.where(F.col("n") * HOT < total).select("digest")
    ends = (F.min("norm").alias("least"), F.max("norm").alias("greatest"))
    checked = (rows.join(F.broadcast(hot), "digest", "left_semi").groupBy("digest").agg(*ends)
               .unionByName(rows.join(F.broadcast(hot), "digest", "left_anti").join(cold.hint("merge"), "digest", "left_semi").groupBy("digest").agg(*ends)))
    collided = cut(checked.where("least != greatest").select("digest"), "collided")
    light = rows.select("id", "file", "row", "digest")
    out = join_per_key(light, state.withColumn("many", F.col("n")), ["digest"], "many", total)
    if not collided.isEmpty():
        split = rows.join(collided, "digest", "left_semi")
        groups = split.groupBy("digest", "norm").agg(F.count("*").alias("n"), F.max(F.struct("id", "file", "row")).alias("keep"))
        apart = split.join(groups, ["digest", "norm"]).select("id", "file", "row", "digest", "n", "keep")
        out = out.join(collided, "digest", "left_anti").select(apart.columns).unionByName(apart)
    return out.withColumn("kept", (F.col("id") == F.col("keep.id")) & (F.col("file") == F.col("keep.file")) & (F.col("row") == F.col("keep.row")))


def dedup_report(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of the files."""
    real = lambda c: F.when(F.col(c) != -2**63, F.col(c))
    return dedup_files(spark, path).select(real("id").alias("doc_id"), real("keep.id").alias("keep_id"), F.col("n").cast("long").alias("group_size"), "kept", F.col("digest").alias("text_sha256"))


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of docs, all columns, that stay. The rows are written to the shared folder, as a stream reads files."""
    spark = docs.sparkSession
    path = shared_path(spark, "arriving")
    docs.write.parquet(path)
    gone = cut(dedup_files(spark, path).where("not kept").select(F.col("file").alias("_file"), F.col("row").alias("_row")), "gone")
    rows = spark.read.schema(docs.schema).parquet(path)
    return (rows.withColumns({"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")})
            .join(gone.hint("merge"), ["_file", "_row"], "left_anti").select(*docs.columns))
