"""Exact deduplication by a stateful stream.

A file stream feeds document digests into a keyed aggregation whose state is kept by
RocksDB: on local disk, checkpointed to the shared folder, and never expiring (there is
no watermark).  For each digest the state holds a stable identifier and a content locator
(file and row) of the row to keep, and the group's size, so a later file that repeats an
old text is a hit however long ago the first came.  Hits are then compared byte for byte:
the locators lead back to the texts, and a group whose smallest and largest text differ is
a digest collision, which is divided by the texts themselves.

Nulls, ties, edges: a null text counts as empty, and all empty texts are one group; equal
rows (same id and text) are told apart by their locator, so one row of a group stays; null
ids sort after all others; extra columns play no part; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import any_columns, checkpoint_dir, drop_path, read, scratch, spill, spilled

SPACE = " \t\n\x0b\x0c\r"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Hit locators are sent to every executor up to this many (about 150 bytes each); above, they are joined by a shuffle.
BROADCAST_HITS = 100_000


def normalized(text: str):
    return F.translate(F.coalesce(F.col(text), F.lit("")), SPACE, "")


def located(docs: DataFrame) -> DataFrame:
    """``docs`` with the locator of each row; needs a table read from files."""
    return docs.select("*", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias("_at"))


def _state(spark: SparkSession, path: str, where: str, schema: T.StructType, files_per_batch: int) -> DataFrame:
    """Runs the stream over the digests in ``path`` until no file is left; its state, kept in ``where``, as a table."""
    # without preallocated files, which cost megabytes a partition however little state it has
    rocks = "spark.sql.streaming.stateStore.rocksdb"
    own = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, f"{rocks}.changelogCheckpointing.enabled": "true", f"{rocks}.allowFAllocate": "false"}
    before = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
        best = F.min(F.struct((-F.col("n_chars")).alias("chars"), F.col("id").isNull().alias("no_id"), "id", "at"))
        groups = stream.groupBy("digest").agg(best.alias("best"), F.count(F.lit(1)).alias("n"))
        query = groups.writeStream.format("noop").outputMode("update").option("checkpointLocation", where).trigger(availableNow=True).start()
        query.awaitTermination()
        if query.lastProgress is None:
            return spark.createDataFrame([], T.StructType([T.StructField("digest", T.StringType()), *groups.schema.fields[1:]]))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    kept = spark.read.format("statestore").load(where)
    value = kept.schema["value"].dataType.names
    return kept.select(F.col("key").getField(kept.schema["key"].dataType.names[0]).alias("digest"), *(F.col("value").getField(v).alias(n) for v, n in zip(value, ("best", "n"), strict=True)))


def stream_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", files_per_batch: int = 1000, digest_bits: int = 256) -> DataFrame:
    """One row per row of ``docs``, which must be read from files: ``id``, ``at`` (its
    locator), ``digest`` (SHA-256 of the text without white space), ``n`` (rows in the
    group), ``keep_id``, ``kept``.  Of equal texts the one with the most code points
    stays, then the smallest id, then the first locator.

    ``digest_bits`` below 256 shortens the state's keys; collisions are resolved on bytes.
    """
    spark = docs.sparkSession
    checkpoint_dir(spark)
    sha = F.sha2(normalized(text_col), 256)
    narrow = located(docs).select(
        F.col(id_col).alias("id"), F.col("_at").alias("at"), F.coalesce(F.length(text_col), F.lit(0)).alias("n_chars"), sha.alias("sha")
    )
    narrow, path = spilled(narrow.withColumn("digest", F.substring("sha", 1, digest_bits // 4)), "dedup-digests")
    if not narrow.inputFiles():
        return narrow.select("id", "at", "sha", F.lit(0).cast("long").alias("n"), F.col("id").alias("keep_id"), F.lit(True).alias("kept"))
    where = scratch(spark, "dedup-state")
    groups = _state(spark, path, where, narrow.schema, files_per_batch)
    rows = narrow.join(groups, "digest").select("digest", "id", "at", "sha", "n", F.col("best.id").alias("keep_id"), (F.col("at") == F.col("best.at")).alias("kept"))
    rows = spill(rows, "dedup-rows")
    for p in (path, where):
        drop_path(spark, p)

    # full bytes on hits
    hits = rows.where("n > 1").select(F.col("at").alias("_at"), "digest")
    if hits.count() <= BROADCAST_HITS:
        hits = F.broadcast(hits)
    texts = located(docs).select("_at", F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(hits, "_at").withColumn("bytes", normalized("text"))
    clash = texts.groupBy("digest").agg(F.min("bytes").alias("a"), F.max("bytes").alias("z")).where("a <> z").select("digest")
    clash = spill(clash, "dedup-clashes")
    if clash.limit(1).count():
        part = texts.join(clash, "digest")
        best = F.min(F.struct((-F.coalesce(F.length("text"), F.lit(0))).alias("chars"), F.col("id").isNull().alias("no_id"), "id", F.col("_at").alias("at")))
        split = part.groupBy("digest", "bytes").agg(best.alias("best"), F.count(F.lit(1)).alias("n"))
        again = part.join(split, ["digest", "bytes"]).select(
            "digest", "id", F.col("_at").alias("at"), F.sha2("bytes", 256).alias("sha"), "n", F.col("best.id").alias("keep_id"), (F.col("_at") == F.col("best.at")).alias("kept")
        )
        rows = rows.join(clash, "digest", "left_anti").unionByName(again)
    return rows.drop("digest")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stream_dedup(read(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "keep_id", F.col("n").alias("group_size"), "kept", F.col("sha").alias("text_sha256"))


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, text, length(coalesce(text, '')) AS n_chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
r AS (
  SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id ASC NULLS LAST) AS k,
         count(*) OVER (PARTITION BY text_sha256) AS group_size,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id ASC NULLS LAST) AS keep_id
  FROM d)
SELECT doc_id, keep_id, group_size, k = 1 AS kept, text_sha256 FROM r
"""


@any_columns
def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that stay, with their own columns: of equal texts one row, repeated rows and rows
    without an id included; null and empty texts are equal.  An empty table gives none."""
    columns = docs.columns
    kept = stream_dedup(docs).where("kept").select(F.col("at").alias("_at"))
    return located(docs).join(kept, "_at", "left_semi").select(*columns)
