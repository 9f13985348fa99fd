"""The progress table: scenarios by topic, updated in place one topic's folder at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import drop_path, spilled
from .lookups import small
from .numbering import RANGE_ROWS, global_row_number
from .progress import _blank

SCHEMA = "scenario_index long, description string, topic string"


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """``scenario_index, description, topic``; empty where there is no table yet."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(path)


def merge_progress(found: DataFrame, path: str, order: list[str], topic: str = "topic", index: str = "scenario_index", description: str = "description", start: int = 1) -> DataFrame:
    """Puts found scenarios into the table and returns them as they stand in it.

    A scenario with an index fills a blank description of that index, or is added under it; one without
    gets the next free index of its topic, in ``order``.  Of several with one index the first in
    ``order`` whose description isn't blank counts.  Rows without a topic are left out.

    The topics that ``found`` has are merged into a staged copy, from which their folders are written anew by
    one dynamic overwrite; other topics' files are neither read nor touched.  Until that write is committed
    the old table stands, so a failed or repeated run changes nothing: repeated scenarios with an index are equal,
    those without one are told by their description if their topic has it already.
    """
    spark = found.sparkSession
    new = found.where(F.col(topic).isNotNull()).select(F.col(topic).alias("topic"), F.col(index).cast("long").alias("scenario_index"), F.col(description).alias("description"), F.struct(*order).alias("_order"))
    topics = new.select("topic").distinct()
    old = read_progress(spark, path).join(small(topics), "topic", "left_semi").select("topic", "scenario_index", "description")

    # known indexes: blanks are filled, new ones added
    named = new.where("scenario_index is not null")
    best = named.groupBy("topic", "scenario_index").agg(F.min_by("description", F.when(~_blank(F.col("description")), F.col("_order"))).alias("_new"))
    kept = old.join(best, ["topic", "scenario_index"], "full_outer")
    both = kept.select("topic", "scenario_index", F.when(_blank(F.col("description")), F.coalesce("_new", "description")).otherwise(F.col("description")).alias("description"))

    # the others are numbered after their topic's largest index, in order, over the whole table
    fresh = new.where("scenario_index is null").groupBy("topic", "description").agg(F.min("_order").alias("_order"))
    fresh = fresh.join(both.select("topic", "description").distinct(), ["topic", "description"], "left_anti")
    placed = global_row_number(fresh, ["topic", "_order", "description"], name="_n")
    first = placed.groupBy("topic").agg(F.min("_n").alias("_first"))
    last = both.groupBy("topic").agg(F.max("scenario_index").alias("_last"))
    base = first.join(last, "topic", "left").select("topic", (F.coalesce("_last", F.lit(start - 1)) + 1 - F.col("_first")).alias("_base"))
    added = placed.join(small(base), "topic").select("topic", (F.col("_n") + F.col("_base")).alias("scenario_index"), "description")

    staged, copy = spilled(both.unionByName(added), "progress")
    staged.select("scenario_index", "description", "topic").repartition("topic", F.floor(F.col("scenario_index") / RANGE_ROWS)).write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("topic").parquet(path)
    drop_path(spark, copy)
    return read_progress(spark, path).join(small(topics), "topic", "left_semi")
