"""Progress tables: upserts, summaries, duplicates, counters, rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .numbering import global_row_number


def _blank(c: Column) -> Column:
    return c.isNull() | (F.regexp_replace(c, r"(?U)\s+", "") == "")


def upsert_fill(old: DataFrame, new: DataFrame, key: list[str], value: str, order: str) -> DataFrame:
    """New keys are inserted, known ones kept, blank values filled by the first new value
    that isn't blank; among new rows of one key the first by ``order`` counts."""
    filled = F.min_by(value, F.when(~_blank(F.col(value)), F.col(order)))
    first = new.groupBy(*key).agg(filled.alias("_v"), F.min_by(value, order).alias("_f"))
    both = old.join(first, key, "full_outer").withColumn("_v", F.coalesce("_v", "_f"))
    return both.select(*key, F.when(_blank(F.col(value)) & ~_blank(F.col("_v")), F.col("_v")).otherwise(F.coalesce(value, "_v")).alias(value))


def next_index(*indexes: DataFrame, key: str, index: str) -> DataFrame:
    """One more than the largest index of each key over several tables."""
    whole = indexes[0].select(key, index)
    for x in indexes[1:]:
        whole = whole.unionByName(x.select(key, index))
    return whole.groupBy(key).agg((F.coalesce(F.max(index), F.lit(0)) + 1).alias("next_index"))


def exact_duplicates(rows: DataFrame, value: str, key: str) -> DataFrame:
    """Values that occur more than once: their hash, count and smallest key.  Only hashes are
    shuffled, not the texts."""
    return rows.select(F.md5(value).alias("digest"), key).groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first_key")).where("n > 1")


def running_counters(events: DataFrame, key: list[str], order: list[str], states: dict[str, Column]) -> DataFrame:
    """Running number of events and of each state within a key."""
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = events.withColumn("done", F.count(F.lit(1)).over(w))
    for name, cond in states.items():
        out = out.withColumn(name, F.count(F.when(cond, 1)).over(w))
    return out


def top_k(rows: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= k)


def numeric_rank(index: Column) -> Column:
    """Sort key of a numeric suffix: none last, and 0 just before none."""
    return F.when(index.isNull(), F.lit(2 * 10**9)).when(index == 0, F.lit(10**9)).otherwise(index)


def round_robin(rows: DataFrame, key: str, tie: list[str], world: int) -> DataFrame:
    return global_row_number(rows, [key, *tie], name="_i").withColumn("worker", F.pmod(F.col("_i") - 1, F.lit(world))).drop("_i")


def chunks(rows: DataFrame, key: str, tie: list[str], size: int) -> DataFrame:
    return global_row_number(rows, [key, *tie], name="_i").withColumn("chunk", F.floor((F.col("_i") - 1) / size)).drop("_i")


def batches(totals: DataFrame, total: str, size: int) -> DataFrame:
    """One row per batch of at most ``size``: its number and its size."""
    b = F.explode(F.sequence(F.lit(1), F.ceil(F.col(total) / size))).alias("batch")
    return totals.where(F.col(total) > 0).select("*", b).withColumn("batch_size", F.least(F.lit(size), F.col(total) - (F.col("batch") - 1) * size))


def audit(rows: DataFrame, value: str, low: float, high: float) -> DataFrame:
    """Rows outside [low, high] with a flag."""
    return rows.where(~F.col(value).between(low, high)).withColumn("flag", F.when(F.col(value) < low, "TOO SHORT").otherwise("TOO LONG"))


def audit_summary(rows: DataFrame, value: str, low: float, high: float) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("total"), F.count_if(~F.col(value).between(low, high)).alias("out_of_range"))


def report_lines(rows: DataFrame, name: str, value: str, flag: str, width: int = 60) -> DataFrame:
    """Fixed-width lines of an audit report."""
    return rows.select(F.concat(F.rpad(F.col(name).cast("string"), width, " "), F.lpad(F.format_string("%.2f", F.col(value).cast("double")), 10, " "), F.lit("  "), F.col(flag)).alias("line"))


def effects_wanted(rows: DataFrame, key: str, policy: str, marker: Column) -> DataFrame:
    """Whether a dialogue gets effects: its policy, or where that is null whether any of its
    lines has a marker."""
    return rows.groupBy(key).agg(F.coalesce(F.first(policy, ignorenulls=True), F.max(marker)).alias("effects"))


def backoff(attempt: Column, base: float, cap: float) -> Column:
    """Seconds to wait before another attempt, without jitter."""
    return F.least(F.lit(float(cap)), F.pow(F.lit(float(base)), attempt - 1))
