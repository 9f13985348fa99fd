"""Speech timelines of dialogues, in whole frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RATE = 24_000


def clean_timeline(turns: DataFrame, key: str = "conv_id", order: str = "turn_index", frames: str = "frames") -> DataFrame:
    """Start and end of each turn when turns follow each other without gaps."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(frames).over(w)
    return turns.withColumn("start_frame", end - F.col(frames)).withColumn("end_frame", end)


def effects_timeline(segments: DataFrame, key: str = "conv_id", order: str = "seg") -> DataFrame:
    """Start and end of each segment with gaps, pauses and overlaps.

    ``segments`` has ``frames``, ``gap`` (silence before an ordinary segment), ``shift`` (null,
    or by how much an overlapping one starts before the end so far) and ``hold`` (its pause).
    With length L so far and n frames: the first segment is 0..n; an ordinary one starts at
    L + gap; an overlapping one at max(0, L - min(shift, n, L)) + hold, and L becomes
    L - min(shift, n, L) + hold + n.  The clamp to L makes this a fold over each dialogue.
    """
    item = F.struct(F.col(order).alias("seg"), F.col("frames").cast("long").alias("n"), F.col("gap").cast("long").alias("gap"), F.col("shift").cast("long").alias("shift"), F.col("hold").cast("long").alias("hold"))
    state = "struct<len:bigint,out:array<struct<seg:bigint,start_frame:bigint,end_frame:bigint>>>"
    zero = F.from_json(F.lit('{"len":0,"out":[]}'), state)

    def step(acc: Column, x: Column) -> Column:
        first = F.size(acc["out"]) == 0
        back = F.least(x["shift"], x["n"], acc["len"])
        start = F.when(first, F.lit(0)).when(x["shift"].isNotNull(), F.greatest(F.lit(0), acc["len"] - back) + x["hold"]).otherwise(acc["len"] + x["gap"])
        length = F.when(first, x["n"]).when(x["shift"].isNotNull(), acc["len"] - back + x["hold"] + x["n"]).otherwise(acc["len"] + x["gap"] + x["n"])
        row = F.struct(x["seg"].cast("long").alias("seg"), start.cast("long").alias("start_frame"), (start + x["n"]).cast("long").alias("end_frame"))
        return F.struct(length.cast("long").alias("len"), F.concat(acc["out"], F.array(row)).alias("out")).cast(state)

    grouped = segments.groupBy(key).agg(F.array_sort(F.collect_list(item)).alias("items"))
    folded = grouped.select(key, F.aggregate("items", zero, step).alias("s"))
    return folded.select(key, F.col("s.len").alias("total_frames"), F.explode("s.out").alias("r")).select(key, "total_frames", F.col("r.seg").alias(order), "r.start_frame", "r.end_frame")


def effects_slices(timeline: DataFrame, key: str = "conv_id", order: str = "seg", role: str = "role", tail: int = int(0.35 * RATE)) -> DataFrame:
    """What to cut for each spoken segment: from the start of a pause that ends before it, to
    ``tail`` frames into an overlap that follows; within the dialogue, empty cuts left out."""
    w = Window.partitionBy(key).orderBy(order)
    lag = lambda c: F.lag(c).over(w)
    lead = lambda c: F.lead(c).over(w)
    after_pause = lag(role).startswith("[pause]") & (lag("end_frame") <= F.col("start_frame"))
    before_overlap = lead(role).startswith("[overlap]")
    start = F.when(F.coalesce(after_pause, F.lit(False)), lag("start_frame")).otherwise(F.col("start_frame"))
    end = F.when(F.coalesce(before_overlap, F.lit(False)), F.greatest("end_frame", lead("start_frame") + tail)).otherwise(F.col("end_frame"))
    cut = timeline.withColumn("a", start).withColumn("z", end).where(~F.col(role).startswith("[pause]"))
    clamp = lambda c: F.least(F.greatest(F.col(c), F.lit(0)), F.col("total_frames"))
    return cut.withColumn("slice_start", clamp("a")).withColumn("slice_end", clamp("z")).drop("a", "z").where("slice_end > slice_start")
