"""Live counters over the append-only progress log, as a file stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..shipping import ship
from ..sources.sinks import PROGRESS_COLUMNS


def progress_stream(spark: SparkSession, path: str, files: int = 1000) -> DataFrame:
    schema = ", ".join(f"`{c}` string" for c in PROGRESS_COLUMNS)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).csv(path, sep="\t")


def status_counts(events: DataFrame) -> DataFrame:
    """Counts by topic and status."""
    s = F.col("status")
    return events.groupBy("topic").agg(F.count(F.lit(1)).alias("done"), F.count_if(s == "OK").alias("generated"), F.count_if(s == "SKIP").alias("skipped"), F.count_if(s == "FAIL").alias("failed"))


def windowed_counts(events: DataFrame, size: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Counts by topic and time window; rows later than ``late`` are left out."""
    timed = events.withColumn("at", F.to_timestamp("ts")).withWatermark("at", late)
    return timed.groupBy(F.window("at", size), "topic").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "FAIL").alias("failed"))


#: Counters and the states they count; ``done`` counts all.  Fixed values.
COUNTED = {"generated": "OK", "skipped": "SKIP", "failed": "FAIL"}


class _Counters(StatefulProcessor):
    """A topic's counters so far, carried from batch to batch without expiry."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        names = ["done", *COUNTED]
        self.state = handle.getValueState("counters", ", ".join(f"{n} long" for n in names))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        have = self.state.get() if self.state.exists() else (0,) * (1 + len(COUNTED))
        # rows of one batch come in any order, but never more of them together than a batch has of the topic
        batch = pd.concat(list(rows)).sort_values(["ts", "dialogue_id"], kind="stable")
        out = batch[["topic", "ts", "dialogue_id", "status"]].copy()
        out["done"] = have[0] + 1 + pd.RangeIndex(len(batch)).to_numpy()
        for n, (name, status) in zip(have[1:], COUNTED.items(), strict=True):
            out[name] = n + (batch["status"] == status).cumsum().to_numpy()
        self.state.update(tuple(int(out[c].iloc[-1]) for c in ("done", *COUNTED)))
        yield out

    def close(self) -> None:
        pass


def live_counters(events: DataFrame) -> DataFrame:
    """Each event with its topic's counters up to it, as ``running_counters`` gives them for a whole
    log: a window can't run over a stream, so the counters are state.

    Events count in the order of ``ts, dialogue_id`` within a batch, and batches in their order, so the
    counters are the log's whatever its files, as long as later files hold later events.  A
    topic's events of one batch meet in one task; ``maxFilesPerTrigger`` bounds them.  Needs the
    RocksDB state store; the state is a few numbers a topic.
    """
    ship(events.sparkSession)
    schema = "topic string, ts string, dialogue_id string, status string, done long, " + ", ".join(f"{n} long" for n in COUNTED)
    picked = events.where("topic is not null").select("topic", "ts", "dialogue_id", "status")
    return picked.groupBy("topic").transformWithStateInPandas(_Counters(), schema, "Append", "None")
