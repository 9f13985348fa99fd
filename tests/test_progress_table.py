"""The progress table across runs, and running counters on a live log."""

import os

import pytest
from pyspark.sql import functions as F

from turnweave.operators import progress_table as PT


def state(spark, path):
    return {(r.topic, r.scenario_index): r.description for r in PT.read_progress(spark, path).collect()}


def listing(path, topic):
    d = os.path.join(path, f"topic={topic}")
    return {n: os.stat(os.path.join(d, n)).st_mtime_ns for n in os.listdir(d)}


def merge(spark, path, rows):
    df = spark.createDataFrame(rows, "topic string, scenario_index long, description string, at int").repartition(3)
    return PT.merge_progress(df, path, ["at"])


def test_runs_give_contiguous_indexes(spark, tmp_path):
    path = str(tmp_path / "t")
    merge(spark, path, [("a", None, f"a{i}", i) for i in range(5)] + [("b", None, "b0", 0), (None, None, "x", 0)])
    assert state(spark, path) == {**{("a", i + 1): f"a{i}" for i in range(5)}, ("b", 1): "b0"}
    before = listing(path, "b")
    got = merge(spark, path, [("a", None, "a9", 2), ("a", None, "a8", 1), ("a", None, "a3", 0), ("c", 4, "c4", 0), ("c", None, "c?", 0)])
    want = {**{("a", i + 1): f"a{i}" for i in range(5)}, ("a", 6): "a8", ("a", 7): "a9", ("b", 1): "b0", ("c", 4): "c4", ("c", 5): "c?"}
    assert state(spark, path) == want and listing(path, "b") == before
    assert {r.topic for r in got.collect()} == {"a", "c"}
    # the same run again changes nothing
    merge(spark, path, [("a", None, "a9", 2), ("a", None, "a8", 1)])
    assert state(spark, path) == want


def test_blanks_are_filled(spark, tmp_path):
    path = str(tmp_path / "t")
    merge(spark, path, [("a", 1, " ", 0), ("a", 2, "two", 0), ("a", 3, None, 0)])
    merge(spark, path, [("a", 1, "", 0), ("a", 1, "late", 2), ("a", 1, "one", 1), ("a", 2, "other", 0), ("a", 5, "five", 0)])
    got = state(spark, path)
    assert got["a", 1] == "one" and got["a", 2] == "two" and not got["a", 3] and got["a", 5] == "five" and len(got) == 4


def test_failed_write_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    merge(spark, path, [("a", None, "a0", 0)])
    before = listing(path, "a")
    bad = spark.createDataFrame([("a", None, "a1", 1)], "topic string, scenario_index long, description string, at int")
    with pytest.raises(Exception, match="lost"):
        PT.merge_progress(bad.withColumn("description", F.raise_error(F.lit("lost")).cast("string")), path, ["at"])
    assert state(spark, path) == {("a", 1): "a0"} and listing(path, "a") == before
    merge(spark, path, [])
    assert state(spark, path) == {("a", 1): "a0"}


@pytest.mark.parametrize("files", [1, 4, 9])
def test_live_counters(spark, tmp_path, files):
    """As the window over the whole log, whatever the files, over a restart in the middle."""
    from turnweave.operators.progress import running_counters
    from turnweave.sources.sinks import PROGRESS_COLUMNS
    from turnweave.streaming.progress_log import COUNTED, live_counters, progress_stream

    rows = [(f"{i:03d}", "ab"[i % 3 % 2], f"d{i}", ["OK", "SKIP", "FAIL", "OTHER"][i * 7 % 4]) for i in range(90)]
    log = tmp_path / "log"
    log.mkdir()

    def put(part, k):
        lines = ["\t".join({"ts": t, "topic": p, "dialogue_id": d, "status": s}.get(c, "x") for c in PROGRESS_COLUMNS) for t, p, d, s in part]
        (log / f"part-{k:03d}.csv").write_text("\n".join(lines[::-1]) + "\n")
        os.utime(log / f"part-{k:03d}.csv", (1_000_000 + k, 1_000_000 + k))

    def run():
        s = live_counters(progress_stream(spark, str(log), files=2))
        q = s.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out"))
        q.awaitTermination(240)

    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        size = -(-90 // files)
        for k in range(files):
            put(rows[k * size : (k + 1) * size], k)
            if k == files // 2:
                run()
        run()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)
    df = spark.createDataFrame(rows, "ts string, topic string, dialogue_id string, status string")
    want = running_counters(df, ["topic"], ["ts", "dialogue_id"], {n: F.col("status") == s for n, s in COUNTED.items()})
    cols = ["topic", "ts", "dialogue_id", "status", "done", *COUNTED]
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))
