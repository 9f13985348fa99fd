"""Attempts over pending requests, and answers asked for once."""

import pytest
from pyspark.sql import functions as F

from turnweave.operators import attempts as AT

SCRIPT = {  # key: what each attempt says
    "ok": ["done"], "twice": [503, 429, "done"], "slow": ["Read timed out", "done"], "reset": ["connection was reset by peer", "temporarily unavailable: service", "done"],
    "bad": [400], "late": [500, 404], "never": [503, 503, 503, 503, 503], "odd": ["ValueError: nothing"],
}


def service(log, script=SCRIPT):
    def call(pending, attempt):
        log.append((attempt, sorted(r.key for r in pending.select("key").collect())))
        rows = []
        for k in log[-1][1]:
            s = script[k][attempt - 1]
            rows.append((k, f"reply {k}" if s == "done" else None, s if isinstance(s, int) else None, None if s == "done" else f"HTTP {s}" if isinstance(s, int) else s))
        return pending.sparkSession.createDataFrame(rows, "key string, reply string, status int, error string")

    return call


def test_states(spark, tmp_path):
    log, waits = [], []
    df = spark.createDataFrame([(k,) for k in [*SCRIPT, "ok", None]], "key string")
    run = lambda: {r.key: (r.state, r.attempts, r.reply, r.error) for r in AT.run_attempts(df, service(log), str(tmp_path / "s"), max_attempts=4, sleep=waits.append).collect()}
    got = run()
    assert got == {
        "ok": ("done", 1, "reply ok", None), "twice": ("done", 3, "reply twice", None), "slow": ("done", 2, "reply slow", None), "reset": ("done", 3, "reply reset", None),
        "bad": ("fatal", 1, None, "HTTP 400"), "late": ("fatal", 2, None, "HTTP 404"), "never": ("exhausted", 4, None, "HTTP 503"), "odd": ("fatal", 1, None, "ValueError: nothing"),
    }
    assert log == [(1, sorted(SCRIPT)), (2, ["late", "never", "reset", "slow", "twice"]), (3, ["never", "reset", "twice"]), (4, ["never"])] and waits == [1.0, 2.0, 4.0]
    assert run() == got and len(log) == 4  # nothing is asked again


def test_lost_run_goes_on(spark, tmp_path):
    """A run that dies in its second attempt leaves the first; the next one starts from there."""
    log, path = [], str(tmp_path / "s")
    df = spark.createDataFrame([("twice",), ("ok",)], "key string")

    def dies(pending, attempt):
        if attempt == 2:
            return pending.select("key", F.raise_error(F.lit("lost")).cast("string").alias("reply"), F.lit(200).alias("status"), F.lit(None).alias("error"))
        return service(log)(pending, attempt)

    with pytest.raises(Exception, match="lost"):
        AT.run_attempts(df, dies, path, sleep=None)
    got = {r.key: r.state for r in AT.run_attempts(df, service(log), path, sleep=None).collect()}
    assert got == {"twice": "done", "ok": "done"} and log == [(1, ["ok", "twice"]), (2, ["twice"]), (3, ["twice"])]


def test_denied(spark, tmp_path):
    log = []
    df = spark.createDataFrame([("a",), ("b",)], "key string")
    with pytest.raises(AT.AccessDenied):
        AT.run_attempts(df, service(log, {"a": ["done"], "b": [401, "done"]}), str(tmp_path / "s"), sleep=None)
    got = AT.run_attempts(df, service(log, {"a": ["done"], "b": [401, "done"]}), str(tmp_path / "s"), sleep=None)
    assert {r.key: r.attempts for r in got.collect()} == {"a": 1, "b": 2} and log[-1] == (2, ["b"])
    assert AT.run_attempts(df.limit(0), service(log), str(tmp_path / "t"), sleep=None).count() == 0


def test_answers_once(spark, tmp_path):
    """One call for each distinct clip without a sentence; none on a rerun; only new clips later."""
    asked = []

    def call(one):
        rows = one.collect()
        asked.append(sorted(bytes(r.content).decode() for r in rows))
        return spark.createDataFrame([(r.digest, None if bytes(r.content) == b"noise" else f"heard {bytes(r.content).decode()}") for r in rows], "digest string, answer string")

    rows = [(1, b"a", None, "p"), (2, b"a", " ", "p"), (3, b"b", "said", "p"), (4, b"noise", None, "p"), (5, None, None, "p"), (6, b"c", "", "p")]
    df = spark.createDataFrame(rows, "i int, content binary, sentence string, digest string").repartition(3)
    for _ in range(2):
        got = {r.i: r.sentence for r in AT.fill_once(df, call, str(tmp_path / "m")).collect()}
        assert got == {1: "heard a", 2: "heard a", 3: "said", 4: None, 5: None, 6: "heard c"}
    assert asked == [["a", "c", "noise"], []]
    more = df.unionByName(spark.createDataFrame([(7, b"d", None, "q")], df.schema))
    assert {r.sentence for r in AT.fill_once(more, call, str(tmp_path / "m")).where("i = 7").collect()} == {"heard d"} and asked[-1] == ["d"]
