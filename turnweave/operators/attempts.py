"""Calls to outside systems as tables: attempts over what is still pending, and answers that are asked for once.

Outcomes are appended to a table in a folder, one part an attempt, so that a run that is lost goes on from
the last attempt that was written whole, and no answer is paid for twice.  Only counts reach the driver.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Status codes that are worth another attempt, and those that no attempt can change.
TRANSIENT, DENIED = (408, 409, 429, 500, 502, 503, 504), (401, 403)


class AccessDenied(RuntimeError):
    """The service refuses the credentials, so the other requests would fail too."""


def outcome(status: Column, error: Column) -> Column:
    """``done, transient, denied`` or ``fatal`` of one call."""
    text = F.lower(F.coalesce(error, F.lit("")))
    passing = text.rlike("timeout|timed out") | text.rlike("connection.*(reset|aborted|refused)|(reset|aborted|refused).*connection") | (text.contains("temporarily") & text.contains("unavailable"))
    return (
        F.when(error.isNull() & (status.isNull() | status.between(200, 299)), "done")
        .when(status.isin(*DENIED), "denied")
        .when(status.isin(*TRANSIENT) | passing, "transient")
        .otherwise("fatal")
    )


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _finished(spark: SparkSession, path: str) -> int:
    """The number of the last attempt that was written whole."""
    n = 0
    while _exists(spark, f"{path}/attempt={n + 1}/_SUCCESS"):
        n += 1
    return n


def run_attempts(
    requests: DataFrame,
    call: Callable[[DataFrame, int], DataFrame],
    path: str,
    key: str = "key",
    max_attempts: int = 20,
    base: float = 2.0,
    cap: float = 300.0,
    sleep: Callable[[float], None] = time.sleep,
) -> DataFrame:
    """``key, state, attempts, reply, error`` of each key of ``requests``.

    ``call`` gets the pending requests (one row a key) and the attempt's number, and returns ``key, reply,
    status, error``.  After each attempt those that failed in passing are pending again, others are
    ``done`` or ``fatal``; what is still pending after ``max_attempts``, or has no outcome, is ``exhausted``.
    Waits grow by ``base`` up to ``cap`` seconds.  ``AccessDenied`` ends the run once the attempt
    is written; a later run asks the denied ones again.  Null keys are not asked; of rows with one key any one is.
    """
    spark = requests.sparkSession
    asked = requests.where(F.col(key).isNotNull()).dropDuplicates([key])
    kind = requests.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, reply string, status int, error string, state string"

    def outcomes(n: int) -> DataFrame:
        if not n:
            return spark.createDataFrame([], f"{schema}, attempt int")
        parts = [spark.read.schema(schema).parquet(f"{path}/attempt={i}").withColumn("attempt", F.lit(i)) for i in range(1, n + 1)]
        whole = parts[0]
        for p in parts[1:]:
            whole = whole.unionByName(p)
        return whole

    n = _finished(spark, path)
    while n < max_attempts:
        over = outcomes(n).where("state in ('done', 'fatal')").select(key)
        pending = asked.join(over, key, "left_anti")
        if not pending.limit(1).count():
            break
        if n and sleep:
            sleep(min(cap, base ** (n - 1)))
        n += 1
        said = call(pending, n).select(key, F.col("reply").cast("string").alias("reply"), F.col("status").cast("int").alias("status"), F.col("error").cast("string").alias("error"))
        said.withColumn("state", outcome(F.col("status"), F.col("error"))).write.mode("overwrite").parquet(f"{path}/attempt={n}")
        denied = outcomes(n).where((F.col("attempt") == n) & (F.col("state") == "denied")).limit(1).count()
        if denied:
            raise AccessDenied("the service refused the credentials; see the attempt's errors")
    order = F.struct(F.col("state").isin("done", "fatal"), "attempt")
    last = outcomes(n).groupBy(key).agg(F.max_by(F.struct("state", "reply", "error"), order).alias("_l"), F.max("attempt").alias("attempts"))
    state = F.when(F.col("_l.state").isin("done", "fatal"), F.col("_l.state")).otherwise("exhausted")
    return asked.select(key).join(last, key, "left").select(key, state.alias("state"), F.coalesce("attempts", F.lit(0)).alias("attempts"), F.when(state == "done", F.col("_l.reply")).alias("reply"), F.when(state != "done", F.col("_l.error")).alias("error"))


def fill_once(clips: DataFrame, call: Callable[[DataFrame], DataFrame], path: str, content: str = "content", value: str = "sentence") -> DataFrame:
    """``clips`` with ``value`` filled where it is null or blank, from one call for each distinct content.

    Answers are kept under ``path`` by the content's digest, and only digests without one are asked for:
    ``call`` gets ``digest, content`` and returns ``digest, answer`` (null: none, and not asked again).
    Equal contents are combined before the shuffle, and the answers meet the clips by digest.  A clip without
    content stays as it is.
    """
    spark = clips.sparkSession
    blank = F.col(value).isNull() | (F.trim(F.col(value)) == "")
    keyed = clips.withColumn("_digest", F.when(blank & F.col(content).isNotNull(), F.sha2(F.col(content).cast("binary"), 256)))
    schema = "digest string, answer string"
    known = spark.read.schema(schema).parquet(path) if _exists(spark, path) else spark.createDataFrame([], schema)
    todo = keyed.where("_digest is not null").select(F.col("_digest").alias("digest"), F.col(content).alias("content")).join(known.select("digest").distinct(), "digest", "left_anti")
    one = todo.groupBy("digest").agg(F.first("content").alias("content"))
    call(one).select("digest", F.col("answer").cast("string").alias("answer")).write.mode("append").parquet(path)
    memo = spark.read.schema(schema).parquet(path).groupBy("digest").agg(F.max("answer").alias("_answer"))
    # clips that ask for nothing have no digest, and take no part in the join
    asking = keyed.where("_digest is not null").join(memo.withColumnRenamed("digest", "_digest"), "_digest", "left")
    filled = asking.withColumn(value, F.coalesce("_answer", value)).select(*clips.columns)
    return filled.unionByName(keyed.where("_digest is null").select(*clips.columns))
