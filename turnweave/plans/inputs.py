"""Pipeline inputs derived from the driver's tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import keyed_draw

POOL = ["happy", "sad", "angry", "calm", "anxiety", "surprise"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spoken turns: system rows left out, white space made single, 1200 frames a letter."""
    c = table(spark, sf_dir, "conversations").where("role <> 'system'")
    text = F.trim(F.regexp_replace("text", r"[ \t\r\n]+", " "))
    t = c.select("conv_id", "turn", F.when(F.col("role") == "user", "User").otherwise("Agent").alias("speaker"), text.alias("text"))
    index = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")) - 1
    return t.select("conv_id", index.cast("long").alias("turn_index"), "speaker", "text", (F.length("text") * 1200).cast("long").alias("frames"), keyed_draw(F.col("conv_id"), F.col("turn")).alias("h"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Script lines with markers and tag variants chosen by a keyed hash."""
    h, t = F.col("h"), F.col("text")
    role = (
        F.when((h % 7 == 0) & (F.col("speaker") == "User"), "[overlap] User")
        .when(h % 11 == 0, "[pause] User")
        .when(h % 13 == 0, F.concat(F.lit("[backchannel] "), "speaker"))
        .otherwise(F.col("speaker"))
    )
    content = (
        F.when(F.col("role") == "[pause] User", F.lit("[pause]"))
        .when(h % 8 == 0, F.concat(F.lit("(emotion:happy) "), t))
        .when(h % 8 == 1, F.concat(F.lit("**(sad) "), t))
        .when(h % 8 == 2, F.concat(F.lit("/emotion:angry/ "), t))
        .when(h % 8 == 3, F.concat(t, F.lit(" (anxiety)")))
        .when(h % 8 == 4, F.concat(F.lit("emotion:calm "), t))
        .when(h % 8 == 5, F.concat(t, F.lit(" (emotion:surprise)")))
        .when(h % 8 == 6, F.concat(F.lit("(unknown) A P P "), t))
        .otherwise(t)
    )
    return turns(spark, sf_dir).withColumn("role", role).withColumn("content", content)


def scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One script text per dialogue, and its lines as an array."""
    line = F.concat("role", F.lit(": "), "content")
    rows = lines(spark, sf_dir).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn_index", line.alias("line")))).alias("a"))
    arr = F.transform("a", lambda x: x["line"])
    return rows.select("conv_id", arr.alias("lines"), F.array_join(arr, "\n").alias("script"))


TURNS = r"""
t0 AS (SELECT conv_id, turn, role, trim(regexp_replace(text, '[ \t\r\n]+', ' ', 'g'), ' ') AS text FROM conversations WHERE role <> 'system'),
turns AS (
  SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS BIGINT) AS turn_index,
         CASE role WHEN 'user' THEN 'User' ELSE 'Agent' END AS speaker, text, CAST(length(text) * 1200 AS BIGINT) AS frames,
         ('0x' || substr(md5(concat_ws(':', conv_id, turn)), 1, 8))::BIGINT AS h
  FROM t0)"""
LINES = (
    TURNS
    + r""",
l0 AS (
  SELECT *, CASE WHEN h % 7 = 0 AND speaker = 'User' THEN '[overlap] User' WHEN h % 11 = 0 THEN '[pause] User'
                 WHEN h % 13 = 0 THEN '[backchannel] ' || speaker ELSE speaker END AS role FROM turns),
lines AS (
  SELECT *, CASE WHEN role = '[pause] User' THEN '[pause]' WHEN h % 8 = 0 THEN '(emotion:happy) ' || text WHEN h % 8 = 1 THEN '**(sad) ' || text
                 WHEN h % 8 = 2 THEN '/emotion:angry/ ' || text WHEN h % 8 = 3 THEN text || ' (anxiety)' WHEN h % 8 = 4 THEN 'emotion:calm ' || text
                 WHEN h % 8 = 5 THEN text || ' (emotion:surprise)' WHEN h % 8 = 6 THEN '(unknown) A P P ' || text ELSE text END AS content
  FROM l0)"""
)
SCRIPTS = LINES + r""",
scripts AS (SELECT conv_id, list(role || ': ' || content ORDER BY turn_index) AS lines, string_agg(role || ': ' || content, chr(10) ORDER BY turn_index) AS script FROM lines GROUP BY conv_id)"""
