"""Whole export rows over the conversations, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import lookups as L
from ..operators.turn_rows import Options, turn_rows
from .inputs import TURNS, table, turns

Q: dict = {}
SQL: dict[str, str] = {}


def _inputs(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Records of turns, scenarios, prompts, scripts and a listing of audio, made from the conversations."""
    h, n = F.col("h"), F.col("conv_id").cast("string")
    topic = F.concat(F.lit("T"), (F.col("conv_id") % 5).cast("string"))
    ident = F.concat_ws("_", topic, F.lit("normal"), n, F.when(F.col("conv_id") % 3 == 0, "1"))
    t = turns(spark, d).withColumns({"topic": topic, "dialogue_id": ident, "folder": F.concat(F.lit("wav/"), ident)})
    record = F.struct(
        F.col("turn_index").alias("turn_idx"),
        F.when(h % 17 != 0, F.lower("speaker")).alias("speaker"),
        "text",
        F.struct(F.when(h % 2 == 0, "male").alias("gender"), F.lit("low").alias("pitch")).alias("para_tags"),
        (F.col("frames") / 24000.0).alias("audio_duration"),
        F.concat(F.lit("old/"), h.cast("string")).alias("audio_path"),
        F.when(h % 6 != 0, F.concat(F.lit("clip"), (h % 9).cast("string"))).alias("speaker_reference"),
    )
    odd = F.concat(
        F.when(h % 3 == 0, ',"emotion_reference":["a","b"]').when(h % 3 == 1, ',"emotion_reference":"a"').otherwise(',"emotion_reference":null'),
        F.when(h % 4 == 0, ',"speaker_reference_metadata":{"age":"20s","gender_norm":"male"}}').when(h % 4 == 1, ',"speaker_reference_metadata":null}').when(h % 4 == 2, "}").otherwise(',"speaker_reference_metadata":"x"}'),
    )
    records = t.select("dialogue_id", "topic", "folder", F.concat(F.regexp_replace(F.to_json(record), r"\}$", ""), odd).alias("record"))
    c = table(spark, d, "conversations").select("conv_id", "role", "text", topic.alias("topic"))
    k = F.col("conv_id")
    ids = c.select("conv_id", "topic").distinct()
    scenarios = ids.where(k % 7 != 0).select("topic", F.concat(F.lit("scenario"), k.cast("string")).alias("scenario_id"), F.concat(F.lit("about "), k.cast("string")).alias("description"))
    system = c.where("role = 'system'").groupBy("conv_id", "topic").agg(F.min("text").alias("text"))
    bare = F.concat(F.lit("scenario"), k.cast("string"))
    named = F.concat_ws("_", "topic", bare)
    prompts = system.select("topic", F.when(k % 3 == 0, "current").otherwise("legacy").alias("layout"), F.when(k % 3 == 2, F.format_string("scenario%06d", "conv_id")).otherwise(named).alias("stem"), "text")
    prompts = prompts.unionByName(system.where(k % 6 == 0).select("topic", F.lit("legacy").alias("layout"), bare.alias("stem"), F.lit("another").alias("text")))
    script = lambda cond, stage, stem: ids.where(cond).select("topic", F.lit(stage).alias("stage"), F.concat(F.lit(f"txt/{stage}/"), stem, F.lit(".txt")).alias("path"))
    texts = script(k % 4 == 0, "filler", named).unionByName(script(k % 4 < 2, "overlap", bare)).unionByName(script(k % 4 < 3, "dialogue", named)).unionByName(script(k % 8 == 0, "filler", F.concat(named, F.lit("_1"))))
    wav = lambda cond, tail: t.where(cond).select(F.concat("folder", F.lit("/individual/turn"), F.format_string("%02d", "turn_index"), F.lit(tail)).alias("path"))
    files = wav(h % 5 != 0, ".wav").unionByName(wav(h % 7 != 0, "_pause_overlap.wav"))
    return {"records": records, "scenarios": scenarios, "prompts": prompts, "texts": texts, "files": files}


def turn_rows_full(spark: SparkSession, d: str) -> DataFrame:
    """All 32 columns of the export; nested ones are given as strings."""
    rows = turn_rows(**_inputs(spark, d), o=Options(root="data", user_model="user/m", agent_model="agent/m", agent_prompt="Be kind.", effects=True))
    return rows.withColumns({"emotion_reference": F.array_join("emotion_reference", ","), "paralinguistic_info": F.to_json("paralinguistic_info")})


Q["turn_rows_full"] = turn_rows_full
SQL["turn_rows_full"] = (
    rf"WITH {TURNS}, t AS (SELECT *, 'T' || conv_id % 5 AS topic, concat_ws('_', 'T' || conv_id % 5, 'normal', conv_id) AS cid, CASE WHEN conv_id % 3 = 0 THEN '_1' ELSE '' END AS tail, "
    r"printf('/individual/turn%02d', turn_index) AS p FROM turns), s AS (SELECT conv_id, trim(min(text)) AS own FROM conversations WHERE role = 'system' GROUP BY conv_id), "
    r"x AS (SELECT t.*, 'wav/' || cid || tail AS f, CASE WHEN conv_id % 7 <> 0 THEN 'about ' || conv_id END AS scenario, nullif(own, '') AS own FROM t LEFT JOIN s USING (conv_id)) "
    r"SELECT cid AS conversation_id, 'normal' AS mode, topic, scenario, "
    r"CASE conv_id % 4 WHEN 0 THEN 'txt/filler/' || topic || '_scenario' || conv_id || '.txt' WHEN 1 THEN 'txt/overlap/scenario' || conv_id || '.txt' WHEN 2 THEN 'txt/dialogue/' || topic || '_scenario' || conv_id || '.txt' END AS final_txt_path, "
    r"coalesce(own, 'Be kind.' || chr(10) || chr(10) || 'Topic（分類名稱，不要直接講出英文）：' || topic || chr(10) || 'Scenario ID：scenario' || conv_id || chr(10) || 'Scenario description：' || coalesce(scenario, '')) AS system_prompt, "
    r"CAST(turn_index AS INTEGER) AS turn_index, 'user/m' AS LLM1, 'agent/m' AS LLM2, CASE WHEN h % 17 = 0 THEN 'unknown' ELSE lower(speaker) END AS speaker, text, "
    r"""CASE WHEN h % 2 = 0 THEN '{"gender":"male","pitch":"low"}' ELSE '{"pitch":"low"}' END AS paralinguistic_info, """
    r"f || p || '.wav' AS audio_path, CASE WHEN h % 5 <> 0 THEN 'data/' || f || p || '.wav' ELSE 'old/' || h END AS audio, CAST(0 AS FLOAT) AS audio_start, CAST(0 AS FLOAT) AS audio_end, CAST(frames / 24000.0 AS FLOAT) AS audio_duration, "
    r"'data/' || f || '/full.wav' AS full_dialogue_audio, CAST(NULL AS VARCHAR) AS emotion, CASE WHEN h % 6 <> 0 THEN 'clip' || h % 9 END AS reference, CAST(NULL AS VARCHAR) AS reference_id, "
    r"""CASE WHEN h % 4 = 0 THEN '{"age":"20s","gender_norm":"male"}' END AS reference_metadata, CASE WHEN h % 4 = 0 THEN '20s' END AS reference_age, CASE WHEN h % 4 = 0 THEN 'male' END AS reference_gender, CAST(NULL AS VARCHAR) AS reference_accent, """
    r"CASE h % 3 WHEN 0 THEN 'a,b' WHEN 1 THEN 'a' ELSE '' END AS emotion_reference, f || p || '_pause_overlap.wav' AS audio_path_pause_overlap, "
    r"CASE WHEN h % 7 <> 0 THEN 'data/' || f || p || '_pause_overlap.wav' ELSE '' END AS audio_pause_overlap, CAST(NULL AS FLOAT) AS audio_start_pause_overlap, CAST(NULL AS FLOAT) AS audio_end_pause_overlap, "
    r"CAST(NULL AS FLOAT) AS audio_duration_pause_overlap, 'data/' || f || '/full_with_overlap_and_pause.wav' AS full_dialogue_audio_pause_overlap FROM x"
)


def zipped_prompts(spark: SparkSession, d: str) -> DataFrame:
    """Prompts for speech: the n-th line of a user with the n-th of the agent as its tags."""
    t = turns(spark, d)
    met = L.zipped(t.where("speaker = 'User'").select("conv_id", "turn_index", "text"), t.where("speaker = 'Agent'"), ["conv_id"], "turn_index", "text")
    return met.select("conv_id", "turn_index", X.reference_prompt(F.lit("local accent"), F.col("tag"), F.col("text")).alias("prompt"))


Q["zipped_prompts"] = zipped_prompts
SQL["zipped_prompts"] = (
    rf"WITH {TURNS}, p AS (SELECT *, row_number() OVER (PARTITION BY conv_id, speaker ORDER BY turn_index, text) AS n FROM turns) "
    r"SELECT a.conv_id, a.turn_index, '[local accent]' || coalesce(b.text, '') || ' ' || a.text AS prompt FROM p a LEFT JOIN p b ON a.conv_id = b.conv_id AND a.n = b.n AND b.speaker = 'Agent' WHERE a.speaker = 'User'"
)
