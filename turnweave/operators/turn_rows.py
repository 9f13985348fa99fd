"""Export rows of turns: their records joined with scenario, prompt, script and the audio that is there.

A turn's record is a JSON object; it is parsed once, as a variant, so that a member that is null
and one that is missing stay apart.  Prompts, scripts and scenarios are settled for each dialogue, and each
kind's candidates by one aggregate over ranks, so that turns meet a single joined row; the
listing of audio files becomes one row a turn and is joined once for both mixes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

#: Stages whose scripts a dialogue is exported with, the preferred first.  Fixed values.
SCRIPT_STAGES = ("filler", "overlap", "dialogue")
#: What a prompt without its own text says about the scenario.  Fixed value.
CONTEXT = "Topic（分類名稱，不要直接講出英文）：%s\nScenario ID：%s\nScenario description：%s\n"
#: Marks of a turn's delivery.  Fixed values.
PARALINGUISTIC = ("gender", "pitch", "speed", "volume", "emotion")


@dataclass(frozen=True)
class Options:
    root: str = ""
    mode: str = "normal"
    user_model: str = ""
    agent_model: str = ""
    agent_prompt: str = ""
    script_stage: str | None = None  # preferred over the others
    effects: bool | None = None  # null: if any dialogue has a mix with effects


def dialogue_parts(c: Column) -> dict[str, Column]:
    """``scenario_index, dialogue_index, conversation_id`` of ``topic_mode_scenario[_k]``, read from the
    right; an id of another form is its own conversation."""
    form = r"^(.+_[^_]+_(?:scenario)?(\d+))(?:_(\d+))?$"
    part = lambda i: X.none_if_empty(F.regexp_extract(c, form, i))
    # topic_mode_N_k: the first digits from the left that only k may follow
    long = r"^(.+_[^_\d][^_]*_(?:scenario)?(\d+))_(\d+)$"
    of_long = lambda i: X.none_if_empty(F.regexp_extract(c, long, i))
    return {
        "scenario_index": F.coalesce(of_long(2), part(2)).cast("bigint"),
        "dialogue_index": F.coalesce(of_long(3), part(3)).cast("bigint"),
        "conversation_id": F.coalesce(of_long(1), part(1), c),
    }


def best_prompts(prompts: DataFrame) -> DataFrame:
    """``topic, scenario_index, prompt``: the text in the current layout, else a legacy one named with the
    topic, else by scenario, else by its number in six digits.  A blank text counts as none.

    ``prompts`` has ``topic, layout, stem, text``; names of another form are passed over.
    """
    named = X.parse_stem(F.col("stem"))
    own = named["prefix"] == X.topic_label(F.col("topic"))
    bare = named["prefix"].isNull()
    padded = F.col("stem").rlike(r"^scenario0\d{5}$")
    old = F.col("layout") == "legacy"
    rank = F.when(~old & own, 0).when(old & own, 1).when(old & bare & ~padded, 2).when(old & bare & padded, 3)
    ranked = prompts.select("topic", named["scenario_index"].alias("scenario_index"), rank.alias("_r"), "text").where("_r is not null and scenario_index is not null")
    best = ranked.groupBy("topic", "scenario_index").agg(F.min(F.struct("_r", "text")).alias("_b"))
    return best.select("topic", "scenario_index", X.none_if_empty(X.strip(F.col("_b.text"))).alias("prompt"))


def best_scripts(dialogues: DataFrame, texts: DataFrame, preferred: str | None = None) -> DataFrame:
    """``dialogues`` with ``final_txt_path``: the first stage's script, and within a stage one named with
    the topic, a bare one, then those that name the dialogue's number too.

    ``texts`` has ``topic, stage, path``.
    """
    first = (preferred or "").strip().lower()
    order = [s for s in (first, *SCRIPT_STAGES) if s in SCRIPT_STAGES]
    stage = F.array_position(F.array(*map(F.lit, dict.fromkeys(order))), F.col("stage"))
    stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "")
    n = X.parse_stem(stem)
    fits = (stage > 0) & n["scenario_index"].isNotNull() & (n["prefix"].isNull() | (n["prefix"] == X.topic_label(F.col("topic"))))
    place = F.struct(stage.alias("s"), F.when(n["prefix"].isNull(), 1).otherwise(0).alias("b"), "path")
    ranked = texts.where(fits).select("topic", n["scenario_index"].alias("scenario_index"), n["dialogue_index"].alias("dialogue_index"), place.alias("_p"))
    # any dialogue of the scenario may take a script without a number; numbered ones come after it in a stage
    item = lambda numbered: F.min(F.struct("_p.s", F.lit(numbered).alias("k"), "_p.b", "_p.path"))
    shared = ranked.where("dialogue_index is null").groupBy("topic", "scenario_index").agg(item(0).alias("_shared"))
    own = ranked.where("dialogue_index is not null").groupBy("topic", "scenario_index", "dialogue_index").agg(item(1).alias("_own"))
    met = dialogues.join(shared, ["topic", "scenario_index"], "left").join(own, ["topic", "scenario_index", "dialogue_index"], "left")
    return met.select(*dialogues.columns, F.least("_shared", "_own")["path"].alias("final_txt_path"))


def audio_listing(files: DataFrame) -> DataFrame:
    """``dialogue_id, turn_index, clean, fx``: which of a turn's files are in a listing of ``path``."""
    form = r"([^/]+)/individual/turn(\d+)(_pause_overlap)?\.wav$"
    part = lambda i: F.regexp_extract("path", form, i)
    found = files.where(F.col("path").rlike(form)).select(part(1).alias("dialogue_id"), part(2).cast("int").alias("turn_index"), (part(3) == "").alias("_clean"))
    return found.groupBy("dialogue_id", "turn_index").agg(F.bool_or("_clean").alias("clean"), F.bool_or(~F.col("_clean")).alias("fx"))


def _get(path: str, kind: str, missing: object = None) -> Column:
    """A member of the record; ``missing`` where there is none, null where it is null or of another kind."""
    value = F.try_variant_get("_v", path, kind)
    return value if missing is None else F.when(F.try_variant_get("_v", path, "variant").isNull(), F.lit(missing).cast(kind)).otherwise(value)


def turn_rows(records: DataFrame, scenarios: DataFrame, prompts: DataFrame, texts: DataFrame, files: DataFrame, o: Options = Options()) -> DataFrame:
    """One row for each turn's record, in 26 columns, and six more for the mix with effects.

    ``records`` has ``dialogue_id, topic, folder`` (below the root) ``, record``; ``scenarios`` has
    ``topic, scenario_id, description``; ``files`` lists ``path``.  A record that isn't an object of JSON has
    defaults everywhere; so has a turn without an index, which counts as turn 0.
    """
    keys = dialogue_parts(F.col("dialogue_id"))
    dialogues = records.select("dialogue_id", "topic").distinct().select("dialogue_id", "topic", *(c.alias(n) for n, c in keys.items()))
    told = scenarios.select("topic", X.scenario_index(X.canonical_scenario_id(F.col("scenario_id"))).alias("scenario_index"), F.col("description").alias("scenario"))
    told = told.where("scenario_index is not null").groupBy("topic", "scenario_index").agg(F.min("scenario").alias("scenario"))
    known = best_scripts(dialogues, texts, o.script_stage).join(told, ["topic", "scenario_index"], "left").join(best_prompts(prompts), ["topic", "scenario_index"], "left")
    name = F.concat(F.lit("scenario"), F.col("scenario_index").cast("string"))
    context = F.when(F.col("scenario_index").isNotNull(), F.concat(F.lit("\n\n"), F.format_string(CONTEXT, F.col("topic"), name, F.coalesce("scenario", F.lit("")))))
    fallback = X.none_if_empty(X.strip(F.concat(F.lit(o.agent_prompt), F.coalesce(context, F.lit("")))))
    known = known.select("dialogue_id", "topic", "conversation_id", "scenario", "final_txt_path", F.coalesce("prompt", fallback).alias("system_prompt"))

    effects = o.effects
    if effects is None:
        effects = not files.where(F.col("path").endswith("/full_with_overlap_and_pause.wav")).isEmpty()
    parsed = records.select("dialogue_id", "topic", "folder", F.try_parse_json("record").alias("_v")).withColumn("turn_index", F.coalesce(_get("$.turn_idx", "int"), F.lit(0)))
    t = parsed.join(known, ["dialogue_id", "topic"], "left").join(audio_listing(files), ["dialogue_id", "turn_index"], "left")

    below = lambda c: F.concat(F.lit(o.root.rstrip("/") + "/" if o.root else ""), c)
    turn = F.concat("folder", F.lit("/individual/turn"), F.format_string("%02d", "turn_index"))
    clean, fx = F.concat(turn, F.lit(".wav")), F.concat(turn, F.lit("_pause_overlap.wav"))
    meta = F.try_variant_get("_v", "$.speaker_reference_metadata", "variant")
    is_object = F.coalesce(F.schema_of_variant(meta).startswith("OBJECT"), F.lit(False))
    of_meta = lambda k: F.when(is_object, F.try_variant_get(meta, f"$.{k}", "string"))
    refs = F.try_variant_get("_v", "$.emotion_reference", "variant")
    kind = F.schema_of_variant(refs)
    none = F.array().cast("array<string>")
    several = F.when(kind.startswith("ARRAY"), F.try_variant_get(refs, "$", "array<string>")).when(kind == "STRING", X.as_list(F.try_variant_get(refs, "$", "string")))

    columns = [
        F.coalesce("conversation_id", "dialogue_id").alias("conversation_id"),
        F.lit(o.mode).alias("mode"),
        "topic",
        "scenario",
        "final_txt_path",
        "system_prompt",
        "turn_index",
        F.lit(o.user_model).alias("LLM1"),
        F.lit(o.agent_model).alias("LLM2"),
        _get("$.speaker", "string", "unknown").alias("speaker"),
        _get("$.text", "string", "").alias("text"),
        F.struct(*(_get(f"$.para_tags.{k}", "string").alias(k) for k in PARALINGUISTIC)).alias("paralinguistic_info"),
        clean.alias("audio_path"),
        F.when(F.col("clean"), below(clean)).otherwise(_get("$.audio_path", "string", "")).alias("audio"),
        _get("$.audio_start", "float", 0.0).alias("audio_start"),
        _get("$.audio_end", "float", 0.0).alias("audio_end"),
        _get("$.audio_duration", "float", 0.0).alias("audio_duration"),
        below(F.concat("folder", F.lit("/full.wav"))).alias("full_dialogue_audio"),
        _get("$.emotion", "string").alias("emotion"),
        _get("$.speaker_reference", "string").alias("reference"),
        _get("$.speaker_reference_id", "string").alias("reference_id"),
        F.when(is_object, F.to_json(meta)).alias("reference_metadata"),
        of_meta("age").alias("reference_age"),
        of_meta("gender_norm").alias("reference_gender"),
        of_meta("accents").alias("reference_accent"),
        F.coalesce(several, none).alias("emotion_reference"),
    ]
    if effects:
        columns += [
            fx.alias("audio_path_pause_overlap"),
            F.when(F.col("fx"), below(fx)).otherwise(_get("$.audio_path_pause_overlap", "string", "")).alias("audio_pause_overlap"),
            _get("$.audio_start_pause_overlap", "float").alias("audio_start_pause_overlap"),
            _get("$.audio_end_pause_overlap", "float").alias("audio_end_pause_overlap"),
            _get("$.audio_duration_pause_overlap", "float").alias("audio_duration_pause_overlap"),
            below(F.concat("folder", F.lit("/full_with_overlap_and_pause.wav"))).alias("full_dialogue_audio_pause_overlap"),
        ]
    return t.select(*columns)
