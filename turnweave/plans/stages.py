"""The pipeline's stages as DataFrame functions, with external systems as plug-ins.

A ``Generator`` turns prompts into replies and a ``Synthesizer`` lines into frame counts.  Real
ones call services; the stubs here are deterministic and say so in what they return.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field, fields
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import json_repair as J
from ..functions import text as X
from ..operators import lookups as L
from ..operators import progress as P
from ..operators import timeline as TL
from ..sources import sinks

ORDER = ("scenario", "system_prompt", "dialogue", "overlap", "filler", "judge", "tts", "export")


class Generator(Protocol):
    def reply(self, prompt: Column, key: Column) -> Column: ...


class Synthesizer(Protocol):
    def frames(self, text: Column) -> Column: ...


class StubGenerator:
    """Echoes a digest of the prompt; no model is called."""

    def reply(self, prompt: Column, key: Column) -> Column:
        return F.concat(F.lit("stub reply "), F.substring(F.md5(F.concat_ws("|", prompt, key.cast("string"))), 1, 12))


class StubSynthesizer:
    """1200 frames a letter; missing text counts as one second of silence."""

    def frames(self, text: Column) -> Column:
        return F.coalesce((F.length(text) * 1200).cast("long"), F.lit(TL.RATE).cast("long"))


@dataclass
class Config:
    topics: list[str] = field(default_factory=lambda: ["Travel"])
    stages: tuple[str, ...] = ("scenario", "system_prompt", "dialogue", "overlap", "filler", "judge", "tts")
    scenarios_per_topic: int = 130
    turns: tuple[int, int] = (12, 15)
    emotion_rate: float = 0.5
    top_x: int = 1
    emotions: list[str] = field(default_factory=lambda: ["happy", "sad", "angry", "calm"])
    input_stage: str | None = None
    needs_effects: bool = False
    generator: Generator = field(default_factory=StubGenerator)
    synthesizer: Synthesizer = field(default_factory=StubSynthesizer)

    def enabled(self) -> list[str]:
        """The chosen stages in the fixed order."""
        unknown = set(self.stages) - set(ORDER)
        if unknown:
            raise ValueError(f"unknown stages: {sorted(unknown)}")
        return [s for s in ORDER if s in self.stages]


def merged_settings(*layers: dict) -> dict:
    """Nested settings, later layers over earlier ones; ``${a.b}`` in a text stands for another setting.  A
    reference to none, or in a circle, is an error."""

    def merge(low: dict, high: dict) -> dict:
        both = {k: merge(low[k], v) if isinstance(v, dict) and isinstance(low.get(k), dict) else v for k, v in high.items()}
        return {**low, **both}

    whole: dict = {}
    for layer in layers:
        whole = merge(whole, layer)

    def settle(value: object, path: tuple[str, ...]) -> object:
        if isinstance(value, dict):
            return {k: settle(v, path) for k, v in value.items()}
        if isinstance(value, (list, tuple)):
            return type(value)(settle(v, path) for v in value)
        if not isinstance(value, str):
            return value
        alone = re.fullmatch(r"\$\{([^${}]+)\}", value)
        if alone:  # keeps its kind
            return named(alone[1].strip(), path)
        return re.sub(r"\$\{([^${}]+)\}", lambda m: str(named(m[1].strip(), path)), value)

    def named(key: str, path: tuple[str, ...]) -> object:
        if key in path:
            raise ValueError(f"settings refer to each other in a circle: {' > '.join((*path, key))}")
        at: object = whole
        for part in key.split("."):
            if not isinstance(at, dict) or part not in at:
                raise ValueError(f"no setting: {key}")
            at = at[part]
        return settle(at, (*path, key))

    return settle(whole, ())


def config_of(settings: dict) -> Config:
    """A ``Config`` from settings; unknown names are an error, lists fill tuples."""
    known = {f.name for f in fields(Config)}
    if unknown := set(settings) - known:
        raise ValueError(f"unknown settings: {sorted(unknown)}")
    return Config(**{k: tuple(v) if k in ("stages", "turns") else v for k, v in settings.items()})


def choose_topics(requested: str | None, available: list[str], strict: bool = False) -> list[str]:
    """Null, blank, ``auto`` and ``all`` mean all; else a comma-separated list."""
    if requested is None or requested.strip().lower() in ("", "auto", "all"):
        return list(available)
    wanted = list(dict.fromkeys(t.strip() for t in requested.split(",") if t.strip()))
    missing = [t for t in wanted if t not in available]
    if strict and missing:
        raise ValueError(f"missing topics: {missing}")
    return [t for t in wanted if t in available]


def scenarios(spark: SparkSession, cfg: Config) -> DataFrame:
    """``topic, scenario_id, description``: replies are parsed, normalised and validated."""
    topics = spark.createDataFrame([(t,) for t in cfg.topics], "topic string")
    asked = topics.select("topic", F.explode(F.sequence(F.lit(1), F.lit(cfg.scenarios_per_topic))).alias("i"))
    said = asked.withColumn("description", cfg.generator.reply(F.concat(F.lit("scenario for "), "topic"), F.concat_ws("/", "topic", F.col("i").cast("string"))))
    one = F.concat(F.lit('{"scenario'), F.col("i").cast("string"), F.lit('":{"description":"'), "description", F.lit('"}}'))
    reply = said.groupBy("topic").agg(F.concat(F.lit('{"scenarios":['), F.array_join(F.sort_array(F.collect_list(one)), ","), F.lit("]}")).alias("reply"))
    found = reply.select("topic", J.scenarios(J.json_object_text(F.col("reply"))).alias("s"))
    return found.select("topic", J.scenarios_error(F.col("s"), cfg.scenarios_per_topic).alias("error"), F.explode("s").alias("x")).where("error is null").select("topic", F.col("x.id").alias("scenario_id"), "x.description")


def number_scenarios(found: DataFrame, start: int) -> DataFrame:
    """Scenarios renumbered from ``start`` in order of their index."""
    w = Window.partitionBy("topic").orderBy(P.numeric_rank(X.scenario_index(F.col("scenario_id"))), "scenario_id")
    n = F.row_number().over(w) + (start - 1)
    return found.select("topic", F.concat(F.lit("scenario"), n.cast("string")).alias("id"), "description")


def system_prompts(found: DataFrame, existing: DataFrame | None, cfg: Config) -> DataFrame:
    """A prompt for each scenario that has none yet."""
    todo = found if existing is None else found.join(existing.select("topic", "scenario_id"), ["topic", "scenario_id"], "left_anti")
    return todo.withColumn("system_prompt", cfg.generator.reply(F.concat(F.lit("prompt for "), "description"), F.col("scenario_id")))


def dialogues(found: DataFrame, cfg: Config) -> DataFrame:
    """Planned turns with their lines; users speak on even turns."""
    lo, hi = cfg.turns
    n = F.lit(lo) + X.keyed_draw(F.lit("turns"), F.col("topic"), F.col("scenario_id")) % (hi - lo + 1)
    t = found.select("topic", "scenario_id", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("turn_index"))
    key = [F.col("topic"), F.col("scenario_id"), F.col("turn_index")]
    emotion = F.element_at(F.array(*map(F.lit, cfg.emotions)), (X.keyed_draw(F.lit("which"), *key) % len(cfg.emotions) + 1).cast("int"))
    tagged = X.keyed_draw(F.lit("tag"), *key) < int(cfg.emotion_rate * 2**32)
    line = cfg.generator.reply(F.lit("turn"), F.concat_ws("/", *(k.cast("string") for k in key)))
    return t.select(*t.columns, F.when(F.col("turn_index") % 2 == 0, "User").otherwise("Agent").alias("role"), F.when(tagged, F.concat(F.lit("(emotion:"), emotion, F.lit(") "), line)).otherwise(line).alias("content"))


def rewrite(lines_: Column, filler: bool) -> Column:
    """What follows a rewrite by a model: pauses split, with fillers also headers joined and
    user lines merged, then tags stripped."""
    text = F.array_join(lines_, "\n")
    text = X.join_headers(text) if filler else text
    parts = X.split_pauses(F.split(text, "\n"))
    parts = X.merge_overlaps(parts) if filler else parts
    return X.strip_emotion_tags(F.array_join(parts, "\n"))


def judge(scored: DataFrame, cfg: Config) -> DataFrame:
    """The best ``top_x`` dialogues of each scenario; ties in order of the path."""
    kept = scored.withColumn("score", X.score_of(F.col("reply"))).where("score is not null")
    return P.top_k(kept, ["topic", "scenario_id"], [F.desc("score"), F.asc("path")], cfg.top_x)


def speech(turns: DataFrame, done: DataFrame | None, cfg: Config, key: str = "dialogue_id") -> DataFrame:
    """Frames and clean timeline of dialogues that have no output yet."""
    todo = turns if done is None else L.pending(turns, done, key)
    sized = todo.withColumn("frames", cfg.synthesizer.frames(X.sanitize_tts(F.col("content"))))
    return TL.clean_timeline(sized, key)


def export(turns: DataFrame, found: DataFrame, prompts: DataFrame) -> DataFrame:
    """Turn rows with their scenario and system prompt; nulls where there is none."""
    return turns.join(found, ["topic", "scenario_id"], "left").join(prompts.select("topic", "scenario_id", "system_prompt"), ["topic", "scenario_id"], "left")


def export_topics(by_topic: list[DataFrame], path: str | None = None) -> DataFrame:
    """Exports of several topics as one table, written over the last one if a path is given."""
    whole = by_topic[0]
    for t in by_topic[1:]:
        whole = whole.unionByName(t, allowMissingColumns=True)
    if path:
        sinks.write_dataset(whole, path)
    return whole


#: Stages whose texts speech can be made from, the preferred first.  Fixed values.
SPEECH_INPUTS = ("filler", "overlap", "dialogue")
#: Outputs that make a dialogue finished; the last only where its mix is asked for.  Fixed values.
OUTPUTS = ("full.wav", "individual/turn_metadata.json", "full_with_overlap_and_pause.wav")


def stages_for_batch(stages: tuple[str, ...], final: bool, export_every_batch: bool = False) -> list[str]:
    """The stages of one batch: the export waits for the final one unless asked for every time."""
    return [s for s in stages if s != "export" or final or export_every_batch]


def speech_input(texts: DataFrame, topics: DataFrame, requested: str | None = None) -> DataFrame:
    """``topic, stage, error``: which stage's texts each topic is spoken from.

    A requested stage must have texts; else the first of ``SPEECH_INPUTS`` that has any counts.
    ``texts`` has ``topic, stage`` and only its distinct pairs are shuffled.
    """
    asked = (requested or "").strip().lower()
    order = (asked,) if asked in SPEECH_INPUTS else SPEECH_INPUTS
    rank = F.array_position(F.array(*map(F.lit, order)), F.col("stage"))
    best = texts.where(rank > 0).groupBy("topic").agg(F.min_by("stage", rank).alias("stage"))
    chosen = topics.select("topic").distinct().join(best, "topic", "left")
    return chosen.withColumn("error", F.when(F.col("stage").isNull(), F.lit("no texts for speech in: " + ", ".join(order))))


def finished(outputs: DataFrame, needs_effects: bool, key: str = "dialogue_id") -> DataFrame:
    """Dialogues that have all their outputs; ``outputs`` has ``key`` and ``name``, one row a file."""
    need = OUTPUTS if needs_effects else OUTPUTS[:2]
    return outputs.where(F.col("name").isin(*need)).groupBy(key).agg(F.count_distinct("name").alias("_n")).where(F.col("_n") == len(need)).select(key)


def with_status(rows: DataFrame, done: DataFrame, key: str = "dialogue_id") -> DataFrame:
    """``status``: SKIP where the dialogue is finished, else null."""
    have = done.select(key).distinct().withColumn("_done", F.lit(True))
    return rows.join(have, key, "left").withColumn("status", F.when(F.col("_done"), "SKIP")).drop("_done")


def _text_turns(texts: DataFrame) -> DataFrame:
    """Turns of a rewritten text; lines without a colon are dropped."""
    lined = texts.select("topic", "scenario_id", F.posexplode(F.split("text", "\n")).alias("_p", "_line")).where(F.col("_line").contains(":"))
    p = X.parse_line(F.col("_line"))
    w = Window.partitionBy("topic", "scenario_id").orderBy("_p")
    return lined.select("topic", "scenario_id", (F.row_number().over(w) - 1).cast("long").alias("turn_index"), p["role"].alias("role"), p["content"].alias("content"))


def _lines(turns: DataFrame) -> DataFrame:
    item = F.struct("turn_index", F.concat("role", F.lit(": "), "content").alias("line"))
    return turns.groupBy("topic", "scenario_id").agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["line"]).alias("lines"))


def run(spark: SparkSession, cfg: Config, on_stage: Callable[[str, DataFrame], None] | None = None, given: dict[str, DataFrame] | None = None, outputs: DataFrame | None = None) -> dict[str, DataFrame]:
    """The enabled stages, lazily composed; returns their results.

    ``given`` holds results of earlier runs, by stage, for stages that aren't chosen; a stage
    whose input is neither chosen nor given is an error that names it.  ``outputs`` (``dialogue_id, name``)
    are files that are there already: finished dialogues are not spoken again.  Fillers are written
    into overlap's texts where there are any, and speech is made from ``cfg.input_stage`` or
    the last text stage there is.
    """
    have: dict[str, DataFrame] = dict(given or {})
    out: dict[str, DataFrame] = {}

    def need(stage: str, *names: str) -> DataFrame:
        for n in names:
            if n in have:
                return have[n]
        raise ValueError(f"stage {stage} needs the result of {' or '.join(names)}: choose it or give it")

    for name in cfg.enabled():
        if name == "scenario":
            res = scenarios(spark, cfg)
        elif name == "system_prompt":
            res = system_prompts(need(name, "scenario"), have.get("system_prompt"), cfg)
            if "system_prompt" in have:
                res = have["system_prompt"].unionByName(res, allowMissingColumns=True)
        elif name == "dialogue":
            res = dialogues(need(name, "scenario"), cfg)
        elif name in ("overlap", "filler"):
            lines = have["overlap"].withColumn("lines", F.split("text", "\n")) if name == "filler" and "overlap" in have else _lines(need(name, "dialogue"))
            res = lines.select("topic", "scenario_id", rewrite(F.col("lines"), name == "filler").alias("text"))
        elif name == "judge":
            rows = need(name, "dialogue").select("topic", "scenario_id").distinct().withColumn("path", F.concat_ws("/", "topic", "scenario_id"))
            res = judge(rows.withColumn("reply", F.concat(F.lit("Score: "), (X.keyed_draw(F.lit("score"), F.col("path")) % 10).cast("string"))), cfg)
        elif name == "tts":
            asked = (cfg.input_stage or "").strip().lower()
            names = (asked,) if asked in SPEECH_INPUTS else SPEECH_INPUTS
            source = next((n for n in names if n in have), None)
            need(name, *names)
            turns = have[source] if source == "dialogue" else _text_turns(have[source])
            named = turns.withColumn("dialogue_id", X.dialogue_id(F.col("topic"), F.lit("normal"), X.scenario_index(F.col("scenario_id")), F.lit(None)))
            res = speech(named, None if outputs is None else finished(outputs, cfg.needs_effects), cfg)
        else:
            found = need(name, "scenario")
            res = export(need(name, "tts"), found, have["system_prompt"] if "system_prompt" in have else system_prompts(found, None, cfg))
        have[name] = out[name] = res
        if on_stage:
            on_stage(name, res)
    return out
