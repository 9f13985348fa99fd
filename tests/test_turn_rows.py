"""Export rows, folders of topics, settings."""

import pytest
from pyspark.sql import functions as F

from turnweave.operators.lookups import zipped
from turnweave.operators.turn_rows import Options, best_prompts, best_scripts, dialogue_parts, turn_rows
from turnweave.plans.stages import config_of, merged_settings
from turnweave.sources.readers import discover_topics


def test_dialogue_parts(spark):
    ids = ["Travel_normal_3", "Travel_normal_3_2", "Two_words_normal_3_2", "T_v2_scenario7_1", "loose", "A_4_normal_5"]
    rows = spark.createDataFrame([(i,) for i in ids], "id string").select(*(c.alias(n) for n, c in dialogue_parts(F.col("id")).items())).collect()
    assert [tuple(r) for r in rows] == [(3, None, "Travel_normal_3"), (3, 2, "Travel_normal_3"), (3, 2, "Two_words_normal_3"), (7, 1, "T_v2_scenario7"), (None, None, "loose"), (5, None, "A_4_normal_5")]


def test_best_prompts(spark):
    rows = [
        ("T", "legacy", "scenario000001", "padded"), ("T", "legacy", "scenario1", "bare"), ("T", "legacy", "T_scenario1", "named"), ("T", "current", "T_scenario1", " now\n"),
        ("T", "legacy", "scenario000002", "padded"), ("T", "legacy", "scenario2", "bare"), ("T", "current", "other_scenario2", "not mine"),
        ("T", "current", "T_scenario3", " "), ("T", "legacy", "scenario3", "hidden by the blank"), ("T", "current", "nothing", "x"), (None, None, None, None),
    ]
    got = {r.scenario_index: r.prompt for r in best_prompts(spark.createDataFrame(rows, "topic string, layout string, stem string, text string")).collect()}
    assert got == {1: "now", 2: "bare", 3: None}


def test_best_scripts(spark):
    texts = spark.createDataFrame(
        [("T", "dialogue", "d/T_scenario1.txt"), ("T", "filler", "f/T_scenario1_2.txt"), ("T", "filler", "f/scenario1_2.txt"), ("T", "overlap", "o/scenario1.txt"), ("T", "overlap", "o/T_scenario1_2.txt"), ("T", "judge", "j/T_scenario1.txt"), (None, None, None)],
        "topic string, stage string, path string",
    )
    dialogues = spark.createDataFrame([("T", 1, 2), ("T", 1, None), ("T", 9, None)], "topic string, scenario_index bigint, dialogue_index bigint")
    path = lambda stage: {(r.scenario_index, r.dialogue_index): r.final_txt_path for r in best_scripts(dialogues, texts, stage).collect()}
    assert path(None) == {(1, 2): "f/T_scenario1_2.txt", (1, None): "o/scenario1.txt", (9, None): None}
    assert path("overlap") == {(1, 2): "o/scenario1.txt", (1, None): "o/scenario1.txt", (9, None): None}
    assert path("dialogue")[(1, 2)] == "d/T_scenario1.txt"


def test_turn_rows(spark):
    records = spark.createDataFrame(
        [
            ("T_normal_1", "T", "wav/T_normal_1", '{"turn_idx":0,"speaker":"user","text":"a","emotion_reference":"x","speaker_reference_metadata":{"age":"20s","accents":null},"audio_path":"kept","audio_start":1.5}'),
            ("T_normal_1", "T", "wav/T_normal_1", '{"turn_idx":101,"speaker":null,"emotion_reference":["x","y"],"speaker_reference_metadata":"no object","para_tags":null}'),
            ("loose", "T", "wav/loose", "no json"),
            ("empty", "T", "wav/empty", None),
        ],
        "dialogue_id string, topic string, folder string, record string",
    )
    empty = lambda schema: spark.createDataFrame([], schema)
    files = spark.createDataFrame([("wav/T_normal_1/individual/turn101.wav",), ("wav/T_normal_1/individual/turn101_pause_overlap.wav",), ("wav/T_normal_1/full.wav",)], "path string")
    inputs = (empty("topic string, scenario_id string, description string"), empty("topic string, layout string, stem string, text string"), empty("topic string, stage string, path string"))
    out = turn_rows(records, *inputs, files, Options(root="r", agent_prompt="hi"))
    assert len(out.columns) == 26
    rows = {(r.conversation_id, r.turn_index): r for r in out.collect()}
    assert len(rows) == 4
    first, late, loose = rows["T_normal_1", 0], rows["T_normal_1", 101], rows["loose", 0]
    assert (first.audio, first.audio_start, first.emotion_reference, first.reference_age, first.reference_accent) == ("kept", 1.5, ["x"], "20s", None)
    assert "accents" in first.reference_metadata
    assert (late.audio, late.speaker, late.text, late.emotion_reference, late.reference_metadata) == ("r/wav/T_normal_1/individual/turn101.wav", None, "", ["x", "y"], None)
    assert (loose.speaker, loose.audio_duration, loose.emotion_reference, loose.system_prompt) == ("unknown", 0.0, [], "hi")
    assert late.system_prompt.startswith("hi\n\nTopic") and "scenario1" in late.system_prompt
    effects = turn_rows(records, *inputs, files.union(spark.createDataFrame([("wav/x/full_with_overlap_and_pause.wav",)], "path string")), Options())
    assert len(effects.columns) == 32
    assert {r.turn_index: r.audio_pause_overlap for r in effects.where("conversation_id = 'T_normal_1'").collect()} == {0: "", 101: "wav/T_normal_1/individual/turn101_pause_overlap.wav"}
    assert turn_rows(records.limit(0), *inputs, files, Options()).count() == 0


def test_discover_topics(spark, tmp_path):
    for name in ("main/normal/b", "main/normal/a", "main/normal/.trash", "other/normal/z", "bare/normal"):
        (tmp_path / name).mkdir(parents=True)
    (tmp_path / "main/normal/file.txt").write_text("x")
    find = lambda *a, **k: [r.topic for r in discover_topics(spark, str(tmp_path), *a, **k).collect()]
    assert sorted(find("main")) == ["a", "b"] and sorted(find("main", hidden=True)) == [".trash", "a", "b"]
    assert find("gone", fallback_root="other") == ["z"]
    with pytest.raises(FileNotFoundError):
        find("gone")
    with pytest.raises(ValueError):
        find("bare")


def test_settings():
    got = merged_settings({"root": "/r", "a": {"x": 1, "path": "${root}/in"}}, {"a": {"y": "${a.x}", "z": ["${a.path}"]}})
    assert got == {"root": "/r", "a": {"x": 1, "path": "/r/in", "y": 1, "z": ["/r/in"]}}
    for bad in ({"a": "${b}", "b": "x${a}"}, {"a": "${none}"}):
        with pytest.raises(ValueError):
            merged_settings(bad)
    assert config_of({"stages": ["tts"], "turns": [2, 3]}).enabled() == ["tts"]
    with pytest.raises(ValueError):
        config_of({"nothing": 1})


def test_zipped(spark):
    texts = spark.createDataFrame([("k", 5, "b"), ("k", 1, "a"), ("k", 9, "c"), (None, 1, "n")], "k string, o int, v string")
    tags = spark.createDataFrame([("k", 2, "t1"), ("k", 3, "t2"), ("z", 1, "t")], "k string, o int, v string")
    assert sorted((r.v, r.tag or "") for r in zipped(texts, tags, ["k"], "o", "v").collect()) == [("a", "t1"), ("b", "t2"), ("c", ""), ("n", "")]
