"""Golden cases of the text, JSON, timeline and audio functions."""

import json
import re

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from turnweave.functions import audio as A
from turnweave.functions import json_repair as J
from turnweave.functions import text as X
from turnweave.operators import lookups as L
from turnweave.operators import progress as P
from turnweave.operators import timeline as TL
from turnweave.plans import stages as S
from turnweave.sources import readers as R
from turnweave.sources import sinks as K
from turnweave.streaming.progress_log import progress_stream, status_counts

POOL = ["happy", "sad"]


def apply(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(f(F.col("v"))).collect()]


def test_emotion_variants(spark):
    cases = {
        "**(happy) t": "(emotion:happy) t",
        "(happy) t": "(emotion:happy) t",
        "**(emotion:happy) t": "(emotion:happy) t",
        "(emotion: happy) t": "(emotion:happy) t",
        "/emotion:happy/ t": "(emotion:happy) t",
        "/happy/ t": "(emotion:happy) t",
        "emotion=happy t": "(emotion:happy) t",
        "t (happy)": "(emotion:happy) t",
        "t (emotion:happy)": "(emotion:happy) t",
        "t [sad]": "(emotion:sad) t",
        "(odd) t": "(odd) t",
        "(Happy) t": "(Happy) t",
        "plain": "plain",
        "": "",
        "(happy)": "(emotion:happy)",
        "(emotion:happy) **好 吗": "(emotion:happy) 好 吗",
    }
    assert apply(spark, list(cases), lambda c: X.normalize_emotion(c, POOL)) == list(cases.values())
    assert apply(spark, [None], lambda c: X.normalize_emotion(c, POOL)) == [None]


def test_sanitize_tts(spark):
    """Against the same rules in plain Python, on lines with spaced letters in all places."""
    cases = ["", " ", "A P P", "the A P P and a b c d ends", "FA P P x A P Px A P P", "a b", "I am a U S A fan (happy)", "x (emotion: sad) ", "(Python) ok (Python)", "A\tP\nP 好 A B C 好", "é A B C é", "A P P A P P", "1 A B C 2", "A P P.", "tail (two words)"]

    def plain(t):
        t = re.sub(r"\b(?:[A-Za-z]\s+){2,}[A-Za-z]\b", lambda m: re.sub(r"\s+", "", m[0]), t)
        return re.sub(r"\s*\(\s*(?:emotion\s*[:=]\s*)?[A-Za-z_\-]+\s*\)\s*$", "", t, flags=re.I).strip()

    assert apply(spark, cases, X.sanitize_tts) == [plain(c) for c in cases]
    assert apply(spark, [None], X.sanitize_tts) == [None]


def test_emotion_round_trip(spark):
    text = "some words here"
    forms = [f"({e}) {text}" for e in POOL] + [f"/{e}/ {text}" for e in POOL] + [f"{text} ({e})" for e in POOL]
    tagged = apply(spark, forms, lambda c: X.normalize_emotion(c, POOL))
    assert tagged == [f"(emotion:{e}) {text}" for e in POOL] * 3
    assert apply(spark, tagged, X.strip_leading_emotion) == [text] * 6
    assert apply(spark, tagged, X.leading_emotion) == POOL * 3


def test_strip_tags_idempotent(spark):
    script = "User: (emotion:happy) hi\n\nAgent: (emotion:sad)\nno colon \n[overlap] User: x: y"
    once = apply(spark, [script], X.strip_emotion_tags)
    assert once == ["User: hi\nAgent:\nno colon\n[overlap] User: x: y"]
    assert apply(spark, once, X.strip_emotion_tags) == once


def test_pauses(spark):
    f = lambda c: F.array_join(X.split_pauses(F.split(c, "\n")), "|")
    assert apply(spark, ["[pause] user: [PAUSE]"], f) == ["[pause] User: [pause]"]
    assert apply(spark, ["a [pause] User:[pause] b [pause] User: [pause]"], f) == ["a|[pause] User: [pause]|b|[pause] User: [pause]"]
    assert apply(spark, ["\n  x  \n\ny"], f) == ["  x|y"]


def test_merge_and_headers(spark):
    f = lambda c: F.array_join(X.merge_overlaps(F.split(c, "\n")), "|")
    assert apply(spark, ["User: a \n[overlap] User:  b\n[overlap] User: c"], f) == ["User: a b|[overlap] User: c"]
    assert apply(spark, ["[overlap] User: a\nUser: b"], f) == ["[overlap] User: a|User: b"]
    assert apply(spark, ["[overlap]\nUser: a\n[pause] User: [pause]\nx"], X.join_headers) == ["[overlap] User: a\n[pause] User: [pause]\nx"]


def test_sanitize(spark):
    assert apply(spark, ["A P P now", "an A P I and A P P", "ok (curious)", "a B", "use (Python) here"], X.sanitize_tts) == ["APP now", "an API and APP", "ok", "a B", "use (Python) here"]


def test_ids(spark):
    assert apply(spark, ["規劃（Planning）", " x ", " ", None], X.topic_label) == ["Planning", "x", "unknown", "unknown"]
    assert apply(spark, ["Travel_scenario007", "12", "scenario3", "other"], X.canonical_scenario_id) == ["scenario7", "scenario12", "scenario3", "other"]
    assert apply(spark, ["..a b/c__", "", None], X.topic_slug) == ["a_b_c", "unknown", "unknown"]
    for stem, want in {"Travel_scenario1_2": ("Travel", "scenario1", 1, 2), "scenario000001": (None, "scenario1", 1, None), "x": (None, None, None, None)}.items():
        df = spark.createDataFrame([(stem,)], "v string")
        assert tuple(df.select(*(c.alias(n) for n, c in X.parse_stem(F.col("v")).items())).first()) == want
    assert apply(spark, [" male", "F", "man", None, " ", "robot", "female_feminine"], X.gender_norm) == ["male", "female", "male", None, None, "other", "female"]


def test_json(spark):
    f = lambda c: F.to_json(J.scenarios(J.json_object_text(c)))
    one = [{"id": "scenario1", "description": "a b"}]
    for raw in ['{"scenarios":[{"scenario1":{"description":"a\nb"}}]}', '```json\n{"scenario1":{"description":"a b"}}\n```', 'x {"scenario01":{"scenario1":{"description":" a b "}}} y', '{"scenarios":[{"scenario1":"a b"}, "loose", {}]}']:
        assert json.loads(apply(spark, [raw], f)[0]) == one, raw
    assert apply(spark, ['{"topics":1}', "nothing"], f) == [None, None]
    assert apply(spark, ['{"scenarios":{"scenario1":{"description":"a"}}}'], f) == ["[]"]
    got = json.loads(apply(spark, ['{"scenario10":"b","scenario2":"a","scenario0":"z"}'], f)[0])
    assert [x["id"] for x in got] == ["scenario2", "scenario10", "scenario0"]
    err = lambda c: J.scenarios_error(J.scenarios(c), 2)
    assert apply(spark, ['{"scenarios":[{"scenario1":"a"},{"scenario01":"b"}]}', '{"scenario1":"a"}', '{"scenario1":"a","scenario2":"b"}'], err) == ["duplicate scenario id: scenario1", "need at least 2 scenarios, got 1", None]


def test_effects_example(spark):
    rows = [(1, 0, 24000, 6000, None, 480), (1, 1, 12000, 6000, 30000, 480), (1, 2, 6000, 6000, None, 480), (2, 0, 100, 5, 50, 480)]
    df = spark.createDataFrame(rows, "conv_id long, seg long, frames long, gap long, shift long, hold long")
    got = {(r.conv_id, r.seg): (r.start_frame, r.end_frame, r.total_frames) for r in TL.effects_timeline(df).collect()}
    assert got == {(1, 0): (0, 24000, 36480), (1, 1): (12480, 24480, 36480), (1, 2): (30480, 36480, 36480), (2, 0): (0, 100, 100)}


def test_clean_timeline_contiguous(spark, sf_dir):
    from turnweave.plans.inputs import turns

    pdf = TL.clean_timeline(turns(spark, sf_dir)).toPandas().sort_values(["conv_id", "turn_index"])
    for _, g in pdf.groupby("conv_id"):
        assert g["start_frame"].iloc[0] == 0
        assert (g["start_frame"].to_numpy()[1:] == g["end_frame"].to_numpy()[:-1]).all()
        assert g["end_frame"].iloc[-1] == g["frames"].sum()


def test_upsert(spark):
    old = spark.createDataFrame([("t", "1", ""), ("t", "2", "keep"), ("t", "4", None)], "topic string, sid string, d string")
    new = spark.createDataFrame([("t", "1", "", 1), ("t", "1", "fill", 2), ("t", "2", "no", 3), ("t", "3", "", 4), ("t", "3", "new", 5)], "topic string, sid string, d string, o int")
    once = P.upsert_fill(old, new, ["topic", "sid"], "d", "o")
    want = {"1": "fill", "2": "keep", "3": "new", "4": None}
    assert {r.sid: r.d for r in once.collect()} == want
    assert {r.sid: r.d for r in P.upsert_fill(once, new, ["topic", "sid"], "d", "o").collect()} == want


def test_two_speakers_distinct(spark):
    rows = spark.range(300).withColumnRenamed("id", "k")
    pool = spark.createDataFrame([("a",), ("b",), ("c",)], "s string")
    got = L.two_distinct(rows, "k", pool, "s").collect()
    assert len(got) == 300 and all(r.user_speaker != r.agent_speaker for r in got)
    assert {(r.user_speaker, r.agent_speaker) for r in got} == {(x, y) for x in "abc" for y in "abc" if x != y}


def test_choices_by_place(spark):
    """As lists per key would give, for keys without values, null keys and values, and empty pools."""
    pool = [("a", "x", f"v{i % 40}") for i in range(90)] + [("a", "y", "w"), ("b", "x", "z"), ("c", None, "q"), ("b", "x", None)]
    rows = [(i, "abcd"[i % 4], ["x", "y", None][i % 3]) for i in range(60)]
    p = spark.createDataFrame(pool, "k string, m string, v string").repartition(3)
    r = spark.createDataFrame(rows, "i long, k string, m string")
    got = {x.i: (x.chosen, x.tier) for x in L.tiered_choice(r, p, [["k", "m"], ["k"], []], "v", F.col("i") * 7).collect()}
    for i, k, m in rows:
        tiers = [sorted({v for a, b, v in pool if v and a == k and b == m and m}), sorted({v for a, _, v in pool if v and a == k}), sorted({v for *_, v in pool if v})]
        t = next(t for t, vs in enumerate(tiers) if vs)
        assert got[i] == (tiers[t][i * 7 % len(tiers[t])], t)
    none = L.tiered_choice(r, p.limit(0), [["k"], []], "v", F.col("i")).collect()
    assert len(none) == 60 and all(x.chosen is None and x.tier is None for x in none)
    assert L.two_distinct(r, "i", p.where("k = 'c'"), "v").count() == 0


def test_resolve_speaker(spark):
    files = [("a/b/1.wav",), ("a/b/2.mp3",), ("a/b/c/3.wav",), ("a/x.txt",), ("top.wav",), ("n/y.txt",)]
    asked = ["a/b", "a/b/c", "a/x.txt", "top.wav", None, "", "n", "a", "zz", "a/b/9.wav"]
    r = spark.createDataFrame(list(enumerate(asked)), "i long, request string")
    f, pool = spark.createDataFrame(files, "path string"), spark.createDataFrame([("p1",), ("p2",)], "path string")
    got = {x.i: (x.recording, x.error) for x in L.resolve_speaker(r, f, pool, "request", F.lit(1).cast("long")).collect()}
    none = lambda p: (None, f"no recordings in folder: {p}")
    assert list(got[i] for i in range(10)) == [("a/b/2.mp3", None), ("a/b/c/3.wav", None), ("a/x.txt", None), ("top.wav", None), ("p2", None), ("p2", None), none("n"), none("a"), (None, "no such path: zz"), (None, "no such path: a/b/9.wav")]
    empty = L.resolve_speaker(r.where("i in (4, 8)"), f, pool.limit(0), "request", F.col("i")).collect()
    assert {(x.i, x.recording, x.error) for x in empty} == {(4, None, "the pool is empty"), (8, None, "no such path: zz")}


def test_filter_or_all(spark):
    rows = [(1, "a", True), (2, "a", False), (3, "b", None), (4, "b", False), (5, None, False), (6, None, True)]
    df = spark.createDataFrame(rows, "i int, g string, m boolean")
    assert sorted(r.i for r in L.filter_or_all(df, F.col("m"), ["g"]).collect()) == [1, 3, 4, 6]
    assert sorted(r.i for r in L.filter_or_all(df, F.col("m")).collect()) == [1, 6]
    assert L.filter_or_all(df, F.lit(False)).count() == 6


def test_global_row_number(spark):
    """As ``row_number``; where all keys tie, ranges are cut by the tie column."""
    df = spark.range(5000).select((F.col("id") * 7919 % 97).alias("a"), F.col("id").alias("b")).repartition(7)
    for order in (["a", "b"], [F.desc("a"), "b"], [F.lit(1) * F.col("b") * 0, "b"]):
        got = P.global_row_number(df, order, name="n", range_rows=600)
        want = df.withColumn("n", F.row_number().over(Window.orderBy(*order)))
        assert got.exceptAll(want).count() == 0 and got.count() == 5000
    ties = df.withColumn("a", F.lit(0)).repartitionByRange(9, "a", "b").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert ties < 5000 / 4
    same = P.global_row_number(df.select(F.lit(1).alias("a")), ["a"], name="n", range_rows=600)
    assert sorted(r.n for r in same.collect()) == list(range(1, 5001))
    assert P.global_row_number(df.limit(0), ["a"]).count() == 0
    nulls = spark.createDataFrame([(None,), (3,), (1,)], "a int")
    assert {(r.a, r.n) for r in P.global_row_number(nulls, ["a"], name="n").collect()} == {(None, 1), (1, 2), (3, 3)}


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "c.tsv").write_text('path\tsentence\tgender\na.mp3\t"say ""hi"""\tmale\nb.mp3\t \tx\n')
    c = R.read_corpus(spark, str(tmp_path / "c.tsv"))
    assert [tuple(r) for r in c.select("path", "sentence", "gender", "age").orderBy("path").collect()] == [("a.mp3", 'say "hi"', "male", None), ("b.mp3", None, "x", None)]
    clips = {r.audio_path: r for r in R.corpus_clips(c, "/clips/").collect()}
    assert clips["/clips/a.mp3"].gender_norm == "male" and clips["/clips/b.mp3"].metadata == {"path": "b.mp3", "gender": "x"}
    (tmp_path / "o.json").write_text('{"topic":"t","count":2}')
    assert [tuple(r) for r in R.read_json_object(spark, str(tmp_path / "o.json"), "topic string, count long").collect()] == [("t", 2)]
    assert R.read_json_object(spark, str(tmp_path / "none.json"), "topic string").count() == 0
    d = tmp_path / "txt"
    d.mkdir()
    (d / "Travel_scenario3_1.txt").write_text("User: a\nAgent: b")
    r = R.read_texts(spark, str(d)).first()
    assert (r.prefix, r.scenario_id, r.dialogue_index, r.text) == ("Travel", "scenario3", 1, "User: a\nAgent: b")
    (d / "happy_anna_1.wav").write_bytes(A.encode_wav(np.zeros((1, 10)), 22050))
    (d / "bella_2.wav").write_bytes(A.encode_wav(np.zeros((1, 10)), 22050))
    assert [(w.emotion, w.speaker, w.variant) for w in R.read_reference_wavs(spark, str(d)).collect()] == [("happy", "anna", 1)]
    rows = spark.createDataFrame([("t", "s", "n", "x y")], "topic string, stage string, name string, text string")
    K.write_texts(rows, str(tmp_path / "out"))
    K.write_dataset(rows, str(tmp_path / "ds"))
    assert spark.read.json(str(tmp_path / "ds/json")).count() == spark.read.parquet(str(tmp_path / "ds/parquet")).count() == 1
    bad = rows.withColumn("error", F.lit("e"))
    assert K.write_quarantine(bad, "error", str(tmp_path / "q")).count() == 0 and spark.read.json(str(tmp_path / "q")).count() == 1


def test_progress_stream(spark, tmp_path):
    log = str(tmp_path / "log")
    rows = spark.createDataFrame([("a", "OK"), ("a", "FAIL"), ("b", "SKIP")], "topic string, status string")
    for c in K.PROGRESS_COLUMNS:
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit("0"))
    K.append_progress(rows, log)
    K.append_progress(rows.where("topic = 'a'"), log)
    q = status_counts(progress_stream(spark, log)).writeStream.format("memory").queryName("progress_log").outputMode("complete").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {tuple(r) for r in spark.sql("select topic, done, generated, skipped, failed from progress_log").collect()} == {("a", 4, 2, 0, 2), ("b", 1, 0, 1, 0)}


def test_stages(spark):
    cfg = S.Config(topics=["Travel", "Food"], scenarios_per_topic=12, stages=("tts", "scenario", "dialogue", "filler", "judge"))
    assert cfg.enabled() == ["scenario", "dialogue", "filler", "judge", "tts"]
    out = S.run(spark, cfg)
    assert out["scenario"].count() == 24
    turns = out["dialogue"].groupBy("topic", "scenario_id").count().toPandas()["count"]
    assert turns.between(12, 15).all() and len(turns) == 24
    assert out["judge"].count() == 24 and out["tts"].count() == turns.sum()
    assert "(emotion" not in out["filler"].first().text
    assert [r.id for r in S.number_scenarios(out["scenario"].where("topic = 'Food'"), 5).orderBy("id").limit(2).collect()] == ["scenario10", "scenario11"]
    alone = S.run(spark, S.Config(topics=["Travel"], stages=("dialogue", "tts"), scenarios_per_topic=12), given={"scenario": out["scenario"]})
    assert set(alone) == {"dialogue", "tts"} and alone["tts"].count() == alone["dialogue"].count() == turns.sum()
    for stages, word in ((("dialogue",), "scenario"), (("export",), "scenario"), (("tts",), "filler or overlap or dialogue")):
        with pytest.raises(ValueError, match=word):
            S.run(spark, S.Config(stages=stages))
    exported = S.run(spark, S.Config(topics=["Travel"], stages=("scenario", "dialogue", "tts", "export"), scenarios_per_topic=12))["export"]
    assert exported.where("system_prompt is null or description is null").count() == 0
    assert S.choose_topics(" all", ["a"]) == ["a"] and S.choose_topics("b, a,b", ["a", "b"]) == ["b", "a"]
    with pytest.raises(ValueError):
        S.choose_topics("z", ["a"], strict=True)


def test_speech_input(spark):
    """The first stage with texts, by topic; finished dialogues are skipped."""
    texts = spark.createDataFrame([("a", "dialogue"), ("a", "filler"), ("a", "judge"), ("b", "overlap"), ("b", "dialogue"), ("c", "judge")], "topic string, stage string")
    topics = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "topic string")
    pick = lambda r=None: {x.topic: (x.stage, x.error) for x in S.speech_input(texts, topics, r).collect()}
    none = (None, "no texts for speech in: filler, overlap, dialogue")
    assert pick() == pick("auto") == {"a": ("filler", None), "b": ("overlap", None), "c": none, "d": none}
    assert pick(" Overlap ") == {t: ("overlap", None) if t == "b" else (None, "no texts for speech in: overlap") for t in "abcd"}
    files = [("x", "full.wav"), ("x", "individual/turn_metadata.json"), ("y", "full.wav"), ("z", "full.wav"), ("z", "individual/turn_metadata.json"), ("z", "full_with_overlap_and_pause.wav"), ("y", "full.wav")]
    outputs = spark.createDataFrame(files, "dialogue_id string, name string")
    assert {r[0] for r in S.finished(outputs, False).collect()} == {"x", "z"} and {r[0] for r in S.finished(outputs, True).collect()} == {"z"}
    rows = spark.createDataFrame([("x",), ("y",)], "dialogue_id string")
    assert {(r.dialogue_id, r.status) for r in S.with_status(rows, S.finished(outputs, False)).collect()} == {("x", "SKIP"), ("y", None)}
    base = ("scenario", "tts", "export")
    assert S.stages_for_batch(base, False) == ["scenario", "tts"] and S.stages_for_batch(base, True) == S.stages_for_batch(base, False, True) == list(base)


def test_progress_item(spark):
    rows = [("Topic（Travel） x", " scenario07 ", " d ", None), (None, "Food_scenario3", None, "kept"), ("T", "notes", " n ", None), (" ", "12", "", ""), ("T", None, None, "b")]
    df = spark.createDataFrame(rows, "t string, s string, d string, b string")
    got = df.select(*(c.alias(n) for n, c in J.progress_item(F.col("t"), F.col("s"), F.col("d"), F.col("b")).items())).collect()
    assert [tuple(r) for r in got] == [
        ("Travel", "scenario7", "Travel_scenario7", "d"), ("unknown", "kept", "unknown_scenario3", ""), ("T", None, "notes", " n "), ("unknown", "scenario12", "unknown_scenario12", ""), ("T", "b", None, None),
    ]
