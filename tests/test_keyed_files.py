"""One file for each key: what is written is read back; attempts that fail leave nothing."""

import os
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnweave.functions import audio as A
from turnweave.operators import audio as O
from turnweave.sources import keyed_files as W
from turnweave.sources import readers as R
from turnweave.sources import sinks as K


def files(root):
    return sorted(os.path.relpath(os.path.join(d, n), root) for d, _, names in os.walk(root) for n in names)


def test_texts(spark, tmp_path):
    """Several dialogues of a topic, names with blanks, empty and null texts, line ends of all kinds."""
    texts = {("Daily Life", "dialogue", f"Daily_scenario{i}_1"): f"User: a{i}\nAgent: 好\r\nUser: c\n" for i in range(40)}
    texts |= {("t+x", "filler", "t_scenario1_1"): "", ("t+x", "dialogue", "t_scenario1_1"): None}
    df = spark.createDataFrame([(*k, v, "x") for k, v in texts.items()], "topic string, stage string, name string, text string, part string").repartition(7)
    for _ in range(2):  # a second run replaces
        K.write_texts(df, str(tmp_path))
        assert files(tmp_path) == sorted("/".join(k) + ".txt" for k in texts)
    got = {tuple(r.path.rsplit("/", 3)[1:]): r.text for r in R.read_texts(spark, "file://" + str(tmp_path)).collect()}
    assert got == {(t, s, n + ".txt"): v for (t, s, n), v in texts.items() if v}  # Spark's readers don't see empty files
    with open(tmp_path / "Daily Life/dialogue/Daily_scenario3_1.txt", newline="") as f:
        assert f.read() == texts["Daily Life", "dialogue", "Daily_scenario3_1"]


def test_parts_come_in_order(spark, tmp_path):
    df = spark.createDataFrame([(f"f{i % 3}", i, f"{i},") for i in range(300)], "name string, part long, text string").repartition(11)
    W.write_named_texts(df, str(tmp_path))
    for k in range(3):
        assert (tmp_path / f"f{k}").read_text() == "".join(f"{i}," for i in range(k, 300, 3))


def test_failed_jobs_leave_nothing(spark, tmp_path):
    (tmp_path / "a").write_text("old")
    df = spark.createDataFrame([("a", "new"), ("b", "new"), (None, "x")], "name string, text string")
    with pytest.raises(Exception, match="without a name"):
        W.write_named_texts(df, str(tmp_path))
    with pytest.raises(Exception, match="not a name inside"):
        W.write_named_texts(spark.createDataFrame([("../b", "x")], "name string, text string"), str(tmp_path))
    assert files(tmp_path) == ["a"] and (tmp_path / "a").read_text() == "old"
    with pytest.raises(ValueError, match="mounted"):
        W.local_path("hdfs://x/y")
    assert W.local_path("file:///x/y") == "/x/y" == W.local_path("/x/y")


def test_attempts_commit_once(tmp_path):
    """Two attempts of a task wrote; only the committed one's files move, and the staging folder goes."""
    from pyspark.sql import Row

    w = W._Writer({"path": str(tmp_path), "kind": "text"})
    rows = [Row(name=f"x/{i}", part=0, text=str(i)) for i in range(5)]
    lost = w.write(iter(rows[:3]))
    kept = w.write(iter(rows))
    assert (lost.files, kept.files) == (3, 5) and len(files(tmp_path)) == 8
    other = W._Writer({"path": str(tmp_path), "kind": "text"})
    other.write(iter(rows[:1]))
    w.commit([kept, None])
    assert [f for f in files(tmp_path) if W.STAGING not in f] == [f"x/{i}" for i in range(5)] and len(files(tmp_path)) == 6
    other.abort([None])
    assert len(files(tmp_path)) == 5 and not os.path.exists(tmp_path / W.STAGING)


def test_mixes(spark, tmp_path):
    """Tiles to files, and the files decoded again."""
    rng = np.random.default_rng(1)
    mixes = {c: rng.uniform(-1, 1, (2, n)).astype(np.float32) for c, n in enumerate((1, 512, 1300, 5000))}
    rows = [(c, t, x.shape[1], x[0, t * 512 : t * 512 + 512].tobytes(), x[1, t * 512 : t * 512 + 512].tobytes()) for c, x in mixes.items() for t in range(-(-x.shape[1] // 512))]
    tiles = spark.createDataFrame(rows, "conv_id long, tile long, n long, left binary, right binary").repartition(5)
    K.write_mixes(tiles, str(tmp_path), F.concat_ws("/", F.lit("full"), F.concat("conv_id", F.lit(".wav"))))
    assert files(tmp_path) == [f"full/{c}.wav" for c in range(4)]
    for c, x in mixes.items():
        with wave.open(str(tmp_path / f"full/{c}.wav")) as w:
            assert (w.getnchannels(), w.getframerate(), w.getnframes()) == (2, 24000, x.shape[1])
            assert w.readframes(10**6) == A.to_pcm(x)
    heads = {os.path.basename(r.path): r for r in R.read_wav_durations(spark, str(tmp_path)).collect()}
    assert all(heads[f"{c}.wav"].frames == x.shape[1] and heads[f"{c}.wav"].whole for c, x in mixes.items())
    back = O.decode_blocks(R.read_wavs(spark, str(tmp_path)), block=600).collect()
    for c, x in mixes.items():
        y = np.concatenate([np.frombuffer(r.samples, np.float32) for r in sorted(back, key=lambda r: r.start) if r.path.endswith(f"/{c}.wav")])
        assert len(y) == x.shape[1] and np.abs(y - x[0]).max() < 1e-4
    W.write_wavs(spark.createDataFrame([("mono.wav", 0, mixes[2][0].tobytes(), None), ("none.wav", 0, None, None)], "name string, part int, left binary, right binary"), str(tmp_path), 16000)
    with wave.open(str(tmp_path / "mono.wav")) as w:
        assert (w.getnchannels(), w.getframerate(), w.getnframes()) == (1, 16000, 1300)
