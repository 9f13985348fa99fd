"""Waveforms: headers, decoding, mixes, slices and alignment against one-dialogue NumPy versions."""

import io
import math
import random
import struct
import time
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnweave.functions import audio as A
from turnweave.operators import audio as O
from turnweave.operators import timeline as TL
from turnweave.plans import audio_queries as Q


def wav(x, rate, width=2, extra=b""):
    """Any PCM width, channels interleaved, chunks before the samples."""
    x = np.atleast_2d(x)
    full = 1 << (8 * width - 1)
    ints = np.clip((x * full).round(), -full, full - 1).astype(np.int64).T.reshape(-1)
    raw = b"".join((int(v) + (128 if width == 1 else 0)).to_bytes(width, "little", signed=width > 1) for v in ints)
    block = len(x) * width
    fmt = struct.pack("<4sIHHIIHH", b"fmt ", 16, 1, len(x), rate, rate * block, block, 8 * width)
    body = b"WAVE" + extra + fmt + struct.pack("<4sI", b"data", len(raw)) + raw
    return struct.pack("<4sI", b"RIFF", len(body)) + body


def chunk(name, data):
    return struct.pack("<4sI", name, len(data)) + data + b"\0" * (len(data) % 2)


def headers():
    rng = random.Random(1)
    good = wav(np.zeros((2, 7)), 22050)
    out = [None, b"", b"RIFF", good, good[:-3], good[:44], good[:43], good[:30], b"RIFX" + good[4:], good.replace(b"WAVE", b"WAVX"), good.replace(b"fmt ", b"fmx "), good.replace(b"data", b"dat_")]
    out += [wav(np.zeros((1, 5)), 8000, w, chunk(b"LIST", b"odd") + chunk(b"fact", b"1234")) for w in (1, 2, 3, 4)]
    out += [wav(np.zeros((3, 5)), 0), good[:20] + b"\3\0" + good[22:], good[:22] + b"\0\0" + good[24:], good[:34] + b"\0\0" + good[36:], good + chunk(b"LIST", b"after")]
    sub = bytes.fromhex("0100000000001000800000AA00389B71")
    for tail in (sub, sub[::-1]):
        fmt = chunk(b"fmt ", struct.pack("<HHIIHHHHI", 0xFFFE, 1, 16000, 32000, 2, 16, 22, 16, 4) + tail)
        body = b"WAVE" + fmt + chunk(b"data", b"\0" * 10)
        out.append(struct.pack("<4sI", b"RIFF", len(body)) + body)
    for _ in range(120):  # one byte of the header changed
        b = bytearray(wav(np.zeros((1, 9)), 24000, extra=chunk(b"LIST", b"INFOx")))
        b[rng.randrange(57)] = rng.randrange(256)
        out.append(bytes(b))
    return out


def plain_header(data):
    try:
        with wave.open(io.BytesIO(data or b"")) as w:
            return w.getnchannels(), w.getframerate(), w.getnframes(), w.getnframes() / w.getframerate() if w.getframerate() else None
    except (wave.Error, EOFError, RuntimeError):
        return None


def test_headers(spark):
    """As the standard library reads them."""
    files = headers()
    df = spark.createDataFrame(list(enumerate(files)), "i int, b binary")
    got = {r.i: r.h for r in df.select("i", A.wav_header(F.col("b")).alias("h")).collect()}
    for i, data in enumerate(files):
        want = plain_header(data)
        h = got[i]
        assert (h and (h.channels, h.rate, h.frames, h.seconds)) == want, (i, data)
    assert got[3].whole and not got[4].whole and not got[5].whole
    # the beginning of a file is enough
    long = wav(np.zeros((1, 5000)), 24000)
    r = spark.createDataFrame([(long[:100], len(long))], "b binary, n long").select(A.wav_header(F.col("b"), F.col("n")).alias("h")).first().h
    assert r.frames == 5000 and r.whole


def test_wav_file(spark):
    pcm = bytes(range(24))
    df = spark.createDataFrame([(pcm, 44100, 2, "INFOodd"), (pcm, 8000, 1, None), (b"", 24000, 1, "xx")], "pcm binary, rate long, channels int, extra string")
    for r in df.select("*", A.wav_file(F.col("pcm"), F.col("rate"), F.col("channels"), F.encode("extra", "UTF-8")).alias("b")).collect():
        with wave.open(io.BytesIO(bytes(r.b))) as w:
            assert (w.getframerate(), w.getnchannels(), w.readframes(99)) == (r.rate, r.channels, bytes(r.pcm))
    x = np.array([[0.5, -0.5, 1.0], [0, 0.25, -1]])
    assert plain_header(A.encode_wav(x, 16000))[:3] == (2, 16000, 3)
    assert A.file_header(3, 16000, 2) == A.encode_wav(x, 16000)[:44]


def direct_resample(x, rate, to):
    """The filter's sum for every output frame, written out."""
    cut = 0.99 * min(rate, to) / rate
    out = np.zeros(math.ceil(len(x) * to / rate))
    n = np.arange(len(x))
    for m in range(len(out)):
        t = cut * (n - m * rate / to)
        out[m] = (x * cut * np.sinc(t) * np.where(np.abs(t) < 6, np.cos(np.pi * t / 12) ** 2, 0)).sum()
    return out


@pytest.mark.parametrize("rate", [22050, 44100, 16000, 24000, 8000])
def test_resampling(rate):
    x = np.round(np.random.default_rng(3).uniform(-1, 1, 1500) * 20000) / 32768
    clip = A.Clip(wav(np.stack((x, -x)), rate))
    got = np.concatenate([b for _, b in A.clip_blocks(clip, 24000, 331)])
    assert np.abs(got - (x if rate == 24000 else direct_resample(x, rate, 24000))).max() < 1e-6
    t = np.arange(8000) / rate
    tone = A.resample_run(lambda a, z: np.pad(np.sin(2 * np.pi * 700 * t)[max(0, a) : max(0, z)], (max(0, -a), max(0, z - max(a, 8000)))), rate, 24000, 500, 3000)
    assert np.abs(tone - np.sin(2 * np.pi * 700 * np.arange(500, 3000) / 24000)).max() < 2e-3


def test_decoding(spark):
    rng = np.random.default_rng(0)
    x = rng.uniform(-0.9, 0.9, (2, 700))
    files = [wav(x, 24000, w) for w in (1, 2, 3, 4)] + [wav(x, 44100)[:-1], None, b"junk", wav(np.zeros((1, 0)), 24000), wav(x[:1], 22050, extra=chunk(b"LIST", b"odd"))]
    df = spark.createDataFrame([(i, f, "k") for i, f in enumerate(files)], "i int, content binary, start_frame string")
    rows = O.decode_blocks(df, block=256).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.i, r.start)):
        assert r.start == len(got.setdefault(r.i, [])) and len(r.samples) <= 1024 and r.start_frame == "k"
        got[r.i].extend(np.frombuffer(r.samples, np.float32).tolist())
    for i, w in enumerate((1, 2, 3, 4)):
        assert np.abs(np.array(got[i]) - x[0]).max() < 1.01 / (1 << (8 * w - 1)) + 1e-7
    assert all(got[i] == [0.0] * 24000 for i in (4, 5, 6)) and 7 not in got and len(got[8]) == math.ceil(700 * 24000 / 22050)
    assert {r.i for r in rows if not r.ok} == {4, 5, 6}
    for r in rows:
        y = np.array(got[r.i], np.float64)
        assert r.frames == len(y) and math.isclose(r.mean, y.mean(), abs_tol=1e-12) and math.isclose(r.norm, np.linalg.norm(y - y.mean()), rel_tol=1e-6, abs_tol=1e-9)
    sized = {r.i: r.frames for r in O.with_frames(df).collect()}
    assert sized == {i: len(got.get(i, [])) for i in range(len(files))}


@pytest.fixture(scope="module")
def dialogues(spark):
    """Clips of many lengths with gaps, pauses and overlaps that cut one or more segments off."""
    rng = np.random.default_rng(7)
    rows, waves = [], {}
    for conv in range(4):
        for seg in range(9):
            n = int(rng.choice([0, 1, 40, 300, 1500, 4000]))
            x = np.round(rng.uniform(-1, 1, n) * 30000) / 32768
            if conv == 2 and seg == 4:
                x = np.zeros(500)
            waves[conv, seg] = x.astype(np.float32)
            shift = int(rng.choice([0, 30, 700, 9000])) if rng.random() < 0.5 else None
            rows.append((conv, seg, int(rng.integers(2)), wav(x, 24000), len(x), shift, 120, 50))
    df = spark.createDataFrame(rows, "conv_id long, seg int, channel int, content binary, frames long, shift long, gap long, hold long").repartition(3)
    return df, rows, waves


def plain_mix(rows, waves, conv):
    """One dialogue at once: an overlap takes the end off its own channel; both channels then grow alike."""
    left, right, places = np.zeros(0, np.float32), np.zeros(0, np.float32), {}
    for c, seg, channel, _, n, shift, gap, hold in sorted(r for r in rows if r[0] == conv):
        own, other = (left, right) if channel == 0 else (right, left)
        x, pause = waves[c, seg], np.zeros(hold if shift is not None else gap, np.float32)
        if seg == 0:
            own, other, places[seg] = x, np.zeros(n, np.float32), 0
        else:
            back = min(shift, n, len(own)) if shift is not None else 0
            places[seg] = len(own) - back + len(pause)
            own = np.concatenate((own[: len(own) - back], pause, x))
            other = np.concatenate((other, pause, np.zeros(n - back, np.float32)))
        left, right = (own, other) if channel == 0 else (other, own)
    return np.stack((left, right)), places


def placed(df):
    t = df.drop("content").join(TL.effects_timeline(df).select("conv_id", "seg", "start_frame", "end_frame", "total_frames"), ["conv_id", "seg"])
    return O.seen_until(t.withColumn("cut_frame", F.when(F.col("shift").isNotNull() & (F.col("seg") > 0), F.col("start_frame") - F.col("hold"))))


def tiles_of(df, tile, block):
    p = placed(df)
    files = df.select("conv_id", "seg", "content").join(p.select("conv_id", "seg", "channel", "start_frame", "seen_end"), ["conv_id", "seg"])
    totals = p.groupBy("conv_id").agg(F.max("total_frames").alias("total_frames"))
    return O.mix_tiles(O.decode_blocks(files, block=block), totals, tile=tile), totals, p


def test_mix_and_slices(spark, dialogues):
    """Sample for sample as one dialogue's mix, in tiles that cut segments anywhere."""
    df, rows, waves = dialogues
    tiles, _, p = tiles_of(df, 512, 300)
    got = {}
    for r in sorted(tiles.collect(), key=lambda r: (r.conv_id, r.tile)):
        assert len(r.left) == len(r.right) == 4 * r.n <= 2048
        got.setdefault(r.conv_id, []).append(np.stack([np.frombuffer(x, np.float32) for x in (r.left, r.right)]))
    starts = {(r.conv_id, r.seg): r.start_frame for r in p.collect()}
    mixes = {c: np.concatenate(x, axis=1) for c, x in got.items()}
    for conv in range(4):
        want, places = plain_mix(rows, waves, conv)
        assert mixes[conv].shape == want.shape and (mixes[conv] == want).all()
        assert places == {s: starts[conv, s] for s in places}
    cuts = [(0, 1, 100, 1700), (0, 2, 511, 513), (1, 0, 0, 512), (1, 5, 512, 512), (3, 3, 7, 8)]
    parts = O.slice_parts(tiles, spark.createDataFrame(cuts, "conv_id long, seg int, slice_start long, slice_end long"), tile=512).collect()
    for conv, seg, a, z in cuts:
        own = sorted((r.part, r.left, r.right) for r in parts if (r.conv_id, r.seg) == (conv, seg))
        for c in (0, 1):
            x = np.concatenate([np.frombuffer(r[c + 1], np.float32) for r in own]) if own else np.zeros(0)
            assert (x == mixes[conv][c, a:z]).all() and len(x) == len(mixes[conv][c, a:z])


def test_alignment(spark, dialogues):
    """As direct correlation, for clips of one and of many blocks, silent and repeating ones, and expected
    places near and beyond the ends."""
    df, rows, waves = dialogues
    reach, tile, block = 700, 512, 300
    tiles, totals, p = tiles_of(df, tile, block)
    rng = np.random.default_rng(5)
    expected = {(r[0], r[1]): int(rng.integers(-900, 900)) for r in rows}
    expected[1, 3], expected[3, 2] = 10**6, -(10**6)
    starts = {(r.conv_id, r.seg): r.start_frame for r in p.collect()}
    asked = spark.createDataFrame([(*k, max(starts[k] + e, -(10**6))) for k, e in expected.items()], "conv_id long, seg int, expected long")
    clips = df.select("conv_id", "seg", "channel", "frames", "content").join(asked, ["conv_id", "seg"])
    got = {(r.conv_id, r.seg): r for r in O.align(clips, tiles, totals, reach=reach, tile=tile, block=block).collect()}
    for conv, seg, channel, _, n, *_ in rows:
        mix = plain_mix(rows, waves, conv)[0][channel].astype(np.float64)
        e = starts[conv, seg] + expected[conv, seg]
        if not n:
            assert (conv, seg) not in got
            continue
        lo, hi = max(0, e - reach), min(len(mix), e + reach + n)
        if hi - lo < n:
            lo = max(0, min(lo, len(mix) - n))
            hi = min(len(mix), lo + n)
        t = waves[conv, seg].astype(np.float64)
        t = t - t.mean()
        corr = np.abs(np.correlate(mix[lo:hi], t / (np.linalg.norm(t) + 1e-6), "valid"))
        r = got[conv, seg]
        assert r.found == lo + int(np.flatnonzero(corr >= corr.max() * (1 - A.TIE))[0]) and math.isclose(r.value, corr.max(), rel_tol=1e-6, abs_tol=1e-9), (conv, seg, n)


@pytest.mark.parametrize("size", [{}, {"stretch": 600, "part": 250, "most": 3000}])
def test_alignment_of_files_made_late(spark, dialogues, size, monkeypatch):
    """As ``align``, with files made where they are heard: groups of a whole mix, or of short stretches and
    few clips, which are searched for in parts."""
    df, rows, _ = dialogues
    monkeypatch.setattr(O, "PLACES", 300)
    tiles, totals, p = tiles_of(df, 512, 300)
    rng = np.random.default_rng(6)
    asked = spark.createDataFrame([(r[0], r[1], int(rng.integers(-100, 6000))) for r in rows], "conv_id long, seg int, expected long")
    clips = df.select("conv_id", "seg", "channel", "frames", "content").join(asked, ["conv_id", "seg"])
    want = {(r.conv_id, r.seg): r for r in O.align(clips, tiles, totals, reach=700, tile=512, block=300).collect()}
    files = df.select("conv_id", "seg", F.base64("content").alias("small"))
    late = lambda x: x.withColumn("content", F.unbase64("small"))
    got = O.align_files(files, late, clips.drop("content"), p, reach=700, **size).collect()
    assert len(got) == len(want) > 20
    for r in got:
        w = want[r.conv_id, r.seg]
        assert r.found == w.found and math.isclose(r.value, w.value, rel_tol=1e-6, abs_tol=1e-9)


def test_alignment_shuffles_no_samples(spark, sf_dir):
    """What the query shuffles stays below the bytes of its samples, which are over 30 times the texts."""

    def written():
        time.sleep(0.5)
        e = spark.sparkContext._jsc.sc().statusStore().executorList(False)
        return sum(e.apply(i).totalShuffleWrite() for i in range(e.size()))

    heard = Q.decoded_audio(spark, sf_dir).agg(F.sum("frames")).head()[0] * 4
    before = written()
    assert Q.align_backfill(spark, sf_dir).count() > 0
    assert 0 < written() - before < heard / 10


def test_correlate():
    rng = np.random.default_rng(2)
    for n, m in [(10, 10), (5000, 3), (9000, 4500), (20000, 1000)]:
        x, t = rng.standard_normal(n), rng.standard_normal(m)
        assert np.allclose(A.correlate(x, t), np.correlate(x, t, "valid"))
    assert A.best_start(np.zeros(5)) == (0.0, 0) and A.best_start(np.array([1.0, -3.0, 3.0 * (1 - 1e-12)])) == (3.0, 1)


def test_queries_against_one_dialogue_at_a_time(spark, sf_dir):
    """The registered queries, from their own files."""
    files = {(r.conv_id, r.seg): r for r in Q.clips(spark, sf_dir).collect()}
    heard = {}
    for k, r in files.items():
        try:
            c = A.Clip(bytes(r.content))
            heard[k] = np.concatenate([b for _, b in A.clip_blocks(c, 24000, 1 << 20)] or [np.zeros(0, np.float32)])
        except (wave.Error, EOFError):
            heard[k] = np.zeros(24000, np.float32)
    clean = {}
    for (conv, seg), r in sorted(files.items()):
        if not r.role.startswith("[pause]"):
            clean.setdefault(conv, [[], []])[0 if r.is_user else 1].append(heard[conv, seg])
    got = {r.conv_id: r for r in Q.stereo_mix(spark, sf_dir).collect()}
    assert set(got) == {c for c, x in clean.items() if sum(map(len, x[0] + x[1]))}
    for conv, r in got.items():
        energy = [sum(float((x.astype(np.float64) ** 2).sum()) for x in xs) for xs in clean[conv]]
        assert r.frames == sum(map(len, clean[conv][0] + clean[conv][1])) and r.wav_bytes == 44 + 4 * r.frames
        assert np.allclose([r.left_energy, r.right_energy], energy, atol=2e-3)
    rows = [(c, s, 0 if r.role in ("User", "[overlap] User", "[pause] User") else 1, None, len(heard[c, s]), 600 + r.h % 4000 if r.role.startswith("[overlap]") else None, 6000, 480) for (c, s), r in files.items()]
    found = {(r.conv_id, r.seg): r for r in Q.align_backfill(spark, sf_dir).collect()}
    cuts = {(r.conv_id, r.seg): r for r in Q.effects_slices_audio(spark, sf_dir).collect()}
    placed_ = Q.effects_placed(O.with_frames(Q.clips(spark, sf_dir)).drop("content"))
    slices = {(r.conv_id, r.seg): r for r in TL.effects_slices(placed_).collect()}
    assert set(cuts) == set(slices)
    for conv in {k[0] for k in files}:
        _, places = plain_mix(rows, heard, conv)
        for seg, at in places.items():
            assert (conv, seg) not in found or found[conv, seg].start == at
    for k, r in cuts.items():
        assert r.frames == slices[k].slice_end - slices[k].slice_start
    assert len(found) == sum(not r.role.startswith("[pause]") and len(heard[k]) > 0 for k, r in files.items())
