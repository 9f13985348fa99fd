"""Waveforms: WAV headers and files as column functions, and NumPy helpers for one block of samples."""

from __future__ import annotations

import io
import struct
import wave
from collections.abc import Callable, Iterator
from functools import lru_cache
from math import ceil, gcd

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Hexadecimal chunk names and the PCM sub-format of extensible files.  Fixed values.
_RIFF, _WAVE, _FMT, _DATA = "52494646", "57415645", "666D7420", "64617461"
_PCM_SUBFORMAT = "0100000000001000800000AA00389B71"
_FIELDS = "struct<pos:bigint,channels:int,rate:bigint,bits:int,size:bigint,state:string>"

#: Zero crossings on either side of the resampling filter, and its cut-off as a share of the lower rate.
CROSSINGS, ROLLOFF = 6, 0.99


# -- headers and files as column functions ---------------------------------------------


def wav_header(head: Column, length: Column | None = None, chunks: int = 32) -> Column:
    """``channels, rate, bits, frames, seconds, whole`` of a WAV file from its leading bytes; null if they
    hold no header of whole-number samples.

    A fold walks over the chunks (at most ``chunks``, padded to even sizes) up to ``data``.
    ``length`` is the file's length, where ``head`` is only its beginning; ``whole`` tells
    whether the file has all the bytes that its header promises.
    """
    length = F.length(head) if length is None else length
    # bound as a lambda's variable, so that no step evaluates the file anew
    return F.element_at(F.transform(F.array(F.struct(head.alias("head"), length.cast("long").alias("length"))), lambda x: _walk(x["head"], x["length"], chunks)), 1)


def _walk(head: Column, length: Column, chunks: int) -> Column:
    digits = lambda pos, n: F.hex(F.substr(head, (pos + 1).cast("int"), F.lit(n)))

    def number(pos: Column, n: int) -> Column:
        return F.conv(F.concat(*(digits(pos + i, 1) for i in reversed(range(n)))), 16, 10).cast("long")

    end = F.least(number(F.lit(4), 4) + 8, length, F.length(head).cast("long"))
    start = F.when((digits(F.lit(0), 4) == _RIFF) & (digits(F.lit(8), 4) == _WAVE), "go").otherwise("bad")
    zero = F.struct(F.lit(12).cast("long").alias("pos"), F.lit(0).alias("channels"), F.lit(0).cast("long").alias("rate"), F.lit(0).alias("bits"), F.lit(0).cast("long").alias("size"), start.alias("state")).cast(_FIELDS)

    def step(s: Column, _: Column) -> Column:
        pos, name, size = s["pos"], digits(s["pos"], 4), number(s["pos"] + 4, 4)
        at = pos + 8
        kind, bits = number(at, 2), number(at + 14, 2)
        known = (kind == 1) | ((kind == 65534) & (size >= 40) & (digits(at + 24, 16) == _PCM_SUBFORMAT))
        fmt_ok = (size >= 16) & (at + 16 <= end) & known & (number(at + 2, 2) > 0) & (bits > 0)
        row = lambda p, c, r, b, n, t: F.struct(p.cast("long").alias("pos"), c.cast("int").alias("channels"), r.cast("long").alias("rate"), b.cast("int").alias("bits"), n.cast("long").alias("size"), t.alias("state")).cast(_FIELDS)
        kept = lambda t: row(pos, s["channels"], s["rate"], s["bits"], s["size"], F.lit(t))
        after = at + size + size % 2
        return (
            F.when(s["state"] != "go", s)
            .when(at > end, kept("bad"))
            .when(name == _FMT, F.when(fmt_ok, row(after, number(at + 2, 2), number(at + 4, 4), bits, F.lit(0), F.lit("go"))).otherwise(kept("bad")))
            .when(name == _DATA, F.when(s["channels"] > 0, row(at, s["channels"], s["rate"], s["bits"], size, F.lit("done"))).otherwise(kept("bad")))
            .otherwise(row(after, s["channels"], s["rate"], s["bits"], F.lit(0), F.lit("go")))
        )

    s = F.aggregate(F.sequence(F.lit(1), F.lit(chunks)), zero, step)

    def fields(x: Column) -> Column:
        wide = F.floor((x["bits"] + 7) / 8)
        frames = F.floor(x["size"] / (x["channels"] * wide)).cast("long")
        whole = x["pos"] + frames * x["channels"] * wide <= length
        out = F.struct(x["channels"].alias("channels"), x["rate"].alias("rate"), x["bits"].alias("bits"), frames.alias("frames"), F.when(x["rate"] > 0, frames / x["rate"]).alias("seconds"), whole.alias("whole"))
        return F.when(x["state"] == "done", out)

    return F.element_at(F.transform(F.array(s), fields), 1)


def little_endian(n: Column, size: int) -> Column:
    """A number as ``size`` bytes, the lowest first."""
    n = n.cast("long")
    return F.unhex(F.concat(*(F.lpad(F.hex(F.shiftright(n, 8 * i).bitwiseAND(255)), 2, "0") for i in range(size))))


def wav_file(pcm: Column, rate: Column, channels: Column, extra: Column | None = None) -> Column:
    """A 16-bit WAV file around interleaved samples; ``extra`` is the body of a LIST chunk before them."""
    le = little_endian
    none = F.unhex(F.lit(""))
    block = (channels * 2).cast("long")
    fmt = F.concat(F.unhex(F.lit(_FMT)), le(F.lit(16), 4), le(F.lit(1), 2), le(channels, 2), le(rate, 4), le(rate * block, 4), le(block, 2), le(F.lit(16), 2))
    if extra is not None:
        pad = F.when(F.length(extra) % 2 == 1, F.unhex(F.lit("00"))).otherwise(none)
        fmt = F.concat(fmt, F.coalesce(F.concat(F.unhex(F.hex(F.lit("LIST"))), le(F.length(extra), 4), extra, pad), none))
    body = F.concat(F.unhex(F.lit(_WAVE)), fmt, F.unhex(F.lit(_DATA)), le(F.length(pcm), 4), pcm)
    return F.concat(F.unhex(F.lit(_RIFF)), le(F.length(body), 4), body)


def resampled_frames(frames: Column, rate: Column, to: int) -> Column:
    return F.ceil(frames.cast("long") * F.lit(to) / rate).cast("long")


# -- one file or block with NumPy ------------------------------------------------------


def file_header(frames: int, rate: int, channels: int) -> bytes:
    """The 44 bytes before ``frames`` 16-bit frames."""
    size, block = frames * channels * 2, channels * 2
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + size, b"WAVE", b"fmt ", 16, 1, channels, rate, rate * block, block, 16, b"data", size)


def to_pcm(channels: np.ndarray) -> bytes:
    """(channels, frames) floats as interleaved 16-bit samples."""
    return (np.clip(channels, -1, 1) * 32767).round().astype("<i2").T.tobytes()


def encode_wav(channels: np.ndarray, rate: int) -> bytes:
    """(channels, frames) floats as a 16-bit file."""
    return file_header(channels.shape[1], rate, channels.shape[0]) + to_pcm(channels)


class Clip:
    """A WAV file in memory, read in runs of frames: its first channel as floats.

    Raises ``wave.Error`` or ``EOFError`` where there is no readable header, and where the file
    ends before its samples do.
    """

    def __init__(self, data: bytes | None) -> None:
        self.file = wave.open(io.BytesIO(data or b""))
        self.rate, self.frames = self.file.getframerate(), self.file.getnframes()
        self.channels, self.width = self.file.getnchannels(), self.file.getsampwidth()
        if self.rate <= 0 or self.width > 4:
            raise wave.Error("no sample rate, or samples of over 32 bits")
        if self.frames:
            self.file.setpos(self.frames - 1)
            if len(self.file.readframes(1)) < self.channels * self.width:
                raise EOFError("the file ends before its samples")

    def read(self, start: int, stop: int) -> np.ndarray:
        """Frames from ``start`` to ``stop``; zeros where there are none."""
        lo, hi = max(0, start), max(0, min(self.frames, stop))
        if hi <= lo:
            return np.zeros(max(0, stop - start))
        self.file.setpos(lo)
        raw = np.frombuffer(self.file.readframes(hi - lo), np.uint8).reshape(hi - lo, self.channels, self.width)[:, 0]
        if self.width == 1:
            x = raw[:, 0].astype(np.float64) - 128
        else:
            wide = np.zeros((len(raw), 4), np.uint8)
            wide[:, 4 - self.width :] = raw
            x = (wide.view("<i4")[:, 0] >> (8 * (4 - self.width))).astype(np.float64)
        return np.pad(x / float(1 << (8 * self.width - 1)), (lo - start, stop - hi))


@lru_cache(64)
def filter_bank(rate: int, to: int, crossings: int = CROSSINGS, rolloff: float = ROLLOFF) -> tuple[int, int, int, np.ndarray]:
    """Down, up, reach and the filter of each phase: ``out[m]`` is the sum over i of
    ``x[m * down // up + i - reach] * bank[m % up, i]``.

    The filter is a sinc with its cut-off at ``rolloff`` of the lower Nyquist frequency, under a
    Hann window that ends after ``crossings`` of its zeros.
    """
    g = gcd(rate, to)
    down, up = rate // g, to // g
    cut = rolloff * min(1.0, up / down)  # per input frame
    reach = ceil(crossings / cut)
    phase = (np.arange(up) * down % up) / up
    t = cut * (np.arange(-reach, reach + 2)[None, :] - phase[:, None])
    window = np.where(np.abs(t) < crossings, np.cos(np.pi * t / (2 * crossings)) ** 2, 0.0)
    return down, up, reach, cut * np.sinc(t) * window


def resample_run(read: Callable[[int, int], np.ndarray], rate: int, to: int, start: int, stop: int) -> np.ndarray:
    """Output frames from ``start`` to ``stop``, from the few input frames that they need."""
    if rate == to:
        return read(start, stop)
    down, up, reach, bank = filter_bank(rate, to)
    m = np.arange(start, stop, dtype=np.int64)
    centre = m * down // up
    first = int(centre[0]) - reach if len(m) else 0
    x = read(first, int(centre[-1]) + reach + 2) if len(m) else np.zeros(0)
    out = np.zeros(len(m))
    for i in range(bank.shape[1]):
        out += x[centre - first + (i - reach)] * bank[m % up, i]
    return out


def clip_blocks(clip: Clip, to: int, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Start and samples of each block of the clip at rate ``to``."""
    total = -(-clip.frames * to // clip.rate)
    for start in range(0, total, size):
        yield start, resample_run(clip.read, clip.rate, to, start, min(total, start + size)).astype(np.float32)


def correlate(x: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Inner products of ``t`` with every run of ``x`` of its length, by overlap-save blocks."""
    n = len(x) - len(t) + 1
    size = max(1 << 12, 1 << (4 * len(t) - 1).bit_length())
    size = min(size, 1 << (len(x) + len(t) - 1).bit_length())
    step = size - len(t) + 1
    runs = -(-n // step)
    padded = np.zeros((runs - 1) * step + size)
    padded[: len(x)] = x[: len(padded)]
    windows = np.lib.stride_tricks.sliding_window_view(padded, size)[::step]
    other = np.conj(np.fft.rfft(t, size))
    return np.fft.irfft(np.fft.rfft(windows, axis=1) * other, size, axis=1)[:, :step].reshape(-1)[:n]


#: Correlations that differ by less than this share of the largest tie, and the earliest counts.
TIE = 1e-9


def best_start(corr: np.ndarray) -> tuple[float, int]:
    """The largest absolute value and its first place."""
    a = np.abs(corr)
    top = float(a.max())
    return top, int(np.flatnonzero(a >= top * (1 - TIE))[0])
