"""Queries over waveforms: WAV files are built from the turns' texts, and read back as files are.

A clip's samples are the bytes of its text's first 32 suffixes, two bytes a sample.  Rates, channels, a
chunk before the samples, and files that end too early are chosen by the turn's keyed hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import audio as A
from ..functions import text as X
from ..operators import audio as O
from ..operators import timeline as TL
from ..storage import spilled
from .inputs import LINES, lines

SUFFIXES = 32
RATES = (22_050, 24_000, 44_100)

_CLIPS = (
    LINES
    + r""",
c0 AS (SELECT conv_id, turn_index AS seg, role, h, CASE WHEN role LIKE '[pause]%' THEN 1 ELSE 1 + (h // 3) % 2 END AS channels,
  CASE WHEN role LIKE '[pause]%' THEN 24000 ELSE [22050, 24000, 44100][CAST(h % 3 AS BIGINT) + 1] END AS rate, role NOT LIKE '[pause]%' AND h % 97 = 0 AS broken,
  CASE WHEN role LIKE '[pause]%' THEN 2 * (14400 + h % 9601) ELSE list_sum(list_transform(range(1, 33), lambda i: strlen(substr(text, CAST(i AS BIGINT))))) END AS bytes FROM lines),
clips AS (SELECT *, CAST(bytes // (2 * channels) AS BIGINT) AS own FROM c0),
heard AS (SELECT *, broken AND own > 0 AS cut, CASE WHEN broken AND own > 0 THEN 24000 ELSE CAST(ceil(own * 24000 / rate) AS BIGINT) END AS frames FROM clips)"""
)


def clip_texts(spark: SparkSession, d: str) -> DataFrame:
    """``conv_id, seg, role, is_user, h, text``: what each line's WAV file is made of."""
    return lines(spark, d).select("conv_id", F.col("turn_index").alias("seg"), "role", X.is_user(F.col("role")).alias("is_user"), "h", "text")


def with_files(texts: DataFrame) -> DataFrame:
    """Rows with ``role, h, text`` and any other columns, with the WAV file as ``content`` in the text's place."""
    h, pause = F.col("h"), X.is_pause(F.col("role"))
    channels = F.when(pause, 1).otherwise(1 + F.floor(h / 3) % 2).cast("long")
    rate = F.when(pause, TL.RATE).otherwise(F.element_at(F.array(*map(F.lit, RATES)), (h % 3 + 1).cast("int"))).cast("long")
    said = F.encode(F.array_join(F.transform(F.sequence(F.lit(1), F.lit(SUFFIXES)), lambda i: F.substr("text", i, F.length("text"))), ""), "UTF-8")
    silence = F.unhex(F.repeat(F.lit("0000"), (14_400 + h % 9_601).cast("int")))
    raw = texts.select(*(c for c in texts.columns if c != "text"), channels.alias("channels"), rate.alias("rate"), F.when(pause, silence).otherwise(said).alias("pcm"))
    whole = F.expr("substring(pcm, 1, cast(length(pcm) div (2 * channels) * 2 * channels as int))")
    extra = F.when(h % 5 == 0, F.encode(F.concat(F.lit("INFO"), F.col("role")), "UTF-8"))
    file = A.wav_file(F.col("pcm"), F.col("rate"), F.col("channels"), extra)
    kept = F.when(~F.col("role").startswith("[pause]") & (h % 97 == 0), F.expr("substring(content, 1, length(content) - 1)")).otherwise(F.col("content"))
    return raw.withColumn("pcm", whole).withColumn("content", file).withColumn("content", kept).drop("channels", "rate", "pcm")


def clips(spark: SparkSession, d: str) -> DataFrame:
    """``conv_id, seg, role, is_user, h, content``: one WAV file for each line."""
    return with_files(clip_texts(spark, d))


def wav_durations(spark: SparkSession, d: str) -> DataFrame:
    """What the files' headers say."""
    h = clips(spark, d).select("conv_id", "seg", A.wav_header(F.col("content")).alias("w"))
    return h.select("conv_id", "seg", "w.channels", "w.rate", "w.frames", "w.seconds", "w.whole")


def decoded_audio(spark: SparkSession, d: str) -> DataFrame:
    """Each file decoded to 24 kHz in blocks: whether it could be read, its frames and blocks."""
    blocks = O.decode_blocks(clips(spark, d).select("conv_id", "seg", "content"))
    n = F.length("samples") / 4
    return blocks.groupBy("conv_id", "seg").agg(F.min("ok").alias("ok"), F.sum(n).cast("long").alias("frames"), F.count(F.lit(1)).alias("blocks"))


def clean_placed(c: DataFrame) -> DataFrame:
    """Spoken clips one after the other, users on the left."""
    t = TL.clean_timeline(c.where(~X.is_pause(F.col("role"))), "conv_id", "seg")
    return t.withColumn("channel", F.when(F.col("is_user"), 0).otherwise(1)).withColumn("seen_end", F.col("end_frame"))


def effects_placed(c: DataFrame) -> DataFrame:
    """All clips with gaps, pauses and overlaps, and how long each is heard in its channel."""
    role, h = F.col("role"), F.col("h")
    shift = F.when(X.is_overlap(role), 600 + h % 4_000)
    s = c.withColumns({"gap": F.lit(6_000), "shift": shift, "hold": F.lit(480), "channel": F.when(X.is_user_strict(role), 0).otherwise(1)})
    t = s.join(TL.effects_timeline(s).select("conv_id", "seg", "start_frame", "end_frame", "total_frames"), ["conv_id", "seg"])
    cut = F.when(F.col("shift").isNotNull() & (F.col("seg") > 0), F.col("start_frame") - F.col("hold"))
    return O.seen_until(t.withColumn("cut_frame", cut))


def _mix(placed: DataFrame, c: DataFrame, end: str) -> DataFrame:
    totals = placed.groupBy("conv_id").agg(F.max(end).alias("total_frames"))
    files = c.select("conv_id", "seg", "content").join(placed.select("conv_id", "seg", "channel", "start_frame", "seen_end"), ["conv_id", "seg"])
    return O.mix_tiles(O.decode_blocks(files), totals)


def _sized(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The files, and a table of their lengths, which timelines read several times."""
    c = clips(spark, d)
    return c, spilled(O.with_frames(c).drop("content"), "clip-lengths")[0]


def stereo_mix(spark: SparkSession, d: str) -> DataFrame:
    """Each dialogue's clean mix: frames, energy of either channel, size of its file."""
    c, sized = _sized(spark, d)
    tiles = O.tile_energy(_mix(clean_placed(sized), c, "end_frame"))
    sums = tiles.groupBy("conv_id").agg(F.sum("n").alias("frames"), F.round(F.sum("left_energy"), 3).alias("left_energy"), F.round(F.sum("right_energy"), 3).alias("right_energy"))
    return sums.withColumn("wav_bytes", F.col("frames") * 4 + 44)


def effects_slices_audio(spark: SparkSession, d: str) -> DataFrame:
    """The cuts of the mix with effects: frames and a sum of the parts' checksums, by channel."""
    c, sized = _sized(spark, d)
    placed, _ = spilled(effects_placed(sized), "effects-timeline")
    tiles = _mix(placed, c, "total_frames")
    cuts = TL.effects_slices(placed).select("conv_id", "seg", "slice_start", "slice_end")
    parts = O.slice_parts(tiles, cuts)
    return parts.groupBy("conv_id", "seg").agg(F.sum(F.length("left") / 4).cast("long").alias("frames"), F.sum(F.crc32("left")).alias("left_sum"), F.sum(F.crc32("right")).alias("right_sum"))


def align_backfill(spark: SparkSession, d: str) -> DataFrame:
    """Where each spoken clip lies in the mix with effects, searched around its clean start.  Texts are
    shuffled, never their samples."""
    _, sized = _sized(spark, d)
    placed, _ = spilled(effects_placed(sized), "effects-timeline")
    expected = clean_placed(sized).select("conv_id", "seg", "channel", "frames", F.col("start_frame").alias("expected"))
    texts = clip_texts(spark, d).select("conv_id", "seg", "role", "h", "text")
    found = O.align_files(texts, with_files, expected, placed)
    return placed.select("conv_id", "seg", F.col("start_frame").alias("start")).join(found.select("conv_id", "seg", "found"), ["conv_id", "seg"])


Q = {f.__name__: f for f in (wav_durations, decoded_audio, stereo_mix, effects_slices_audio, align_backfill)}
SQL: dict[str, str] = {
    "wav_durations": rf"WITH {_CLIPS} SELECT conv_id, seg, CAST(channels AS INTEGER) AS channels, CAST(rate AS BIGINT) AS rate, own AS frames, CAST(own AS DOUBLE) / rate AS seconds, NOT cut AS whole FROM heard",
    "decoded_audio": rf"WITH {_CLIPS} SELECT conv_id, seg, NOT cut AS ok, frames, CAST(ceil(frames / 32768) AS BIGINT) AS blocks FROM heard WHERE frames > 0",
}
