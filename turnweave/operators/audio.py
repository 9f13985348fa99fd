"""Audio of dialogues as distributed jobs: decoding, mixing, slicing and alignment.

Samples travel as blocks of bounded length, 32-bit floats in binary columns.  A mix is a
table of tiles of ``TILE`` frames: blocks are cut at tile borders where they stand and meet
their tile by key, so a task holds tiles, never a dialogue.  Slices are cut from the tiles that
they cover.  Alignment correlates a clip's blocks with the tiles around their expected place and
adds up the blocks' correlations.  Where the files can be made from smaller columns,
``align_files`` deals out these columns instead, and decodes, mixes and searches in one task per
``STRETCH`` of a dialogue, so that no samples are shuffled.

A clip that can't be read (no header, samples missing, null) is a second of silence, with
``ok`` false.
"""

from __future__ import annotations

import wave
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import audio as A
from ..shipping import ship
from ..storage import small_batches, spilled
from .timeline import RATE

BLOCK = 1 << 15
TILE = 1 << 16
#: Clips whose expected places share a tile and that are aligned together.
TOGETHER = 256
#: Places of a correlation that are added up together, for clips of several blocks.
PLACES = 1 << 13
OUT_BYTES = 4 << 20
#: Frames of a mix that one group of ``align_files`` searches from, and of a clip that it searches for at once.
STRETCH, PART = 1 << 19, 1 << 18
#: Frames of clips that such a group holds, where each clip counts as 1024 more.
HELD = 1 << 20


def with_frames(clips: DataFrame, content: str = "content", rate: int = RATE, name: str = "frames") -> DataFrame:
    """Clips with their length after decoding, from their headers alone."""
    h = A.wav_header(F.col(content))
    heard = clips.withColumn("_h", h)
    fine = F.coalesce(F.col("_h.whole") & (F.col("_h.rate") > 0) & (F.col("_h.bits") <= 32), F.lit(False))
    return heard.withColumn(name, F.when(fine, A.resampled_frames(F.col("_h.frames"), F.col("_h.rate"), rate)).otherwise(F.lit(rate).cast("long"))).drop("_h")


def _decode(batches: Iterator[pa.RecordBatch], content: str, rate: int, block: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != content]
        rows: list[tuple] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal held
            i, *cols = zip(*rows, strict=True)
            kinds = (pa.bool_(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.binary())
            out = [k.take(pa.array(i, pa.int64())) for k in keys] + [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]
            rows.clear()
            held = 0
            return pa.RecordBatch.from_arrays(out, names=names)

        for i, data in enumerate(batch.column(content)):
            ok, blocks = True, None
            try:
                clip = A.Clip(data.as_py())
                total = -(-clip.frames * rate // clip.rate)
                blocks = lambda clip=clip: A.clip_blocks(clip, rate, block)
            except (wave.Error, EOFError):
                ok, total = False, rate
                blocks = lambda: ((s, np.zeros(min(block, rate - s), np.float32)) for s in range(0, rate, block))
            if total <= block:
                kept = list(blocks())
                blocks = lambda kept=kept: iter(kept)
            one = two = 0.0
            for _, x in blocks():
                one, two = one + float(x.sum(dtype=np.float64)), two + float((x.astype(np.float64) ** 2).sum())
            mean = one / max(1, total)
            norm = max(0.0, two - total * mean * mean) ** 0.5
            for start, x in blocks():
                rows.append((i, ok, total, mean, norm, start, x.tobytes()))
                held += x.nbytes
                if held >= OUT_BYTES:
                    yield flush()
        if rows:
            yield flush()


def decode_blocks(clips: DataFrame, content: str = "content", rate: int = RATE, block: int = BLOCK) -> DataFrame:
    """The clips' first channels at ``rate``, one row a block: the other columns, ``ok, frames, mean, norm``
    of the whole clip (``norm``: root of the summed squares around the mean), ``start, samples``.

    Files are resampled block by block; a clip without frames gives no row.
    """
    ship(clips.sparkSession)
    small_batches(clips.sparkSession)
    kept = [f for f in clips.schema.fields if f.name != content]
    schema = T.StructType([*kept]).add("ok", "boolean").add("frames", "long").add("mean", "double").add("norm", "double").add("start", "long").add("samples", "binary")
    return clips.mapInArrow(lambda it: _decode(it, content, rate, block, schema.names), schema)


def seen_until(timeline: DataFrame, key: str = "conv_id", order: str = "seg", channel: str = "channel") -> DataFrame:
    """A timeline (``start_frame, end_frame, cut_frame``: where the segment ends what its channel holds, or
    null) with ``seen_end``: up to where each segment is heard."""
    later = Window.partitionBy(key, channel).orderBy(order).rowsBetween(1, Window.unboundedFollowing)
    return timeline.withColumn("seen_end", F.least("end_frame", F.min("cut_frame").over(later)))


def _tiles(lo: Column, hi: Column, size: int) -> Column:
    """Numbers of the tiles that [lo, hi) touches."""
    return F.sequence(F.floor(lo / size), F.floor((hi - 1) / size))


def _cut(samples: str, offset: Column, frames: Column) -> Column:
    return F.substr(F.col(samples), (offset * 4 + 1).cast("int"), (frames * 4).cast("int"))


def _lay(group: pa.Table, key: str, width: int) -> pa.Table:
    """One tile with its pieces in place."""
    n = max(x or 0 for x in group.column("n").to_pylist())
    out = np.zeros((2, n), np.float32)
    for c, at, data in zip(*(group.column(x).to_pylist() for x in ("channel", "at", "samples")), strict=True):
        if data is not None:
            x = np.frombuffer(data, np.float32)
            out[c, at : at + len(x)] = x
    tile = group.column("tile")[0].as_py()
    return pa.table({key: group.column(key).slice(0, 1), "tile": pa.array([tile], pa.int64()), "n": pa.array([n], pa.int64()), "left": pa.array([out[0].tobytes()], pa.binary()), "right": pa.array([out[1].tobytes()], pa.binary())})


def mix_tiles(blocks: DataFrame, totals: DataFrame, key: str = "conv_id", tile: int = TILE) -> DataFrame:
    """``key, tile, n, left, right``: every tile of every mix, silent ones too.

    ``blocks`` are decoded blocks with ``channel`` (0 left), ``start_frame`` and ``seen_end`` of their
    segment; ``totals`` has ``key, total_frames``.
    """
    a = F.col("start_frame") + F.col("start")
    z = F.least(a + F.length("samples") / 4, "seen_end").cast("long")
    placed = blocks.select(key, F.col("channel").cast("int").alias("channel"), a.alias("a"), z.alias("z"), "samples").where("z > a")
    spread = placed.select("*", F.explode(_tiles(F.col("a"), F.col("z"), tile)).alias("tile"))
    lo, hi = F.greatest("a", F.col("tile") * tile), F.least("z", (F.col("tile") + 1) * tile)
    pieces = spread.select(key, "tile", "channel", (lo - F.col("tile") * tile).alias("at"), _cut("samples", lo - F.col("a"), hi - lo).alias("samples"), F.lit(None).cast("long").alias("n"))
    whole = totals.where("total_frames > 0").select(key, "total_frames", F.explode(_tiles(F.lit(0), F.col("total_frames"), tile)).alias("tile"))
    blank = whole.select(key, "tile", F.lit(None).cast("int").alias("channel"), F.lit(None).cast("long").alias("at"), F.lit(None).cast("binary").alias("samples"), F.least(F.lit(tile), F.col("total_frames") - F.col("tile") * tile).alias("n"))
    kind = blocks.schema[key].dataType.simpleString()
    return pieces.unionByName(blank).groupBy(key, "tile").applyInArrow(lambda t: _lay(t, key, tile), f"{key} {kind}, tile long, n long, left binary, right binary")


def slice_parts(tiles: DataFrame, cuts: DataFrame, key: str = "conv_id", tile: int = TILE) -> DataFrame:
    """The tiles' parts of every cut: the columns of ``cuts`` (with ``slice_start, slice_end``), ``part``
    in order, ``left, right``."""
    spread = cuts.where("slice_end > slice_start").select("*", F.explode(_tiles(F.col("slice_start"), F.col("slice_end"), tile)).alias("tile"))
    lo = F.greatest(F.col("slice_start") - F.col("tile") * tile, F.lit(0))
    hi = F.least(F.col("slice_end") - F.col("tile") * tile, F.lit(tile))
    return spread.join(tiles, [key, "tile"]).select(*cuts.columns, F.col("tile").alias("part"), _cut("left", lo, hi - lo).alias("left"), _cut("right", lo, hi - lo).alias("right"))


def _match(templates: pa.Table, near: pa.Table, key: str, order: str, tile: int, block: int) -> pa.Table:
    """Correlations of the blocks of one group with the tiles around them."""
    out: dict[str, list] = {c: [] for c in ("row", "piece", "corr", "value", "found")}
    tiles = {t: np.frombuffer(s, np.float32) for t, s in zip(near.column("tile").to_pylist(), near.column("samples").to_pylist(), strict=True)}
    if len(templates) and tiles:
        first = min(tiles)
        x = np.concatenate([tiles.get(t, np.zeros(tile, np.float32)) for t in range(first, max(tiles) + 1)]).astype(np.float64)
    cols = {c: templates.column(c).to_pylist() for c in ("lo", "hi", "start", "frames", "mean", "norm", "samples")}
    for i in range(len(templates)):
        lo, hi, start, frames, mean, norm = (cols[c][i] for c in ("lo", "hi", "start", "frames", "mean", "norm"))
        t = np.frombuffer(cols["samples"][i], np.float32).astype(np.float64) - mean
        a = lo + start - first * tile
        run = x[a : a + hi - lo + len(t)]
        silent = norm * norm <= 1e-12 * frames
        corr = np.zeros(hi - lo + 1) if silent else A.correlate(run, t) / (norm + 1e-6)
        if frames <= block:
            value, at = A.best_start(corr)
            parts = [(None, None, value, lo + at)]
        else:
            parts = [(p, corr[p : p + PLACES].tobytes(), None, None) for p in range(0, len(corr), PLACES)]
        for p in parts:
            for c, v in zip(("piece", "corr", "value", "found"), p, strict=True):
                out[c].append(v)
            out["row"].append(i)
    take = pa.array(out["row"], pa.int64())
    return pa.table(
        {key: templates.column(key).take(take), order: templates.column(order).take(take), "lo": templates.column("lo").take(take), "piece": pa.array(out["piece"], pa.int64()), "corr": pa.array(out["corr"], pa.binary()), "value": pa.array(out["value"], pa.float64()), "found": pa.array(out["found"], pa.int64())}
    )


def _add(batches: Iterator[pa.RecordBatch], key: str, order: str) -> Iterator[pa.RecordBatch]:
    """The sum of the blocks' correlations at some places, and its best."""
    total, first = None, None
    for b in batches:
        for data in b.column("corr").to_pylist():
            x = np.frombuffer(data, np.float64)
            total = x.copy() if total is None else total + x
        first = b.slice(0, 1) if first is None else first
    if first is not None:
        value, at = A.best_start(total)
        found = first.column("lo")[0].as_py() + first.column("piece")[0].as_py() + at
        yield pa.RecordBatch.from_arrays([first.column(key), first.column(order), pa.array([value]), pa.array([found], pa.int64())], names=[key, order, "value", "found"])


def _asked(clips: DataFrame, totals: DataFrame, key: str, reach: int) -> DataFrame:
    """Clips (``expected, frames``) with the first and last start to try (``lo, hi``) in their mix."""
    n, total = F.col("frames"), F.col("total_frames")
    lo = F.greatest(F.col("expected") - reach, F.lit(0))
    hi = F.least(total, F.col("expected") + reach + n) - n
    late = F.greatest(F.least(lo, total - n), F.lit(0))
    asked = clips.join(totals, key).where((n > 0) & (n <= total))
    return asked.withColumn("lo", F.when(hi < lo, late).otherwise(lo)).withColumn("hi", F.when(hi < lo, late).otherwise(hi))


def align(clips: DataFrame, tiles: DataFrame, totals: DataFrame, key: str = "conv_id", order: str = "seg", content: str = "content", reach: int = 2 * RATE, rate: int = RATE, tile: int = TILE, block: int = BLOCK) -> DataFrame:
    """``key, order, found, value``: where each clip lies in its channel of its mix.

    ``clips`` have ``key, order, channel, expected`` (frames), ``frames`` and ``content``.  Starts up to
    ``reach`` frames from the expected one are tried that leave the clip within the mix;
    where there is none, the last start that does.  The largest absolute correlation with the
    mean-free clip counts, ties go to the earliest, so that silence is found at the first start
    tried.  Clips without frames and those longer than the mix give no row.
    """
    spark = clips.sparkSession
    ship(spark)
    small_batches(spark)
    n = F.col("frames")
    asked = _asked(clips, totals, key, reach)
    place = F.row_number().over(Window.partitionBy(key, "channel", F.floor(F.col("lo") / tile)).orderBy(order)) - 1
    # a table of numbers that three branches read; content is met again by key
    sub, _ = spilled(asked.select(key, order, "channel", "lo", "hi", n.alias("_n"), F.floor(place / TOGETHER).alias("sub")), "searches")
    blocks = decode_blocks(clips.select(key, order, content).join(sub.drop("_n"), [key, order]), content, rate, block)
    own = blocks.withColumn("base", F.floor((F.col("lo") + F.col("start")) / tile))
    span = -(-(tile + 2 * reach + block) // tile)
    need = sub.select(key, "channel", "sub", F.explode(F.sequence(F.floor(F.col("lo") / tile), F.floor((F.col("lo") + F.col("_n") - 1) / tile))).alias("base")).distinct()
    need = need.select("*", F.explode(F.sequence(F.col("base"), F.col("base") + (span - 1))).alias("tile"))
    near = need.join(tiles, [key, "tile"]).select(key, "channel", "sub", "base", "tile", F.when(F.col("channel") == 0, F.col("left")).otherwise(F.col("right")).alias("samples"))
    groups = [key, "channel", "sub", "base"]
    kinds = {f.name: f.dataType.simpleString() for f in clips.schema.fields}
    ids = f"{key} {kinds[key]}, {order} {kinds[order]}"
    got = own.groupBy(*groups).cogroup(near.groupBy(*groups)).applyInArrow(lambda a, b: _match(a, b, key, order, tile, block), f"{ids}, lo long, piece long, corr binary, value double, found long")
    short = got.where("corr is null").select(key, order, "value", "found")
    long = got.where("corr is not null").groupBy(key, order, "piece").applyInArrow(_adder(key, order), f"{ids}, value double, found long")
    return _best(short.unionByName(long), key, order)


def _best(tried: DataFrame, key: str, order: str) -> DataFrame:
    """The earliest of each clip's best places."""
    best = tried.groupBy(key, order).agg(F.max("value").alias("value"), F.collect_list(F.struct("found", "value")).alias("all"))
    tied = F.filter("all", lambda x: x["value"] >= F.col("value") * (1 - A.TIE))
    return best.select(key, order, F.array_min(F.transform(tied, lambda x: x["found"])).alias("found"), "value")


def _adder(key: str, order: str):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _add(batches, key, order)

    return add


class _Heard:
    """One file's samples at ``rate``, in runs; a second of silence where it can't be read."""

    def __init__(self, data: bytes | None, rate: int, part: int) -> None:
        try:
            clip = A.Clip(data)
            self.total = -(-clip.frames * rate // clip.rate)
            self.run = lambda a, z: A.resample_run(clip.read, clip.rate, rate, a, z).astype(np.float32)
        except (wave.Error, EOFError):
            self.total, self.run = rate, lambda a, z: np.zeros(z - a, np.float32)
        if self.total <= part:
            whole = self.run(0, self.total)
            self.run = lambda a, z: whole[a:z]


def _searched(held: list[tuple], mix: np.ndarray, first: int, part: int) -> Iterator[tuple]:
    """``order, lo, value, found, piece, n, one, two, corr, sums`` for each part of a clip that a group holds:
    its best place where it is the whole clip, else what the parts' sums are made of, in pieces."""
    for order, channel, lo, hi, at, total, x in held:
        run = mix[channel, lo + at - first : hi + at - first + len(x)].astype(np.float64)
        t = x.astype(np.float64)
        one, two = float(t.sum()), float((t * t).sum())
        mean = one / len(t)
        if total <= part:
            norm = max(0.0, two - one * mean) ** 0.5
            corr = np.zeros(hi - lo + 1) if norm * norm <= 1e-12 * total else A.correlate(run, t - mean) / (norm + 1e-6)
            value, best = A.best_start(corr)
            yield order, lo, value, lo + best, None, None, None, None, None, None
            continue
        corr = A.correlate(run, t - mean)
        up = np.concatenate((np.zeros(1), np.cumsum(run)))
        sums = up[len(t) :] - up[: len(corr)]
        for p in range(0, len(corr), PLACES):
            yield order, lo, None, None, p, len(t), one, two, corr[p : p + PLACES].tobytes(), sums[p : p + PLACES].tobytes()


def _search(batches: Iterator[pa.RecordBatch], names: list[str], stretch: int, span: int, part: int, rate: int) -> Iterator[pa.RecordBatch]:
    """Searches of groups whose rows (key, stretch, sub, order, jobs, content) follow each other."""
    kinds, now, mix, held, rows, size = (), None, None, [], [], 0

    def finish() -> Iterator[pa.RecordBatch]:
        nonlocal size
        for r in _searched(held, mix, now[1] * stretch, part) if held else ():
            rows.append((now[0], *r))
            size += 64 + sum(len(x) for x in r[-2:] if x is not None)
            if size >= OUT_BYTES:
                yield flush()

    def flush() -> pa.RecordBatch:
        nonlocal size
        out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
        rows.clear()
        size = 0
        return out

    for batch in batches:
        kinds = (batch.schema.field(0).type, batch.schema.field(3).type, pa.int64(), pa.float64(), *[pa.int64()] * 3, *[pa.float64()] * 2, *[pa.binary()] * 2)
        cols = [batch.column(i).to_pylist() for i in range(5)]
        for *group, order, jobs, content in zip(*cols, batch.column(5), strict=True):
            if group != now:
                yield from finish()
                now, mix, held = group, np.zeros((2, span), np.float32), []
            first = now[1] * stretch
            heard = _Heard(content.as_py(), rate, part)
            for j in jobs:
                if j["search"]:
                    held.append((order, j["channel"], j["a"], j["z"], j["at"], heard.total, heard.run(j["at"], min(heard.total, j["at"] + part))))
                elif (a := max(j["a"], first)) < (z := min(j["a"] + heard.total, j["z"], first + span)):
                    mix[j["channel"], a - first : z - first] = heard.run(a - j["a"], z - j["a"])
    yield from finish()
    if rows:
        yield flush()


def _add_parts(batches: Iterator[pa.RecordBatch], key: str, order: str) -> Iterator[pa.RecordBatch]:
    """The best of some places of a clip, from its parts: around the mean of all instead of each part's own."""
    n, one, two, corr, own, sums, first = 0, 0.0, 0.0, 0.0, 0.0, 0.0, None
    for b in batches:
        first = b.slice(0, 1) if first is None and len(b) else first
        for m, a, q, c, s in zip(*(b.column(x).to_pylist() for x in ("n", "one", "two", "corr", "sums")), strict=True):
            s = np.frombuffer(s, np.float64)
            n, one, two = n + m, one + a, two + q
            corr, own, sums = corr + np.frombuffer(c, np.float64), own + a / m * s, sums + s
    if first is not None:
        mean = one / n
        norm = max(0.0, two - one * mean) ** 0.5
        total = np.zeros_like(sums) if norm * norm <= 1e-12 * n else (corr + own - mean * sums) / (norm + 1e-6)
        value, at = A.best_start(total)
        found = first.column("lo")[0].as_py() + first.column("piece")[0].as_py() + at
        yield pa.RecordBatch.from_arrays([first.column(key), first.column(order), pa.array([value]), pa.array([found], pa.int64())], names=[key, order, "value", "found"])


def align_files(sources: DataFrame, content: Callable[[DataFrame], DataFrame], searches: DataFrame, placed: DataFrame, key: str = "conv_id", order: str = "seg", reach: int = 2 * RATE, rate: int = RATE, stretch: int = STRETCH, part: int = PART, most: int = HELD) -> DataFrame:
    """What ``align`` gives, for clips whose files are made from other columns.

    ``sources`` has ``key, order`` and the columns from which ``content`` adds the file as ``content``;
    it keeps all columns that it is given.  ``searches`` are ``key, order, channel, expected, frames``; the mix
    is that of ``placed``: ``key, order, channel, start_frame, end_frame, seen_end, total_frames``.

    Only numbers and the sources' columns are shuffled.  A group is a ``stretch`` of a mix in which
    searches start: it makes and decodes the files that are heard there or searched for, lays
    out the mix of both channels, and correlates.  Where searches of more than ``most`` frames start in
    a stretch, they are several groups.  Clips of more than ``part`` frames are
    searched for in parts, whose correlations are added up.
    """
    spark = sources.sparkSession
    ship(spark)
    small_batches(spark)
    totals = placed.groupBy(key).agg(F.max("total_frames").alias("total_frames"))
    asked = _asked(searches.select(key, order, "channel", "expected", "frames"), totals, key, reach)
    asked = asked.select(key, order, F.col("channel").cast("int").alias("channel"), "lo", "hi", "frames", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("frames") - 1) / part))).alias("_part"))
    asked = asked.withColumn("at", F.col("_part") * part).withColumn("n", F.least(F.lit(part), F.col("frames") - F.col("at")))
    asked = asked.withColumn("stretch", F.floor((F.col("lo") + F.col("at")) / stretch))
    mass = F.sum(F.col("n") + 1024).over(Window.partitionBy(key, "stretch").orderBy(order, "at").rowsBetween(Window.unboundedPreceding, 0))
    asked, _ = spilled(asked.withColumn("sub", F.floor(mass / most)).drop("_part"), "searches")
    span = stretch + 2 * reach + part
    groups = asked.groupBy(key, "stretch", "sub", "channel").agg(F.min(F.col("lo") + F.col("at")).alias("_lo"), F.max(F.col("hi") + F.col("at") + F.col("n")).alias("_hi"))
    a, z = F.col("start_frame"), F.least("end_frame", "seen_end")
    heard = placed.where(z > a).select(key, order, F.col("channel").cast("int").alias("channel"), a.alias("a"), z.alias("z"))
    near = F.sequence(F.greatest(F.floor((F.col("a") - span) / stretch) + 1, F.lit(0).cast("long")), F.floor((F.col("z") - 1) / stretch))
    heard = heard.withColumn("stretch", F.explode(near)).join(groups, [key, "stretch", "channel"]).where("a < _hi and z > _lo")
    place = [key, "stretch", "sub", order]
    job = lambda search, a, z, at: F.struct(F.lit(search).alias("search"), "channel", F.col(a).alias("a"), F.col(z).alias("z"), at.alias("at")).alias("job")
    jobs = heard.select(*place, job(False, "a", "z", F.lit(0).cast("long"))).unionByName(asked.select(*place, job(True, "lo", "hi", F.col("at").cast("long"))))
    # by key alone, as the sources often are already
    jobs = jobs.repartition(key).groupBy(*place).agg(F.collect_list("job").alias("jobs"))
    dealt = sources.join(jobs, [key, order]).repartition(*place[:3]).sortWithinPartitions(*place)
    files = content(dealt).select(*place, "jobs", "content")
    kinds = {f.name: f.dataType for f in sources.schema.fields}
    out = T.StructType().add(key, kinds[key]).add(order, kinds[order]).add("lo", "long").add("value", "double").add("found", "long").add("piece", "long").add("n", "long").add("one", "double").add("two", "double").add("corr", "binary").add("sums", "binary")
    names = out.names
    got = files.mapInArrow(lambda it: _search(it, names, stretch, span, part, rate), out)
    if not asked.where(F.col("frames") > part).limit(1).count():
        return _best(got, key, order)
    got, _ = spilled(got, "search-parts")
    ids = f"{key} {kinds[key].simpleString()}, {order} {kinds[order].simpleString()}"
    long = got.where("corr is not null").groupBy(key, order, "piece").applyInArrow(_part_adder(key, order), f"{ids}, value double, found long")
    return _best(got.where("corr is null").select(key, order, "value", "found").unionByName(long), key, order)


def _part_adder(key: str, order: str):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _add_parts(batches, key, order)

    return add


def _energy(batches: Iterator[pa.RecordBatch], names: list[str], keys: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sums = [[float((np.frombuffer(x, np.float32).astype(np.float64) ** 2).sum()) for x in b.column(c).to_pylist()] for c in ("left", "right")]
        yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(keys)), *map(pa.array, sums)], names=names)


def tile_energy(tiles: DataFrame) -> DataFrame:
    """Tiles with the summed squares of their channels in place of the samples."""
    kept = [f for f in tiles.schema.fields if f.name not in ("left", "right")]
    schema = T.StructType([*kept]).add("left_energy", "double").add("right_energy", "double")
    return tiles.select(*(f.name for f in kept), "left", "right").mapInArrow(lambda it: _energy(it, schema.names, len(kept)), schema)
