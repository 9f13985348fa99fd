"""Joins and lookups with fallbacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import keyed_draw
from .numbering import SMALL, numbered


def small(df: DataFrame) -> DataFrame:
    """Broadcast if its size, counted up to the bound, is proven small."""
    return F.broadcast(df) if df.limit(SMALL + 1).count() <= SMALL else df


def with_default(rows: DataFrame, dim: DataFrame, key: str, columns: dict[str, object]) -> DataFrame:
    """Left join; a column that stays null gets its default."""
    out = rows.join(dim, key, "left")
    for c, v in columns.items():
        out = out.withColumn(c, F.coalesce(c, F.lit(v)) if v is not None else F.col(c))
    return out


def first_by_priority(rows: DataFrame, candidates: DataFrame, key: list[str], rank: list[str]) -> DataFrame:
    """Each row with its best candidate: the one of least ``rank``, nulls where it has none."""
    values = [c for c in candidates.columns if c not in key]
    best = candidates.groupBy(*key).agg(F.min(F.struct(*rank, *(c for c in values if c not in rank))).alias("_best"))
    return rows.join(best, key, "left").select(*rows.columns, *(F.col(f"_best.{c}").alias(c) for c in values))


def tiered_choice(rows: DataFrame, pool: DataFrame, tiers: list[list[str]], value: str, draw: Column) -> DataFrame:
    """Each row with one value of the first tier that has any: tiers are lists of columns to
    match, from the most special to the most general (an empty list matches all).

    The values of a tier are numbered in order; a row meets the first number and the count of its
    key, draws a number, and meets the value with it.  ``chosen`` and ``tier`` are null where no tier has any.
    """
    out, values, number = rows, None, []
    for i, keys in enumerate(tiers):
        placed, sizes = numbered(pool, keys, value)
        sizes = sizes.withColumnsRenamed({"_first": f"_first{i}", "_size": f"_size{i}"})
        # without keys there is one row of two numbers
        out = out.join(small(sizes), keys, "left") if keys else out.crossJoin(F.broadcast(sizes))
        number.append(F.when(F.col(f"_size{i}") > 0, F.struct(F.lit(i).alias("tier"), (F.col(f"_first{i}") + F.pmod(draw, F.col(f"_size{i}"))).alias("n"))))
        own = placed.select(F.lit(i).alias("_tier"), F.col("_n"), F.col(value).alias("chosen"))
        values = own if values is None else values.unionByName(own)
    drawn = out.withColumn("_d", F.coalesce(*number)).select(*rows.columns, F.col("_d.tier").alias("_tier"), F.col("_d.n").alias("_n"))
    return drawn.join(values, ["_tier", "_n"], "left").select(*rows.columns, "chosen", F.col("_tier").alias("tier"))


def two_distinct(rows: DataFrame, key: str, pool: DataFrame, value: str) -> DataFrame:
    """Two different values of a pool for each row, by keyed hash: the first is drawn from all, the
    second from the others.  A pool of fewer than two values gives no rows."""
    names, sizes = numbered(pool, [], value)
    n = F.col("_size")
    i = F.pmod(keyed_draw(F.lit("first"), F.col(key)), n)
    j = F.pmod(i + 1 + F.pmod(keyed_draw(F.lit("second"), F.col(key)), n - 1), n)
    drawn = rows.crossJoin(F.broadcast(sizes.where("_size >= 2"))).select(*rows.columns, (i + 1).alias("_i"), (j + 1).alias("_j"))  # one row
    user = names.select(F.col("_n").alias("_i"), F.col(value).alias("user_speaker"))
    agent = names.select(F.col("_n").alias("_j"), F.col(value).alias("agent_speaker"))
    return drawn.join(user, "_i").join(agent, "_j").select(*rows.columns, "user_speaker", "agent_speaker")


def pending(inputs: DataFrame, outputs: DataFrame, key: str) -> DataFrame:
    """Inputs without an output yet."""
    return inputs.join(outputs.select(key).distinct(), key, "left_anti")


def listed(rows: DataFrame, whitelist: DataFrame | None, key: str) -> DataFrame:
    """Rows on a whitelist; without one, all."""
    return rows if whitelist is None else rows.join(whitelist.select(key).distinct(), key, "left_semi")


def request_status(requested: DataFrame, available: DataFrame, key: str) -> DataFrame:
    """Each requested key with whether it is available."""
    have = available.select(key).distinct().withColumn("_there", F.lit(True))
    return requested.select(key).distinct().join(have, key, "left").select(key, F.coalesce("_there", F.lit(False)).alias("available"))


def grid(*dims: DataFrame) -> DataFrame:
    """All combinations of small dimension tables."""
    out = dims[0]
    for d in dims[1:]:
        out = out.crossJoin(F.broadcast(d))
    return out


def filter_or_all(rows: DataFrame, matches: Column, group: list[str] | None = None) -> DataFrame:
    """The rows that match; all rows (of the group) where none does."""
    m = rows.withColumn("_m", F.coalesce(matches, F.lit(False)))
    if group:
        # one flag for each group instead of a window over its rows; null groups are a group
        flags = m.groupBy(*(F.col(g).alias(f"_g{i}") for i, g in enumerate(group))).agg(F.max("_m").alias("_any"))
        same = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)]
        return m.join(small(flags), same).where("_m or not _any").select(*rows.columns)
    found = m.agg(F.coalesce(F.max("_m"), F.lit(False)).alias("_any"))
    return m.crossJoin(F.broadcast(found)).where("_m or not _any").drop("_m", "_any")  # one row


def resolve_speaker(rows: DataFrame, files: DataFrame, pool: DataFrame, request: str, draw: Column, kinds: str = "wav|mp3|flac|m4a") -> DataFrame:
    """``recording`` or ``error`` for each request: a drawn one of the pool where it is null or empty, the
    file that it names, or a drawn recording of the folder that it names.  ``files`` (all files there are)
    and ``pool`` have ``path``."""
    every = files.select("path").distinct()
    parts = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    folders = every.where(F.size(parts) > 1).select(F.explode(above).alias("_request")).distinct().withColumn("_folder", F.lit(True))
    recordings = every.where(F.col("path").rlike(rf"\.({kinds})$") & (F.size(parts) > 1)).select(F.regexp_replace("path", r"/[^/]*$", "").alias("_request"), "path")
    owned, own = numbered(recordings, ["_request"], "path")
    pooled, whole = numbered(pool, [], "path")
    known = every.select(F.col("path").alias("_request"), F.lit(True).alias("_file"))
    j = rows.withColumn("_request", F.nullif(request, F.lit(""))).join(known, "_request", "left").join(folders, "_request", "left").join(own, "_request", "left")
    j = j.crossJoin(F.broadcast(whole.withColumnsRenamed({"_first": "_pool_first", "_size": "_pool_size"})))  # one row
    asked, file, folder = F.col("_request").isNotNull(), F.coalesce("_file", F.lit(False)), F.coalesce("_folder", F.lit(False))
    place = lambda first, size: F.col(first) + F.pmod(draw, F.nullif(F.col(size), F.lit(0)))
    j = j.withColumn("_own_n", F.when(asked & ~file, place("_first", "_size"))).withColumn("_pool_n", F.when(~asked, place("_pool_first", "_pool_size")))
    j = j.join(owned.select(F.col("_n").alias("_own_n"), F.col("path").alias("_own")), "_own_n", "left").join(pooled.select(F.col("_n").alias("_pool_n"), F.col("path").alias("_pooled")), "_pool_n", "left")
    error = (
        F.when(~asked & F.col("_pooled").isNull(), "the pool is empty")
        .when(asked & ~file & ~folder, F.concat(F.lit("no such path: "), "_request"))
        .when(asked & ~file & F.col("_own").isNull(), F.concat(F.lit("no recordings in folder: "), "_request"))
    )
    return j.select(*rows.columns, F.when(file, F.col("_request")).otherwise(F.coalesce("_own", "_pooled")).alias("recording"), error.alias("error"))


def with_registry(clips: DataFrame, registry: DataFrame, transcripts: DataFrame, speaker: str, path: str) -> DataFrame:
    """Clips with their speaker's display name and their transcription; defaults where a
    registry has no entry."""
    out = clips.join(small(registry.select(speaker, "display_name")), speaker, "left").join(transcripts.select(path, "transcription"), path, "left")
    return out.withColumn("display_name", F.coalesce("display_name", F.col(speaker).cast("string"))).withColumn("transcription", F.coalesce("transcription", F.lit("")))


def zip_segments(segments: DataFrame, metadata: DataFrame, key: str, order: str, skipped: Column) -> DataFrame:
    """Segments with the metadata entry of their place among those not skipped; skipped ones
    keep an empty slot.  ``metadata`` has ``key`` and ``place`` (from 0)."""
    w = Window.partitionBy(key).orderBy(order)
    place = F.when(~skipped, F.sum(F.when(skipped, 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    return segments.withColumn("place", place).join(metadata, [key, "place"], "left")


def zipped(texts: DataFrame, tags: DataFrame, key: list[str], order: str, value: str) -> DataFrame:
    """``texts`` with the tag at the same place of their key: both are counted in ``order``, ties by the
    value.  A text beyond the last tag has null; tags beyond the last text are left out."""

    def placed(df: DataFrame) -> DataFrame:
        return df.withColumn("_place", F.row_number().over(Window.partitionBy(*key).orderBy(order, value)))

    other = placed(tags.select(*key, order, value)).select(*key, "_place", F.col(value).alias("tag"))
    return placed(texts).join(other, [*key, "_place"], "left").drop("_place")
