"""Variable-capacity best-fit packing of documents into training sequences.

Each document is a piece of its length (in words, or any length column); one longer than
the largest permitted sequence is cut into pieces of that length and a rest.  Pieces are
packed longest first.  A piece goes into the open sequence that it leaves with the least
room; where none fits, the sequence length whose cost for each word used promises least is
opened: lengths are rated together, by a dry run of best-fit on the shard's own lengths,
so a short length is opened only if the remaining pieces fill it well.  Last, every
sequence shrinks to the shortest permitted length that holds its contents.

Shards of about ``shard_rows`` pieces are packed apart, so the work grows in proportion
and no task holds more than its shard.  A row's shard is a hash of its id, text and place in the input,
so that repeated rows spread too.  Only ids and lengths are shuffled.

Nulls and edges: a null text has length 0.  Documents of length 0 take part with one empty
piece each, in a sequence with others or of their own.  Null ids and repeated rows are
packed as rows of their own.  Extra columns are untouched; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import any_columns, arrow_limits, read, spill

WORDS = r"[^\x20\x09-\x0D]+"
CAPACITIES = (256, 512, 1024, 2048, 4096)
#: A sequence of length c costs c + c * c / ATTENTION + OVERHEAD: its places, attention's share and a fixed part.
OVERHEAD, ATTENTION = 16, 32_768
SHARD_ROWS = 4_000


def _fill(lengths: np.ndarray, size_for) -> tuple[np.ndarray, list[int], list[int]]:
    """Best-fit of lengths in falling order; ``size_for(length, left)`` names the capacity
    to open.  Returns each piece's bin, and each bin's capacity and contents."""
    where = np.zeros(len(lengths), dtype=np.int64)
    caps: list[int] = []
    used: list[int] = []
    room: list[tuple[int, int]] = []  # (room left, bin), sorted
    for i, n in enumerate(lengths.tolist()):
        j = bisect_left(room, (n, -1))
        if j < len(room):
            left, b = room.pop(j)
        else:
            b, cap = len(caps), size_for(n)
            caps.append(cap)
            used.append(0)
            left = cap
        where[i] = b
        used[b] += n
        if left > n:
            insort(room, (left - n, b))
        elif n == 0:
            insort(room, (left, b))
    return where, caps, used


def _costs(used, capacities: tuple[int, ...]) -> np.ndarray:
    """Of bins with these contents, shrunk to the shortest length that holds them."""
    fit = np.asarray(capacities, dtype=np.float64)[np.searchsorted(capacities, np.maximum(used, 1))]
    return fit + fit * fit / ATTENTION + OVERHEAD


def pack(lengths: np.ndarray, capacities: tuple[int, ...] = CAPACITIES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packs lengths (none above the largest capacity): each one's bin, and each bin's
    final capacity and contents.

    For every piece, the capacity opened is the one of least expected cost a word: its cost
    over the words it came to hold in a dry run in which every bin that may take the piece
    had that capacity.
    """
    caps = tuple(sorted(capacities))
    order = np.argsort(-lengths, kind="stable")
    falling = lengths[order]
    # dry runs: for each capacity, how full its bins get, by the size class of their first piece
    rate = np.full((len(caps), len(caps)), np.inf)
    for k, cap in enumerate(caps):
        sub = falling[falling <= cap]
        if not len(sub):
            continue
        where, _, used = _fill(sub, lambda n, cap=cap: cap)
        first = np.zeros(len(used), dtype=np.int64)
        seen = np.unique(where, return_index=True)[1]
        first = np.searchsorted(caps, np.maximum(sub[seen], 1))
        for c in range(k + 1):
            held = np.asarray(used)[first == c]
            if len(held) and held.sum():
                rate[c, k] = _costs(held, caps).sum() / held.sum()
    best = [caps[int(np.argmin(rate[c]))] if np.isfinite(rate[c]).any() else caps[-1] for c in range(len(caps))]
    plans = [lambda n: best[int(np.searchsorted(caps, max(n, 1)))], lambda n: caps[-1], lambda n: caps[int(np.searchsorted(caps, max(n, 1)))]]
    where, _, used = min((_fill(falling, f) for f in plans), key=lambda r: _costs(r[2], caps).sum() if r[2] else 0.0)
    bins = np.zeros(len(lengths), dtype=np.int64)
    bins[order] = where
    held = np.asarray(used, dtype=np.int64)
    return bins, np.asarray(caps, dtype=np.int64)[np.searchsorted(caps, np.maximum(held, 1))] if len(held) else held, held


def _pack_shard(key: tuple, rows: pd.DataFrame, capacities: tuple[int, ...]) -> pd.DataFrame:
    rows = rows.sort_values(["length", "order"], ascending=[False, True], kind="stable", ignore_index=True)
    bins, final, held = pack(rows["length"].to_numpy(), capacities)
    start = rows.groupby(bins)["length"].cumsum() - rows["length"]
    return pd.DataFrame({"id": rows["id"].astype("Int64"), "piece": rows["piece"], "at": rows["at"], "length": rows["length"], "shard": key[0], "bin": bins, "capacity": final[bins], "bin_used": held[bins], "start": start})


def best_fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", capacities: tuple[int, ...] = CAPACITIES, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per piece: ``id, piece, at`` (its first word in the document), ``length,
    shard, bin, capacity, bin_used, start`` (its place in the sequence).  (shard, bin) names
    a sequence."""
    arrow_limits(docs.sparkSession)
    top = max(capacities)
    text = F.coalesce(F.col(text_col), F.lit(""))
    sized = docs.select(F.col(id_col).cast("long").alias("id"), F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words"), F.xxhash64(F.col(id_col), text, F.monotonically_increasing_id()).alias("order"))
    pieces = F.greatest(F.ceil(F.col("words") / top), F.lit(1)).cast("int")
    cut = sized.select("id", "words", "order", F.explode(F.sequence(F.lit(0), pieces - 1)).alias("piece"))
    cut = cut.select("id", "piece", (F.col("piece") * F.lit(top)).cast("long").alias("at"), F.least(F.lit(top), F.col("words") - F.col("piece") * top).cast("long").alias("length"), "order")
    cut = spill(cut, "pack-pieces")
    shards = max(1, -(-cut.count() // shard_rows))
    sharded = cut.withColumn("shard", F.pmod(F.xxhash64("order", "piece"), F.lit(shards)).cast("long"))
    schema = "id long, piece int, at long, length long, shard long, bin long, capacity long, bin_used long, start long"
    return sharded.groupBy("shard").applyInPandas(lambda key, rows: _pack_shard(key, rows, capacities), schema)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = best_fit(read(spark, sf_dir, "documents"))
    return packed.select(F.col("id").alias("doc_id"), "piece", F.col("at").alias("first_word"), F.col("length").alias("n_words"), "shard", "bin", "capacity", "bin_used", "start")


@any_columns
def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences.  Texts without words, null or empty, have one empty piece;
    repeated rows and rows without an id are packed like others.  An empty table gives none."""
    packed = best_fit(docs)
    return packed.select(F.col("id").alias("doc_id"), "piece", F.col("at").alias("first_word"), F.col("length").alias("n_words"), "shard", "bin", "capacity", "bin_used", "start")
