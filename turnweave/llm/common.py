"""Helpers shared by the corpus operators: table access, checkpoints, word hashing, components."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..shipping import ship

WORD_SPACE = r"[\x20\x09-\x0D]"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The columns of ``documents``, which stages read by name.
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def any_columns(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage that lets further columns of any name through, whatever names it uses inside: they
    have neutral names meanwhile."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = docs.columns
        neutral = [n if n in DOCUMENT else f"further{i}__" for i, n in enumerate(names)]
        if neutral == names:
            return stage(spark, docs, sf_dir)
        out = stage(spark, docs.toDF(*neutral), sf_dir)
        return out.toDF(*names) if out.columns == neutral else out

    return run


#: Arrow batches stop at this size; a longer row is a batch of its own.
BATCH_BYTES = 4 << 20


def arrow_limits(spark: SparkSession, rows: int = 2000) -> None:
    """Keeps Arrow batches small, so that long texts don't add up in a Python worker, and
    gives the workers this package."""
    ship(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a folder in the local
    temporary directory is set only where the session names none (tests)."""
    sc = spark.sparkContext
    jdir = sc._jsc.sc().getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if jdir.isEmpty():
        if not named:
            named = "file://" + tempfile.mkdtemp(prefix="turnweave-checkpoint-")
        sc.setCheckpointDir(named)
        return named
    return named or jdir.get()


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), f"{label}-{uuid.uuid4().hex}")


def materialize(df: DataFrame) -> DataFrame:
    """Cuts lineage with a reliable checkpoint, which outlives lost executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spilled(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Writes ``df`` as Parquet to the shared folder and reads it back: columnar, so that
    later passes over a few columns don't read the others.  Also gives the path."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def spill(df: DataFrame, label: str) -> DataFrame:
    return spilled(df, label)[0]


def drop_path(spark: SparkSession, path: str) -> None:
    """Removes an intermediate table that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def whole_texts(rows: DataFrame, group: str, most_bytes: int) -> list[tuple]:
    """``(i, group, t)`` of a sample ``rows(i, group, t)`` of bounded number, sorted: texts are whole, and
    each group's are taken by the hash of ``i`` until they have ``most_bytes`` bytes together (the
    first always).  Repeated rows count once."""
    rows = rows.where("i is not null and t <> ''").withColumn("h", F.xxhash64("t")).dropDuplicates(["i", group, "h"])
    rows, path = spilled(rows.withColumn("n", F.octet_length("t").cast("long")), "sample")
    w = Window.partitionBy(group).orderBy(F.xxhash64("i"), "i", "h")
    sizes = rows.select("i", group, "h", "n").withColumn("b", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    fits = sizes.where(F.col("b") <= F.greatest(F.lit(most_bytes), "n")).select("i", group, "h")
    out = sorted(map(tuple, rows.join(fits, ["i", group, "h"]).select("i", group, "t").collect()))
    drop_path(rows.sparkSession, path)
    return out


# -- word hashing over Arrow buffers ---------------------------------------------------

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_BYTE = np.random.default_rng(20_011).integers(1, 2**63, size=256, dtype=np.uint64) | np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15)
_PIECE = 1 << 18


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inv = pow(int(_P), -1, 1 << 64)
    up = np.full(n, _P, dtype=np.uint64)
    down = np.full(n, np.uint64(inv), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


_UP, _DOWN = _powers(_PIECE + 1)


def mix64(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _piece_words(b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and 64-bit hash of each word of one piece of lower-cased bytes."""
    gap = np.concatenate(([True], _SPACE[b], [True]))
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    s, e = edge[0::2], edge[1::2]
    if len(b) > _PIECE:
        up, down = _powers(len(b) + 1)
    else:
        up, down = _UP, _DOWN
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[b] * up[: len(b)], dtype=np.uint64)))
    h = (sums[e] - sums[s]) * down[s]
    return s, e, mix64(h + (e - s).astype(np.uint64) * _P)


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; nulls have no bytes."""
    col = col.cast(pa.large_string()) if not pa.types.is_large_string(col.type) else col
    if col.null_count:
        col = col.fill_null("")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[col.offset : col.offset + len(col) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all rows in order, and the first word's index of each row
    (one more at the end).  A-Z count as a-z; words are runs of bytes outside
    ``[\\x20\\x09-\\x0D]``, which in UTF-8 never cut a character."""
    hashes, counts = [], np.zeros(len(offsets) - 1, dtype=np.int64)
    row, n = 0, len(offsets) - 1
    while row < n:
        last = int(np.searchsorted(offsets, offsets[row] + _PIECE, side="right")) - 1
        last = min(max(last, row + 1), n)
        a, z = int(offsets[row]), int(offsets[last])
        if last == row + 1 and z - a > _PIECE:  # one long text, cut at white space
            at = a
            while at < z:
                to = min(z, at + _PIECE)
                while to < z and not _SPACE[raw[to]]:
                    step = np.flatnonzero(_SPACE[raw[to : min(z, to + _PIECE)]])
                    to = to + int(step[0]) if len(step) else min(z, to + _PIECE)
                _, _, h = _piece_words(_LOWER[raw[at:to]])
                hashes.append(h)
                counts[row] += len(h)
                at = to
        else:
            # a space between rows, so that no word runs from one into the next
            sizes = np.diff(offsets[row : last + 1])
            b = np.full(z - a + (last - row), 0x20, dtype=np.uint8)
            keep = np.ones(len(b), dtype=bool)
            ends = np.cumsum(sizes + 1) - 1
            keep[ends] = False
            b[keep] = _LOWER[raw[a:z]]
            s, _, h = _piece_words(b)
            hashes.append(h)
            counts[row:last] = np.bincount(np.searchsorted(ends, s, side="right"), minlength=last - row)
        row = last
    firsts = np.concatenate((np.zeros(1, np.int64), np.cumsum(counts)))
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), firsts


def shingle_hashes(words: np.ndarray, firsts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each row (its whole word sequence where it has
    fewer words, none where it has none) and each row's first index."""
    n = np.diff(firsts)
    counts = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    starts = np.concatenate((np.zeros(1, np.int64), np.cumsum(counts)))
    out = np.zeros(int(starts[-1]), dtype=np.uint64)
    if not len(out):
        return out, starts
    if len(words) >= k:
        span = len(words) - k + 1
        roll = np.zeros(span, dtype=np.uint64)
        for j in range(k):
            roll = mix64(roll + words[j : j + span] + np.uint64(j + 1))
        full = np.flatnonzero(n >= k)
        if len(full):
            c = counts[full]
            within = np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c)
            out[np.repeat(starts[full], c) + within] = roll[np.repeat(firsts[full], c) + within]
    for i in np.flatnonzero((n > 0) & (n < k)):
        h = np.array([n[i]], dtype=np.uint64)
        for w in words[firsts[i] : firsts[i + 1]]:
            h = mix64(h + w)
        out[starts[i]] = h[0] ^ np.uint64(0x5BD1E995)
    return out, starts


# -- connected components --------------------------------------------------------------


#: Labels are sent to every executor up to this many (16 bytes each); above, they are joined by a shuffle.
BROADCAST_LABELS = 300_000


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components of an edge list: ``(v, component)`` for every vertex with an
    edge, the component being its smallest vertex.

    Labels start at the smallest neighbour.  In each round a vertex takes the smallest label
    among its neighbours, hands it to its old label too, and jumps to its label's own label, so that
    the rounds grow with the logarithm of the longest path.  Every round is a table in the shared
    folder, read back with its true size (the sizes Spark estimates for nested joins multiply);
    nothing but whether labels changed reaches the driver.  Edges with a null end and loops
    are ignored.
    """
    spark = edges.sparkSession
    e = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x is not null and y is not null and x <> y")
    both, both_path = spilled(e.union(e.select(F.col("y"), F.col("x"))).distinct(), "edges")
    labels = both.groupBy(F.col("x").alias("v")).agg(F.min("y").alias("m")).select("v", F.least("v", "m").alias("component"))
    labels, path = spilled(labels, "labels")
    sized = F.broadcast if labels.count() <= BROADCAST_LABELS else (lambda df: df)
    for _ in range(max_rounds):
        seen = both.join(sized(labels.select(F.col("v").alias("y"), F.col("component").alias("c"))), "y").select("x", "c")
        own = labels.select(F.col("v").alias("x"), F.col("component").alias("c"), F.col("component").alias("old"))
        step = own.unionByName(seen, allowMissingColumns=True).groupBy(F.col("x").alias("v")).agg(F.min("old").alias("old"), F.min("c").alias("new"))
        hand = step.select(F.explode(F.array(F.struct("v", "old", "new"), F.struct(F.col("old").alias("v"), F.lit(None).cast("long").alias("old"), "new"))).alias("s"))
        step = hand.groupBy("s.v").agg(F.min("s.old").alias("old"), F.min("s.new").alias("new"))
        jump = labels.select(F.col("v").alias("new"), F.col("component").alias("far"))
        nxt = step.join(sized(jump), "new", "left").select("v", "old", F.least("new", F.coalesce("far", "new")).alias("component"))
        nxt, new_path = spilled(nxt, "labels")
        drop_path(spark, path)
        labels, path = nxt.select("v", "component"), new_path
        if not nxt.where("old <> component").limit(1).count():
            drop_path(spark, both_path)
            return labels
    raise RuntimeError("components did not settle")
