"""Vector code compression: product codes by integer k-means with Exponion search.

Vectors become integers, floor(scale * x), and are cut into ``parts`` equal consecutive
parts.  Each part position has a codebook, which starts as that part of the ``entries``
smallest ids.  Every round assigns each part to the nearest entry and moves each entry to
the floored mean of its parts; after the last round parts are assigned once more.

The nearest entry is found by Exponion search.  It starts at the part's entry of the round
before, a, at squared distance d.  An entry as near as a or nearer lies within twice the
distance of a from it, so only a's neighbours j with |a - j|^2 <= 4 d are scanned; they are a
prefix of a's list of entries sorted by distance, which each codebook has for each entry.
All distances are whole numbers below 2^53, which doubles hold exactly, and equal ones go
to the lower index.

A round is one pass of tasks over a table in the shared folder with the integers and the
entries of the round before.  Each task writes the same rows with their new entries, and
one row more with the sums and counts of its parts by entry, so that sums never need a
pass of their own.  The sums are folded in larger tasks, added by a shuffle, and only the
codebooks, entries * dimension numbers whatever the table's size, reach the driver.

Nulls and edges: vectors that are null, empty or hold null or non-finite components are
dropped, as are those of another than the most common dimension (ties: the smaller).  A
dimension that ``parts`` doesn't divide is filled up with zeros.  Where an id repeats, its
smallest vector counts as its starting entry; all its rows are coded.  A null id is never
a starting entry; where all ids are null, codes and errors are null.  With fewer ids than
entries the codebooks are smaller.  Components beyond
+-``bound(...)`` (about 11,000 before scaling at 16 components a part) count as that bound.  An
empty table gives no rows.  A sum of errors beyond 2^63 is null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_LABELS, arrow_limits, drop_path, read, scratch, spilled

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Rows that a task searches together.
BLOCK = 16_384


def bound(width: int) -> int:
    """The largest component for which distances between parts of ``width`` stay below 2^53."""
    return min(isqrt(2**53 // width) // 2, 2**30)


class Entries:
    """One codebook with each entry's neighbours in order of distance."""

    def __init__(self, book: np.ndarray) -> None:
        self.words = book.astype(np.float64)
        self.norms = (self.words**2).sum(1)
        gap = self._distances(self.words, self.norms, np.arange(len(book)))
        self.order = np.argsort(gap, axis=1, kind="stable")
        self.gap = np.take_along_axis(gap, self.order, 1)

    def _distances(self, x: np.ndarray, norms: np.ndarray, columns: np.ndarray) -> np.ndarray:
        return norms[:, None] - 2 * (x @ self.words[columns].T) + self.norms[columns]

    def nearest(self, x: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each row's nearest entry, the search starting at
        ``start``."""
        x = x.astype(np.float64)
        norms = (x**2).sum(1)
        first = ((x - self.words[start]) ** 2).sum(1)
        index, distance = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        by = np.argsort(start, kind="stable")
        edges = np.searchsorted(start[by], np.arange(len(self.words) + 1))
        for a in np.flatnonzero(np.diff(edges)):
            rows = by[edges[a] : edges[a + 1]]
            # how many neighbours lie inside each row's radius; rows of like reach are scanned together
            reach = np.searchsorted(self.gap[a], 4 * first[rows], side="right")
            ring = np.ceil(np.log2(reach)).astype(np.int64)
            for r in np.unique(ring):
                own = rows[ring == r]
                near = self.order[a, : 1 << r]
                d = self._distances(x[own], norms[own], near).astype(np.int64)
                best = d.min(1)
                distance[own] = best
                index[own] = np.where(d == best[:, None], near, len(self.words)).min(1)
        return index, distance


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches joined to about ``BLOCK`` rows."""
    held: list[pa.RecordBatch] = []
    n = 0
    for b in batches:
        if len(b):
            held.append(b)
            n += len(b)
        if n >= BLOCK:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _ints(col: pa.Array, parts: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), parts, -1)


def _seeds(batches: Iterator[pa.RecordBatch], entries: int) -> Iterator[pa.RecordBatch]:
    """The smallest ids of this partition, each with its smallest vector."""
    best: dict[int, list[int]] = {}
    top = None
    for b in batches:
        ids = b.column(0).to_numpy(zero_copy_only=False)
        few = np.arange(len(ids)) if top is None else np.flatnonzero(ids <= top)
        for i in few[np.argsort(ids[few], kind="stable")].tolist():
            key, x = int(ids[i]), b.column(1)[i].as_py()
            if key in best:
                best[key] = min(best[key], x)
            elif len(best) < entries or key < top:
                best[key] = x
                if len(best) > entries:
                    del best[max(best)]
            top = max(best) if len(best) == entries else None
    keys = sorted(best)
    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([best[k] for k in keys], pa.list_(pa.int32()))], names=["vec_id", "x"])


def _binary(rows: np.ndarray) -> pa.Array:
    """One binary value for each row of bytes."""
    rows = np.ascontiguousarray(rows)
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(rows.shape[1]), len(rows), [None, pa.py_buffer(rows)]).cast(pa.binary())


def _assign(blocks: Iterator[pa.RecordBatch], books: list[Entries]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Each block with its integers, its entries and its distances (rows, parts)."""
    parts = len(books)
    for b in blocks:
        x = _ints(b.column("x"), parts)
        old = b.column("codes")
        start = np.zeros((len(b), parts), np.uint8) if old.null_count else np.frombuffer(b"".join(old.to_pylist()), np.uint8).reshape(len(b), parts)
        found = [books[m].nearest(x[:, m], start[:, m].astype(np.int64)) for m in range(parts)]
        yield b, x, np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)


def _round(batches: Iterator[pa.RecordBatch], books: list[Entries]) -> Iterator[pa.RecordBatch]:
    """The rows with their new entries; last a row with the task's sums and counts."""
    parts, (entries, width) = len(books), books[0].words.shape
    total = np.zeros((parts, entries, width + 1), np.int64)
    last = None
    for b, x, codes, _ in _assign(_blocks(batches), books):
        last = b
        for m in range(parts):
            by = np.argsort(codes[:, m], kind="stable")
            at = np.flatnonzero(np.diff(codes[by, m], prepend=-1))
            used = codes[by[at], m]
            total[m, used, :width] += np.add.reduceat(x[by, m].astype(np.int64), at, axis=0)
            total[m, used, width] += np.bincount(codes[:, m], minlength=entries)[used]
        yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), b.column("x"), _binary(codes.astype(np.uint8)), pa.nulls(len(b), pa.binary())], names=["vec_id", "label", "x", "codes", "sums"])
    if last is not None:
        kinds = [last.column(i).type for i in range(3)]
        yield pa.RecordBatch.from_arrays([*(pa.nulls(1, k) for k in kinds), pa.nulls(1, pa.binary()), pa.array([total.tobytes()], pa.binary())], names=["vec_id", "label", "x", "codes", "sums"])


def _fold(batches: Iterator[pa.RecordBatch], parts: int, entries: int) -> Iterator[pa.RecordBatch]:
    """The sums of many tasks as one row for each part and entry."""
    total = None
    for b in batches:
        for s in b.column(0).to_pylist():
            x = np.frombuffer(s, np.int64)
            total = x.copy() if total is None else total + x
    if total is not None:
        rows = total.reshape(parts * entries, -1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(rows), dtype=np.int32)), pa.array(rows.tolist(), pa.list_(pa.int64()))], names=["slot", "s"])


def _moved(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """Each entry at the floored mean of its parts; those without parts stay."""
    parts, entries, width = books.shape
    folded = state.where("sums is not null").select("sums").mapInArrow(lambda it: _fold(it, parts, entries), "slot int, s array<bigint>")
    sums = folded.select("slot", F.posexplode("s").alias("i", "v")).groupBy("slot", "i").agg(F.sum("v").alias("v"))
    table = np.zeros((parts * entries, width + 1), np.int64)
    for r in sums.collect():  # parts * entries * (width + 1) rows
        table[r["slot"], r["i"]] = r["v"]
    total = table.reshape(parts, entries, width + 1)
    n = total[..., width:]
    return np.where(n > 0, total[..., :width] // np.maximum(n, 1), books)


def _coded(batches: Iterator[pa.RecordBatch], books: list[Entries]) -> Iterator[pa.RecordBatch]:
    for b, _, codes, errors in _assign(_blocks(batches), books):
        text = np.frombuffer(codes.astype(np.uint8).tobytes().hex().encode(), f"S{2 * len(books)}").astype(str)
        yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), pa.array(text.tolist(), pa.string()), pa.array(errors.sum(1))], names=["vec_id", "label", "code", "error"])


def digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' components in decimal, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, code, error`` of every vector that takes part, and the final codebooks
    (part, entry, component)."""
    spark = vectors.sparkSession
    arrow_limits(spark)
    if not 0 < entries <= 256:
        raise ValueError("codes are bytes: 1 to 256 entries")
    v = F.col(vector_col).cast("array<double>")
    label = vectors.schema[label_col].dataType
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), v.alias("v"))
    rows = rows.where("v is not null").where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))).where(F.size("v") > 0)
    size = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    ends = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", label), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if not size:
        return spark.createDataFrame([], ends), np.zeros((parts, 0, 0), np.int64)
    width = -(-size[0]["d"] // parts)
    most = float(bound(width))
    whole = F.transform("v", lambda x: F.floor(F.least(F.greatest(x * float(scale), F.lit(-most)), F.lit(most))).cast("int"))
    fill = F.array_repeat(F.lit(0), width * parts - size[0]["d"])
    rows = rows.where(F.size("v") == size[0]["d"]).select("vec_id", "label", F.concat(whole, fill).alias("x"))

    seeds = rows.where("vec_id is not null").select("vec_id", "x").mapInArrow(lambda it: _seeds(it, entries), "vec_id long, x array<int>")
    first = seeds.groupBy("vec_id").agg(F.min("x").alias("x")).orderBy("vec_id").limit(entries).collect()  # ``entries`` vectors
    if not first:
        return rows.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")), np.zeros((parts, 0, width), np.int64)
    books = np.array([r["x"] for r in first], np.int64).reshape(len(first), parts, width).transpose(1, 0, 2)

    state, path = rows.withColumns({"codes": F.lit(None).cast("binary"), "sums": F.lit(None).cast("binary")}), None
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast([Entries(b) for b in books])  # entries * (dimension + 2 * entries) numbers
        new, at = spilled(state.where("x is not null").mapInArrow(lambda it, s=sent: _round(it, s.value), state.schema), "vector-round")
        if path:
            drop_path(spark, path)
        state, path = new, at
        books = _moved(state, books)
    sent = spark.sparkContext.broadcast([Entries(b) for b in books])
    coded, _ = spilled(state.where("x is not null").mapInArrow(lambda it: _coded(it, sent.value), ends), "vector-codes")
    if path:
        drop_path(spark, path)
    return coded, books


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector's code, its error, its label's error and the digest of the codebooks."""
    coded, books = compress(read(spark, sf_dir, "embeddings"))
    # rows of a label are added before the shuffle; a hot label's rows stay where they are if labels are few
    sums = coded.groupBy("label").agg(F.try_sum("error").alias("label_error")).withColumnRenamed("label", "l")
    sums = F.broadcast(sums) if sums.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS else sums
    out = coded.join(sums, F.col("label").eqNullSafe(F.col("l")), "left")
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _sql() -> str:
    """The same by all distances, for DuckDB."""
    steps = [
        "k AS MATERIALIZED (SELECT row_number() OVER () AS i, vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings "
        "WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        "p AS MATERIALIZED (SELECT i, m, list_slice(v, m * len(v) // 4 + 1, (m + 1) * len(v) // 4) AS x FROM k, range(4) r(m))",
        "b0 AS MATERIALIZED (SELECT m, row_number() OVER (PARTITION BY m ORDER BY vec_id) - 1 AS e, x FROM p JOIN (SELECT i, vec_id FROM k WHERE vec_id IS NOT NULL ORDER BY vec_id LIMIT 256) USING (i))",
    ]
    for r in range(5):
        d = "CAST(list_dot_product(p.x, p.x) - 2 * list_dot_product(p.x, b.x) + list_dot_product(b.x, b.x) AS BIGINT)"
        steps.append(f"a{r} AS MATERIALIZED (SELECT i, m, min({d} * 256 + e) % 256 AS e, min({d} * 256 + e) // 256 AS d FROM p JOIN b{r} b USING (m) GROUP BY i, m)")
        if r < 4:
            steps.append(
                f"b{r + 1} AS MATERIALIZED (SELECT b.m, b.e, coalesce(n.x, b.x) AS x FROM b{r} b LEFT JOIN (SELECT m, e, list(x ORDER BY j) AS x FROM "
                f"(SELECT m, e, j, floor(sum(y) / count(*)) AS x FROM (SELECT m, e, unnest(x) AS y, generate_subscripts(x, 1) AS j FROM a{r} JOIN p USING (i, m)) GROUP BY m, e, j) GROUP BY m, e) n USING (m, e))"
            )
    steps.append("c AS MATERIALIZED (SELECT i, string_agg(printf('%02x', e), '' ORDER BY m) AS code, CAST(sum(d) AS BIGINT) AS error FROM a4 GROUP BY i)")
    steps.append("s AS (SELECT sha256(string_agg(CAST(CAST(y AS BIGINT) AS VARCHAR), ',' ORDER BY m, e, j)) AS codebooks_sha256 FROM (SELECT m, e, unnest(x) AS y, generate_subscripts(x, 1) AS j FROM b4))")
    return "WITH " + ",\n".join(steps) + "\nSELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM k JOIN c USING (i) CROSS JOIN s"


OP11_SQL = _sql()
