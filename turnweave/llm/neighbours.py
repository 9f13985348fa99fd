"""Approximate nearest neighbours by additive quantisation.

A vector is encoded as a sum of ``BOOKS`` codewords, one from each of as many codebooks of
full dimension.  Codebooks are trained in turn on what the earlier ones leave, on a sample
of at most ``max_sample`` vectors, and encoding keeps the ``BEAM`` best partial sums at each
step.  The index holds every vector's codes and the squared norm of its reconstruction,
which turns inner products into distances where those are asked for.

A search looks up, for each query, the inner products of all codewords once; a vector's
score is then ``BOOKS`` additions.  In each partition the ``rerank`` best of every query are
scored exactly, in double precision, on the original vectors, and the ``k`` best go on to the
merge.  Queries run in blocks of ``QUERY_BLOCK``, so what is broadcast has a fixed bound:
a block's vectors and the codebooks.

Nulls and edges: null vectors, zero vectors, those with null or non-finite components and
those of another than the most common dimension take no part.  Ties go to the smaller id,
also in the shortlist.  A query never finds rows of its own id; queries that repeat an id
count once if their vectors are equal.  Fewer candidates than k: all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_limits, read, spill

BOOKS, WORDS, BEAM = 8, 256, 8
QUERY_BLOCK = 4096
RERANK = 200


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, v`` (array<double>) of the vectors that take part."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(F.coalesce(fine, F.lit(False)))


def _matrix(col: pa.Array) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1) if len(col) else np.zeros((0, 0))


def _nearest(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return ((words * words).sum(1)[None, :] - 2 * x @ words.T).argmin(1)


def encode(x: np.ndarray, books: np.ndarray, beam: int = BEAM) -> np.ndarray:
    """Codes by beam search; ``books`` is (books, words, dimension)."""
    n = len(x)
    codes = np.zeros((n, len(books)), dtype=np.uint8)
    for lo in range(0, n, 1024):
        part = x[lo : lo + 1024]
        rest = part[:, None, :]  # what each beam leaves
        own = np.zeros((len(part), 1, 0), dtype=np.uint8)
        for words in books:
            b, w = rest.shape[1], len(words)
            error = (rest * rest).sum(2)[:, :, None] - 2 * (rest.reshape(-1, rest.shape[2]) @ words.T).reshape(len(part), b, w) + (words * words).sum(1)
            flat = error.reshape(len(part), b * w)
            k = min(beam, b * w)
            best = np.argpartition(flat, k - 1, axis=1)[:, :k]
            best = np.take_along_axis(best, np.argsort(np.take_along_axis(flat, best, 1), axis=1, kind="stable"), 1)
            parent, word = best // w, best % w
            rest = np.take_along_axis(rest, parent[:, :, None], 1) - words[word]
            own = np.concatenate((np.take_along_axis(own, parent[:, :, None], 1), word[:, :, None].astype(np.uint8)), axis=2)
        codes[lo : lo + 1024] = own[:, 0]
    return codes


def train(sample: np.ndarray, books: int = BOOKS, words: int = WORDS, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """Codebooks by k-means on residuals, then refitted together by least squares."""
    rng = np.random.default_rng(seed)
    x = sample.astype(np.float32)
    rest = x.copy()
    out = np.zeros((books, words, x.shape[1]), dtype=np.float32)
    for m in range(books):
        w = rest[rng.choice(len(rest), words, replace=len(rest) < words)].copy()
        for _ in range(rounds):
            c = _nearest(rest, w)
            n = np.bincount(c, minlength=words)
            sums = np.zeros_like(w)
            np.add.at(sums, c, rest)
            w = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], rest[rng.choice(len(rest), words)])
        out[m] = w
        rest = rest - w[_nearest(rest, w)]
    for _ in range(2):  # each book in turn to the mean of what the others leave
        codes = encode(x, out)
        whole = sum(out[m][codes[:, m]] for m in range(books))
        for m in range(books):
            left = x - whole + out[m][codes[:, m]]
            n = np.bincount(codes[:, m], minlength=words)
            sums = np.zeros_like(out[m])
            np.add.at(sums, codes[:, m], left)
            new = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], out[m])
            whole += new[codes[:, m]] - out[m][codes[:, m]]
            out[m] = new
    return out


def _index(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = _matrix(batch.column(1))
        codes = encode(x.astype(np.float32), books) if len(x) else np.zeros((0, len(books)), np.uint8)
        near = sum(books[m][codes[:, m]] for m in range(len(books))) if len(x) else np.zeros((0, 1))
        data = pa.FixedSizeBinaryArray.from_buffers(pa.binary(len(books)), len(codes), [None, pa.py_buffer(np.ascontiguousarray(codes))]).cast(pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), data, pa.array((near * near).sum(1).astype(np.float64))], names=["id", "v", "codes", "norm"])


def _search(batches: Iterator[pa.RecordBatch], ids: np.ndarray, queries: np.ndarray, books: np.ndarray, k: int, rerank: int) -> Iterator[pa.RecordBatch]:
    """The ``k`` best of this partition for each query; scores are taken over runs of rows
    of bounded size, and their best are merged."""
    tables = np.einsum("qd,mwd->mqw", queries.astype(np.float32), books)
    best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0))] * len(ids)
    held: list[pa.RecordBatch] = []

    def run() -> None:
        rows = pa.Table.from_batches(held).combine_chunks()
        own = rows.column("id").to_numpy()
        order = np.argsort(own, kind="stable")  # so that ties in the shortlist go to smaller ids
        own = own[order]
        x = np.concatenate([_matrix(c) for c in rows.column("v").chunks])[order]
        codes = np.concatenate([np.frombuffer(b"".join(c.to_pylist()), np.uint8) for c in rows.column("codes").chunks]).reshape(len(own), -1)[order]
        for lo in range(0, len(ids), 64):
            score = np.zeros((min(64, len(ids) - lo), len(own)), dtype=np.float32)
            for m in range(len(books)):
                score += tables[m, lo : lo + 64][:, codes[:, m]]
            for j, s in enumerate(score):
                q = lo + j
                if len(s) > rerank:
                    cut = np.partition(s, len(s) - rerank)[len(s) - rerank]
                    above = np.flatnonzero(s > cut)
                    short = np.concatenate((above, np.flatnonzero(s == cut)[: rerank - len(above)]))
                else:
                    short = np.arange(len(s))
                short = short[own[short] != ids[q]]
                exact = (x[short] * queries[q]).sum(1)
                i, e = np.concatenate((best[q][0], own[short])), np.concatenate((best[q][1], exact))
                top = np.lexsort((i, -e))[:k]
                best[q] = i[top], e[top]
        held.clear()

    n = 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n >= 16_384:
            run()
            n = 0
    if n:
        run()
    sizes = [len(i) for i, _ in best]
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.repeat(ids, sizes)), pa.array(np.concatenate([i for i, _ in best]) if best else np.zeros(0, np.int64)), pa.array(np.concatenate([s for _, s in best]) if best else np.zeros(0))], names=["query_id", "vec_id", "score"]
    )


def additive_search(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 20, k: int = 20, rerank: int = RERANK, max_sample: int = 20_000) -> DataFrame:
    """Queries: rows whose id is divisible by ``every``; candidates: all rows.  Returns
    ``query_id, rank, vec_id, score``."""
    spark = vectors.sparkSession
    arrow_limits(spark)
    schema = "query_id long, rank int, vec_id long, score double"
    whole = usable(vectors, id_col, vector_col)
    sizes = whole.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], schema)
    d, total = sizes[0]["d"], sizes[0]["count"]
    whole = whole.where(F.size("v") == d)
    share = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < F.lit(int(min(1.0, max_sample / total) * (1 << 20)) + 1)
    sample = whole.where(share).select(F.col("v").cast("array<float>").alias("v")).limit(2 * max_sample).toPandas()
    sample = np.stack([np.asarray(v, dtype=np.float32) for v in sample["v"]]) if len(sample) else np.ones((1, d), np.float32)
    books = spark.sparkContext.broadcast(train(sample))  # fixed size: books * words * dimension
    index = spill(whole.mapInArrow(lambda it: _index(it, books.value), "id long, v array<double>, codes binary, norm double"), "vector-index")

    asked = index.where(F.col("id") % every == 0).select("id", "v").distinct()
    n = asked.count()
    blocks = max(1, -(-n // QUERY_BLOCK))
    found = None
    for b in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).orderBy("id").toPandas() if blocks > 1 else asked.orderBy("id").toPandas()
        if not len(block):
            continue
        # about QUERY_BLOCK rows, whatever the size of the table
        q = spark.sparkContext.broadcast((block["id"].to_numpy(np.int64), np.stack([np.asarray(v, dtype=np.float64) for v in block["v"]])))
        part = index.mapInArrow(lambda it, q=q: _search(it, *q.value, books.value, k, rerank), "query_id long, vec_id long, score double")
        found = part if found is None else found.union(part)
    if found is None:
        return spark.createDataFrame([], schema)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.distinct().withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op7_additive_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return additive_search(read(spark, sf_dir, "embeddings"))


OP7_SQL = """
WITH e AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, x -> x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, x -> x <> 0)) > 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v) AS score
  FROM e q JOIN e c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
