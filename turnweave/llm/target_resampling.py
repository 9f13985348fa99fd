"""Importance resampling towards a target distribution, by a dictionary of distinct features.

A document's features are its runs of one and two consecutive words.  Each feature has a
bucket; a bucket's gain is the log-ratio of its share in the target's features to its share
in all documents', and a document's weight the mean gain of its features.  Weights with
Gumbel noise, keyed by document, order the documents, so that the best of them are a sample
without replacement in proportion to the exponential of their weights.

1. ``encode`` cuts the texts into blocks of bounded bytes and keeps each block as word
   numbers of its own, with its words.  A long text runs over several blocks.
2. Each block hands its distinct features, as strings with their counts, to the shards of
   the dictionary.  A feature occurs once in a block's hand-over however often the block has
   it, so the commonest word is no hot key; a shard gets a like share of all features.
3. A shard merges what blocks hand over into its distinct strings, counts them in documents
   and target, and hashes each string once.  It keeps its counts by bucket, and for every
   block the buckets of the features in the order of the hand-over.
4. Gains of all buckets (their number is a parameter) go to every task; a block takes the
   gains of its features from the dictionary's answer and adds them up for its documents.

The number of shards follows the bytes of the texts, so that neither blocks nor shards grow
with the table.  Hand-overs never outnumber the distinct features of blocks.

Nulls and edges: a null text has no words, a null id is hashed as an empty string.  A document
without features weighs 0.  Repeated rows count and are drawn one by one; rows that tie in score are
drawn by smaller id, null ids first, then by their features.  Empty tables give empty results; an
empty target leaves only the smoothing.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.progress import global_row_number
from .common import arrow_limits, drop_path, mix64, read, spilled, text_buffers, word_hashes

BUCKETS, SEED, MIN_WORDS, PERCENT = 10_000, 7, 20, 25
#: Bytes of text in a block, and bytes of text for which there is one shard of the dictionary.
BLOCK_BYTES, SHARD_BYTES = 6 << 20, 6 << 20

_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def pack(**columns: pa.Array) -> bytes:
    """Columns as a compressed Arrow stream."""
    batch = pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(data: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(data).read_next_batch()


def words_of(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and length of each word of a text's lower-cased bytes, and the words' bytes."""
    is_word = _WORD[raw]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], is_word, [False])).astype(np.int8)))
    return edge[0::2], edge[1::2] - edge[0::2], raw[is_word]


def _cuts(raw: np.ndarray, most: int) -> list[int]:
    """Ends of pieces of about ``most`` bytes that never cut a word."""
    out, at = [], 0
    while len(raw) - at > most:
        step = np.flatnonzero(~_WORD[raw[at + most : at + 2 * most]])
        while not len(step) and at + 2 * most < len(raw):  # a word longer than a piece
            at += most
            step = np.flatnonzero(~_WORD[raw[at + most : at + 2 * most]])
        if not len(step):
            break
        at += most + int(step[0])
        out.append(at)
    return [*out, len(raw)]


def encode(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[pa.RecordBatch]:
    """Blocks of documents as numbers of words, and the words."""
    base = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
    blocks = rows = 0
    pool = pa.default_memory_pool()
    pieces: list[tuple] = []  # (row, id, words, whether the first word ends the piece before)
    lengths: list[np.ndarray] = []
    values: list[np.ndarray] = []
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal blocks, held
        if not pieces:
            return
        sizes = np.concatenate(lengths)
        data = np.concatenate(values)
        offsets = np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes, dtype=np.int64)))
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        row, ids, n, carried = zip(*pieces, strict=True)
        out = [pa.array([base + blocks]), pa.array([int(len(data))], pa.int64())]
        out += [pa.array([x], pa.binary()) for x in (pack(row=pa.array(row, pa.int64()), id=pa.array(ids, pa.int64()), n=pa.array(n, pa.int64()), carried=pa.array(carried, pa.bool_())), pack(w=words.indices), pack(name=words.dictionary))]
        yield pa.RecordBatch.from_arrays(out, names=["block", "bytes", "pieces", "seq", "names"])
        blocks, held = blocks + 1, 0
        pieces.clear(), lengths.clear(), values.clear()
        pool.release_unused()

    for batch in batches:
        raw, offsets = text_buffers(batch.column(1))
        raw = _LOWER[raw]
        for i, key in enumerate(batch.column(0).to_pylist()):
            text = raw[offsets[i] : offsets[i + 1]]
            last = np.zeros(0, np.uint8)
            start = 0
            for end in _cuts(text, block_bytes):
                _, size, value = words_of(text[start:end])
                carried = bool(len(last)) and bool(len(size))
                if carried:
                    size, value = np.concatenate(([len(last)], size)), np.concatenate((last, value))
                pieces.append((base + rows, key, len(size), carried))
                lengths.append(size)
                values.append(value)
                held += len(value) + 64
                if len(size):
                    last = value[len(value) - size[-1] :]
                start = end
                if held >= block_bytes:
                    yield from flush()
            rows += 1
    yield from flush()


class Block:
    """A block's distinct features: its words in order of their numbers, then its pairs."""

    def __init__(self, seq: bytes, pieces: bytes, names: bytes, shards: int) -> None:
        self.pieces = unpack(pieces)
        self.names = unpack(names).column(0)
        w = unpack(seq).column(0).to_numpy()
        n = self.pieces.column("n").to_numpy()
        self.ends = np.cumsum(n)
        self.carried = self.pieces.column("carried").to_numpy(zero_copy_only=False)
        inner = np.ones(len(w), dtype=bool)  # words with a word before them in their piece
        inner[(self.ends - n)[n > 0]] = False
        second = np.flatnonzero(inner)
        self.own = np.ones(len(w), dtype=bool)  # words that don't belong to the piece before
        self.own[(self.ends - n)[self.carried]] = False
        self.words, self.second = w, second
        self.pairs, self.which = np.unique((w[second - 1].astype(np.int64) << 32) | w[second], return_inverse=True)
        raw = b" ".join(self.names.to_pylist())
        h = word_hashes(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0]
        self.left, self.right = self.pairs >> 32, self.pairs & 0xFFFFFFFF
        both = mix64(h[self.left] * np.uint64(3) + mix64(h[self.right])) if len(h) else h
        shard = (np.concatenate((h, both)) >> np.uint64(20)) % np.uint64(shards)
        self.order = np.argsort(shard, kind="stable")
        self.edges = np.searchsorted(shard[self.order], np.arange(shards + 1))

    def counts(self) -> np.ndarray:
        k = len(self.names)
        return np.concatenate((np.bincount(self.words[self.own], minlength=k), np.bincount(self.which, minlength=len(self.pairs))))

    def strings(self, features: np.ndarray) -> pa.Array:
        """Features as strings: a word, or two with a space between."""
        k = len(self.names)
        single = self.names.take(pa.array(features[features < k]))
        pair = features[features >= k] - k
        double = pc.binary_join_element_wise(self.names.take(pa.array(self.left[pair])), self.names.take(pa.array(self.right[pair])), pa.scalar(b" ", pa.large_binary()))
        return pa.concat_arrays([single, double])

    def sums(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words, features and sum of the features' values of each piece."""
        k = len(self.names)
        per = np.where(self.own, value[self.words], 0) if k else np.zeros(0, np.int64)
        per[self.second] += value[k + self.which]
        total = np.concatenate((np.zeros(1, np.int64), np.cumsum(per)))
        starts = self.ends - self.pieces.column("n").to_numpy()
        n = self.ends - starts
        words = n - self.carried
        return words, words + np.maximum(n - 1, 0), total[self.ends] - total[starts]


def _hand_over(batches: Iterator[pa.RecordBatch], side: int, shards: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            b = Block(r["seq"], r["pieces"], r["names"], shards)
            counts = b.counts()
            for s in np.flatnonzero(np.diff(b.edges)):
                f = b.order[b.edges[s] : b.edges[s + 1]]  # words before pairs, as the sort is stable
                data = pack(feature=b.strings(f), n=pa.array(counts[f], pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([int(s)], pa.int64()), pa.array([side], pa.int32()), pa.array([r["block"]], pa.int64()), pa.array([data], pa.binary())], names=["shard", "side", "block", "data"])


def _merge(group: pa.Table, buckets: int) -> pa.Table:
    """One shard of the dictionary: its counts by bucket, and each block's buckets."""
    side = group.column("side").to_numpy()
    got = [unpack(d) for d in group.column("data").to_pylist()]
    size = [len(g) for g in got]
    # a string of all blocks is one entry, and is hashed once
    coded = pa.concat_arrays([g.column("feature") for g in got]).dictionary_encode()
    n = np.concatenate([g.column("n").to_numpy() for g in got])
    del got
    which, k = coded.indices.to_numpy(), len(coded.dictionary)
    bucket = np.concatenate([np.fromiter(map(zlib.crc32, coded.dictionary.slice(at, 65_536).to_pylist()), np.int64) for at in range(0, k, 65_536)] or [np.zeros(0, np.int64)]) % buckets
    target = np.repeat(side, size) == 1
    counts = [np.bincount(which[m], weights=n[m], minlength=k) for m in (~target, target)]
    sums = np.stack([np.bincount(bucket, weights=c, minlength=buckets) for c in counts]).astype(np.int64)
    ends = np.cumsum(size)
    own = np.flatnonzero(side == 0)
    data = [pack(bucket=pa.array(bucket[which[ends[i] - size[i] : ends[i]]].astype(np.int32))) for i in own.tolist()]
    shard = group.column("shard")[0].as_py()
    block = group.column("block").to_numpy()[own].tolist()
    return pa.table({"shard": pa.array([shard] * (len(own) + 1), pa.int64()), "block": pa.array([*block, None], pa.int64()), "data": pa.array([*data, None], pa.binary()), "sums": pa.array([None] * len(own) + [sums.tobytes()], pa.binary())})


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for b in batches:
        for s in b.column(0).to_pylist():
            x = np.frombuffer(s, np.int64)
            total = x.copy() if total is None else total + x
    if total is not None:
        rows = total.reshape(2, -1).T
        some = np.flatnonzero(rows.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(rows[some, 0]), pa.array(rows[some, 1])], names=["bucket", "s", "t"])


def bucket_gains(sums: DataFrame, buckets: int) -> np.ndarray:
    """The gain of every bucket; ``sums`` has ``bucket, s, t``.  ``buckets`` rows come to the driver."""
    one = sums.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    total = one.agg(F.coalesce(F.sum("s"), F.lit(0)).alias("s"), F.coalesce(F.sum("t"), F.lit(0)).alias("t")).first()
    every = sums.sparkSession.range(buckets).withColumnRenamed("id", "bucket").join(one, "bucket", "left").na.fill(0)
    d = lambda c: F.col(c).cast("double")
    up = (d("t") + 1.0) * float(total["s"] + buckets)
    down = (d("s") + 1.0) * float(total["t"] + buckets)
    rows = every.select("bucket", F.floor(1000.0 * F.log(up / down)).alias("gain")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["gain"]
    return out


def _weigh(left: pa.Table, right: pa.Table, gains: np.ndarray, shards: int) -> pa.Table:
    """Each piece of one block with its words, features and gains."""
    out: list[list] = [[], [], [], [], []]
    for r in left.to_pylist():
        b = Block(r["seq"], r["pieces"], r["names"], shards)
        value = np.zeros(len(b.order), np.int64)
        answered = 0
        for s, data in zip(right.column("shard").to_pylist(), right.column("data").to_pylist(), strict=True):
            f = b.order[b.edges[s] : b.edges[s + 1]]
            value[f] = gains[unpack(data).column(0).to_numpy()]
            answered += len(f)
        if answered != len(value):
            raise RuntimeError("the dictionary lacks features of a block")
        for x, y in zip(out, (b.pieces.column("row").to_numpy(), b.pieces.column("id").to_pylist(), *b.sums(value)), strict=True):
            x.extend(y)
    return pa.table([pa.array(x, pa.int64()) for x in out], names=["row", "doc_id", "n_words", "n_features", "gain"])


def weights(docs: DataFrame, target: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", buckets: int = BUCKETS, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of each document."""
    spark = docs.sparkSession
    arrow_limits(spark)
    schema = "block long, bytes long, pieces binary, seq binary, names binary"
    texts = lambda df, key, text: df.select(key.cast("long").alias("doc_id"), F.col(text).alias("text"))
    blocks, path = spilled(texts(docs, F.col(id_col), text_col).mapInArrow(lambda it: encode(it, block_bytes), schema), "resampling-blocks")
    aims = texts(target, F.lit(None), target_col).mapInArrow(lambda it: encode(it, block_bytes), schema)
    shards = max(1, -(-(blocks.agg(F.sum("bytes")).first()[0] or 0) // shard_bytes))

    kind = "shard long, side int, block long, data binary"
    handed = blocks.mapInArrow(lambda it: _hand_over(it, 0, shards), kind).unionByName(aims.mapInArrow(lambda it: _hand_over(it, 1, shards), kind))
    merged = handed.groupBy("shard").applyInArrow(lambda t: _merge(t, buckets), "shard long, block long, data binary, sums binary")
    answers, answers_path = spilled(merged, "resampling-dictionary")
    folded = answers.where("sums is not null").select("sums").mapInArrow(_fold, "bucket long, s long, t long")
    gains = spark.sparkContext.broadcast(bucket_gains(folded, buckets))  # ``buckets`` numbers

    own = answers.where("block is not null").select("block", "shard", "data")
    pieces = blocks.groupBy("block").cogroup(own.groupBy("block")).applyInArrow(lambda a, b: _weigh(a, b, gains.value, shards), "row long, doc_id long, n_words long, n_features long, gain long")
    whole = pieces.groupBy("row").agg(F.first("doc_id").alias("doc_id"), *(F.sum(c).alias(c) for c in ("n_words", "n_features", "gain")))
    n = F.col("n_features")
    mean = F.when(n > 0, F.expr("(gain - pmod(gain, n_features)) div n_features")).otherwise(F.lit(0))
    out, _ = spilled(whole.select("doc_id", "n_words", "n_features", mean.cast("long").alias("weight")), "resampling-weights")
    drop_path(spark, path)
    drop_path(spark, answers_path)
    return out


def resample(weighed: DataFrame, *, seed: int = SEED, min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """``weighed`` with its scores, and the ranks of the documents drawn: ``percent`` of those of
    ``min_words`` words or more."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = weighed.withColumn("score", F.col("weight") + noise)
    fit = F.col("n_words") >= min_words
    drawn = scored.where(fit).count() * percent // 100
    placed = global_row_number(scored.where(fit), [F.desc("score"), "doc_id", "n_features", "weight"], name="rank")
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    return placed.withColumn("rank", rank).unionByName(scored.where(~fit).withColumn("rank", F.lit(None).cast("long")))


def op12_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents resampled towards the texts of ``benchmark``."""
    weighed = weights(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return resample(weighed).select("doc_id", "n_features", "weight", "score", "rank")


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BIT = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
#: The same for DuckDB, which has no crc32: its table of 256 steps, and a fold over the bytes.
OP12_SQL = rf"""
WITH RECURSIVE t8 AS (SELECT i, i AS c, 0 AS k FROM range(256) r(i) UNION ALL SELECT i, {_BIT}, k + 1 FROM t8 WHERE k < 8),
steps AS MATERIALIZED (SELECT list(c ORDER BY i) AS l FROM t8 WHERE k = 8),
texts AS (SELECT 0 AS side, row_number() OVER () AS i, doc_id, text FROM documents UNION ALL SELECT 1, row_number() OVER (), NULL, text FROM benchmark),
w AS MATERIALIZED (SELECT side, i, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', lower('{_UPPER}')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
f AS MATERIALIZED (SELECT side, i, f, count(*) AS n FROM (
  SELECT side, i, unnest(w) AS f FROM w UNION ALL SELECT side, i, unnest(list_transform(range(1, len(w)), lambda j: w[j] || ' ' || w[j + 1])) FROM w) GROUP BY ALL),
d AS MATERIALIZED (SELECT f, hex(encode(f)) AS h, coalesce(sum(n) FILTER (WHERE side = 0), 0) AS s, coalesce(sum(n) FILTER (WHERE side = 1), 0) AS t FROM f GROUP BY f),
c AS MATERIALIZED (SELECT f, s, t, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(len(h) // 2), lambda k: ('0x' || substr(h, 2 * k + 1, 2))::BIGINT)),
  lambda a, b: xor(a >> 8, l[(xor(a & 255, b) + 1)::BIGINT]))) % 10000 AS bucket FROM d, steps),
b AS (SELECT bucket, sum(s) AS s, sum(t) AS t FROM c GROUP BY bucket),
g AS MATERIALIZED (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE))) AS gain FROM b),
m AS (SELECT i, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(sum(n * gain) / sum(n)) AS BIGINT) AS weight FROM f JOIN c USING (f) JOIN g USING (bucket) WHERE side = 0 GROUP BY i),
x AS (SELECT doc_id, len(w) AS words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, ('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT AS h FROM w LEFT JOIN m USING (i) WHERE side = 0),
z AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5)::DOUBLE / 4294967296))) AS BIGINT) AS score FROM x),
r AS (SELECT *, row_number() OVER (PARTITION BY words >= 20 ORDER BY score DESC, doc_id NULLS FIRST, n_features, weight) AS p, count(*) OVER (PARTITION BY words >= 20) AS n FROM z)
SELECT doc_id, n_features, weight, score, CASE WHEN words >= 20 AND p <= 25 * n // 100 THEN CAST(p AS BIGINT) END AS rank FROM r
"""
