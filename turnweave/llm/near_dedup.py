"""Near-duplicate detection: MinHash bands, sequential Bayesian pruning, exact checks.

1. Each text becomes its set of distinct word shingles (64-bit hashes), a fingerprint of
   the set and a MinHash signature.  Documents with one and the same set form a class, told by
   the fingerprint and numbered by its first row, so copies cost one row each from here on.
2. Bands of the signatures are bucket keys.  In each bucket every class is compared with one
   of them, drawn by hash, in a few rounds; never all with all.
3. A candidate pair is compared in batches of signature positions.  With m of n equal and a
   uniform prior, the similarity s has P(s >= t | m, n) = P(Binomial(n + 1, t) <= m); a pair is
   given up as soon as that is below ``miss``.
4. Survivors are verified on their full shingle sets in whole numbers.
5. Verified links give components.  In buckets whose members are not yet all in one
   component, those outside its largest one are compared with the members of all other
   components by finer sketches and, where these leave a chance, on full sets, so that no
   link between different texts is lost to step 2.

With 24 bands of 4 rows a pair at similarity 0.8 is missed with probability 3e-6, and
pruning adds at most about ``miss`` for each batch.

Nulls and edges: null, empty and blank texts have an empty set and are linked with nothing.
Fewer words than a shingle: the whole sequence is the one shingle.  Rows that share an id
count as versions of one document, and link what any version does.  A row without an id takes part
like others; its ``component_id`` is null, and it is kept, where no document of its group has an id.
Extra columns play no part; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import any_columns, arrow_limits, components, drop_path, materialize, mix64, read, shingle_hashes, spill, spilled, text_buffers, word_hashes

BANDS, ROWS = 24, 4
BATCH = 16
#: Members of a bucket that are compared at once.
BLOCK, GROUP = 128, 8
#: Rounds in which every member of an open bucket meets one other.
STARS = 2
#: Bins of the sketches that tell near pairs in open buckets.
FINE = 2048
#: Sets of at most this many elements go along with the sketches.
SHORT = 512
_RNG = np.random.default_rng(8_191)
_A = _RNG.integers(0, 2**32, size=BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
_B = _RNG.integers(0, 2**32, size=BANDS * ROWS, dtype=np.uint32)
_CHUNK = 1 << 16
#: Ids are sent to every executor up to this many (some 50 bytes each); above, they are joined by a shuffle.
BROADCAST_IDS = 200_000


def least_matches(threshold: float, miss: float, positions: int = BANDS * ROWS, batch: int = BATCH) -> list[tuple[int, int]]:
    """(positions compared, fewest matches that keep a pair) after each batch."""
    out = []
    for n in range(batch, positions + 1, batch):
        below, m = 0.0, 0
        while m <= n:
            below += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if below >= miss:
                break
            m += 1
        out.append((n, m))
    return out


def shingle_sets(col: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """All shingle hashes of the rows, with each row's first index."""
    words, firsts = word_hashes(*text_buffers(col))
    return shingle_hashes(words, firsts, k)


def signatures(s: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """MinHash signatures, one row each; rows without shingles hold the largest value."""
    out = np.full((len(starts) - 1, len(_A)), 0xFFFFFFFF, dtype=np.uint32)
    full = np.flatnonzero(np.diff(starts) > 0)
    i = 0
    while i < len(full):
        j = max(i + 1, int(np.searchsorted(starts[full + 1], starts[full[i]] + _CHUNK, side="right")))
        rows = full[i:j]
        a, z = int(starts[rows[0]]), int(starts[rows[-1] + 1])
        h = (s[a:z] >> np.uint64(32)).astype(np.uint32)
        at = starts[rows] - a
        for k in range(len(_A)):
            out[rows, k] = np.minimum.reduceat(h * _A[k] + _B[k], at)
        i = j
    return out


def fine_sketches(s: np.ndarray, starts: np.ndarray, bins: int) -> np.ndarray:
    """One byte per bin: each shingle falls into one bin by its hash, a bin keeps its smallest
    and shows one of 255 marks of it, 0 if it is empty.  A small set has nearly every element
    in a bin of its own, so its similarities come out nearly exact."""
    rows = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    least = np.full((len(starts) - 1) * bins, np.uint64(2**64 - 1), dtype=np.uint64)
    at = rows * bins + (s % np.uint64(bins)).astype(np.int64)
    np.minimum.at(least, at, s)
    out = (mix64(least) % np.uint64(255) + np.uint64(1)).astype(np.uint8)
    out[least == np.uint64(2**64 - 1)] = 0
    return out.reshape(len(starts) - 1, bins)


def finely_similar(x: np.ndarray, y: np.ndarray, sizes: np.ndarray, percent: int, sigmas: float = 5.0) -> tuple[np.ndarray, np.ndarray]:
    """Whether fine sketches leave a pair a chance to reach the threshold, and whether they leave it
    none to miss it.  Of U elements in the union n are seen, one a bin, without repetition: at
    similarity t the matches have mean t n and variance t (1 - t) n (1 - n / U); ``sigmas``
    deviations tell.  Marks agree by chance in one of 255 bins."""
    t = percent / 100
    n = ((x > 0) | (y > 0)).sum(axis=1)
    m = ((x == y) & (x > 0)).sum(axis=1)
    unseen = np.clip(1 - n / (sizes / (1 + t)), 0.02, 1)
    spread = sigmas * np.sqrt(t * (1 - t) * n * unseen) + 1
    return m >= t * n - spread, m - (n - m) / 32 >= t * n + spread


def row_sets(s: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """Each row's distinct hashes, sorted."""
    return [np.unique(s[a:z]) for a, z in zip(starts[:-1], starts[1:], strict=True)]


def prints_of(sets: list[np.ndarray]) -> tuple[pa.Array, pa.Array]:
    """Size and fingerprint of 128 bits of each set."""
    prints = np.zeros((len(sets), 2), dtype=np.uint64)
    for i, u in enumerate(sets):
        prints[i] = mix64(u).sum(dtype=np.uint64), mix64(u ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return pa.array([len(u) for u in sets], pa.int64()), as_binary(prints)


def _fine(batches: Iterator[pa.RecordBatch], k: int, bins: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        s, starts = shingle_sets(batch.column(0), k)
        sets = row_sets(s, starts)
        exact = pa.array([u.view(np.int64) if len(u) <= SHORT else None for u in sets], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([*prints_of(sets), as_binary(fine_sketches(s, starts, bins)), exact], names=["n", "print", "fine", "exact"])


def as_binary(values: np.ndarray) -> pa.Array:
    """Rows of a 2-d array as binary values."""
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(values.shape[1] * values.itemsize), len(values), [None, pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def _sketch(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        s, starts = shingle_sets(batch.column(1), k)
        yield pa.RecordBatch.from_arrays([batch.column(0), *prints_of(row_sets(s, starts)), as_binary(signatures(s, starts))], names=["id", "n", "print", "sig"])


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """The bucket key of each band of each signature."""
    keys = np.zeros((len(sig), bands), dtype=np.uint64)
    for b in range(bands):
        h = np.full(len(sig), b + 1, dtype=np.uint64)
        for r in range(rows):
            h = mix64(h + sig[:, b * rows + r])
        keys[:, b] = h
    return keys


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sig = _signature_matrix(batch.column(1))
        keys = band_keys(sig, BANDS, ROWS)
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(np.repeat(ids, BANDS))], names=["key", "cid"])


def _signature_matrix(col: pa.Array, width: int = BANDS * ROWS) -> np.ndarray:
    raw, _ = _raw(col)
    return raw.view(np.uint32).reshape(len(col), width)


def _matrix(col: pa.Array, kind: type) -> np.ndarray:
    """Binary values of one length as rows."""
    return _raw(col)[0].view(kind).reshape(len(col), -1)


def _raw(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    col = col.cast(pa.large_binary())
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    o = np.frombuffer(off, dtype=np.int64)[col.offset : col.offset + len(col) + 1]
    return np.frombuffer(data, dtype=np.uint8)[o[0] : o[-1]].copy(), o - o[0]


def _survivors(x: np.ndarray, y: np.ndarray, steps: list[tuple[int, int]]) -> np.ndarray:
    """Rows of paired signatures that no batch of positions gives up."""
    alive, matches, done = np.arange(len(x)), np.zeros(len(x), dtype=np.int64), 0
    for n, least in steps:
        matches = matches + (x[alive, done:n] == y[alive, done:n]).sum(axis=1)
        keep = matches >= least
        alive, matches, done = alive[keep], matches[keep], n
        if not len(alive):
            break
    return alive


def _prune(batches: Iterator[pa.RecordBatch], steps: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = pa.array(_survivors(_signature_matrix(batch.column(2)), _signature_matrix(batch.column(3)), steps))
        yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], names=["a", "b"])


def _cross(batches: Iterator[pa.RecordBatch], bands: int, rows: int, percent: int, steps: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    """Pairs between blocks of one bucket's outsiders and members that may be linked: of
    different components, similar size, no earlier band in common, and not given up.  Sketches
    that leave a doubt give way to the sets themselves, where these are short."""
    for batch in batches:
        sides = []
        for c in (1, 2):
            col = batch.column(c)
            at = col.offsets.to_numpy()
            v = col.values
            sides.append((at, *(v.field(i).to_numpy(zero_copy_only=False) for i in range(4)), *(v.field(i) for i in (4, 5, 6))))
        found = []
        for r, key in enumerate(batch.column(0).to_numpy()):
            (p, pc, pn, _, ps, pf, px), (q, qc, qn, qo, qs, qf, qx) = (
                (*(f[at[r] : at[r + 1]] for f in (cid, comp, n, out)), *(_matrix(b.slice(at[r], at[r + 1] - at[r]), t) for b, t in ((sig, np.uint32), (fine, np.uint8))), exact.slice(at[r], at[r + 1] - at[r]))
                for at, cid, comp, n, out, sig, fine, exact in sides
            )
            ok = (pc[:, None] != qc[None, :]) & (~qo[None, :] | (p[:, None] < q[None, :]))
            ok &= 100 * np.minimum(pn[:, None], qn[None, :]) >= percent * np.maximum(pn[:, None], qn[None, :])
            left, right = np.nonzero(ok)
            band = (band_keys(ps, bands, rows).view(np.int64) == key).argmax(axis=1)
            links = []
            for lo in range(0, len(left), 1 << 15):
                a, b = left[lo : lo + (1 << 15)], right[lo : lo + (1 << 15)]
                same = (ps[a] == qs[b]).reshape(len(a), bands, rows).all(axis=2)
                here = np.flatnonzero(same.argmax(axis=1) == band[a])
                a, b = a[here], b[here]
                keep = _survivors(ps[a], qs[b], steps)
                for part in np.array_split(keep, len(keep) // 2048 + 1):
                    i, j = a[part], b[part]
                    good, sure = finely_similar(pf[i], qf[j], pn[i] + qn[j], percent)
                    links.append((i[good], j[good], sure[good]))
            if not links:
                continue
            i, j, sure = (np.concatenate([x[k] for x in links]) for k in range(3))
            good = sure.copy()
            for k in np.flatnonzero(~sure):
                x, y = px[int(i[k])].values, qx[int(j[k])].values
                good[k] = x is None or y is None or _similar(x.to_numpy(), y.to_numpy(), percent)
                sure[k] = good[k] and x is not None and y is not None
            i, j, sure = i[good], j[good], sure[good]
            found.append((np.minimum(p[i], q[j]), np.maximum(p[i], q[j]), pc[i], qc[j], sure))
        a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if found:
            a, b, *rest = (np.concatenate([x[k] for x in found]) for k in range(5))
            at = _needed(*rest)
            a, b = a[at], b[at]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b)], names=["a", "b"])


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    c = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * c >= percent * (len(x) + len(y) - c)


def _needed(first: np.ndarray, second: np.ndarray, sure: np.ndarray) -> list[int]:
    """Which candidate links between components could join any: of the sure ones a spanning
    forest, and the others between components that it leaves apart."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    out = []
    for k in np.argsort(~sure, kind="stable").tolist():
        a, b = root(int(first[k])), root(int(second[k]))
        if a != b:
            out.append(k)
            if sure[k]:
                parent[a] = b
    return out


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = row_sets(*shingle_sets(batch.column(0), k))
        off = np.concatenate((np.zeros(1, np.int64), np.cumsum([len(u) for u in sets]))).astype(np.int32)
        values = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([*prints_of(sets), pa.ListArray.from_arrays(pa.array(off), pa.array(values))], names=["n", "print", "set"])


def _sized(ids: DataFrame) -> DataFrame:
    """Broadcast up to ``BROADCAST_IDS`` rows, else left to a shuffle."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _exact(near: DataFrame, sets_of, percent: int) -> DataFrame:
    """The pairs (a, b) whose shingle sets A, B have 100 |A & B| >= percent |A | B|; ``sets_of`` gives
    the sets of classes."""
    near = materialize(near.distinct())
    ids = near.select(F.col("a").alias("cid")).union(near.select(F.col("b").alias("cid"))).distinct()
    sets, path = spilled(sets_of(ids), "near-sets")
    found = materialize(similar_sets(near, sets, "cid", percent))
    drop_path(near.sparkSession, path)
    return found


def similar_sets(pairs: DataFrame, sets: DataFrame, key: str, percent: int) -> DataFrame:
    both = pairs.join(sets.select(F.col(key).alias("a"), F.col("set").alias("x")), "a").join(sets.select(F.col(key).alias("b"), F.col("set").alias("y")), "b")
    c = both.select("a", "b", F.size("x").alias("nx"), F.size("y").alias("ny"), F.size(F.array_intersect("x", "y")).alias("c")).where("c > 0")
    return c.where(100 * F.col("c") >= percent * (F.col("nx") + F.col("ny") - F.col("c"))).select("a", "b").distinct()


def bucket_links(members: DataFrame, sketches: DataFrame, fine, verify_star, verify, *, bands: int, rows: int, percent: int, steps: list[tuple[int, int]]) -> DataFrame:
    """Verified links (a, b) that join the members of buckets as all their links would.

    ``members(key, cid)`` has each bucket's members, ``sketches(cid, n, sig)`` their set sizes and
    signatures; ``fine`` gives the fine sketches (and short sets) of some of them, the other two functions keep
    the pairs (a, b) that are linked.  In each round every member of an open bucket, one whose
    members lie in several components, meets one of its bucket, drawn anew by hash, unless both are
    in one component already.  Where buckets are after ``STARS`` rounds
    still open, those outside their largest component meet the members of all other
    components, block by block: these pairs could still join components.  They are compared
    within blocks, and only survivors become rows.
    """

    def largest(placed: DataFrame) -> DataFrame:
        """Open buckets with their members' number and largest component; buckets of two have been compared."""
        counts = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("c"))
        tops = counts.groupBy("key").agg(F.max_by("component", "c").alias("main"), F.max("c").alias("most"), F.sum("c").alias("m"))
        return tops.where("m > 2 and most < m").select("key", "m", "main")

    def now(rows: DataFrame, found: DataFrame) -> DataFrame:
        known = found.select(F.col("v").alias("cid"), "component")
        return rows.select("key", "cid").join(known, "cid", "left").select("key", "cid", F.coalesce("component", "cid").alias("component"))

    open_, links = members.select("key", "cid", F.col("cid").alias("component")), None
    for turn in range(STARS):
        drawn = F.xxhash64("cid", F.pmod("key", F.lit(4)), F.lit(turn))
        lead = open_.groupBy("key").agg(F.min_by("cid", drawn).alias("lead"), F.min_by("component", drawn).alias("own"))
        pairs = open_.join(lead, "key").where("component <> own")
        new = verify_star(pairs.select(F.least("cid", "lead").alias("a"), F.greatest("cid", "lead").alias("b")).distinct())
        links = new if links is None else materialize(links.union(new).distinct())
        placed = now(open_, components(links))
        open_ = materialize(placed.join(largest(placed), "key"))
    exact = fine(materialize(open_.select("cid").distinct()))
    open_ = open_.join(sketches, "cid").join(exact, "cid").withColumn("out", F.col("component") != F.col("main"))
    block = F.pmod(F.xxhash64("cid"), F.ceil(F.col("m") / BLOCK)).cast("int")
    one = F.struct("cid", "component", "n", "out", "sig", "fine", "exact")
    blocks = open_.groupBy("key", block.alias("block"), "out").agg(F.collect_list(one).alias("items"), F.first("m").alias("m"))
    # groups of GROUP blocks meet as a grid, so that no task gets more than a cell of a bucket
    cells = F.sequence(F.lit(0), F.floor((F.ceil(F.col("m") / BLOCK) - 1) / GROUP).cast("int"))
    own = F.floor(F.col("block") / GROUP).cast("int")
    blocks = materialize(blocks.select("key", "out", "items", own.alias("g"), cells.alias("cells")))
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    p = blocks.where("out").select("key", F.col("g").alias("i"), F.explode("cells").alias("j"), F.col("items").alias("p")).repartition(n, "key", "i", "j")
    q = blocks.select("key", F.explode("cells").alias("i"), F.col("g").alias("j"), F.col("items").alias("q")).repartition(n, "key", "i", "j")
    pairs = p.join(q, ["key", "i", "j"])
    more = pairs.select("key", "p", "q").mapInArrow(lambda it: _cross(it, bands, rows, percent, steps), "a long, b long").where("a <> b")
    again = verify(more)
    return materialize(links.union(again)) if again.limit(1).count() else links


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80, miss: float = 1e-6) -> DataFrame:
    """One row per row of ``docs``: ``id, n_shingles, component_id, kept``; the component is
    the smallest id reachable over links of at least ``percent`` hundredths similarity."""
    arrow_limits(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sketched = texts.mapInArrow(lambda it: _sketch(it, shingle), "id long, n long, print binary, sig binary")
    marks, wide = spilled(sketched.withColumn("row", F.monotonically_increasing_id()), "near-marks")
    some = marks.where("n > 0")
    classes, of_classes = spilled(some.groupBy("print", "n").agg(F.min("row").alias("cid"), F.min("id").alias("id")), "near-classes")
    named, of_named = spilled(some.select(F.col("row").alias("cid"), "n", "sig").join(classes.select("cid"), "cid", "left_semi"), "near-sketches")
    marks, of_marks = spilled(marks.select("id", "n", "print"), "near-rows")
    some = marks.where("n > 0")
    drop_path(docs.sparkSession, wide)

    keys = named.select("cid", "sig").mapInArrow(_bands, "key long, cid long")
    shared = keys.groupBy("key").agg(F.min("cid").alias("low"), F.max("cid").alias("high")).where("low < high").select("key")
    members, path = spilled(keys.join(shared, "key"), "near-members")

    steps = least_matches(percent / 100, miss)

    def from_texts(asked: DataFrame, f, schema: str) -> DataFrame:
        """What ``f`` makes of a text of each class asked for.  The texts are those of rows with the id of
        such a class; classes are told by their fingerprints."""
        own = materialize(classes.join(asked, "cid", "left_semi"))
        ids = own.select(F.col("id").alias("own")).distinct()
        rows = texts.join(_sized(ids), F.col("id").eqNullSafe(F.col("own")), "left_semi").select("text").mapInArrow(f, f"n long, print binary, {schema}")
        return rows.join(_sized(own.select("print", "n", "cid")), ["print", "n"]).drop("print", "n").dropDuplicates(["cid"])

    def sets_of(asked: DataFrame) -> DataFrame:
        return from_texts(asked, lambda it: _sets(it, shingle), "set array<long>")

    def fine(asked: DataFrame) -> DataFrame:
        return from_texts(asked, lambda it: _fine(it, shingle, FINE), "fine binary, exact array<long>")

    def star(pairs: DataFrame) -> DataFrame:
        x = named.select(F.col("cid").alias("a"), F.col("n").alias("xn"), F.col("sig").alias("x"))
        y = named.select(F.col("cid").alias("b"), F.col("n").alias("yn"), F.col("sig").alias("y"))
        sized = pairs.join(x, "a").join(y, "b").where(100 * F.least("xn", "yn") >= percent * F.greatest("xn", "yn"))
        return _exact(sized.select("a", "b", "x", "y").mapInArrow(lambda it: _prune(it, steps), "a long, b long"), sets_of, percent)

    links = bucket_links(members, named, fine, star, lambda near: _exact(near, sets_of, percent), bands=BANDS, rows=ROWS, percent=percent, steps=steps)
    drop_path(docs.sparkSession, path)
    # several versions of a document are one
    rows = some.select("id", "n", "print").join(classes.select("print", "n", "cid"), ["print", "n"])
    many = rows.where("id is not null").groupBy("id").agg(F.min("cid").alias("a"), F.max("cid").alias("z")).where("a < z").select("id", "a")
    versions = rows.select("id", F.col("cid").alias("b")).join(many, "id").where("a <> b").select("a", "b")
    found = components(links.union(versions.distinct()))
    placed = classes.join(found.select(F.col("v").alias("cid"), "component"), "cid", "left").select("print", "n", "id", F.coalesce("component", "cid").alias("component"))
    placed, of_placed = spilled(placed, "near-placed")
    first = placed.groupBy("component").agg(F.min("id").alias("component_id"))
    placed = placed.join(first, "component").select("print", "n", "component", "component_id")

    out = marks.select("id", "n", "print").join(placed, ["print", "n"], "left")
    component_id = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id"))
    kept = F.coalesce(F.col("id") == component_id, component_id.isNull())
    out = spill(out.select("id", F.col("n").alias("n_shingles"), component_id.alias("component_id"), kept.alias("kept"), "print", F.col("component").alias("group")), "near-found")
    for p in (of_classes, of_named, of_marks, of_placed):
        drop_path(docs.sparkSession, p)
    return out


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents"), shingle=4, percent=80)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


@any_columns
def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without all but one of each group of near duplicates.  Rows without an id
    stay where their group has no document with one: one row of each such group, and empty texts."""
    found = near_duplicates(docs)
    gone = found.where("not kept and id is not null").select(F.col("id").alias("doc_id")).distinct()
    named = docs.where("doc_id is not null").join(gone, "doc_id", "left_anti").select(*docs.columns)
    unnamed = docs.where("doc_id is null")
    if not unnamed.limit(1).count():
        return named
    marks = F.pandas_udf(_text_print, "n long, print binary")("text")
    rows = unnamed.select(*docs.columns, marks.alias("_m"))
    groups = found.where("id is null and kept and n_shingles > 0").select(F.col("print").alias("_p"), F.col("n_shingles").alias("_n"), F.col("group").alias("_g")).distinct()
    one = rows.join(groups, (F.col("_m.print") == F.col("_p")) & (F.col("_m.n") == F.col("_n"))).dropDuplicates(["_g"])
    return named.unionByName(one.select(*docs.columns)).unionByName(rows.where("_m.n = 0").select(*docs.columns))


def _text_print(texts: pd.Series) -> pd.DataFrame:
    n, prints = prints_of(row_sets(*shingle_sets(pa.Array.from_pandas(texts, type=pa.large_string()), 5)))
    return pd.DataFrame({"n": n.to_numpy(), "print": prints.to_pylist()})
