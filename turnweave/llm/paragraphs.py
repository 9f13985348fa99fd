"""Passages that repeat across documents, by paragraph MinHash banding.

A document's paragraphs are its lines of at least ``MIN_WORDS`` words.  Their signatures
are cut into ``BANDS`` bands of ``ROWS`` positions, tuned for recall: a pair at the threshold of
0.8 misses every band with probability 0.002, one at 0.9 with 5e-5.  Colliding paragraphs
are joined, verified by exact Jaccard similarity of their word
shingles, and the verified links give components, of which one paragraph stays.

A passage may also stand inside a longer line, or over several short ones.  Such passages are
paragraphs of a second kind, found over the whole word sequence whatever its lines.  Equal runs
of ``RUN_WORDS`` words at the smallest of each ``WINDOW`` neighbouring hashes of ``GRAM`` words are
seeds: any common stretch of RUN_WORDS + WINDOW - 1 words (24) has one.  Passages of at
least ``MIN_WORDS`` words at the threshold have such a stretch, as each changed word costs up to
five of their shingles.  From a seed the two texts are followed to both sides, over places where
up to ``GAP`` words differ, as far as the exact Jaccard similarity stays at the threshold; the
passages so found link where MIN_WORDS or more remain on both sides.  Only the parts of texts
around shared seeds, with ``MARGIN`` words more, are brought together.  A text's seed meets the
first text that has it.  Seeds that then stand in no passage of their text meet once more, under
finer keys: the seed with several numbers of words before and after it (``AROUND``).  Texts with an
equal stretch of 34 words are thus always linked; a near passage could only be missed where the
first text differs under all these keys.

Only hashes, places and ids are shuffled; texts come back for candidate paragraphs alone.
A bucket's members meet one of them in each of a few rounds, never all with all; only members
that this leaves in other components meet the rest, so no link between components is lost.

Documents with one and the same text are a class, of which each has a row for its whole text.  Passages
inside that text are rows of the class's first document alone, and count for all of them: what
a copy holds is told by the document that its whole text names.

Nulls and edges: null, empty and short texts have no paragraphs.  Copies within one document
alone are no repeat across documents and aren't returned.  Rows without an id are left out.
Rows that share an id are one document.  Extra columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_limits, components, drop_path, materialize, mix64, read, shingle_hashes, spill, spilled, text_buffers, word_hashes
from .near_dedup import SHORT, as_binary, band_keys, bucket_links, fine_sketches, similar_sets

BANDS, ROWS = 6, 2
SHINGLE = 5
FINE = 1024
MIN_WORDS = 30
RUN_WORDS, WINDOW, GRAM = 12, 13, 4
GAP = 8
#: Words before and after a seed that make up finer keys: any stretch of 34 equal words that holds it has one of 30, any of 27 one of 24.
AROUND = ((18, 0), (13, 5), (9, 9), (5, 13), (0, 18), (12, 0), (8, 4), (4, 8), (0, 12))
#: Words of a text that are looked at beyond its first and last shared seed.
MARGIN = 64
#: Keys are sent to every executor up to this many (8 bytes each); above, they are joined by a shuffle.
BROADCAST_KEYS = 100_000
_RNG = np.random.default_rng(65_537)
_A = _RNG.integers(0, 2**32, size=BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
_B = _RNG.integers(0, 2**32, size=BANDS * ROWS, dtype=np.uint32)


def _slide(x: np.ndarray, width: int, least) -> np.ndarray:
    """``least`` (minimum or maximum) of every ``width`` neighbours, by doubling."""
    out, size = x, 1
    while 2 * size <= width:
        out, size = least(out[:-size], out[size:]), 2 * size
    n = len(x) - width + 1
    return least(out[:n], out[width - size : width - size + n]) if size < width else out


def runs_of(words: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first word and hash of the runs of all rows, from the hashes of their words."""
    n = np.maximum(np.diff(firsts) - RUN_WORDS + 1, 0)  # places where a run fits
    span = len(words) - RUN_WORDS + 1
    none = np.zeros(0, np.int64)
    if span < 1 or not n.any():
        return none, none, none
    grams = np.zeros(span, dtype=np.uint64)
    for j in range(GRAM):
        grams = mix64(grams + words[j : j + span] + np.uint64(j + 1))
    picked = []
    full = np.flatnonzero(n >= WINDOW)
    if len(full):
        c = n[full] - WINDOW + 1
        start = np.repeat(firsts[full], c) + np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c)
        # the smallest of each window within a row, and the places that are it for some window
        least = np.zeros(span + WINDOW - 1, dtype=np.uint64)
        least[start + WINDOW - 1] = _slide(grams, WINDOW, np.minimum)[start]
        picked.append(np.flatnonzero(_slide(least, WINDOW, np.maximum) == grams))
    for i in np.flatnonzero((n > 0) & (n < WINDOW)):
        picked.append(firsts[i] + grams[firsts[i] : firsts[i] + n[i]].argmin(keepdims=True))
    at = np.unique(np.concatenate(picked))
    key = np.zeros(len(at), dtype=np.uint64)
    for j in range(RUN_WORDS):
        key = mix64(key + words[at + j])
    row = np.searchsorted(firsts, at, side="right") - 1
    return row, at - firsts[row], key.view(np.int64)


def text_keys(words: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """A hash of each row's word sequence."""
    n = np.diff(firsts)
    place = np.arange(len(words), dtype=np.uint64) - np.repeat(firsts[:-1], n).astype(np.uint64)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix64(words + mix64(place + np.uint64(1))), dtype=np.uint64)))
    return mix64(sums[firsts[1:]] - sums[firsts[:-1]] + n.astype(np.uint64)).view(np.int64)


class Lines:
    """The words of a column's texts, and its lines of enough words: row, first word, words,
    and a hash of their word sequence."""

    def __init__(self, column: pa.Array) -> None:
        split = pc.split_pattern(column.cast(pa.large_string()), "\n")
        at = split.offsets.to_numpy().astype(np.int64)
        self.words, firsts = word_hashes(*text_buffers(split.values.slice(at[0], at[-1] - at[0])))
        at -= at[0]
        self.firsts = firsts[at]  # of each text
        n = np.diff(firsts)
        long = np.flatnonzero(n >= MIN_WORDS)
        self.row = np.searchsorted(at, long, side="right") - 1
        self.first = firsts[long] - self.firsts[self.row]
        self.n = n[long]
        self.edges = np.concatenate((np.zeros(1, np.int64), np.cumsum(self.n)))
        place = np.arange(int(self.edges[-1])) + np.repeat(firsts[long] - self.edges[:-1], self.n)
        self.own = self.words[place]
        self.keys = text_keys(self.own, self.edges)

    def signed(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Shingle hashes, each line's first, and signatures."""
        s, starts = shingle_hashes(self.own, self.edges, SHINGLE)
        return s, starts, _signature(s, starts)


def _signature(s: np.ndarray, starts: np.ndarray) -> np.ndarray:
    h = (s >> np.uint64(32)).astype(np.uint32)
    return np.stack([np.minimum.reduceat(h * _A[k] + _B[k], starts[:-1]) if len(h) else np.zeros(0, np.uint32) for k in range(BANDS * ROWS)], axis=1)


def _listed(starts: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), values)


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each text its id, words, a hash of its word sequence, its lines with their bands, and its seeds."""
    for batch in batches:
        x = Lines(batch.column(1))
        bands = band_keys(x.signed()[2], BANDS, ROWS).reshape(-1).view(np.int64)
        fields = [pa.array(x.first.astype(np.int32)), pa.array(x.n.astype(np.int32)), pa.array(x.keys), _listed(np.arange(len(x.n) + 1) * BANDS, pa.array(bands))]
        lines = pa.StructArray.from_arrays(fields, names=["first_word", "n_words", "key", "bands"])
        row, at, key = runs_of(x.words, x.firsts)
        seeds = pa.StructArray.from_arrays([pa.array(at.astype(np.int32)), pa.array(key)], names=["at", "key"])
        rows = np.arange(len(batch) + 1)
        cols = [batch.column(0), pa.array(text_keys(x.words, x.firsts)), pa.array(np.diff(x.firsts).astype(np.int32)), _listed(np.searchsorted(x.row, rows), lines), _listed(np.searchsorted(row, rows), seeds)]
        yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "tid", "n_words", "lines", "seeds"])


MARKS = "doc_id long, tid long, n_words int, lines array<struct<first_word:int,n_words:int,key:long,bands:array<long>>>, seeds array<struct<at:int,key:long>>"


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Id, hash and text of rows; those that a task has seen aren't repeated."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        keys = text_keys(*word_hashes(*text_buffers(batch.column(1)))).tolist()
        new = []
        for i, k in enumerate(zip(batch.column(0).to_pylist(), keys, strict=True)):
            if k not in seen:
                seen.add(k)
                new.append(i)
        if len(seen) > 1_000_000:
            seen.clear()
        at = pa.array(new, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array(keys, pa.int64()).take(at), batch.column(1).take(at)], names=["doc_id", "tid", "text"])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The parts of a text around its shared seeds."""
    for batch in batches:
        tid, seg, first, part = [], [], [], []
        for t, text, parts in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
            words = text.as_py().encode().split()  # bytes split at [\x20\x09-\x0D]
            for p in parts:
                lo = max(0, p["lo"] - MARGIN)
                tid.append(t)
                seg.append(p["seg"])
                first.append(lo)
                part.append(b" ".join(words[lo : p["hi"] + RUN_WORDS + MARGIN]))
        yield pa.RecordBatch.from_arrays([pa.array(tid, pa.int64()), pa.array(seg, pa.int64()), pa.array(first, pa.int32()), pa.array(part, pa.binary()).cast(pa.string())], names=["tid", "seg", "first", "part"])


def _sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Further keys of seeds, from the words around them: the words ``AROUND`` them, and the bands of the words on either side."""
    for batch in batches:
        words, firsts = word_hashes(*text_buffers(batch.column(3)))
        lists = batch.column(4)
        edges = lists.offsets.to_numpy()
        own = lists.values.slice(edges[0], edges[-1] - edges[0])
        row = np.repeat(np.arange(len(batch)), np.diff(edges))
        at = own.field(0).to_numpy(zero_copy_only=False)
        place = firsts[row] + at - batch.column(2).to_numpy()[row]
        key, who = [], []
        for before, after in AROUND:
            some = np.flatnonzero((place - before >= firsts[row]) & (place + RUN_WORDS + after <= firsts[row + 1]))
            k = np.full(len(some), before, dtype=np.uint64)
            for j in range(-before, RUN_WORDS + after):
                k = mix64(k + words[place[some] + j])
            key.append(k)
            who.append(some)
        who = np.concatenate(who)
        cols = [pa.array(np.concatenate(key).view(np.int64)), *(pa.array(batch.column(i).to_numpy()[row[who]]) for i in range(2)), pa.array(at[who])]
        yield pa.RecordBatch.from_arrays(cols, names=["key", "tid", "seg", "at"])


def follow(x: np.ndarray, y: np.ndarray, gx: np.ndarray, gy: np.ndarray, i: int, j: int) -> list[tuple[int, int, int]]:
    """(start, start, words) of the equal stretches from (i, j) on; between two of them up to
    ``GAP`` words of either side differ, and ``SHINGLE`` words or more are equal again."""
    out = []
    while True:
        n = min(len(x) - i, len(y) - j)
        size, step = 0, 64
        while size < n:
            m = min(step, n - size)
            off = np.flatnonzero(x[i + size : i + size + m] != y[j + size : j + size + m])
            if len(off):
                size += int(off[0])
                break
            size, step = size + m, step * 4
        out.append((i, j, size))
        i, j = i + size, j + size
        p, q = np.nonzero(gx[i : i + GAP + 1, None] == gy[None, j : j + GAP + 1])
        if not len(p):
            return out
        best = np.lexsort((np.abs(p - q), p + q))[0]
        i, j = i + int(p[best]), j + int(q[best])


def chain(x: np.ndarray, y: np.ndarray, gx: np.ndarray, gy: np.ndarray, i: int, j: int) -> tuple[list[tuple[int, int, int]], int]:
    """Equal stretches to both sides of the equal words at (i, j), and which of them holds these."""
    right = follow(x, y, gx, gy, i, j)
    left = [(len(x) - a - n, len(y) - b - n, n) for a, b, n in follow(x[::-1], y[::-1], gx[::-1], gy[::-1], len(x) - i, len(y) - j)]
    return left[:0:-1] + [(left[0][0], left[0][1], left[0][2] + right[0][2])] + right[1:], len(left) - 1


def common_passage(parts: list[tuple[int, int, int]], seed: int, gx: np.ndarray, gy: np.ndarray, percent: int) -> tuple[int, int, int, int] | None:
    """First word and words in both texts of the longest passage found by taking the shorter
    end off the stretches until the similarity is at the threshold; the seed's stretch stays."""
    lo, hi = 0, len(parts)
    same = sum(max(0, n - SHINGLE + 1) for _, _, n in parts)
    whole = True
    while True:
        a, b = parts[lo][0], parts[lo][1]
        m, n = parts[hi - 1][0] + parts[hi - 1][2] - a, parts[hi - 1][1] + parts[hi - 1][2] - b
        if min(m, n) < MIN_WORDS:
            return None
        if lo == seed == hi - 1:
            return a, m, b, n  # the words are equal
        # shingles of the stretches tell whether counting sets is worth while; the sets decide (at
        # first with some allowance, as shingles may also recur elsewhere)
        if 100 * same >= (percent - 20 * whole) * (m + n - 2 * SHINGLE + 2 - same):
            p, q = np.unique(gx[a : a + m - SHINGLE + 1]), np.unique(gy[b : b + n - SHINGLE + 1])
            c = len(np.intersect1d(p, q, assume_unique=True))
            if 100 * c >= percent * (len(p) + len(q) - c):
                return a, m, b, n
        whole = False
        if lo < seed and (hi - 1 == seed or parts[lo][2] <= parts[hi - 1][2]):
            same -= max(0, parts[lo][2] - SHINGLE + 1)
            lo += 1
        else:
            same -= max(0, parts[hi - 1][2] - SHINGLE + 1)
            hi -= 1


def pair_passages(x: np.ndarray, y: np.ndarray, gx: np.ndarray, gy: np.ndarray, seeds: list[tuple[int, int]], percent: int) -> list[tuple[int, int, int, int]]:
    """The passages around the common seeds of two texts, from the hashes of their words and shingles."""
    found: list[tuple[int, int, int, int]] = []
    known: dict[int, list[tuple[int, int, list[tuple[int, int, int]], int]]] = {}  # stretches by how far they are shifted
    tried: set[tuple[int, int]] = set()
    for i, j in sorted(seeds):
        if any(u <= i < u + m and v <= j < v + n for u, m, v, n in found):
            continue
        held = next(((parts, k) for lo, hi, parts, k in known.get(j - i, ()) if lo <= i < hi), None)
        if held is None:
            held = chain(x, y, gx, gy, i, j)
            for k, (u, v, n) in enumerate(held[0]):
                known.setdefault(v - u, []).append((u, u + n, held[0], k))
        parts, k = held
        if parts[k][:2] in tried:
            continue
        tried.add(parts[k][:2])
        passage = common_passage(parts, k, gx, gy, percent)
        if passage:
            found.append(passage)
    return found


def _passages(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The common passages of pairs of parts of texts (a, b) around their common seeds."""
    for batch in batches:
        rows = []
        words = [word_hashes(*text_buffers(batch.column(c))) for c in (5, 6)]
        grams = [shingle_hashes(*w, SHINGLE) for w in words]
        for r, (a, b, at, u, v) in enumerate(zip(*(c.to_pylist() for c in batch.columns[:5]), strict=True)):
            x, y = (w[f[r] : f[r + 1]] for w, f in words)
            gx, gy = (g[f[r] : f[r + 1]] for g, f in grams)
            found = pair_passages(x, y, gx, gy, [(p["i"] - u, p["j"] - v) for p in at], percent)
            rows += [(a, b, i + u, m, j + v, n) for i, m, j, n in found]
        names = ["a", "b", "a_first", "a_words", "b_first", "b_words"]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(6)], names=names)


def _line_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sequence hash, signature and sorted shingle hashes of each line; those that a task has seen aren't repeated."""
    seen: set[int] = set()
    for batch in batches:
        x = Lines(batch.column(0))
        s, starts, sig = x.signed()
        new = []
        for i, k in enumerate(x.keys.tolist()):
            if k not in seen:
                seen.add(k)
                new.append(i)
        if len(seen) > 1_000_000:
            seen.clear()
        if not new:
            continue
        parts = [np.unique(s[starts[i] : starts[i + 1]]).view(np.int64) for i in new]
        n = np.array([len(p) for p in parts], dtype=np.int64)
        sets = _listed(np.concatenate((np.zeros(1, np.int64), np.cumsum(n))), pa.array(np.concatenate(parts)))
        yield pa.RecordBatch.from_arrays([pa.array(x.keys[new]), pa.array(n), as_binary(sig[new]), sets], names=["cid", "n", "sig", "set"])


def _line_fine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fine sketches of sets, and the sets where they are short."""
    for batch in batches:
        at = batch.column(1).offsets.to_numpy().astype(np.int64)
        s = batch.column(1).values.to_numpy().view(np.uint64)[at[0] : at[-1]]
        short = [x if len(x) <= SHORT else None for x in np.split(s.view(np.int64), (at - at[0])[1:-1])] if len(batch) else []
        yield pa.RecordBatch.from_arrays([batch.column(0), as_binary(fine_sketches(s, at - at[0], FINE)), pa.array(short, pa.list_(pa.int64()))], names=["cid", "fine", "exact"])


def _sized(keys: DataFrame) -> DataFrame:
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def line_links(texts: DataFrame, lines: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between sequence hashes of different but similar lines."""
    bands = lines.select(F.explode("bands").alias("band"), F.col("key").alias("cid")).withColumnRenamed("band", "key")
    shared = bands.groupBy("key").agg(F.min("cid").alias("low"), F.max("cid").alias("high")).where("low < high").select("key")
    members, path = spilled(bands.join(shared.hint("shuffle_hash"), "key").distinct(), "para-members")
    wanted = materialize(members.select("cid").distinct())
    holders = lines.select("doc_id", "key").join(_sized(wanted.select(F.col("cid").alias("key"))), "key", "left_semi").groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    holders = materialize(holders.select("doc_id").distinct())
    sets = texts.join(_sized(holders), "doc_id", "left_semi").select("text").mapInArrow(_line_sets, "cid long, n long, sig binary, set array<long>")
    sets, sets_path = spilled(sets.join(_sized(wanted), "cid", "left_semi").dropDuplicates(["cid"]), "para-sets")
    verify = lambda pairs: materialize(similar_sets(pairs.distinct(), sets.select("cid", "set"), "cid", percent))
    fine = lambda ids: sets.select("cid", "set").join(_sized(ids), "cid", "left_semi").mapInArrow(_line_fine, "cid long, fine binary, exact array<long>")
    links = bucket_links(members, sets.select("cid", "n", "sig"), fine, verify, verify, bands=BANDS, rows=ROWS, percent=percent, steps=[])
    for p in (path, sets_path):
        drop_path(texts.sparkSession, p)
    return links


def _shared(members: DataFrame) -> DataFrame:
    """The members (key, tid, ...) of keys that several texts have, with each key's first text ``low``."""
    shared = materialize(members.groupBy("key").agg(F.min("tid").alias("low"), F.max("tid").alias("high")).where("low < high").select("key", "low"))
    # the shared keys of a partition are a small table to look up, which spares sorting all members
    return members.join(F.broadcast(shared) if shared.count() <= BROADCAST_KEYS else shared.hint("shuffle_hash"), "key").distinct()


def _meetings(members: DataFrame) -> DataFrame:
    """Pairs of parts with their common seeds: each member (key, low, tid, seg, at) meets its key's first."""
    lead = members.where("tid = low").groupBy("key").agg(F.min(F.struct("seg", "at")).alias("l"))
    met = members.where("tid <> low").join(lead, "key")
    met = met.select(F.col("low").alias("a"), F.col("l.seg").alias("a_seg"), F.col("tid").alias("b"), F.col("seg").alias("b_seg"), F.struct(F.col("l.at").alias("i"), F.col("at").alias("j")).alias("p"))
    return met.groupBy("a", "a_seg", "b", "b_seg").agg(F.collect_set("p").alias("at"))


def passages(texts: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """Passages over any lines that two texts share: ``tid`` (hash of the text), ``first_word``,
    ``n_words``, ``key`` (of the passage) and ``component``."""
    spark = texts.sparkSession
    seeds = marks.select("tid", F.explode("seeds").alias("s")).select("tid", "s.at", "s.key")
    seeds = _shared(seeds)
    # seeds of a text that are near each other are in one part of it
    w = Window.partitionBy("tid").orderBy("at")
    seeds = seeds.withColumn("far", F.coalesce(F.col("at") - F.lag("at").over(w) > RUN_WORDS + 2 * MARGIN, F.lit(False)).cast("long"))
    seeds = seeds.select("key", "low", "tid", F.sum("far").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("seg"), "at")
    seeds, path = spilled(seeds, "para-seeds")

    segs = seeds.groupBy("tid", "seg").agg(F.min("at").alias("lo"), F.max("at").alias("hi"))
    wanted = materialize(segs.groupBy("tid").agg(F.collect_list(F.struct("seg", "lo", "hi")).alias("parts")))
    held = marks.select("doc_id", "tid").join(_sized(wanted.select("tid")), "tid", "left_semi").groupBy("tid").agg(F.min("doc_id").alias("doc_id"))
    held = materialize(held)
    keyed = texts.join(_sized(held.select("doc_id").distinct()), "doc_id", "left_semi").mapInArrow(_keyed, "doc_id long, tid long, text string")
    whole = keyed.join(held.join(wanted, "tid"), ["doc_id", "tid"]).select("tid", "text", "parts")
    parts, parts_path = spilled(whole.mapInArrow(_slices, "tid long, seg long, first int, part string").dropDuplicates(["tid", "seg"]), "para-parts")

    def verified(pairs: DataFrame) -> DataFrame:
        side = lambda c, text: parts.select(F.col("tid").alias(c), F.col("seg").alias(f"{c}_seg"), F.col("first").alias(f"{c}_at"), F.col("part").alias(text))
        both = pairs.join(side("a", "s"), ["a", "a_seg"]).join(side("b", "t"), ["b", "b_seg"]).select("a", "b", "at", "a_at", "b_at", "s", "t")
        return materialize(both.mapInArrow(lambda it: _passages(it, percent), "a long, b long, a_first long, a_words long, b_first long, b_words long"))

    side = lambda rows, c: rows.select(F.col(c).alias("tid"), F.col(f"{c}_first").alias("first_word"), F.col(f"{c}_words").alias("n_words"))
    found = verified(_meetings(seeds))
    # seeds in none of their text's passages meet again, under finer keys; the first of a key has met all
    cover = side(found, "a").union(side(found, "b")).distinct().withColumnRenamed("tid", "own")
    inside = (F.col("tid") == F.col("own")) & (F.col("at") >= F.col("first_word")) & (F.col("at") + RUN_WORDS <= F.col("first_word") + F.col("n_words"))
    out = seeds.where("tid <> low").join(cover, inside, "left_anti")
    open_ = out.groupBy("key").agg(F.min("tid").alias("low"), F.max("tid").alias("high")).where("low < high").select("key")
    out = materialize(out.join(open_, "key", "left_semi"))
    if out.limit(1).count():
        again = out.groupBy("tid", "seg").agg(F.collect_set(F.struct("at")).alias("own"))
        keys = parts.join(again, ["tid", "seg"]).select("tid", "seg", "first", "part", "own").mapInArrow(_sides, "key long, tid long, seg long, at int")
        keys = spill(_shared(spill(keys, "para-sides")), "para-sides")
        found = materialize(found.union(verified(_meetings(keys))).distinct())
    for p in (path, parts_path):
        drop_path(spark, p)

    named = lambda c: F.xxhash64(c, f"{c}_first", f"{c}_words")
    spans = materialize(side(found, "a").union(side(found, "b")).distinct().withColumn("key", F.xxhash64("tid", "first_word", "n_words")))
    # places of one text that are nearly the same are one passage
    w = Window.partitionBy("tid").orderBy("first_word", "n_words")
    last = F.lag(F.struct("first_word", "n_words", "key")).over(w)
    near = spans.withColumn("o", last).where("o is not null").withColumn("end", F.col("o.first_word") + F.col("o.n_words"))
    common = F.least(F.col("end"), F.col("first_word") + F.col("n_words")) - F.col("first_word") - SHINGLE + 1
    near = near.withColumn("c", common).where(100 * F.col("c") >= percent * (F.col("n_words") + F.col("o.n_words") - 2 * SHINGLE + 2 - F.col("c")))
    links = found.select(named("a").alias("a"), named("b").alias("b")).union(near.select(F.col("key").alias("a"), F.col("o.key").alias("b")))
    return spans.join(components(links).withColumnRenamed("v", "key"), "key")


def repeated_passages(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """One row per paragraph that repeats across documents: ``doc_id, first_word, n_words,
    kind, component_id`` (the smallest document of its component), ``n_places`` (paragraphs
    in the component, those of copies too), ``kept`` (the paragraph that stays).

    Passages over any lines (``kind`` 1) are rows of the first of the documents that have the text.  The
    others have a row for the whole text, from word 0, whose ``component_id`` is that first document."""
    arrow_limits(docs.sparkSession, 500)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null and text is not null")
    marks, path = spilled(texts.mapInArrow(_marks, MARKS), "para-marks")
    lines = marks.select("doc_id", F.explode("lines").alias("l")).select("doc_id", "l.*")
    units = lines.select("doc_id", "first_word", "n_words", F.lit(0).alias("kind"), "key").union(marks.select("doc_id", F.lit(0), "n_words", F.lit(1), "tid"))
    found = components(line_links(texts, lines, percent))
    again = units.where(f"n_words >= {MIN_WORDS}").groupBy("kind", "key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("kind", "key")
    keys = materialize(again.union(found.select(F.lit(0), "v")).distinct())
    placed = units.join(_sized(keys), ["kind", "key"], "left_semi").join(found.select(F.lit(0).alias("kind"), F.col("v").alias("key"), "component"), ["kind", "key"], "left")
    placed = placed.select("doc_id", F.col("first_word").cast("long").alias("first_word"), "n_words", "kind", F.coalesce("component", "key").alias("component"))
    # a text's passages times its copies would grow with the square of a group, so copies are counted
    copies = marks.select("doc_id", "tid").distinct().groupBy("tid").agg(F.min("doc_id").alias("doc_id"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n_docs"))
    inside = passages(texts, marks, percent).join(copies, "tid").groupBy("doc_id", "first_word", "n_words", "component")
    inside = inside.agg(F.max("last").alias("last"), (F.sum("n_docs") - F.count(F.lit(1)) + 1).alias("n_docs"))  # versions of a document are one
    inside = inside.select("doc_id", "first_word", F.col("n_words").cast("int").alias("n_words"), F.lit(1).alias("kind"), "component", "last", "n_docs")
    placed = spill(placed.select("*", F.col("doc_id").alias("last"), F.lit(1).cast("long").alias("n_docs")).union(inside), "para-placed")
    drop_path(docs.sparkSession, path)
    place = F.struct("doc_id", "first_word", "n_words")
    groups = placed.groupBy("kind", "component").agg(F.min("doc_id").alias("component_id"), F.max("last").alias("last"), F.min(place).alias("stays"), F.sum("n_docs").alias("n_places")).where("component_id < last").drop("last")
    rows = placed.join(groups, ["kind", "component"])
    return rows.select("doc_id", "first_word", "n_words", "kind", "component_id", "n_places", (place == F.col("stays")).alias("kept"))


def op5_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(read(spark, sf_dir, "documents"))
