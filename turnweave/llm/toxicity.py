"""Toxicity by compression distance.

Two zstandard dictionaries are made from labelled text: one of ordinary words, and one
that adds to these the words by which toxic texts differ.  A text is cut into windows of
one word each; a window's distance is the number of bytes by which the toxic dictionary
compresses it better than the ordinary one.  The largest distances of a text, the shares
of windows beyond several thresholds and its length go through a logistic calibration
fitted on labelled texts that the dictionaries used for it haven't seen.

Short windows leave a general compressor little to save, so every byte is first written as
a code of ``CODE`` bytes: a match of a few letters then pays for its own description, and
lengths differ by several bytes instead of one.  As a window's distance depends on the word
alone, each task keeps the distances of up to ``MEMO`` words.

The sample is bounded: at most ``max_positive`` toxic and ``max_negative`` ordinary texts, by hash
order, each read whole; of either kind as many as have ``sample_bytes`` bytes together.  Scoring reads
whole texts.

Nulls and edges: null and empty texts have no window and get the calibrated score of a text
without any distance.  Without both labels the score is the share of toxic labels (0 with
none).  Labels that are null are not learnt; repeated rows of an id and text count once.  A null id
is never learnt from and never held out.  Extra columns play no part.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import zstandard as zstd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import any_columns, arrow_limits, read, whole_texts

STRIP = " .,;:!?|*$%&#()[]{}<>\"'`~_-+=/\\"
LEVEL, CODE, MEMO = 9, 4, 400_000
THRESHOLD = 0.3
#: A word beginning is toxic if LEAST toxic texts have it and the bound SURE deviations below its ratio is over BAR.
LEAST, SURE, BAR = 3, 1.64, 6
STEPS = (2, 4, 6, 8, 10, 12)
_rng = np.random.default_rng(131_071)
_CODES = [bytes(_rng.integers(1, 256, size=CODE, dtype=np.uint8)) for _ in range(256)]


def wide(word: str) -> bytes:
    return b"".join([_CODES[b] for b in f" {word} ".encode()])


def words_of(text: str) -> list[str]:
    return [w.strip(STRIP) for w in text.lower().split()]


@dataclass
class Compressors:
    """What a task needs to measure words; built once in each Python worker."""

    toxic: bytes
    plain: bytes
    memo: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        def ready(content: bytes):
            d = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            return zstd.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False).compress

        self.with_plain, self.with_toxic = ready(self.plain), ready(self.toxic)

    def distances(self, text: str) -> np.ndarray:
        memo, out = self.memo, []
        if len(memo) > MEMO:
            memo.clear()
        for w in words_of(text):
            d = memo.get(w)
            if d is None:
                x = wide(w)
                d = memo[w] = len(self.with_plain(x)) - len(self.with_toxic(x))
            out.append(d)
        return np.asarray(out, dtype=np.float64)


def features(d: np.ndarray) -> list[float]:
    if not len(d):
        return [0.0] * (5 + 2 * len(STEPS))
    top = np.sort(d)[::-1][:3]
    top = np.concatenate((top, np.zeros(3 - len(top))))
    counts = [float((d >= s).sum()) for s in STEPS]
    return [*(top / 8), float(np.clip(d, 0, None).mean()), float(np.log1p(len(d)) / 5), *(float(np.log1p(c)) for c in counts), *(20 * c / len(d) for c in counts)]


@dataclass
class Model:
    toxic: bytes
    plain: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    rate: float | None = None  # the score where nothing could be learnt

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.rate is not None:
            return np.full(len(x), self.rate)
        z = (x - self.mean) / self.scale @ self.weights[1:] + self.weights[0]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _distinct(texts: list[str]) -> list[str]:
    """Without near copies, whose words would else seem frequent: a text goes if one of
    three smallest shingle hashes has been seen."""
    seen: set[tuple[int, int]] = set()
    out = []
    for t in texts:
        w = t.lower().split()
        h = np.fromiter((zlib.crc32(" ".join(w[i : i + 4]).encode()) for i in range(max(1, len(w) - 3))), dtype=np.uint32)
        keys = [(j, int((h * np.uint32(m)).min())) for j, m in enumerate((1, 0x9E3779B1, 0x85EBCA6B))]
        if not any(k in seen for k in keys):
            out.append(t)
        seen.update(keys)
    return out


class Counts:
    """How many texts have each word beginning, and how often each word occurs."""

    def __init__(self, texts: list[str] = ()) -> None:
        self.n, self.starts, self.words = len(texts), Counter(), Counter()
        for t in texts:
            w = words_of(t)
            self.words.update(w)
            self.starts.update({x[:k] for x in set(w) for k in range(3, min(len(x), 8) + 1)})

    def __add__(self, other: Counts) -> Counts:
        out = Counts()
        out.n, out.starts, out.words = self.n + other.n, self.starts + other.starts, self.words + other.words
        return out


def dictionaries(positive: Counts, negative: Counts, *, words: int = 400, base: int = 300, stems: int = 200) -> tuple[bytes, bytes]:
    """Contents of the toxic and the ordinary dictionary.

    Word beginnings that are surely ``BAR`` times as frequent among toxic texts, by a lower
    confidence bound whatever the number of texts, name the words that the toxic dictionary
    gets; the likeliest come last, nearest to what is compressed.
    """
    a, b = positive.starts, negative.starts
    na, nb = positive.n + 1, negative.n + 1
    ratio = {k: (a[k] + 0.2) / na * nb / (b[k] + 0.5) for k in a if a[k] >= LEAST}
    # the spread of a logarithm of two counts' ratio
    sure = lambda k, r: np.log(r) - SURE * np.sqrt(1 / (a[k] + 0.2) + 1 / (b[k] + 0.5)) > np.log(BAR)
    ranked = sorted((k for k, r in ratio.items() if sure(k, r)), key=lambda k: (-a[k] * np.log(ratio[k]), k))
    chosen: list[str] = []
    for k in ranked:
        if not any(k.startswith(x) for x in chosen):
            chosen = [x for x in chosen if not x.startswith(k)] + [k]
        if len(chosen) >= stems:
            break
    found = {w: n for w, n in positive.words.items() if w.startswith(tuple(chosen))} if chosen else {}
    pick = lambda c, n: [w for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:n]][::-1]
    common = b"".join(wide(w) for w in pick(negative.words, base)) or wide("the")
    return b"".join(wide(w) for w in pick(found, words)) + common, common


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = np.hstack([np.ones((len(x), 1)), (x - mean) / scale])
    w = np.zeros(z.shape[1])
    penalty = np.full(z.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (p - y) + penalty * w
        h = (z * (p * (1 - p) + 1e-6)[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, w


def fit(positive: list[str], negative: list[str], folds: int = 3) -> Model:
    """Dictionaries from all texts; the calibration from the features that each fold gets
    from the dictionaries of the others."""
    n = len(positive) + len(negative)
    if not positive or not negative:
        return Model(b"", b"", np.zeros(0), np.zeros(0), np.zeros(0), rate=len(positive) / n if n else 0.0)
    positive, negative = _distinct(positive), _distinct(negative)
    parts = [(positive[f::folds], negative[f::folds]) for f in range(folds)]
    counted = [(Counts(p), Counts(q)) for p, q in parts]
    whole = lambda side, skip=-1: sum((c[side] for f, c in enumerate(counted) if f != skip), Counts())
    x, y = [features(np.zeros(0))], [0.0]
    for f, (p, q) in enumerate(parts):
        # with texts too few to leave any out, all are used
        own = [whole(side, f) if whole(side, f).n else whole(side) for side in (0, 1)]
        c = Compressors(*dictionaries(*own))
        for label, texts in ((1.0, p), (0.0, q)):
            x += [features(c.distances(t)) for t in texts]
            y += [label] * len(texts)
    mean, scale, w = _logistic(np.array(x), np.array(y))
    return Model(*dictionaries(whole(0), whole(1)), mean, scale, w)


def remainder(id_col: str):
    """crc32 of the id as text, modulo 4."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_positive: int = 1500, max_negative: int = 3000, sample_bytes: int = 16 << 20) -> Model:
    """Fits on labelled rows whose id isn't held out."""
    learnt = labels.where(F.col(label_col).isNotNull() & (remainder(id_col) != 2)).select(id_col, F.col(label_col).cast("int").alias("_y"))

    def sample(y: int, most: int) -> DataFrame:
        return learnt.where(F.col("_y") == y).orderBy(F.xxhash64(id_col), id_col).limit(most)

    chosen = sample(1, max_positive).union(sample(0, max_negative))
    rows = docs.select(id_col, F.col(text_col).alias("t")).join(F.broadcast(chosen), id_col).select(F.col(id_col).alias("i"), F.col("_y").alias("y"), "t")
    texts = whole_texts(rows, "y", sample_bytes)
    return fit([t for _, y, t in texts if y == 1], [t for _, y, t in texts if y == 0])


def scorer(model: Model):
    """A column function: text to score."""

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = Compressors(model.toxic, model.plain) if model.rate is None else None
        for texts in parts:
            if c is None:
                yield pd.Series(np.full(len(texts), model.rate))
            else:
                yield pd.Series(model.score(np.array([features(c.distances(t if isinstance(t, str) else "")) for t in texts]).reshape(len(texts), -1)) if len(texts) else np.zeros(0))

    return score


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrow_limits(spark)
    docs = read(spark, sf_dir, "documents")
    model = train(docs, read(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", F.coalesce(remainder("doc_id") == 2, F.lit(False)).alias("held_out"), scorer(model)("text").alias("score"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


@any_columns
def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents below the threshold, with their own columns; repeated rows and rows without an id are
    judged like others.  Without labels of both kinds nothing can be told, and all documents stay."""
    arrow_limits(spark)
    model = train(docs, read(spark, sf_dir, "labels"))
    if model.rate is not None:
        return docs
    return docs.withColumn("_score", scorer(model)("text")).where(F.col("_score") < THRESHOLD).select(*docs.columns)
