"""Hierarchical language identification.

First the family is predicted, by linear support vector machines one against the rest;
then, within it, a linear machine for each pair of languages votes (one against one, ties by
the sum of margins).  Features are hashed byte n-grams (1 to 4) of the whole text, with
A-Z lowered and everything that is neither an ASCII letter nor part of a longer character
as one space.  Scoring is a gather and a sum over NumPy arrays, so its cost is a few
nanoseconds for each byte, and texts are measured in pieces: memory stays bounded.

The sample is bounded: about ``per_language`` texts of each language, by hash, and ``most_texts`` of all
(but 20 of each), read whole; of each language as many as have its share of ``sample_bytes`` bytes.
Every language present is learnt; over ``MAX_LANGUAGES`` are an error.  The score is the family's calibrated probability times the
weakest pair's.

Nulls and edges: ``und`` with score 0 for null texts and texts without a letter, and where
there is nothing to learn from.  A null id is never learnt from and never held out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_limits, read, text_buffers, whole_texts

#: Families of language codes; a code that isn't listed is a family of its own.
FAMILIES = {
    "romance": "ca es fr gl it la oc pt ro",
    "germanic": "af da de en fy is lb nl no nb nn sv yi",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tt uz",
    "indo-aryan": "bn gu hi mr ne pa ur",
    "cjk": "ja ko zh",
}
FAMILY_OF = {code: name for name, codes in FAMILIES.items() for code in codes.split()}
BITS = 14
ORDERS = (1, 2, 3, 4)
PIECE = 1 << 18
LETTER = re.compile(r"[^\W\d_]")
MAX_LANGUAGES = 1000

_MAP = np.full(256, 0x20, dtype=np.uint8)
_MAP[0x61:0x7B] = np.arange(0x61, 0x7B)
_MAP[0x41:0x5B] = np.arange(0x61, 0x7B)
_MAP[0x80:] = np.arange(0x80, 0x100)
_K = np.random.default_rng(524_287).integers(1, 2**32, size=8, dtype=np.uint32) | np.uint32(1)


def grams(raw: np.ndarray) -> Iterator[np.ndarray]:
    """For each order, the feature of the n-gram that begins at each byte."""
    b = _MAP[raw].astype(np.uint32)
    h = np.zeros(len(b), dtype=np.uint32)
    for n in ORDERS:
        if len(b) < n:
            return
        h = (h[: len(b) - n + 1] ^ (b[n - 1 :] * _K[n])) * np.uint32(0x9E3779B1)
        yield (h ^ np.uint32(n)) * np.uint32(0x85EBCA6B) >> np.uint32(32 - BITS)


def counts(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    out = np.zeros(1 << BITS, dtype=np.float32)
    for g in grams(raw):
        out += np.bincount(g, minlength=1 << BITS).astype(np.float32)
    return out


def svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, rounds: int = 30) -> np.ndarray:
    """Linear machine with squared hinge loss and no intercept, by dual coordinate descent."""
    alpha, w = np.zeros(len(x)), np.zeros(x.shape[1])
    norms = np.einsum("ij,ij->i", x, x) + 1 / (2 * c)
    rng = np.random.default_rng(1)
    for _ in range(rounds):
        largest = 0.0
        for i in rng.permutation(len(x)):
            g = y[i] * (x[i] @ w) - 1 + alpha[i] / (2 * c)
            new = max(0.0, alpha[i] - g / norms[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                largest = max(largest, abs(new - alpha[i]))
                alpha[i] = new
        if largest < 1e-3:
            break
    return w


def _calibrated(m: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve over margins."""
    s = float(np.abs(m).mean()) or 1.0
    a, b = 2.0 / s, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * m + b, -30, 30)))
        r, v = p - (y > 0), p * (1 - p) + 1e-6
        g = np.array([(r * m).sum() + 1e-2 * (a - 2.0 / s) * s * s, r.sum() + 1e-2 * b])
        h = np.array([[(v * m * m).sum() + 1e-2 * s * s, (v * m).sum()], [(v * m).sum(), v.sum() + 1e-2]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
    return max(a, 0.1 / s), b


class Model:
    """``weights``: a column for each family, then for each pair of languages."""

    def __init__(self, texts: list[str], langs: list[str]) -> None:
        self.langs = sorted(set(langs))
        self.family = {x: FAMILY_OF.get(x.lower().split("-")[0], x) for x in self.langs}
        self.families = sorted(set(self.family.values()))
        self.pairs = [p for f in self.families for p in combinations([x for x in self.langs if self.family[x] == f], 2)]
        if not self.langs:
            return
        x = np.stack([counts(t) for t in texts])
        x /= np.maximum(x.sum(1, keepdims=True), 1)
        scale = 1 / np.sqrt(x.mean(0) + 1e-6)
        x *= scale
        norm = np.linalg.norm(x, axis=1) + 1e-12
        x /= norm[:, None]
        lang = np.array(langs)
        fam = np.array([self.family[v] for v in langs])
        columns, curves = [], []

        def learn(rows: np.ndarray, y: np.ndarray) -> None:
            w = svm(x[rows], y)
            columns.append((w * scale).astype(np.float32))
            curves.append(_calibrated((x[rows] @ w) * norm[rows], y))

        for f in self.families if len(self.families) > 1 else []:
            learn(np.arange(len(x)), np.where(fam == f, 1.0, -1.0))
        for a, b in self.pairs:
            rows = np.flatnonzero((lang == a) | (lang == b))
            learn(rows, np.where(lang[rows] == a, 1.0, -1.0))
        self.weights = np.stack(columns, axis=1) if columns else np.zeros((1 << BITS, 0), np.float32)
        self.curves = np.array(curves).reshape(-1, 2)

    def margins(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean weight of each row's n-grams."""
        out = np.zeros((len(offsets) - 1, self.weights.shape[1]))
        n = np.zeros(len(out))
        row = 0
        while row < len(out):
            last = min(max(int(np.searchsorted(offsets, offsets[row] + PIECE, side="right")) - 1, row + 1), len(out))
            a, z = int(offsets[row]), int(offsets[last])
            if z - a > PIECE:  # one long text; each n-gram belongs to the piece in which it begins
                for p in range(a, z, PIECE):
                    for g in grams(raw[p : min(z, p + PIECE + max(ORDERS) - 1)]):
                        g = g[:PIECE]
                        out[row] += self.weights[g].sum(0, dtype=np.float64)
                        n[row] += len(g)
            else:
                edges = offsets[row : last + 1] - a
                for k, g in enumerate(grams(raw[a:z])):
                    starts = np.minimum(edges[:-1], len(g))
                    ends = np.maximum(np.minimum(edges[1:] - ORDERS[k] + 1, len(g)), starts)
                    sums = np.concatenate((np.zeros((1, out.shape[1])), np.cumsum(self.weights[g], axis=0, dtype=np.float64)))
                    out[row:last] += sums[ends] - sums[starts]
                    n[row:last] += ends - starts
            row = last
        return out / np.maximum(n, 1)[:, None]

    def predict(self, col: pa.Array) -> tuple[list[str], np.ndarray]:
        some = np.array([t is not None and LETTER.search(t) is not None for t in col.to_pylist()], dtype=bool)
        if not self.langs or not len(some):
            return ["und"] * len(some), np.zeros(len(some))
        m = self.margins(*text_buffers(col))
        p = 1 / (1 + np.exp(-np.clip(m * self.curves[:, 0] + self.curves[:, 1], -30, 30))) if len(self.curves) else m
        k = len(self.families) if len(self.families) > 1 else 0
        fam = p[:, :k].argmax(1) if k else np.zeros(len(m), dtype=int)
        pred, score = np.full(len(m), "und", dtype=object), np.zeros(len(m))
        for f, name in enumerate(self.families):
            rows = np.flatnonzero((fam == f) & some)
            own = [x for x in self.langs if self.family[x] == name]
            at = {x: i for i, x in enumerate(own)}
            votes, sure = np.zeros((len(rows), len(own))), np.ones((len(rows), len(own)))
            for j, (a, b) in enumerate(self.pairs):
                if a in at:
                    q = p[rows, k + j]
                    votes[:, at[a]] += (q >= 0.5) + 1e-3 * q
                    votes[:, at[b]] += (q < 0.5) + 1e-3 * (1 - q)
                    sure[:, at[a]] = np.minimum(sure[:, at[a]], q)
                    sure[:, at[b]] = np.minimum(sure[:, at[b]], 1 - q)
            best = votes.argmax(1)
            pred[rows] = np.array(own, dtype=object)[best]
            score[rows] = sure[np.arange(len(rows)), best] * (p[rows, f] if k else 1.0)
        return pred.tolist(), score


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 400, most_texts: int = 8000, sample_bytes: int = 32 << 20) -> Model:
    """Fits on rows with a language whose id isn't held out."""
    usable = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 != 2))
    sizes = {r[0]: r[1] for r in usable.groupBy(lang_col).count().limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"over {MAX_LANGUAGES} languages")
    if not sizes:
        return Model([], [])
    most = max(20, min(per_language, most_texts // len(sizes)))
    draw = F.pmod(F.xxhash64(id_col), F.lit(1 << 20)) / float(1 << 20)
    share = F.create_map(*(F.lit(v) for x, n in sizes.items() for v in (x, min(1.0, most / n))))
    rows = usable.where(draw < share[F.col(lang_col)]).select(F.col(id_col).alias("i"), F.col(lang_col).alias("y"), F.col(text_col).alias("t"))
    texts = [(y, t) for _, y, t in whole_texts(rows, "y", max(1, sample_bytes // len(sizes))) if LETTER.search(t)]
    return Model([t for _, t in texts], [y for y, _ in texts])


def identify(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        pred, score = model.predict(pa.Array.from_pandas(texts, type=pa.large_string()))
        return pd.DataFrame({"lang_pred": pred, "score": score})

    return docs.withColumn("_p", predict(text_col)).select(*docs.columns, "_p.lang_pred", "_p.score")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrow_limits(spark)
    docs = read(spark, sf_dir, "documents")
    model = train(docs)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
