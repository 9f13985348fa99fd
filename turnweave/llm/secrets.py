"""Secret scans: patterns of known kinds, and character Markov models for the rest.

Three patterns find secrets by their surroundings or form.  What they can't know is told by
two first-order Markov models over characters, one of random strings and one of ordinary
identifiers: a token's log-likelihood ratio is the sum over its transitions of
log P(b | a, random) - log P(b | a, ordinary), and a token is a secret when that exceeds the
log of the odds against one, so that longer tokens need less evidence a character.

``train`` counts transitions over labelled samples, of which there can be any number.  Samples
of a corpus come from ``labelled``: what the patterns find is random, the other tokens of at
most ``max_docs`` documents, drawn by the hash of their ids and read whole, are ordinary.  As
few corpora have secrets of all alphabets, ``random_samples`` adds made ones.

A scan is one pass without a shuffle over whole texts.  Positions are code points.

Nulls and edges: a null text is empty; a text without secrets has the digest of an empty
string.  Tokens are the longest runs of ASCII letters, digits and ``+/_=-``; only those of
``MIN_TOKEN`` characters and more with a letter that touch no span of a pattern are weighed.
Repeated rows give equal rows.  Without samples both models are flat, and no token is added.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_limits, read

KINDS = ("assign", "access", "hex", "markov")
#: Marked letters count in either case; the other two kinds don't.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
KEYWORDS = re.compile(r"passw|secret|token|api_?key", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
MIN_VALUE = 8
MIN_TOKEN = 16
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_TOKEN)
SAMPLE_TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{4,}")
LETTER = re.compile(r"[A-Za-z]")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
_CODE = np.full(128, len(ALPHABET), np.int64)
_CODE[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))
STATES = len(ALPHABET) + 1

#: Against one token in a million being a secret.
ODDS = 1e6
MAX_DOCS = 20_000


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """``(start, kind, end, value)`` of the patterns' matches, by start and kind."""
    out = []
    if KEYWORDS.search(text):
        # short values are dropped only after the match, which they end
        out += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    # a run that is too short has no longer one inside, so these find the runs of the open patterns
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(out)


def _free(text: str, spans: list[tuple[int, int, int, str]], pattern: re.Pattern[str]) -> Iterator[re.Match[str]]:
    """Matches that touch none of the spans."""
    i, reach = 0, 0
    for m in pattern.finditer(text):
        while i < len(spans) and spans[i][0] < m.end():
            reach = max(reach, spans[i][2])
            i += 1
        if reach <= m.start():
            yield m


def transitions(token: str) -> np.ndarray:
    """Numbers of the pairs of consecutive characters."""
    c = _CODE[np.frombuffer(token.encode("ascii", "replace"), np.uint8)]
    return c[:-1] * STATES + c[1:]


class Models:
    """Log-likelihood ratios of all transitions; counts are (2, STATES * STATES): ordinary, random."""

    def __init__(self, counts: np.ndarray) -> None:
        n = counts.reshape(2, STATES, STATES) + 1.0
        p = np.log(n / n.sum(2, keepdims=True))
        self.ratio = (p[1] - p[0]).reshape(-1)

    def score(self, token: str) -> float:
        return float(self.ratio[transitions(token)].sum())


def random_samples(n: int = 2_000, seed: int = 13) -> list[tuple[str, int]]:
    """Random strings over the alphabets keys are written in, all labelled 1."""
    rng = random.Random(seed)
    upper, lower, digits = ALPHABET[:26], ALPHABET[26:52], ALPHABET[52:62]
    kinds = ["0123456789abcdef", "0123456789ABCDEF", upper + "234567", upper + digits, lower + digits, upper + lower + digits, upper + lower + digits + "+/", upper + lower + digits + "-_"]
    return [("".join(rng.choices(kinds[i % len(kinds)], k=rng.randint(16, 64))), 1) for i in range(n)]


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tokens: list[str] = []
        labels: list[int] = []
        for text in batch.column(0).to_pylist():
            spans = base_spans(text or "")
            tokens += [s[3] for s in spans]
            labels += [1] * len(spans)
            plain = [m[0] for m in _free(text or "", spans, SAMPLE_TOKEN)]
            tokens += plain
            labels += [0] * len(plain)
        yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.string()), pa.array(labels, pa.int32())], names=["text", "label"])


def labelled(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", max_docs: int = MAX_DOCS) -> DataFrame:
    """Distinct ``text, label`` of the tokens of about ``max_docs`` documents: 1 where a pattern found them."""
    arrow_limits(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    share = int(min(1.0, max_docs / max(1, rows.count())) * (1 << 20)) + 1
    drawn = rows.where(F.pmod(F.xxhash64("i"), F.lit(1 << 20)) < share).select("t")
    return drawn.mapInArrow(_labelled, "text string, label int").distinct()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, STATES * STATES), np.int64)
    for batch in batches:
        for token, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if token is not None and label in (0, 1):
                total[label] += np.bincount(transitions(token), minlength=STATES * STATES)
    label, pair = np.nonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(pair, pa.int32()), pa.array(total[label, pair])], names=["label", "pair", "n"])


def train(samples: DataFrame) -> Models:
    """Models from labelled samples ``text, label`` (1: random); null ones are left out."""
    arrow_limits(samples.sparkSession)
    counts = samples.select("text", F.col("label").cast("int").alias("label")).mapInArrow(_count, "label int, pair int, n long").groupBy("label", "pair").agg(F.sum("n").alias("n"))
    table = np.zeros((2, STATES * STATES))
    for r in counts.collect():  # two rows for each pair of characters
        table[r["label"], r["pair"]] = r["n"]
    return Models(table)


def joined(spans: list[tuple]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{z}" for a, k, z, *_ in spans)


def spans_of(text: str, models: Models, least: float) -> tuple[list[tuple], list[tuple]]:
    """The patterns' spans, and all spans."""
    base = base_spans(text)
    more = [(m.start(), 3, m.end(), m[0]) for m in _free(text, base, TOKEN) if LETTER.search(m[0]) and models.score(m[0]) > least]
    return base, sorted(base + more)


def _scan(batches: Iterator[pa.RecordBatch], models: Models, least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[] for _ in range(6)]
        for text in batch.column(1).to_pylist():
            base, every = spans_of(text or "", models, least)
            n = [sum(s[1] == k for s in every) for k in range(4)]
            row = [*n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)]
            for x, y in zip(out, row, strict=True):
                x.append(y)
        kinds = [pa.int64()] * 4 + [pa.string()] * 2
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, k) for x, k in zip(out, kinds, strict=True))], names=["doc_id", "n_assign", "n_access", "n_hex", "n_markov", "base_sha256", "spans"])


def scan(docs: DataFrame, models: Models, *, id_col: str = "doc_id", text_col: str = "text", odds: float = ODDS) -> DataFrame:
    """Each document's spans: counts by kind, digest of the patterns' spans, all spans."""
    spark = docs.sparkSession
    arrow_limits(spark)
    sent = spark.sparkContext.broadcast(models)  # STATES * STATES numbers
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        lambda it: _scan(it, sent.value, log(odds)), "doc_id long, n_assign long, n_access long, n_hex long, n_markov long, base_sha256 string, spans string"
    )


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, with models trained on its patterns' finds and made strings."""
    docs = read(spark, sf_dir, "documents")
    made = spark.createDataFrame(random_samples(), "text string, label int")
    return scan(docs, train(labelled(docs).unionByName(made)))
