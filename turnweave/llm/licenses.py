"""License scans by an exact set-similarity join.

Every text is cut into blocks: its lines, and windows of ``BLOCK`` words that overlap by half over its
whole word sequence, so that wording that runs over line ends is in one block too.  A block matches a license template when it contains at least ``CONTAIN``
of the template's distinct tokens.  The join is exact and never forms all pairs:

* tokens are ordered by how often they occur in the whole corpus, rarest first;
* prefix filter: a match must hold one of a template's first |T| - need + 1 tokens, where
  need = ceil(CONTAIN |T|), so only blocks with such a token are looked at;
* length filter: the block must have at least ``need`` of the template vocabulary's tokens;
* positional filter: tokens before the first common one can't be common, which bounds the
  overlap from the positions on both sides.

The templates are a short fixed list; they and the frequencies of their tokens are all that
is sent to the executors.  Fixed phrases are found beside it, anywhere in the word sequence.

Nulls and edges: null and empty texts have no words, places or labels, and score 0.  Repeated rows give equal
rows; extra columns play no part; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_limits, read

TOKEN = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLOCK = 64
CONTAIN = 0.9

PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Wordings by which texts name their license; at most BLOCK / 2 tokens each.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at apache org"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "licensed under the bsd 3 clause license"),
    ("gpl-2", "gnu general public license version 2"),
    ("gpl-3", "gnu general public license version 3"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nd", "licensed under cc by nd 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "cc0 1 0 universal public domain dedication"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("proprietary", "all rights reserved no part of this publication may be reproduced"),
]


def tokens(line: bytes) -> list[bytes]:
    return TOKEN.findall(line)


class Join:
    """Templates ordered and indexed for blocks."""

    def __init__(self, templates: list[tuple[str, str]], counts: dict[bytes, int], contain: float) -> None:
        sets = [(label, set(tokens(text.encode()))) for label, text in templates]
        vocabulary = set().union(*(s for _, s in sets)) if sets else set()
        self.rank = {t: i for i, t in enumerate(sorted(vocabulary, key=lambda t: (counts.get(t, 0), t)))}
        self.templates = [(label, sorted(self.rank[t] for t in s), max(1, ceil(contain * len(s) - 1e-9))) for label, s in sets]
        self.index: dict[int, list[int]] = {}
        for k, (_, order, need) in enumerate(self.templates):
            for r in order[: len(order) - need + 1]:
                self.index.setdefault(r, []).append(k)
        names = sorted(self.rank, key=self.rank.get)
        self.first = frozenset(names[r] for r in self.index)

    def matches(self, block: list[bytes]) -> list[tuple[int, float]]:
        """(template, containment) of every template that the block contains."""
        rank = self.rank
        own = sorted({rank[t] for t in block if t in rank})
        seen: set[int] = set()
        out = []
        for j, r in enumerate(own):
            for k in self.index.get(r, ()):
                if k in seen:
                    continue
                seen.add(k)  # r is the rarest token that both have
                _, order, need = self.templates[k]
                if len(own) < need:
                    continue
                i = order.index(r)
                if 1 + min(len(order) - i - 1, len(own) - j - 1) < need:
                    continue
                common = len(set(order[i:]).intersection(own[j:]))
                if common >= need:
                    out.append((k, common / len(order)))
        return out


def blocks(lines: list[list[bytes]], words: list[bytes]) -> Iterator[list[bytes]]:
    """Short lines, and windows over all words; a line above half a window is in windows whole or in parts."""
    if len(lines) > 1:
        for w in lines:
            if w and len(w) <= BLOCK:
                yield w
    for i in range(0, max(1, len(words) - BLOCK // 2), BLOCK // 2):
        yield words[i : i + BLOCK]


def phrase_places(words: list[bytes]) -> list[tuple[int, bytes]]:
    """(first word, phrase) of each place of a fixed phrase."""
    row = b" " + b" ".join(words) + b" "
    out = []
    for phrase in PHRASES:
        p = b" " + phrase.encode() + b" "
        at = row.find(p)
        while at >= 0:
            out.append((row.count(b" ", 0, at), phrase.encode()))
            at = row.find(p, at + 1)
    return out


def scan_text(text: str | None, join: Join) -> tuple:
    lines = [tokens(line) for line in (text or "").encode().lower().split(b"\n")]
    words = [w for line in lines for w in line]
    places = phrase_places(words)
    base = {PHRASES[p.decode()] for _, p in places}
    found, score, hit_blocks = set(base), 1.0 if base else 0.0, 0
    if not join.first.isdisjoint(words):
        for block in blocks(lines, words):
            if join.first.isdisjoint(block):
                continue
            hits = join.matches(block)
            hit_blocks += bool(hits)
            for k, share in hits:
                found.add(join.templates[k][0])
                score = max(score, share)
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(found)), score, hit_blocks)


_FIELDS = (("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("n_blocks", pa.int64()))


def _scan(batches: Iterator[pa.RecordBatch], join: Join) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [scan_text(t.as_py(), join) for t in batch.column(1)]
        cols = [pa.array([r[i] for r in rows], type=t) for i, (_, t) in enumerate(_FIELDS)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=["id", *(n for n, _ in _FIELDS)])


def _count(batches: Iterator[pa.RecordBatch], vocabulary: frozenset[bytes]) -> Iterator[pa.RecordBatch]:
    total: Counter = Counter()
    for batch in batches:
        for t in batch.column(0):
            total.update(filter(vocabulary.__contains__, tokens((t.as_py() or "").encode().lower())))
    yield pa.RecordBatch.from_arrays([pa.array([k.decode() for k in total], type=pa.string()), pa.array(list(total.values()), type=pa.int64())], names=["token", "n"])


def license_scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] = TEMPLATES, contain: float = CONTAIN) -> DataFrame:
    """One row per row of ``docs``: ``id``, word and place counts, labels and score (the
    largest containment found; 1 where a fixed phrase stands)."""
    arrow_limits(docs.sparkSession)
    vocabulary = frozenset(t for _, text in templates for t in tokens(text.encode()))
    counted = docs.select(text_col).mapInArrow(lambda it: _count(it, vocabulary), "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    join = Join(templates, {r["token"].encode(): r["n"] for r in counted.collect()}, contain)  # a row for each token of the templates at most
    schema = "id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, n_blocks long"
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(lambda it: _scan(it, join), schema)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
