"""The pipeline's stages, each on what its predecessor kept."""

import itertools
import random
import re
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from turnweave.llm import toxicity


def test_stages(spark, tmp_path):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]
    model = toxicity.train(docs, spark.read.parquet(f"{d}/labels.parquet"))
    last = None
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, d)
        if name != "packing":
            assert out.columns == columns
        path = str(tmp_path / str(k))
        out.write.parquet(path)
        new = spark.read.parquet(path)
        if name == "toxicity":
            rejected = docs.select("doc_id", toxicity.scorer(model)("text").alias("s")).where(f"s >= {toxicity.THRESHOLD}").count()
            assert new.count() == docs.count() - rejected
        elif name in ("exact_dedup", "near_dedup"):
            assert new.join(docs, "doc_id", "left_anti").count() == 0 and new.count() <= docs.count()
        elif name == "mixing":
            words = lambda df: df.selectExpr("sum(regexp_count(text, '[^\\\\x20\\\\x09-\\\\x0D]+')) as n").first().n
            assert abs(words(new) / words(docs) - 1) < 0.05
        else:
            assert new.selectExpr("sum(n_words) as n").first().n == docs.selectExpr("sum(regexp_count(text, '[^\\\\x20\\\\x09-\\\\x0D]+')) as n").first().n
        last = docs = new
    assert last.count() > 0


def test_run(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0


#: Names that the stages use inside, as columns of the input.
CLASHES = ["_score", "_copy", "_at", "_p", "_m", "_n", "_g", "_whole", "at", "copies", "kept", "id", "print", "piece", "length", "a.b", "Further1__"]
SYLLABLES = ["".join(p) for p in itertools.product("bcdfg", "aeiou", ("lan", "men", "ris", "so"))]
TOXIC = "you are a worthless stupid idiot and everyone hates you"


def prose(rng, n):
    return " ".join(rng.choice(SYLLABLES) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def clashing(spark, tmp_path_factory):
    """A few documents with clashing columns, null ids, repeated rows, null and empty texts; some labels."""
    rng = random.Random(3)
    texts = [prose(rng, 60) for _ in range(40)]
    texts += [f"{prose(rng, 20)} {TOXIC} {prose(rng, 20)}" for _ in range(24)]
    texts += [texts[0], texts[1].replace(" ", "  "), " ".join([*texts[2].split(" ")[:-1], "other"]), None, "", " \n"]
    rows = [(i, t, "en", ["a", "b", None][i % 3], None, *[f"{n}{i}" for n in CLASHES]) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, texts[6], None, None, None, *CLASHES), (None, "a text of its own without an id", None, None, None, *CLASHES)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in CLASHES)
    d = str(tmp_path_factory.mktemp("clashing"))
    docs = spark.createDataFrame(rows, schema)
    docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, int(40 <= i < 64)) for i in range(64)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d, spark.read.schema(docs.schema).parquet(f"{d}/documents.parquet"), rows


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 4]) for i in range(len(w) - 3)) if len(w) > 3 else frozenset([tuple(w)] if w else [])


def test_stages_against_plain_versions(spark, clashing):
    d, docs, rows = clashing
    stage = dict(corpus_pipeline.STAGES)
    as_rows = lambda df: Counter(tuple(r) for r in df.collect())

    model = toxicity.train(docs, spark.read.parquet(f"{d}/labels.parquet"))
    c = toxicity.Compressors(model.toxic, model.plain)
    score = lambda t: model.score(np.array([toxicity.features(c.distances(t or ""))]))[0]
    out = stage["toxicity"](spark, docs, d)
    assert out.columns == docs.columns
    assert as_rows(out) == Counter(r for r in rows if score(r[1]) < toxicity.THRESHOLD)

    out = stage["exact_dedup"](spark, docs, d)
    assert out.columns == docs.columns
    got = as_rows(out)
    bare = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = {}
    for r in rows:
        groups.setdefault(bare(r[1]), []).append(r)
    assert sum(got.values()) == len(groups) and {bare(r[1]) for r in got} == set(groups)
    for r in got:
        assert len(r[1] or "") == max(len(x[1] or "") for x in groups[bare(r[1])])

    out = stage["near_dedup"](spark, docs, d)
    assert out.columns == docs.columns
    named = {r[0]: shingles(r[1]) for r in rows if r[0] is not None}
    like = lambda a, b: bool(a and b) and 100 * len(a & b) >= 80 * len(a | b)
    first = {i: i for i in named}
    for _ in named:
        for i in named:
            for j in named:
                if like(named[i], named[j]):
                    first[i] = first[j] = min(first[i], first[j])
        if all(first[i] == first[j] for i in named for j in named if like(named[i], named[j])):
            break
    kept = [r for r in out.collect() if r.doc_id is not None]
    assert {r.doc_id for r in kept} == {i for i in named if first[i] == i}
    assert [r.text for r in out.where("doc_id is null").collect()] == ["a text of its own without an id"]

    out = stage["mixing"](spark, docs, d)
    assert out.columns == docs.columns
    took = as_rows(out)
    have = Counter(rows)
    assert set(took) <= set(have) and all(n <= 3 * have[r] for r, n in took.items())

    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    out = stage["packing"](spark, docs, d).collect()
    assert sum(r.n_words for r in out) == sum(words(r[1]) for r in rows)
    spans = {}
    for r in out:
        spans.setdefault((r.shard, r.bin), []).append((r.start, r.start + r.n_words, r.capacity))
    for s in spans.values():
        s.sort()
        assert all(a[1] <= b[0] for a, b in zip(s, s[1:])) and s[-1][1] <= s[-1][2]


def test_stages_on_nothing(spark, clashing):
    d, docs, _ = clashing
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs.limit(0), d)
        assert out.count() == 0 and (name == "packing" or out.columns == docs.columns)


def test_labels_of_one_kind(spark, clashing, tmp_path):
    _, docs, rows = clashing
    for value in (0, 1):
        d = str(tmp_path / str(value))
        spark.createDataFrame([(i, 1, value) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
        assert toxicity.toxicity_stage(spark, docs, d).count() == len(rows)
