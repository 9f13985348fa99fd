import random

import pytest

WORDS = ["".join(p) for p in __import__("itertools").product("bcdfg", "aeiou", "lmnrs", ("a", "en", "ist", "o"))]
FIELDS = "doc_id long, text string, lang string, source string, n_chars long, key string, digest string"


def prose(rng, n, lines=3):
    out = []
    for _ in range(lines):
        w = [rng.choice(WORDS) for _ in range(max(1, n // lines))]
        out.append(" ".join(w).capitalize() + ".")
    return "\n".join(out)


@pytest.fixture(scope="session")
def rows():
    """Documents with copies, near copies, shared passages, edge cases and hot groups; two
    extra columns whose names the operators also use inside."""
    rng = random.Random(5)
    texts = [prose(rng, rng.choice([3, 30, 120, 300])) for _ in range(160)]
    texts += [t.replace(" ", "  \t") for t in texts[:6]] + [texts[3]] * 40
    for t in texts[20:60]:
        w = t.split(" ")
        for _ in range(max(1, len(w) // 60)):
            w[rng.randrange(len(w))] = rng.choice(WORDS)
        texts.append(" ".join(w))
    base = prose(rng, 200)
    for _ in range(60):
        w = base.split(" ")
        for _ in range(rng.choice([1, 3, 8, 14])):
            w[rng.randrange(len(w))] = rng.choice(WORDS)
        texts.append(" ".join(w))
    passage = prose(rng, 60, lines=1)
    texts += [f"{prose(rng, 40)} {passage} {prose(rng, 30)}" for _ in range(5)]
    texts += ["", " \t\n", None, None, "x", "x", "\x00odd éß 中文 \U0001f600", prose(rng, 4000, 1), "w " * 300]
    out = [(i * 3 % 977, t, rng.choice(["en", "fr"]), rng.choice(["a", "a", "b", "c", None]), None, "k", "d") for i, t in enumerate(texts)]
    return out + [out[10], out[10], (None, "no id at all", None, None, None, None, None)]


@pytest.fixture(scope="session")
def docs_dir(spark, rows, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("docs"))
    df = spark.createDataFrame(rows, FIELDS)
    df.repartition(3).write.parquet(f"{d}/documents.parquet")
    return d


@pytest.fixture(scope="session")
def empty_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    none = lambda schema: spark.createDataFrame([], schema).write
    none(FIELDS).parquet(f"{d}/documents.parquet")
    none("doc_id long, quality int, toxic int").parquet(f"{d}/labels.parquet")
    none("vec_id long, embedding array<float>, label int").parquet(f"{d}/embeddings.parquet")
    none("item_id long, text string").parquet(f"{d}/benchmark.parquet")
    none("page_id long, url string, html string").parquet(f"{d}/pages.parquet")
    return d
