"""Every query with SQL gives the rows that DuckDB gives."""

import duckdb
import pytest

from turnweave.plans import audio_queries, export_queries, table_queries, text_queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
ALL = {k: (f, m.SQL.get(k)) for m in (text_queries, table_queries, audio_queries, export_queries) for k, f in m.Q.items()}


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    c.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def rows_of(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted(map(str, pdf[cols].astype(object).where(pdf[cols].notna(), None).itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", sorted(ALL))
def test_query(spark, duck, sf_dir, name):
    f, sql = ALL[name]
    got = f(spark, sf_dir).toPandas()
    if sql is None:
        assert len(got)
    else:
        assert rows_of(got) == rows_of(duck.sql(sql).df())
