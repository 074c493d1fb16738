"""Every registered query against its DuckDB oracle on sf0.001, plus invariants."""

import hashlib
import math

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from pullscope.plans.oracle_all import oracle_sql as library_oracle
from pullscope.plans.registry import queries as library_queries

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "\x00"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6f}"
    return str(v)


def _digest(rows):
    return sorted(hashlib.md5("|".join(map(_norm, r)).encode()).hexdigest() for r in rows)


@pytest.fixture(scope="module")
def con(small_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small_dir}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"agent", "merged", "total", "merge_rate"}
    assert df.count() >= 1


def test_every_query_has_an_oracle():
    assert set(library_queries()) == set(library_oracle()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(library_queries()))
def test_query_matches_oracle(spark, con, small_dir, name):
    df = E.queries()[name](spark, small_dir)
    cols = sorted(df.columns)
    srows = [tuple(r[c] for c in cols) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    ocols = rel.columns
    idx = sorted(range(len(ocols)), key=lambda i: ocols[i])
    orows = [tuple(r[i] for i in idx) for r in rel.fetchall()]
    assert cols == sorted(ocols)
    assert len(srows) == len(orows)
    assert _digest(srows) == _digest(orows)


def test_invariants(spark, small_dir):
    q = E.queries()
    cls = q["classified_prs"](spark, small_dir)
    n = cls.count()
    ct = q["source_type_crosstab"](spark, small_dir).agg(F.sum(F.col("fix") + F.col("other"))).first()[0]
    assert ct == n
    a = cls.where("is_agent").count()
    h = cls.where("not is_agent").count()
    assert a + h == n
    fix = q["fix_prs_only"](spark, small_dir).count()
    assert q["monthly_volume"](spark, small_dir).agg(F.sum("total")).first()[0] == fix
    sc = {r["source"]: r["merged_with_commits"] for r in q["single_commit_rate"](spark, small_dir).collect()}
    rv = {r["source"]: r["revised"] for r in q["revised_summary"](spark, small_dir).collect()}
    single = {r["source"]: r["single"] for r in q["single_commit_rate"](spark, small_dir).collect()}
    for s in ("agent", "human"):
        assert single[s] + rv[s] == sc[s]
