import duckdb
import pytest

import __spark_entry__ as entry
from pullscope.llm.oracle import oracle_sql
from pullscope.llm.queries import queries

SMALL = "/root/testdata/sf0.001"
COLUMNS = {
    1: {"doc_id", "n_shingles", "component_id", "kept"}, 2: {"doc_id", "held_out", "score", "predicted"},
    3: {"doc_id", "start", "n_tokens", "ids_crc32"}, 4: {"doc_id", "item_id"}, 5: {"doc_id", "held_out", "lang_pred", "score"},
    6: {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"}, 7: {"doc_id", "n_words", "n_removed", "kept_sha256"},
    8: {"doc_id", "held_out", "score", "predicted"}, 9: {"doc_id", "size", "source_size", "target", "taken"},
    10: {"doc_id", "keep_id", "group_size", "kept", "text_sha256"}, 11: {"vec_id", "n_links", "component_id", "kept"},
    12: {"anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"},
    13: {"doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"}}


def test_every_operator_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert {n: sum(k.startswith(f"op{n}_") for k in names) for n in range(1, 14)} == dict.fromkeys(range(1, 14), 1)
    assert "pipeline" in names and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, name):
    df = queries()[name](spark, SMALL)
    rows = [r.asDict() for r in df.collect()]
    assert COLUMNS[int(name[2:].split("_")[0])] <= set(df.columns)
    if not name.startswith(("op4", "op12")):
        source = "embeddings" if name.startswith("op11") else "documents"
        assert len(rows) == spark.read.parquet(f"{SMALL}/{source}.parquet").count()
    if name in oracle_sql():
        con = duckdb.connect()
        for t in ("documents", "embeddings"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
        want = con.sql(oracle_sql()[name])
        cols = want.columns
        assert sorted(tuple(r[c] for c in cols) for r in rows) == sorted(want.fetchall())
