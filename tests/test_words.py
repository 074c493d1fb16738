"""Words of long texts are counted on buffers, as ``str.split()`` counts them."""

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pullscope.functions import words as W
from pullscope.operators import facts, reports

TEXTS = ["a b", "  a\tb\nc  ", "a b　c", "a\x1cb\x1fc", "a​b", "", None, "\u0085x y", "é à\xa0ü", "a", " ", "bÂ c…d‧e"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | st.text(alphabet=st.sampled_from(" ab é€‧​" + W._WHITE_SPACE), max_size=20), max_size=20),
       st.sampled_from([1, 8, 1 << 22]))
def test_count_words_as_python_split(texts, step):
    was, W.STEP = W.STEP, step
    try:
        assert list(W.count_words(pa.array(texts, pa.string()))) == [len((t or "").split()) for t in texts]
    finally:
        W.STEP = was


def test_bodies_are_counted_without_making_words(spark):
    prs = spark.createDataFrame([(i, "agent", "Devin", True, "closed", "o/r", "2024-01-01T00:00:00Z", None, t) for i, t in enumerate(TEXTS)],
                                "id long, source string, agent string, is_agent boolean, state string, repo_name string, "
                                "created_at string, merged_at string, body string")
    commits = spark.createDataFrame([], "pr_id long, sha string")
    details = spark.createDataFrame([], "pr_id long, filename string, additions long, deletions long")
    for df in (facts.fact_pr(prs, commits, details), reports.description_length(prs)):
        plan = df._jdf.queryExecution().toString()
        assert "ArrowEvalPython" in plan and "split(" not in plan
    got = {r["pr_id"]: r["desc_words"] for r in facts.fact_pr(prs, commits, details).collect()}
    assert got == {i: len((t or "").split()) for i, t in enumerate(TEXTS)}
    assert spark.range(1).select(W.word_count_long(spark, F.lit("a  b"))).first()[0] == 2
