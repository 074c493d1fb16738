"""SQL functions H1-H5 give what the Column functions give."""

from pullscope.functions import scalars as S
from pullscope.functions.sql import SQL_FUNCTIONS, register_sql_functions

TEXTS = [None, "", "Fix crash", "prefix", "fixes: a'b", "BUG  FIX", "a b c\x1fd  e\n", "https://github.com/o/r/pull/1", "http://github.com/o/r",
         "https://github.com/o/r//", "https://api.github.com/repos/o/r", "Unknown", "o/r", "éfix", "resolve—it", "x" * 1000]


def test_sql_functions_equal_column_functions(spark):
    assert set(register_sql_functions(spark)) == set(SQL_FUNCTIONS)
    df = spark.createDataFrame([(i, a, TEXTS[(i * 5 + 3) % len(TEXTS)]) for i, a in enumerate(TEXTS)], "i int, a string, b string")
    sql = spark.sql("SELECT i, classify_title(a) AS c, repo_from_url(a) AS r, clean_url(a) AS u, final_name(a, b, a) AS n, "
                    "word_count(a) AS w FROM {df}", df=df)
    col = df.select("i", S.classify_title("a").alias("c"), S.repo_from_url("a").alias("r"), S.clean_url("a").alias("u"),
                    S.final_name("a", "b", "a").alias("n"), S.word_count("a").alias("w"))
    assert sorted(map(tuple, sql.collect())) == sorted(map(tuple, col.collect()))
    plan = sql._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
