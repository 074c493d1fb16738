"""The row functions H1-H5 as SQL functions, for queries written in SQL (2.11).

``register_sql_functions(spark)`` creates temporary functions with SQL bodies: Spark inlines them into the
plan, so they cost what the Column functions of ``functions.scalars`` cost and run in the JVM.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from pullscope.functions.scalars import _WHITE_SPACE, FIX_REGEX

_BLANKS = "".join(f"\\u{ord(c):04x}" for c in _WHITE_SPACE)
_OWNER_REPO = r"github\.com/([^/]+/[^/]+)"
_REPO_URL = r"(https?://github\.com/[^/]+/[^/]+)"


def _repo(url: str) -> str:
    return f"nullif(regexp_extract({url}, r'{_OWNER_REPO}', 1), '')"


#: name -> (parameters, type, body)
SQL_FUNCTIONS = {
    # H1
    "classify_title": ("title STRING", "STRING", f"CASE WHEN coalesce(title RLIKE r'{FIX_REGEX}', false) THEN 'fix' ELSE 'other' END"),
    # H2
    "repo_from_url": ("url STRING", "STRING", _repo("url")),
    # H3
    "clean_url": ("url STRING", "STRING",
                  f"CASE WHEN regexp_extract(url, r'{_REPO_URL}', 1) <> '' "
                  f"THEN concat(regexp_replace(regexp_extract(url, r'{_REPO_URL}', 1), '/+$', ''), '/') ELSE url END"),
    # H4
    "final_name": ("full_name STRING, html_url STRING, repo_url STRING", "STRING",
                   f"coalesce(nullif(full_name, 'Unknown'), {_repo('html_url')}, {_repo('repo_url')}, 'Unknown')"),
    # H5
    "word_count": ("text STRING", "BIGINT",
                   f"CAST(size(filter(split(translate(coalesce(text, ''), '{_BLANKS}', '{' ' * len(_WHITE_SPACE)}'), ' '), "
                   "w -> w <> '')) AS BIGINT)"),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create (or replace) the temporary functions of this session; returns their names."""
    for name, (parameters, kind, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
    return list(SQL_FUNCTIONS)
