"""Oracle SQL for the queries of ``registry_flow``."""

from __future__ import annotations

from pullscope import schemas
from pullscope.plans.oracle import FIX_RE, IN_WINDOW, with_ctes
from pullscope.plans.oracle_more import ORACLE_MORE

ORACLE_FLOW: dict[str, str] = {}

_REWRITTEN = """
again AS (SELECT id, repo_name, agent, CASE WHEN user_id % 499 = 3 THEN 'Again: ' || coalesce(title, '') ELSE title END AS title
          FROM pr WHERE user_id % 997 <> 5)
"""
ORACLE_FLOW["chunks_rewritten"] = with_ctes("SELECT id, repo_name, title, agent FROM again", _REWRITTEN)
ORACLE_FLOW["chunks_current"] = with_ctes(
    "SELECT agent, count(*) AS prs, count(DISTINCT repo_name) AS repos FROM again GROUP BY agent", _REWRITTEN)

# the altered copy of an id that is divisible by 21 was landed before its original
ORACLE_FLOW["ingest_redelivered"] = with_ctes(f"""
SELECT id, title, created_at, agent, CASE WHEN coalesce(regexp_matches(title, '{FIX_RE}'), false) THEN 'fix' ELSE 'other' END AS type
FROM (SELECT id, agent, CASE WHEN id % 21 = 0 THEN 'Fix: other copy' ELSE title END AS title,
             CASE WHEN id % 21 = 0 THEN '2001-02-03T04:05:06Z' ELSE created_at END AS created_at FROM pr)
""")
ORACLE_FLOW["ingest_resumed"] = with_ctes(
    'SELECT id, title, login AS "user", created_at, merged_at, is_agent, agent, type FROM cls')
_DEAD = """
SELECT DISTINCT 'page_failed' AS kind, repo_name AS repo, '{"repo":"' || repo_name || '","page":2,"page_failed":true}' AS raw
FROM raw_pr WHERE id % 97 = 5
UNION ALL SELECT DISTINCT 'no_id', repo_name, '{"message":"Not Found","repo":"' || repo_name || '"}' FROM raw_pr WHERE id % 89 = 7
UNION ALL SELECT 'malformed', NULL, '{"id": ' || id FROM raw_pr WHERE id % 83 = 3
"""
ORACLE_FLOW["stream_dead_letters"] = with_ctes(_DEAD)
ORACLE_FLOW["stream_retry"] = with_ctes("""
SELECT repo_name, count(*) AS prs, bool_or(id % 97 = 5) AND repo_name LIKE '%/repo1%' AS still_failed
FROM raw_pr GROUP BY repo_name HAVING bool_or(id % 97 = 5 OR id % 89 = 7)
""")
ORACLE_FLOW["stream_progress"] = with_ctes(f"""
SELECT 'pull_requests' AS phase, total AS done, total, rows AS written_rows, (SELECT count(*) FROM ({_DEAD})) AS dead_rows, true AS has_rate
FROM (SELECT count(*) + count_if(id % 97 = 5) + count_if(id % 89 = 7) + count_if(id % 83 = 3) AS total, count(*) AS rows FROM raw_pr)
""")


def _paged(key: str, item: str, order: str, rows: str, page: int) -> str:
    return f"""
SELECT {key}, (place // {page})::BIGINT AS page, count(*)::INTEGER AS n, string_agg({item}::VARCHAR, ',' ORDER BY place) AS items
FROM (SELECT {key}, {item}, row_number() OVER (PARTITION BY {key} ORDER BY {order}) - 1 AS place FROM {rows}) GROUP BY 1, 2
"""


ORACLE_FLOW["sha_pr_lists"] = with_ctes(_paged("sha", "pr_id", "pr_id, commit_seq", "cm", 1000))
ORACLE_FLOW["repo_sha_lists"] = with_ctes(_paged("repo_name", "sha", "pr_id, commit_seq, sha", "held", 5), """
held AS (SELECT s.sha, s.repo_name, f.pr_id, f.commit_seq
  FROM (SELECT c.sha, first(r.repo_name ORDER BY c.pr_id, c.commit_seq) AS repo_name
        FROM cm c JOIN raw_pr r ON c.pr_id = r.id WHERE r.repo_name IS NOT NULL GROUP BY c.sha) s
  JOIN (SELECT sha, min((pr_id, commit_seq)) AS m, m[1] AS pr_id, m[2] AS commit_seq FROM cm GROUP BY sha) f USING (sha))
""")
ORACLE_FLOW["window_from_clustered"] = with_ctes(f"SELECT id, created_at, repo_name FROM raw_pr WHERE {IN_WINDOW}")
_NO_PATCH = ", ".join(c for c in schemas.COMMIT_DETAILS.names if c not in ("patch", "author"))
ORACLE_FLOW["details_from_bytes"] = with_ctes(
    f"SELECT replace(author, 'Dev Name ', 'D' || chr(65533) || 'v Name ') AS author, {_NO_PATCH} FROM dt")
ORACLE_FLOW["patches_from_bytes"] = with_ctes("SELECT DISTINCT sha, filename, patch FROM flp WHERE filename IS NOT NULL")
ORACLE_FLOW["sql_row_functions"] = with_ctes("""
SELECT r.id, c.type, r.repo_name AS repo, 'https://github.com/' || r.repo_name || '/' AS url, r.repo_name AS name,
       len(list_filter(string_split(coalesce(r.title, ''), ' '), lambda w: w <> '')) AS words
FROM raw_pr r JOIN cls c ON r.id = c.id
""")
ORACLE_FLOW["report_text"] = f"""
SELECT concat_ws('  ', section, coalesce(grp, '-'), metric, CASE
  WHEN value IS NULL THEN 'n/a' WHEN metric IN ('merge_rate', 'single_pct') THEN format('{{:,.1f}}', value)
  WHEN metric IN ('chi2', 'median_hours') THEN format('{{:,.2f}}', value) WHEN metric = 'p_value' THEN format('{{:,.4f}}', value)
  ELSE format('{{:,.0f}}', value) END) AS line
FROM ({ORACLE_MORE["report_table"]})
"""
ORACLE_FLOW["samples_csv"] = with_ctes("""
SELECT 'pull_requests' AS "table", id::VARCHAR AS key, nullif(title, '') AS value FROM
  (SELECT id, title FROM pr ORDER BY sha1(concat_ws('|', '42', id::VARCHAR)), id LIMIT 20)
UNION ALL
SELECT 'commits', sha, pr_id::VARCHAR FROM
  (SELECT sha, pr_id FROM cm ORDER BY sha1(concat_ws('|', '42', sha, pr_id::VARCHAR, commit_seq::VARCHAR)), sha, pr_id, commit_seq LIMIT 20)
""")


def _listed(name: str, columns: list[str], rows: str) -> str:
    return (f"SELECT '{name}' AS \"table\", count(*) AS rows, '{','.join(columns)}' AS columns, count(*) AS file_rows, "
            f"true AS sized FROM {rows}")


_P, _C, _D = schemas.PULL_REQUESTS.names, schemas.COMMITS.names, schemas.COMMIT_DETAILS.names
ORACLE_FLOW["manifest_columns"] = with_ctes(" UNION ALL ".join([
    _listed("all_pull_requests", _P, "pr"), _listed("agent_pull_requests", _P, "pr WHERE is_agent"),
    _listed("human_pull_requests", _P, "pr WHERE NOT is_agent"), _listed("pr_commits", _C, "cm"), _listed("pr_commit_details", _D, "dt")]))


def _conformance(table: str, where: str, changed: dict[str, str | None]) -> list[str]:
    out = []
    for f in schemas.PULL_REQUESTS.fields:
        want = f.dataType.simpleString()
        got = changed.get(f.name, want)
        source = {"user": "login", "body": "CAST(NULL AS VARCHAR)"}.get(f.name, f.name)
        held = f"count({source}) AS values, count(*) - count({source}) AS nulls" if got else "nullif(count(*), count(*)) AS values, nullif(count(*), count(*)) AS nulls"
        actual = f"'{got}'" if got else "CAST(NULL AS VARCHAR)"
        out.append(f"SELECT '{table}' AS \"table\", '{f.name}' AS column, {got is not None} AS present, {actual} AS actual, '{want}' AS expected, "
                   f"{got == want} AS matches, {held} FROM pr WHERE {where}")
    return out


ORACLE_FLOW["conformance_nulls"] = with_ctes(" UNION ALL ".join(
    _conformance("agent", "is_agent", {}) + _conformance("human", "NOT is_agent", {"body": None, "number": "string"})))
ORACLE_FLOW["optional_inputs"] = with_ctes("""
SELECT 'present' AS input, 'read' AS outcome, count(*) AS rows, count(DISTINCT pr_id) AS prs FROM dt
UNION ALL SELECT 'absent', 'skipped', 0, 0
UNION ALL SELECT 'prs', 'rows', count(*), count(DISTINCT id) FROM pr
UNION ALL SELECT 'none', 'no rows in none: cannot proceed', 0, 0
""")
