"""Oracle SQL for the queries of ``registry_more``."""

from __future__ import annotations

from pullscope.plans.oracle import IN_WINDOW, ORACLE, with_ctes, _COMMIT_COUNTS, _EXPORT, _PR_STATS, _REV_BY_SOURCE

_AGENTS = "('Devin', 'Copilot', 'Cursor', 'Claude_Code')"

ORACLE_MORE: dict[str, str] = {}
ORACLE_MORE["prs_from_json"] = ORACLE["pull_requests"]
ORACLE_MORE["commits_from_json"] = with_ctes(
    "SELECT sha, pr_id, author, committer, message, commit_seq FROM cm WHERE pr_id % 101 <> 3")
ORACLE_MORE["target_repo_prs"] = with_ctes(f"""
SELECT p.id, p.repo_name, t.id AS repo_id FROM (SELECT * FROM pr WHERE {IN_WINDOW}) p
JOIN (SELECT full_name, max(id) AS id FROM repo WHERE full_name IS NOT NULL AND id IN (SELECT repo_id FROM base WHERE agent IN {_AGENTS})
      GROUP BY full_name) t ON p.repo_name = t.full_name
""")
ORACLE_MORE["chunks_merged"] = with_ctes("SELECT id, repo_name, title, agent FROM pr")
ORACLE_MORE["state_remaining"] = with_ctes("""
SELECT 'remaining' AS kind, repo_name AS key FROM raw_pr GROUP BY repo_name HAVING min(user_id) % 3 <> 0
UNION ALL SELECT 'retry', repo_name FROM raw_pr GROUP BY repo_name HAVING min(user_id) % 5 = 1
""")
ORACLE_MORE["retry_prs"] = with_ctes("""
SELECT id, repo_name, state FROM raw_pr WHERE repo_name IN (SELECT repo_name FROM raw_pr WHERE id % 97 = 5 OR id % 89 = 7)
""")
ORACLE_MORE["capped_patches"] = with_ctes("""
SELECT DISTINCT sha, filename, CASE WHEN strlen(patch) <= 18 THEN patch END AS patch, strlen(patch) > 18 AS patch_capped
FROM flp WHERE filename IS NOT NULL
""")
ORACLE_MORE["repo_slugs"] = with_ctes("SELECT replace(repo_name, '/', '__') AS slug, count(*) AS prs FROM raw_pr GROUP BY 1")
ORACLE_MORE["first_prs"] = with_ctes("SELECT id, title, repo_name FROM raw_pr ORDER BY id LIMIT 10")
ORACLE_MORE["collect_manifest"] = with_ctes("""
SELECT 'all_pull_requests' AS "table", count(*) AS rows FROM pr
UNION ALL SELECT 'agent_pull_requests', count(*) FROM pr WHERE is_agent
UNION ALL SELECT 'human_pull_requests', count(*) FROM pr WHERE NOT is_agent
UNION ALL SELECT 'pr_commits', count(*) FROM cm UNION ALL SELECT 'pr_commit_details', count(*) FROM dt
""")
ORACLE_MORE["classified_from_files"] = with_ctes("SELECT id, type, source FROM fixpr")
ORACLE_MORE["labels_in_stored_order"] = with_ctes(f"""
SELECT login AS "user", arg_max(agent, first_ord) AS agent FROM (
  SELECT login, agent, min(-id) AS first_ord FROM base WHERE agent IN {_AGENTS} GROUP BY login, agent) GROUP BY login
""")
ORACLE_MORE["export_csv"] = with_ctes("SELECT repository, pr_count, in_repository_metadata FROM exp", _EXPORT)
ORACLE_MORE["commit_errors"] = with_ctes("""
SELECT DISTINCT 'page_failed' AS kind, CAST(pr_id AS VARCHAR) AS key FROM cm WHERE pr_id % 101 = 3
UNION ALL SELECT 'empty', CAST(-id AS VARCHAR) FROM raw_pr WHERE id % 103 = 4
UNION ALL SELECT 'malformed', '{"id": ' || id FROM raw_pr WHERE id % 107 = 3
""")
ORACLE_MORE["pr_errors"] = with_ctes("""
SELECT DISTINCT 'page_failed' AS kind, repo_name AS key FROM raw_pr WHERE id % 97 = 5
UNION ALL SELECT 'no_id', repo_name FROM raw_pr WHERE id % 89 = 7
UNION ALL SELECT 'malformed', '{"id": ' || id FROM raw_pr WHERE id % 83 = 3
""")
ORACLE_MORE["unmatched_shas"] = with_ctes("""
SELECT sha FROM cm GROUP BY sha HAVING count_if(pr_id IN (SELECT id FROM raw_pr WHERE user_id % 3 <> 0)) = 0
""")
ORACLE_MORE["details_from_json"] = with_ctes("SELECT * REPLACE ('Api: ' || author AS author) FROM dt WHERE sha NOT LIKE 'f%'")
ORACLE_MORE["detail_errors"] = with_ctes("""
SELECT 'malformed' AS kind, '{"id": ' || id AS key, count(*) AS lines FROM raw_pr WHERE id % 107 = 3 GROUP BY id
UNION ALL SELECT 'no_sha', '', (SELECT count(DISTINCT (pr_id, (commit_seq - 1) // 100)) FROM cm)
  + (SELECT count(DISTINCT pr_id) FROM cm WHERE pr_id % 101 = 3) + (SELECT count(*) FROM raw_pr WHERE id % 103 = 4)
""")
ORACLE_MORE["details_from_git_text"] = with_ctes("SELECT * FROM dt")
_LOCAL = """
local AS (SELECT DISTINCT sha1('c' || l_partkey || '-' || l_suppkey) AS sha FROM lineitem
          WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0))
"""
ORACLE_MORE["details_prefer_git"] = with_ctes("""
SELECT *, 'git' AS detail_source FROM dt WHERE sha IN (SELECT sha FROM local)
UNION ALL
SELECT * REPLACE ('Api: ' || author AS author), 'api' FROM dt WHERE sha NOT IN (SELECT sha FROM local) AND sha NOT LIKE 'f%'
""", _LOCAL)
ORACLE_MORE["missing_shas"] = with_ctes("""
SELECT DISTINCT sha FROM cm WHERE sha NOT IN (SELECT sha FROM local) AND sha LIKE 'f%'
""", _LOCAL)
ORACLE_MORE["sha_repo"] = with_ctes("""
SELECT c.sha, first(r.repo_name ORDER BY c.pr_id, c.commit_seq) AS repo_name
FROM cm c JOIN raw_pr r ON c.pr_id = r.id WHERE r.repo_name IS NOT NULL GROUP BY c.sha
""")
ORACLE_MORE["sha_batches"] = with_ctes("""
SELECT repo_name, count(*) AS shas, CAST(ceil(count(*) / 2.0) AS BIGINT) AS batches, true AS within FROM (
  SELECT c.sha, first(r.repo_name ORDER BY c.pr_id, c.commit_seq) AS repo_name
  FROM cm c JOIN raw_pr r ON c.pr_id = r.id WHERE r.repo_name IS NOT NULL GROUP BY c.sha) GROUP BY repo_name
""")
ORACLE_MORE["validation_month"] = with_ctes(f"""
SELECT (SELECT count(*) FROM m) AS total_prs, (SELECT count_if(is_agent) FROM m) AS agent_prs,
       (SELECT count(DISTINCT repo_id) FROM m WHERE is_agent AND repo_id IS NOT NULL) AS repos_ours,
       (SELECT count(DISTINCT repo_id) FROM base WHERE agent IN {_AGENTS} AND repo_id IS NOT NULL) AS repos_baseline,
       (SELECT count(DISTINCT repo_id) FROM m WHERE is_agent AND repo_id IN
          (SELECT repo_id FROM base WHERE agent IN {_AGENTS})) AS repo_overlap,
       round((SELECT count(DISTINCT repo_id) FROM m WHERE is_agent AND repo_id IN
          (SELECT repo_id FROM base WHERE agent IN {_AGENTS})) * 100.0
          / greatest((SELECT count(DISTINCT repo_id) FROM base WHERE agent IN {_AGENTS} AND repo_id IS NOT NULL), 1), 6)
         AS coverage_pct
""", "m AS (SELECT * FROM pr WHERE created_at >= '1997-01-01' AND created_at <= '1997-01-31T23:59:59Z')")
ORACLE_MORE["sample_prs"] = with_ctes("""
SELECT id, number, title, login AS "user", user_id, state, created_at, closed_at, merged_at, repo_id,
       repo_url, repo_name, html_url, is_agent, agent
FROM pr ORDER BY sha1(concat_ws('|', '42', CAST(id AS VARCHAR))), id LIMIT 20
""")


def _violin(vals_sql: str, extra: str) -> str:
    return with_ctes(f"""
SELECT d.grp AS source, CAST(d.i AS INTEGER) AS i, round(d.gx, 6) AS grid_x, round(d.density, 6) AS density,
       round(d.density / max(d.density) OVER (PARTITION BY d.grp), 6) AS density_scaled,
       round(s.q[1], 6) AS q1, round(s.q[2], 6) AS median, round(s.q[3], 6) AS q3
FROM (
  SELECT g.grp, g.i, s.lo + g.i * (s.hi - s.lo) / 99.0 AS gx,
         sum(c.n * exp(-0.5 * pow(((s.lo + g.i * (s.hi - s.lo) / 99.0) - c.x) / s.h, 2)))
           / (s.nn * s.h * sqrt(2 * pi())) AS density
  FROM (SELECT grp, unnest(range(0, 100)) AS i FROM st) g
  JOIN st s ON g.grp = s.grp JOIN cnt c ON c.grp = g.grp
  GROUP BY g.grp, g.i, s.lo, s.hi, s.nn, s.h
) d JOIN st s ON d.grp = s.grp
""", extra + f""",
vals AS ({vals_sql}),
cnt AS (SELECT grp, x, count(*) AS n FROM vals GROUP BY grp, x),
st AS (SELECT grp, count(*) AS nn, min(x) AS lo, max(x) AS hi,
              stddev_samp(x) * pow(CAST(count(*) AS DOUBLE), -0.2) * 0.5 AS h,
              quantile_cont(x, [0.25, 0.5, 0.75]) AS q FROM vals GROUP BY grp)
""")


ORACLE_MORE["violin_lines_added"] = _violin(
    "SELECT source AS grp, log10(greatest(CAST(lines_added AS DOUBLE), 1.0)) AS x FROM psrc", _PR_STATS)
for _m in ("files_changed", "lines_deleted"):
    ORACLE_MORE[f"violin_{_m}"] = _violin(
        f"SELECT source AS grp, log10(greatest(CAST({_m} AS DOUBLE), 1.0)) AS x FROM psrc", _PR_STATS)
for _m in ("rev_files_changed", "rev_lines_added", "rev_lines_deleted"):
    ORACLE_MORE[f"violin_{_m}"] = _violin(
        f"SELECT source AS grp, log10(greatest(CAST({_m} AS DOUBLE), 1.0)) AS x FROM rst_s",
        _COMMIT_COUNTS + "," + _REV_BY_SOURCE)
# exact p: every way to place the smaller sample's ranks (5 of 25 nations), by its rank sum
ORACLE_MORE["mann_whitney_exact"] = """
WITH v AS (
  SELECT CAST(round(sum(c_acctbal) * 100) AS BIGINT) AS v, n_regionkey = 0 AS a FROM customer JOIN nation ON c_nationkey = n_nationkey
  GROUP BY c_nationkey, n_regionkey
), r AS (SELECT a, rank() OVER (ORDER BY v) AS k FROM v
), st AS (SELECT count_if(a) AS n1, count_if(NOT a) AS n2, sum(k) FILTER (WHERE a) - count_if(a) * (count_if(a) + 1) / 2 AS u1 FROM r
), n AS (SELECT k FROM r), ways AS (
  SELECT n1.k + n2.k + n3.k + n4.k + n5.k - 15 AS s FROM n n1 JOIN n n2 ON n1.k < n2.k JOIN n n3 ON n2.k < n3.k
  JOIN n n4 ON n3.k < n4.k JOIN n n5 ON n4.k < n5.k)
, p AS (SELECT n1, n2, u1, least(1.0, 2.0 * (SELECT avg(CAST(ways.s >= greatest(st.u1, n1 * n2 - st.u1) AS DOUBLE)) FROM ways)) AS p FROM st)
SELECT CAST(n1 AS BIGINT) AS n_agent, CAST(n2 AS BIGINT) AS n_human, CAST(u1 AS DOUBLE) AS u_statistic, p AS p_value, p < 0.05 AS significant
FROM p
"""
ORACLE_MORE["mann_whitney_tied"] = with_ctes("""
SELECT count_if(is_agent) AS n_agent, count_if(NOT is_agent) AS n_human, count_if(is_agent) * count_if(NOT is_agent) / 2.0 AS u_statistic,
       CAST(1.0 AS DOUBLE) AS p_value, false AS significant FROM pr WHERE merged_at IS NOT NULL
""")
ORACLE_MORE["violin_revisions"] = _violin(
    "SELECT source AS grp, least(CAST(num_commits AS DOUBLE), least(50.0, (SELECT max(num_commits) FROM rev))) AS x "
    "FROM rev", _COMMIT_COUNTS)
ORACLE_MORE["ingest_stream_prs"] = with_ctes(
    f'SELECT id, title, login AS "user", created_at, merged_at, is_agent, agent, type, source FROM cls WHERE {IN_WINDOW}')
ORACLE_MORE["volume_stream_daily"] = with_ctes("""
SELECT substr(r.created_at, 1, 10) AS day,
       CASE WHEN ua.label IS NOT NULL THEN 'agent' ELSE 'human' END AS source, count(*) AS count
FROM raw_pr r LEFT JOIN user_agent ua ON r.login = ua.login GROUP BY 1, 2
""")


def _unpivot(section: str, sql: str, grp: str | None, metrics: list[str]) -> str:
    g = f"CAST({grp} AS VARCHAR)" if grp else "CAST(NULL AS VARCHAR)"
    cols = ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in metrics)
    inner = f"SELECT '{section}' AS section, {g} AS grp, {cols} FROM ({sql}) q"
    return (f"SELECT section, grp, metric, round(value, 6) AS value FROM "
            f"({inner}) UNPIVOT INCLUDE NULLS (value FOR metric IN ({', '.join(metrics)}))")


def _report_sql() -> str:
    O = {**ORACLE, **ORACLE_MORE}
    parts = [
        _unpivot("overview", O["overview"], None,
                 ["prs", "agent_prs", "human_prs", "repositories", "commits", "unique_authors"]),
        _unpivot("overview", "SELECT replace(substr(min(created_at), 1, 10), '-', '') AS date_from, "
                 "replace(substr(max(created_at), 1, 10), '-', '') AS date_to FROM ("
                 + with_ctes("SELECT created_at FROM fixpr") + ") f", None, ["date_from", "date_to"]),
        _unpivot("agent_breakdown", O["agent_breakdown"], "agent", ["count"]),
        _unpivot("change_size", O["change_size_by_source"], "source", ["files_changed", "lines_added", "lines_deleted"]),
        _unpivot("description_length", O["description_length"], "source", ["median_desc_words"]),
        _unpivot("merge_rate", O["merge_rate_by_source"], "source", ["merged", "total", "merge_rate"]),
        _unpivot("merge_rate_test", O["merge_rate_chi2"], None, ["chi2", "p_value", "significant"]),
        _unpivot("merge_rate_by_agent", O["merge_rate_by_agent"], "agent", ["merged", "total", "merge_rate"]),
        _unpivot("time_to_merge", O["time_to_merge"], "source", ["merged", "median_hours"]),
        _unpivot("single_commit", O["single_commit_rate"], "source", ["single", "merged_with_commits", "single_pct"]),
        _unpivot("revised", O["revised_summary"], "source", ["revised", "median_commits"]),
        _unpivot("revisions_test", O["mann_whitney_revisions"], None, ["u_statistic", "p_value", "significant"]),
        _unpivot("revision_size", O["revision_size_by_source"], "source",
                 ["rev_files_changed", "rev_lines_added", "rev_lines_deleted"]),
        _unpivot("state", f"SELECT concat_ws('/', source, state) AS g, count FROM ({O['state_breakdown']}) s",
                 "g", ["count"]),
        _unpivot("monthly", O["monthly_volume"], "month", ["agent", "human", "total"]),
        _unpivot("top_repos", O["top_repos"], "repo_name", ["total", "agent"]),
    ]
    return "\nUNION ALL\n".join(parts)


ORACLE_MORE["report_table"] = _report_sql()

ORACLE_MORE["events_type_volume_stream"] = f"""
SELECT strftime(ts, '%Y-%m-%d') AS day,
       CASE WHEN coalesce(regexp_matches(event_type, '{__import__("pullscope.plans.oracle", fromlist=["FIX_RE"]).FIX_RE}'), false)
            THEN 'fix' ELSE 'other' END AS type,
       count(*) AS count
FROM events GROUP BY 1, 2
"""
