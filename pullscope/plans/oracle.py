"""DuckDB SQL for the fixture mapping and every registered query (the correctness oracle).

Written independently of the Spark code: the same tables in another engine's SQL. Titles are
ASCII, so DuckDB's ASCII ``\\b`` agrees with the Unicode look-arounds used on Spark.
"""

from __future__ import annotations

from pullscope.functions.mathx import erfc_sql
from pullscope.sources.fixtures import (AGENT_SEGMENTS, PRIORITY_AGENT, TITLES, WINDOW_FROM,
                                        WINDOW_TO)


def _q(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


_TITLE_CASE = "CASE o_orderkey % 16 " + " ".join(
    f"WHEN {i} THEN {_q(t)}" for i, t in enumerate(TITLES)) + " END"
_AGENT_CASE = "CASE o_orderpriority " + " ".join(
    f"WHEN {_q(p)} THEN {_q(a)}" for p, a in PRIORITY_AGENT) + " END"
_SEGS = ", ".join(_q(s) for s in AGENT_SEGMENTS)
IN_WINDOW = f"created_at >= '{WINDOW_FROM}' AND created_at <= '{WINDOW_TO}T23:59:59Z'"
ISO = "'%Y-%m-%dT%H:%M:%SZ'"
FIX_RE = (r"(?i)\b(fix(es|ed|ing)?|bug\s*fix|hotfix|bug|patch|resolv(e[ds]?|ing)|error|"
          r"crash(es|ed|ing)?|defect|regression|broken)\b")

BASE_CTES = f"""
o_rn AS (
  SELECT *, concat('org', o_custkey % 20, '/repo', o_custkey) AS rn FROM orders
),
base AS (
  SELECT o_orderkey AS id,
         CAST(CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE o_custkey END AS BIGINT) AS repo_id,
         concat('u', o_custkey) AS login,
         {_AGENT_CASE} AS agent,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE concat('https://api.github.com/repos/', rn) END AS repo_url,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL
              ELSE concat('https://github.com/', rn, '/pull/', o_orderkey + 1) END AS html_url
  FROM o_rn
  WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment IN ({_SEGS}))
),
repo AS (
  SELECT CAST(c_custkey AS BIGINT) AS id,
         concat('https://api.github.com/repos/', rn) AS url,
         CASE c_nationkey % 3 WHEN 0 THEN 'MIT' WHEN 1 THEN 'Apache-2.0' END AS license,
         CASE WHEN c_custkey % 23 = 5 THEN 'Unknown' WHEN c_custkey % 29 = 7 THEN NULL ELSE rn END AS full_name,
         lower(c_mktsegment) AS language,
         CAST(c_nationkey AS BIGINT) AS forks,
         CAST(floor(c_acctbal) AS BIGINT) AS stars
  FROM (SELECT *, concat('org', c_custkey % 20, '/repo', c_custkey) AS rn FROM customer)
  WHERE c_acctbal >= 0
),
user_agent AS (
  SELECT login, arg_max(agent, first_ord) AS label
  FROM (SELECT login, agent, min(id) AS first_ord FROM base
        WHERE agent IN ('Devin', 'Copilot', 'Cursor', 'Claude_Code') GROUP BY login, agent)
  GROUP BY login
),
repo_dim AS (
  SELECT full_name AS rname, arg_max(id, id) AS rid FROM repo WHERE full_name IS NOT NULL GROUP BY full_name
),
raw_pr AS (
  SELECT o_orderkey AS id, o_orderkey + 1 AS number,
         {_TITLE_CASE} AS title,
         concat('u', o_custkey) AS login,
         o_custkey AS user_id,
         CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE 'closed' END AS state,
         strftime(o_orderdate + to_hours(o_orderkey % 24), {ISO}) AS created_at,
         CASE WHEN o_orderstatus <> 'O'
              THEN strftime(o_orderdate + to_hours(o_orderkey % 24 + o_orderkey % 97 + 1), {ISO}) END AS closed_at,
         CASE WHEN o_orderstatus = 'F'
              THEN strftime(o_orderdate + to_hours(o_orderkey % 24 + o_orderkey % 97 + 1), {ISO}) END AS merged_at,
         rn AS repo_name,
         concat('https://github.com/', rn, '/pull/', o_orderkey + 1) AS html_url
  FROM o_rn
),
pr AS (
  SELECT r.id, r.number, r.title, r.login, r.user_id, r.state, r.created_at, r.closed_at,
         r.merged_at, d.rid AS repo_id, concat('https://api.github.com/repos/', r.repo_name) AS repo_url,
         r.repo_name, r.html_url, ua.label IS NOT NULL AS is_agent, coalesce(ua.label, 'human') AS agent
  FROM raw_pr r
  LEFT JOIN repo_dim d ON r.repo_name = d.rname
  LEFT JOIN user_agent ua ON r.login = ua.login
),
cls AS (
  SELECT pr.*, CASE WHEN coalesce(regexp_matches(title, '{FIX_RE}'), false) THEN 'fix' ELSE 'other' END AS type,
         CASE WHEN is_agent THEN 'agent' ELSE 'human' END AS source
  FROM pr
),
fixpr AS (SELECT * FROM cls WHERE type = 'fix'),
li AS (
  SELECT *, sha1(concat('c', l_partkey, '-', l_suppkey)) AS sha FROM lineitem
),
cm AS (
  SELECT sha, l_orderkey AS pr_id,
         CASE WHEN l_suppkey % 9 = 0 THEN concat('Dev Name ', l_suppkey) ELSE concat('dev', l_suppkey) END AS author,
         concat('dev', l_suppkey % 7) AS committer,
         concat('Update part ', l_partkey) AS message,
         CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
              l_shipdate, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS INTEGER) AS commit_seq
  FROM li
),
cf AS (
  SELECT sha, p, s, unnest(CASE WHEN n > 0 THEN range(1, n + 1) ELSE [NULL::BIGINT] END) AS i
  FROM (SELECT DISTINCT sha, l_partkey AS p, l_suppkey AS s,
               CASE WHEN l_partkey % 17 = 0 THEN 0 ELSE l_partkey % 3 + 1 END AS n FROM li)
),
fl AS (
  SELECT sha,
         concat('Dev Name ', s) AS author, 'GitHub' AS committer,
         concat('Update part ', p, chr(10), chr(10), 'Touches supplier ', s) AS message,
         CASE WHEN i IS NOT NULL THEN concat('src/mod', (p * 31 + i * 7) % 97, '.py') END AS filename,
         CASE WHEN i IS NOT NULL THEN (CASE substr('AMDRTM', CAST((s + i) % 6 + 1 AS INTEGER), 1)
              WHEN 'A' THEN 'added' WHEN 'M' THEN 'modified' WHEN 'D' THEN 'removed'
              WHEN 'R' THEN 'renamed' WHEN 'C' THEN 'copied' WHEN 'T' THEN 'changed' END) END AS status,
         CAST(CASE WHEN i IS NULL THEN NULL WHEN (p + i) % 23 = 0 THEN 0 ELSE (p + s * i) % 120 END AS BIGINT) AS additions,
         CAST(CASE WHEN i IS NULL THEN NULL WHEN (p + i) % 23 = 0 THEN 0 ELSE (p * i + s) % 45 END AS BIGINT) AS deletions
  FROM cf
),
flp AS (
  SELECT *, CASE WHEN filename IS NOT NULL
                 THEN concat('@@ -1,', deletions, ' +1,', additions, ' @@', chr(10), '+line', chr(10)) END AS patch
  FROM fl
),
flt AS (
  SELECT flp.*,
         CAST(coalesce(sum(additions) OVER (PARTITION BY sha), 0) AS BIGINT) AS commit_stats_additions,
         CAST(coalesce(sum(deletions) OVER (PARTITION BY sha), 0) AS BIGINT) AS commit_stats_deletions
  FROM flp
),
dt AS (
  SELECT f.sha, f.author, f.committer, f.message,
         f.commit_stats_additions + f.commit_stats_deletions AS commit_stats_total,
         f.commit_stats_additions, f.commit_stats_deletions,
         b.pr_id, f.filename, f.status, f.additions, f.deletions,
         f.additions + f.deletions AS changes, f.patch
  FROM flt f JOIN (SELECT sha, pr_id FROM cm) b ON f.sha = b.sha
),
fixcm AS (SELECT * FROM cm WHERE pr_id IN (SELECT id FROM fixpr)),
fixdt AS (SELECT * FROM dt WHERE pr_id IN (SELECT id FROM fixpr)),
src AS (SELECT * FROM (VALUES ('agent'), ('human')) t(source))
"""


def with_ctes(body: str, extra: str = "") -> str:
    ctes = BASE_CTES.strip()
    if extra:
        ctes += ",\n" + extra.strip()
    return "WITH " + ctes + "\n" + body.strip()


PR_COLS = ('id, number, title, body, login AS "user", user_id, state, created_at, closed_at, '
           'merged_at, repo_id, repo_url, repo_name, html_url, is_agent, agent')

_BODY = "bd AS (SELECT c.*, d.text AS body FROM cls c LEFT JOIN documents d ON d.doc_id = c.id // 15)"

_PR_STATS = """
pst AS (
  SELECT pr_id, count(DISTINCT filename) AS files_changed,
         CAST(coalesce(sum(additions), 0) AS BIGINT) AS lines_added,
         CAST(coalesce(sum(deletions), 0) AS BIGINT) AS lines_deleted
  FROM fixdt WHERE pr_id IS NOT NULL GROUP BY pr_id
),
psrc AS (SELECT p.*, f.source, f.merged_at FROM pst p JOIN fixpr f ON p.pr_id = f.id)
"""

_COMMIT_COUNTS = """
ncm AS (
  SELECT c.pr_id, count(*) AS num_commits, f.source, f.merged_at
  FROM fixcm c JOIN fixpr f ON c.pr_id = f.id GROUP BY c.pr_id, f.source, f.merged_at
),
rev AS (SELECT pr_id, source, num_commits FROM ncm WHERE merged_at IS NOT NULL AND num_commits > 1)
"""

_REV_GLOBAL = """
rcm AS (SELECT * FROM fixcm WHERE pr_id IN (SELECT pr_id FROM rev)),
firsts AS (SELECT pr_id, arg_min(sha, commit_seq) AS sha FROM rcm GROUP BY pr_id),
revsha AS (SELECT DISTINCT sha FROM rcm WHERE sha NOT IN (SELECT sha FROM firsts)),
rdt AS (SELECT * FROM fixdt WHERE sha IN (SELECT sha FROM revsha)),
rst AS (
  SELECT pr_id, count(DISTINCT filename) AS rev_files_changed,
         CAST(coalesce(sum(additions), 0) AS BIGINT) AS rev_lines_added,
         CAST(coalesce(sum(deletions), 0) AS BIGINT) AS rev_lines_deleted
  FROM rdt WHERE pr_id IS NOT NULL GROUP BY pr_id
)
"""

_REV_PR = """
rcm AS (SELECT * FROM fixcm WHERE pr_id IN (SELECT pr_id FROM rev)),
firsts AS (SELECT pr_id, arg_min(sha, commit_seq) AS sha FROM rcm GROUP BY pr_id),
revpair AS (SELECT DISTINCT r.pr_id, r.sha FROM rcm r ANTI JOIN firsts f ON r.pr_id = f.pr_id AND r.sha = f.sha),
rdt AS (SELECT d.* FROM fixdt d SEMI JOIN revpair r ON d.pr_id = r.pr_id AND d.sha = r.sha),
rst AS (
  SELECT pr_id, count(DISTINCT filename) AS rev_files_changed,
         CAST(coalesce(sum(additions), 0) AS BIGINT) AS rev_lines_added,
         CAST(coalesce(sum(deletions), 0) AS BIGINT) AS rev_lines_deleted
  FROM rdt WHERE pr_id IS NOT NULL GROUP BY pr_id
)
"""

_EXPORT = """
ragg AS (
  SELECT repo_id, count(*) AS pr_count,
         arg_min(repo_url, id) FILTER (WHERE repo_url IS NOT NULL) AS repo_url,
         arg_min(html_url, id) FILTER (WHERE html_url IS NOT NULL) AS html_url
  FROM base WHERE repo_id IS NOT NULL GROUP BY repo_id
),
exp AS (
  SELECT a.repo_id,
         coalesce(nullif(m.full_name, 'Unknown'),
                  nullif(regexp_extract(a.html_url, 'github\\.com/([^/]+/[^/]+)', 1), ''),
                  nullif(regexp_extract(a.repo_url, 'github\\.com/([^/]+/[^/]+)', 1), ''),
                  'Unknown') AS repository,
         a.pr_count,
         a.repo_id IN (SELECT id FROM repo WHERE id IS NOT NULL) AS in_repository_metadata,
         m.language, m.stars, m.forks, m.license, a.repo_url,
         CASE WHEN regexp_extract(a.html_url, '(https?://github\\.com/[^/]+/[^/]+)', 1) <> ''
              THEN concat(rtrim(regexp_extract(a.html_url, '(https?://github\\.com/[^/]+/[^/]+)', 1), '/'), '/')
              ELSE a.html_url END AS html_url
  FROM ragg a LEFT JOIN repo m ON a.repo_id = m.id
)
"""


def _r(x: str, d: int = 6) -> str:
    return f"round({x}, {d})"


def erfc(x: str) -> str:
    return erfc_sql(x)


ORACLE: dict[str, str] = {}

ORACLE["classified_prs"] = with_ctes(f"SELECT {PR_COLS}, type, source FROM bd", _BODY)
ORACLE["fix_prs_only"] = with_ctes(f"SELECT {PR_COLS}, type, source FROM bd WHERE type = 'fix'", _BODY)
ORACLE["source_type_crosstab"] = with_ctes("""
SELECT source, count_if(type = 'fix') AS fix, count_if(type = 'other') AS other FROM cls GROUP BY source
""")
ORACLE["fix_pr_commits"] = with_ctes("SELECT sha, pr_id, author, committer, message, commit_seq FROM fixcm")
ORACLE["fix_pr_commit_details"] = with_ctes("""
SELECT sha, pr_id, filename, status, additions, deletions, changes,
       commit_stats_total, commit_stats_additions, commit_stats_deletions FROM fixdt
""")
ORACLE["commit_details"] = with_ctes("SELECT * EXCLUDE (patch) FROM dt")
ORACLE["overview"] = with_ctes("""
SELECT substr(min(created_at), 1, 10) AS date_from, substr(max(created_at), 1, 10) AS date_to,
       count(*) AS prs, count_if(is_agent) AS agent_prs, count_if(NOT is_agent) AS human_prs,
       count(DISTINCT repo_name) AS repositories,
       (SELECT count(*) FROM fixcm) AS commits,
       (SELECT count(DISTINCT author) FROM fixcm) AS unique_authors
FROM fixpr
""")
ORACLE["agent_breakdown"] = with_ctes("""
SELECT agent, count(*) AS count FROM fixpr WHERE source = 'agent' AND agent IS NOT NULL GROUP BY agent
""")
ORACLE["state_breakdown"] = with_ctes("""
SELECT source, state, count(*) AS count FROM fixpr WHERE state IS NOT NULL GROUP BY source, state
""")
ORACLE["pr_change_size"] = with_ctes(
    "SELECT pr_id, files_changed, lines_added, lines_deleted, source FROM psrc", _PR_STATS)
ORACLE["change_size_by_source"] = with_ctes(f"""
SELECT s.source, {_r('coalesce(m.files_changed, 0.0)')} AS files_changed,
       {_r('coalesce(m.lines_added, 0.0)')} AS lines_added,
       {_r('coalesce(m.lines_deleted, 0.0)')} AS lines_deleted
FROM src s LEFT JOIN (SELECT source, median(files_changed) AS files_changed, median(lines_added) AS lines_added,
                             median(lines_deleted) AS lines_deleted FROM psrc GROUP BY source) m
ON s.source = m.source
""", _PR_STATS)
ORACLE["description_length"] = with_ctes(f"""
SELECT s.source, {_r('m.med')} AS median_desc_words
FROM src s LEFT JOIN (SELECT source, median(coalesce(len(regexp_extract_all(body, '[^\\s]+')), 0)) AS med
                      FROM bd WHERE type = 'fix' GROUP BY source) m ON s.source = m.source
""", _BODY)
ORACLE["merge_rate_by_source"] = with_ctes(f"""
SELECT s.source, coalesce(m.merged, 0) AS merged, coalesce(m.total, 0) AS total,
       {_r('coalesce(m.rate, 0.0)')} AS merge_rate
FROM src s LEFT JOIN (SELECT source, count(merged_at) AS merged, count(*) AS total,
                             CASE WHEN count(*) > 0 THEN count(merged_at) / count(*) * 100.0 ELSE 0.0 END AS rate
                      FROM fixpr GROUP BY source) m ON s.source = m.source
""")
ORACLE["merge_rate_by_agent"] = with_ctes(f"""
SELECT agent, count(merged_at) AS merged, count(*) AS total,
       {_r('count(merged_at) / count(*) * 100.0')} AS merge_rate
FROM fixpr WHERE source = 'agent' GROUP BY agent
""")
ORACLE["merge_rate_sets"] = with_ctes(f"""
SELECT CASE WHEN grouping(source, agent) = 3 THEN 'all' WHEN grouping(source, agent) = 1 THEN 'source'
            ELSE 'agent' END AS level,
       source, agent, count(merged_at) AS merged, count(*) AS total,
       {_r('CASE WHEN count(*) > 0 THEN count(merged_at) / count(*) * 100.0 ELSE 0.0 END')} AS merge_rate
FROM fixpr GROUP BY GROUPING SETS ((), (source), (source, agent))
""")

_CHI = """
cells AS (
  SELECT CAST(count_if(source = 'agent' AND merged_at IS NOT NULL) AS DOUBLE) AS a,
         CAST(count_if(source = 'agent' AND merged_at IS NULL) AS DOUBLE) AS b,
         CAST(count_if(source = 'human' AND merged_at IS NOT NULL) AS DOUBLE) AS c,
         CAST(count_if(source = 'human' AND merged_at IS NULL) AS DOUBLE) AS d
  FROM fixpr
),
chi AS (
  SELECT *, a + b + c + d AS n,
         CASE WHEN least(a, b, c, d) > 0 THEN
           (a + b + c + d) * pow(greatest(0.0, abs(a * d - b * c) - (a + b + c + d) / 2.0), 2)
           / ((a + b) * (c + d) * (a + c) * (b + d)) END AS chi2
  FROM cells
)
"""
ORACLE["merge_rate_chi2"] = with_ctes(f"""
SELECT CAST(a AS BIGINT) AS agent_merged, CAST(a + b AS BIGINT) AS agent_total,
       CAST(c AS BIGINT) AS human_merged, CAST(c + d AS BIGINT) AS human_total,
       {_r('chi2')} AS chi2, {_r(erfc('sqrt(chi2 / 2.0)'))} AS p_value,
       CASE WHEN chi2 IS NULL THEN NULL WHEN {erfc('sqrt(chi2 / 2.0)')} < 0.05 THEN true ELSE false END AS significant
FROM chi
""", _CHI)
ORACLE["time_to_merge"] = with_ctes(f"""
SELECT source, count(*) AS merged,
       {_r('median((epoch(CAST(merged_at AS TIMESTAMPTZ)) - epoch(CAST(created_at AS TIMESTAMPTZ))) / 3600.0)')} AS median_hours
FROM fixpr WHERE merged_at IS NOT NULL GROUP BY source
""")
ORACLE["single_commit_rate"] = with_ctes(f"""
SELECT s.source, coalesce(m.single, 0) AS single, coalesce(m.tot, 0) AS merged_with_commits,
       {_r('CASE WHEN coalesce(m.tot, 0) > 0 THEN m.single / m.tot * 100.0 ELSE 0.0 END')} AS single_pct
FROM src s LEFT JOIN (SELECT source, count_if(num_commits = 1) AS single, count(*) AS tot
                      FROM ncm WHERE merged_at IS NOT NULL GROUP BY source) m ON s.source = m.source
""", _COMMIT_COUNTS)
ORACLE["revised_summary"] = with_ctes(f"""
SELECT s.source, coalesce(m.revised, 0) AS revised, {_r('m.med')} AS median_commits
FROM src s LEFT JOIN (SELECT source, count(*) AS revised, median(num_commits) AS med FROM rev GROUP BY source) m
ON s.source = m.source
""", _COMMIT_COUNTS)
ORACLE["revision_size_pr"] = with_ctes(
    "SELECT pr_id, rev_files_changed, rev_lines_added, rev_lines_deleted FROM rst",
    _COMMIT_COUNTS + "," + _REV_GLOBAL)
ORACLE["revision_size_pr_scope"] = with_ctes(
    "SELECT pr_id, rev_files_changed, rev_lines_added, rev_lines_deleted FROM rst",
    _COMMIT_COUNTS + "," + _REV_PR)
_REV_BY_SOURCE = """
rcs AS (SELECT c.*, r.source FROM fixcm c JOIN rev r ON c.pr_id = r.pr_id),
firsts_s AS (SELECT source, pr_id, arg_min(sha, commit_seq) AS sha FROM rcs GROUP BY source, pr_id),
revsha_s AS (SELECT DISTINCT source, sha FROM rcs
             WHERE (source, sha) NOT IN (SELECT (source, sha) FROM firsts_s)),
rst_s AS (
  SELECT s.source, d.pr_id, count(DISTINCT d.filename) AS rev_files_changed,
         CAST(coalesce(sum(d.additions), 0) AS BIGINT) AS rev_lines_added,
         CAST(coalesce(sum(d.deletions), 0) AS BIGINT) AS rev_lines_deleted
  FROM fixdt d JOIN revsha_s s ON d.sha = s.sha WHERE d.pr_id IS NOT NULL GROUP BY s.source, d.pr_id
)
"""
ORACLE["revision_size_rows_by_source"] = with_ctes(
    "SELECT source, pr_id, rev_files_changed, rev_lines_added, rev_lines_deleted FROM rst_s",
    _COMMIT_COUNTS + "," + _REV_BY_SOURCE)
ORACLE["revision_size_by_source"] = with_ctes(f"""
SELECT s.source, {_r('coalesce(m.f, 0.0)')} AS rev_files_changed, {_r('coalesce(m.a, 0.0)')} AS rev_lines_added,
       {_r('coalesce(m.d, 0.0)')} AS rev_lines_deleted
FROM src s LEFT JOIN (
  SELECT source, median(rev_files_changed) AS f, median(rev_lines_added) AS a, median(rev_lines_deleted) AS d
  FROM rst_s GROUP BY source) m ON s.source = m.source
""", _COMMIT_COUNTS + "," + _REV_BY_SOURCE)

_MWU = """
vals AS (SELECT num_commits AS v, source FROM rev),
cnt AS (SELECT v, count_if(source = 'agent') AS na, count_if(source = 'human') AS nh, count(*) AS t
        FROM vals GROUP BY v),
rk AS (SELECT *, coalesce(sum(t) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                 + (t + 1) / 2.0 AS midrank FROM cnt),
tot AS (SELECT CAST(sum(na) AS DOUBLE) AS n1, CAST(sum(nh) AS DOUBLE) AS n2, sum(na * midrank) AS r1,
               CAST(sum(t * t * t - t) AS DOUBLE) AS tie FROM rk),
u AS (SELECT n1, n2, r1 - n1 * (n1 + 1) / 2.0 AS u1, tie FROM tot),
z AS (SELECT n1, n2, u1, greatest(u1, n1 * n2 - u1) AS um,
             (greatest(u1, n1 * n2 - u1) - n1 * n2 / 2.0 - 0.5)
             / sqrt(n1 * n2 / 12.0 * ((n1 + n2 + 1) - tie / ((n1 + n2) * (n1 + n2 - 1)))) AS zz
      FROM u WHERE n1 > 0 AND n2 > 0)
"""
ORACLE["mann_whitney_revisions"] = with_ctes(f"""
SELECT CAST(n1 AS BIGINT) AS n_agent, CAST(n2 AS BIGINT) AS n_human, {_r('u1')} AS u_statistic,
       {_r(f"least(1.0, {erfc('zz / sqrt(2.0)')})")} AS p_value,
       {f"least(1.0, {erfc('zz / sqrt(2.0)')})"} < 0.05 AS significant
FROM z
""", _COMMIT_COUNTS + "," + _MWU)
ORACLE["monthly_volume"] = with_ctes("""
SELECT substr(created_at, 1, 7) AS month, count_if(is_agent) AS agent, count_if(NOT is_agent) AS human,
       count(*) AS total FROM fixpr GROUP BY 1
""")
ORACLE["top_repos"] = with_ctes("""
SELECT repo_name, count(*) AS total, count_if(is_agent) AS agent FROM fixpr WHERE repo_name IS NOT NULL
GROUP BY repo_name ORDER BY total DESC, repo_name LIMIT 10
""")
ORACLE["repo_export"] = with_ctes("SELECT * FROM exp", _EXPORT)
ORACLE["top_exported_repos"] = with_ctes("""
SELECT repository, repo_id, pr_count, in_repository_metadata FROM exp
ORDER BY pr_count DESC, repository, repo_id LIMIT 10
""", _EXPORT)
ORACLE["repo_metadata_report"] = with_ctes(f"""
SELECT (SELECT count(DISTINCT repo_id) FROM base WHERE repo_id IS NOT NULL) AS repos_in_prs,
       (SELECT count(DISTINCT repo_id) FROM base WHERE repo_id IN (SELECT id FROM repo)) AS overlap,
       (SELECT count(DISTINCT repo_id) FROM base WHERE repo_id IS NOT NULL AND repo_id NOT IN (SELECT id FROM repo))
         AS missing_from_metadata,
       {_r('''(SELECT count(DISTINCT repo_id) FROM base WHERE repo_id IN (SELECT id FROM repo)) * 100.0
              / (SELECT count(DISTINCT repo_id) FROM base WHERE repo_id IS NOT NULL)''')} AS coverage_pct,
       (SELECT count(DISTINCT id) FROM repo) AS repos_in_metadata,
       (SELECT count(*) FROM exp WHERE repository <> 'Unknown' AND NOT in_repository_metadata) AS names_recovered
""", _EXPORT)
ORACLE["target_repos"] = with_ctes("SELECT * FROM repo WHERE id IN (SELECT repo_id FROM base WHERE agent IN "
                                   "('Devin', 'Copilot', 'Cursor', 'Claude_Code'))")
ORACLE["user_agent_labels"] = with_ctes('SELECT login AS "user", label AS agent FROM user_agent')
ORACLE["pull_requests"] = with_ctes(
    'SELECT id, number, title, login AS "user", user_id, state, created_at, closed_at, merged_at, repo_id, '
    f'repo_url, repo_name, html_url, is_agent, agent FROM pr WHERE {IN_WINDOW}')
