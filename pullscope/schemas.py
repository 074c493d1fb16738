"""Explicit schemas for every table and payload (the reference infers all types)."""

from __future__ import annotations

from pyspark.sql import types as T

L, S, B, D, I = T.LongType(), T.StringType(), T.BooleanType(), T.DoubleType(), T.IntegerType()


def _st(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


REPOSITORY = _st(("id", L), ("url", S), ("license", S), ("full_name", S),
                 ("language", S), ("forks", L), ("stars", L))

BASELINE_PR = _st(("id", L), ("repo_id", L), ("user", S), ("agent", S),
                  ("repo_url", S), ("html_url", S))

PULL_REQUESTS = _st(("id", L), ("number", L), ("title", S), ("body", S), ("user", S),
                    ("user_id", L), ("state", S), ("created_at", S), ("closed_at", S),
                    ("merged_at", S), ("repo_id", L), ("repo_url", S), ("repo_name", S),
                    ("html_url", S), ("is_agent", B), ("agent", S))

COMMITS = _st(("sha", S), ("pr_id", L), ("author", S), ("committer", S), ("message", S),
              ("commit_seq", I))

COMMIT_DETAILS = _st(("sha", S), ("author", S), ("committer", S), ("message", S),
                     ("commit_stats_total", L), ("commit_stats_additions", L),
                     ("commit_stats_deletions", L), ("pr_id", L), ("filename", S),
                     ("status", S), ("additions", L), ("deletions", L), ("changes", L),
                     ("patch", S))

# The ten columns kept for the fix subset (no text columns, never the patch).
LEAN_DETAIL_COLUMNS = ["sha", "pr_id", "filename", "status", "additions", "deletions",
                       "changes", "commit_stats_total", "commit_stats_additions",
                       "commit_stats_deletions"]

CLASSIFIED_PRS = T.StructType(PULL_REQUESTS.fields + [T.StructField("type", S, True),
                                                       T.StructField("source", S, True)])

REPO_EXPORT = _st(("repo_id", L), ("repository", S), ("pr_count", L),
                  ("in_repository_metadata", B), ("language", S), ("stars", L), ("forks", L),
                  ("license", S), ("repo_url", S), ("html_url", S))

# ---- landed API payloads (one JSON object per line) -------------------------------------
PR_PAYLOAD_DDL = (
    "repo STRING, page INT, page_failed BOOLEAN, "
    "id BIGINT, number BIGINT, title STRING, body STRING, "
    "user STRUCT<login: STRING, id: BIGINT>, state STRING, created_at STRING, "
    "closed_at STRING, merged_at STRING, html_url STRING, pull_request MAP<STRING, STRING>"
)

COMMIT_LIST_DDL = (
    "pr_id BIGINT, page INT, page_failed BOOLEAN, "
    "commits ARRAY<STRUCT<sha: STRING, author: STRUCT<login: STRING>, "
    "committer: STRUCT<login: STRING>, "
    "commit: STRUCT<message: STRING, author: STRUCT<name: STRING>, committer: STRUCT<name: STRING>>>>"
)

COMMIT_DETAIL_DDL = (
    "sha STRING, commit STRUCT<message: STRING, author: STRUCT<name: STRING>, "
    "committer: STRUCT<name: STRING>>, "
    "stats STRUCT<total: BIGINT, additions: BIGINT, deletions: BIGINT>, "
    "files ARRAY<STRUCT<filename: STRING, status: STRING, additions: BIGINT, "
    "deletions: BIGINT, patch: STRING>>"
)

# ---- incremental state -------------------------------------------------------------------
STATE = _st(("phase", S), ("key", S), ("kind", S), ("detail", S), ("run_id", S))

REPORT = _st(("section", S), ("grp", S), ("metric", S), ("value", D), ("text", S))
