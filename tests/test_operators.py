"""Golden tests of the operators on small frames built from the cited edge rules."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from pullscope.operators import details as det
from pullscope.operators import facts, labels, quality, reports, repos, revisions, sampling, stats


def test_user_agent_last_distinct_label_wins(spark):
    base = spark.createDataFrame([(1, "u1", "A"), (2, "u1", "B"), (3, "u1", "A"), (4, "u2", "C"),
                                  (5, "u3", None)], "id long, user string, agent string")
    dim = {r["user"]: r["_label"] for r in labels.user_agent_dim(base).collect()}
    assert dim == {"u1": "B", "u2": "C"}
    prs = spark.createDataFrame([(10, "u1"), (11, "u9"), (12, "")], "id long, user string")
    out = {r["id"]: (r["is_agent"], r["agent"]) for r in labels.label_author(prs, labels.user_agent_dim(base)).collect()}
    assert out == {10: (True, "B"), 11: (False, "human"), 12: (False, "human")}


def test_repo_id_last_duplicate_wins(spark):
    repos_df = spark.createDataFrame([(1, "a/b"), (2, "a/b"), (3, None)], "id long, full_name string")
    prs = spark.createDataFrame([(1, "a/b"), (2, "x/y")], "id long, repo_name string")
    out = {r["id"]: r["repo_id"] for r in labels.attach_repo_id(prs, labels.repo_id_dim(repos_df)).collect()}
    assert out == {1: 2, 2: None}


def test_filter_created_inclusive_string_bounds(spark):
    df = spark.createDataFrame([("2024-12-01T00:00:00Z",), ("2024-11-30T23:59:59Z",),
                                ("2026-02-28T23:59:59Z",), ("2026-03-01T00:00:00Z",)], "created_at string")
    got = sorted(r[0] for r in labels.filter_created(df, "2024-12-01", "2026-02-28").collect())
    assert got == ["2024-12-01T00:00:00Z", "2026-02-28T23:59:59Z"]


def test_first_non_null_per_column(spark):
    df = spark.createDataFrame([(1, 7, None, "h1"), (2, 7, "r2", None), (3, 7, "r3", "h3"), (4, None, "x", "y"),
                                (5, 8, None, None)], "id long, repo_id long, repo_url string, html_url string")
    out = {r["repo_id"]: (r["pr_count"], r["repo_url"], r["html_url"]) for r in repos.repo_agg(df).collect()}
    assert out == {7: (3, "r2", "h1"), 8: (1, None, None)}


def test_repo_export_flags_and_names(spark):
    base = spark.createDataFrame([(1, 1, "https://api.github.com/repos/o/r", "https://github.com/o/r/pull/1"),
                                  (2, 2, None, "https://github.com/p/q/pull/9/"),
                                  (3, 3, None, None)],
                                 "id long, repo_id long, repo_url string, html_url string")
    meta = spark.createDataFrame([(1, "u", "MIT", "Unknown", "py", 1, 2), (1, "u", "MIT", "o/r", "py", 1, 2)],
                                 "id long, url string, license string, full_name string, language string, "
                                 "forks long, stars long")
    out = repos.sorted_export(repos.repo_export(base, meta)).collect()
    got = [(r["repo_id"], r["repository"], r["in_repository_metadata"], r["html_url"]) for r in out]
    # duplicated metadata id multiplies rows; names recovered from URLs; 'Unknown' as last resort
    assert sorted(got) == sorted([(1, "o/r", True, "https://github.com/o/r/"),
                                  (1, "o/r", True, "https://github.com/o/r/"),
                                  (2, "p/q", False, "https://github.com/p/q/"),
                                  (3, "Unknown", False, None)])


def test_change_size_null_sums_are_zero(spark):
    d = spark.createDataFrame([("s1", 1, None, None, None), ("s2", 2, "f", 3, 4), ("s2", 2, "f", 1, None),
                               ("s3", None, "g", 1, 1)],
                              "sha string, pr_id long, filename string, additions long, deletions long")
    out = {r["pr_id"]: tuple(r)[1:] for r in facts.change_size(d).collect()}
    assert out == {1: (0, 0, 0), 2: (1, 4, 4)}


def test_median_interpolates_and_empty_is_zero(spark):
    st = spark.createDataFrame([("agent", 1), ("agent", 2), ("agent", 10), ("agent", 11)], "source string, m long")
    out = {r["source"]: r["m"] for r in facts.median_by_source(st, ["m"]).collect()}
    assert out == {"agent": 6.0, "human": 0.0}


def test_fan_out_and_totals(spark):
    files = spark.createDataFrame([("s1", "f1", 1, 2), ("s1", "f2", 3, None), ("s2", None, None, None),
                                   ("s3", "f", 5, 5)],
                                  "sha string, filename string, additions long, deletions long")
    files = files.withColumn("author", F.lit("a")).withColumn("committer", F.lit("c")) \
        .withColumn("message", F.lit("m")).withColumn("status", F.lit("modified"))
    bridge = spark.createDataFrame([("s1", 10), ("s1", 11), ("s1", 11), ("s2", 12)], "sha string, pr_id long")
    out = det.assemble_details(files, bridge, keep_orphans=True).collect()
    assert det.assemble_details(files, bridge).where("pr_id is null").count() == 0
    s1 = [r for r in out if r["sha"] == "s1"]
    assert len(s1) == 6  # 2 files x 3 bridge rows (duplicate pair multiplies)
    assert {(r["commit_stats_additions"], r["commit_stats_deletions"], r["commit_stats_total"]) for r in s1} == {(4, 2, 6)}
    s2 = [r for r in out if r["sha"] == "s2"]
    assert len(s2) == 1 and s2[0]["filename"] is None and s2[0]["commit_stats_total"] == 0
    s3 = [r for r in out if r["sha"] == "s3"]
    assert len(s3) == 1 and s3[0]["pr_id"] is None and s3[0]["changes"] == 10


def test_prefer_and_missing(spark):
    a = spark.createDataFrame([("s1", "git")], "sha string, src string")
    b = spark.createDataFrame([("s1", "api"), ("s2", "api")], "sha string, src string")
    keys = spark.createDataFrame([("s1",), ("s2",), ("s3",)], "sha string")
    rows, missing = det.prefer(a, b, keys)
    assert sorted(map(tuple, rows.collect())) == [("s1", "git"), ("s2", "api")]
    assert [r[0] for r in missing.collect()] == ["s3"]


def test_revision_scopes(spark):
    # PR 1: shas x (first), y; PR 2: y (first), z; PR 3 (not revised) shares z
    commits = spark.createDataFrame([("x", 1, 1), ("y", 1, 2), ("y", 2, 1), ("z", 2, 2), ("z", 3, 1)],
                                    "sha string, pr_id long, commit_seq int")
    det_df = spark.createDataFrame([("x", 1, "a", 1, 0), ("y", 1, "b", 2, 0), ("y", 2, "b", 2, 0),
                                    ("z", 2, "c", 3, 0), ("z", 3, "c", 3, 0)],
                                   "sha string, pr_id long, filename string, additions long, deletions long")
    rev = spark.createDataFrame([(1,), (2,)], "pr_id long")
    g = {r["pr_id"]: r["rev_lines_added"] for r in revisions.revision_size(rev, commits, det_df, "global").collect()}
    p = {r["pr_id"]: r["rev_lines_added"] for r in revisions.revision_size(rev, commits, det_df, "pr").collect()}
    # global: y is first in PR 2 so it is removed everywhere; z is kept and PR 3 gets a row
    assert g == {2: 3, 3: 3}
    assert p == {1: 2, 2: 3}


def test_single_commit_rate_and_revised(spark):
    prs = spark.createDataFrame([(1, "agent", "m"), (2, "agent", "m"), (3, "agent", None), (4, "human", "m"),
                                 (5, "human", "m")], "id long, source string, merged_at string")
    cm = spark.createDataFrame([("a", 1), ("b", 2), ("c", 2), ("d", 3), ("e", 4), ("f", 4), ("g", 4)],
                               "sha string, pr_id long")
    r = {x["source"]: (x["single"], x["merged_with_commits"]) for x in facts.single_commit_rate(prs, cm).collect()}
    assert r == {"agent": (1, 2), "human": (0, 1)}
    s = {x["source"]: (x["revised"], x["median_commits"]) for x in facts.revised_summary(prs, cm).collect()}
    assert s == {"agent": (1, 2.0), "human": (1, 3.0)}


def test_crosstab_fills_zero_and_monthly(spark):
    df = spark.createDataFrame([("agent", "fix", True, "2025-01-31T23:59:59Z"),
                                ("human", "fix", False, "2025-02-01T00:00:00Z")],
                               "source string, type string, is_agent boolean, created_at string")
    ct = {r["source"]: (r["fix"], r["other"]) for r in reports.crosstab(df).collect()}
    assert ct == {"agent": (1, 0), "human": (1, 0)}
    mv = {r["month"]: (r["agent"], r["human"], r["total"]) for r in reports.monthly_volume(df).collect()}
    assert mv == {"2025-01": (1, 0, 1), "2025-02": (0, 1, 1)}


def _yates(a, b, c, d):
    n = a + b + c + d
    obs = [[a, b], [c, d]]
    rs, cs = [a + b, c + d], [a + c, b + d]
    chi = 0.0
    for i, j in itertools.product(range(2), range(2)):
        e = rs[i] * cs[j] / n
        diff = abs(obs[i][j] - e)
        chi += max(0.0, diff - min(0.5, diff)) ** 2 / e
    return chi


def test_chi2_matches_cell_by_cell_yates(spark):
    rng = random.Random(7)
    for _ in range(4):
        a, b, c, d = (rng.randint(1, 60) for _ in range(4))
        rows = ([("agent", "m")] * a + [("agent", None)] * b + [("human", "m")] * c + [("human", None)] * d)
        df = spark.createDataFrame(rows, "source string, merged_at string")
        r = stats.chi2_merge_rate(df).collect()[0]
        exp = _yates(a, b, c, d)
        assert r["chi2"] == pytest.approx(exp, rel=1e-9)
        assert r["p_value"] == pytest.approx(math.erfc(math.sqrt(exp / 2)), rel=1e-6, abs=1e-12)
    df = spark.createDataFrame([("agent", "m"), ("human", None)], "source string, merged_at string")
    assert stats.chi2_merge_rate(df).collect()[0]["chi2"] is None


def _mwu_brute(x, y):
    allv = sorted(x + y)
    ranks = {}
    i = 0
    while i < len(allv):
        j = i
        while j < len(allv) and allv[j] == allv[i]:
            j += 1
        ranks[allv[i]] = (i + 1 + j) / 2.0
        i = j
    r1 = sum(ranks[v] for v in x)
    u1 = r1 - len(x) * (len(x) + 1) / 2
    n1, n2 = len(x), len(y)
    n = n1 + n2
    ties = [allv.count(v) for v in set(allv)]
    tie = sum(t ** 3 - t for t in ties)
    s = math.sqrt(n1 * n2 / 12 * ((n + 1) - tie / (n * (n - 1))))
    z = (max(u1, n1 * n2 - u1) - n1 * n2 / 2 - 0.5) / s
    return u1, min(1.0, math.erfc(z / math.sqrt(2)))


def test_mann_whitney_matches_brute_force(spark):
    rng = random.Random(3)
    x = [rng.randint(2, 300) for _ in range(80)]
    y = [rng.randint(2, 200) for _ in range(60)]
    df = spark.createDataFrame([("agent", v) for v in x] + [("human", v) for v in y], "source string, v long")
    r = stats.mann_whitney(df, "v").collect()[0]
    u, p = _mwu_brute(x, y)
    assert r["u_statistic"] == pytest.approx(u)
    assert r["p_value"] == pytest.approx(p, rel=1e-6)


def test_exact_p_value_small_samples():
    # brute force over all rank assignments
    x, y = [1.0, 4.0, 9.0], [2.0, 3.0, 5.0, 6.0, 7.0]
    u1 = sum(1 for a in x for b in y if a > b)
    allv = x + y
    us = []
    for comb in itertools.combinations(range(len(allv)), len(x)):
        xs = [allv[i] for i in comb]
        ys = [allv[i] for i in range(len(allv)) if i not in comb]
        us.append(sum(1 for a in xs for b in ys if a > b))
    umax = max(u1, len(x) * len(y) - u1)
    brute = min(1.0, 2 * sum(1 for u in us if u >= umax) / len(us))
    assert stats.exact_p_value(u1, len(x), len(y)) == pytest.approx(brute)


def test_violin_density_matches_numpy(spark):
    import numpy as np
    vals = [1, 2, 2, 3, 10, 40, 41, 7]
    df = spark.createDataFrame([("agent", v) for v in vals], "source string, v long")
    out = sorted(stats.violin(df, "v", log=True).collect(), key=lambda r: r["i"])
    x = np.log10(np.maximum(np.array(vals, float), 1))
    h = x.std(ddof=1) * len(x) ** -0.2 * 0.5
    grid = np.linspace(x.min(), x.max(), 100)
    dens = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / h) ** 2).sum(1) / (len(x) * h * math.sqrt(2 * math.pi))
    assert [r["density"] for r in out] == pytest.approx(list(dens), rel=1e-9)
    assert out[0]["median"] == pytest.approx(float(np.percentile(x, 50)))


def test_coverage_and_validation(spark):
    a = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k long")
    b = spark.createDataFrame([(2,), (3,)], "k long")
    r = repos.coverage(a, b, "k", "k").collect()[0]
    assert (r["size_a"], r["size_b"], r["overlap"], r["only_a"]) == (2, 2, 1, 1)
    assert r["coverage_pct"] == 50.0


def test_sample_is_deterministic_and_bounded(spark):
    df = spark.range(0, 500).withColumnRenamed("id", "id")
    s1 = [r[0] for r in sampling.sample_n(df.repartition(7), 20, 42, ["id"]).collect()]
    s2 = [r[0] for r in sampling.sample_n(df.repartition(3), 20, 42, ["id"]).collect()]
    assert s1 == s2 and len(set(s1)) == 20


def test_quarantine_and_missing(spark):
    df = spark.createDataFrame([(1, "ok"), (2, None)], "id long, v string")
    good, bad = quality.quarantine(df, F.col("v").isNull())
    assert [r[0] for r in good.collect()] == [1] and [r[0] for r in bad.collect()] == [2]
    with pytest.raises(ValueError):
        quality.require_rows(df.where("false"), "prs")


def test_median_by_equals_median(spark):
    rng = random.Random(11)
    rows = [(g, float(rng.randint(0, 40)) / 4) for g in ("a", "b", "c") for _ in range(rng.randint(1, 60))]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r["g"]: r["median"] for r in reports.median_by(df, ["g"], "x").collect()}
    exp = {r["g"]: r["m"] for r in df.groupBy("g").agg(F.median("x").alias("m")).collect()}
    assert got.keys() == exp.keys()
    for k in got:
        assert got[k] == pytest.approx(exp[k])


@pytest.mark.parametrize("buckets", [2, 4, 128])
def test_distributed_median_edge_cases(spark, buckets):
    rng = random.Random(buckets)
    rows = ([("one", 5.0)] + [("two", 1.0), ("two", 4.0)] + [("same", 3.0)] * 9
            + [("skew", float(rng.choice([1, 1, 1, 2, 1000, 10 ** 6]))) for _ in range(301)]
            + [("ties", float(rng.randint(0, 3))) for _ in range(100)]
            + [("even", float(rng.random())) for _ in range(200)])
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r["g"]: r["median"] for r in reports.median_by(df, ["g"], "x", buckets=buckets).collect()}
    exp = {r["g"]: r["m"] for r in df.groupBy("g").agg(F.median("x").alias("m")).collect()}
    assert got.keys() == exp.keys()
    for k in got:
        assert got[k] == pytest.approx(exp[k], rel=1e-12)


def test_medians_by_pivots_metrics(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 3, 30), ("b", 2, 5)], "source string, m1 long, m2 long")
    got = {r["source"]: (r["m1"], r["m2"]) for r in reports.medians_by(df, ["source"], ["m1", "m2"]).collect()}
    assert got == {"a": (2.0, 20.0), "b": (2.0, 5.0)}


@pytest.mark.parametrize("method", ["map", "distributed"])
def test_median_methods_agree(spark, method):
    st = spark.createDataFrame([("agent", 1, 5), ("agent", 2, 7), ("agent", 10, 7), ("agent", 11, 1),
                                ("human", 3, 3)], "source string, a long, b long")
    out = {r["source"]: (r["a"], r["b"]) for r in facts.median_by_source(st, ["a", "b"], method).collect()}
    assert out == {"agent": (6.0, 6.0), "human": (3.0, 3.0)}


def test_sha_repo_and_batches(spark):
    commits = spark.createDataFrame([("s1", 2, 1), ("s1", 1, 3), ("s2", 9, 1), ("s3", 3, 1)],
                                    "sha string, pr_id long, commit_seq int")
    prs = spark.createDataFrame([(1, "o/a"), (2, "o/b"), (3, None)], "id long, repo_name string")
    m, unmatched = det.sha_repo(commits, prs)
    assert {r["sha"]: r["repo_name"] for r in m.collect()} == {"s1": "o/a"}
    assert sorted(r[0] for r in unmatched.collect()) == ["s2", "s3"]
    many = spark.range(0, 2000).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("sha"),
                                       F.lit("o/hot").alias("repo_name"))
    b = det.batch_keys(many, batch_size=500)
    sizes = [r["count"] for r in b.groupBy("repo_name", "batch").count().collect()]
    assert len(sizes) == 4 and sum(sizes) == 2000 and max(sizes) < 700


def test_revision_size_by_group_keeps_reference_per_call_semantics(spark):
    # agent revised PR 1: shas a (first), x; human revised PR 2: x (first), y; PR 3 (not revised) holds y
    commits = spark.createDataFrame([("a", 1, 1), ("x", 1, 2), ("x", 2, 1), ("y", 2, 2), ("y", 3, 1)],
                                    "sha string, pr_id long, commit_seq int")
    det_df = spark.createDataFrame([("a", 1, "f", 1, 0), ("x", 1, "g", 2, 0), ("x", 2, "g", 2, 0),
                                    ("y", 2, "h", 4, 0), ("y", 3, "h", 4, 0)],
                                   "sha string, pr_id long, filename string, additions long, deletions long")
    rev = spark.createDataFrame([(1, "agent"), (2, "human")], "pr_id long, source string")
    got = sorted((r["source"], r["pr_id"], r["rev_lines_added"])
                 for r in revisions.revision_size_by(rev, commits, det_df).collect())
    # agent keeps x (first only in the human call) -> rows for PR 1 and PR 2 (shares x);
    # human keeps y -> rows for PR 2 and PR 3 (not revised, shares y)
    assert got == [("agent", 1, 2), ("agent", 2, 2), ("human", 2, 4), ("human", 3, 4)]


def test_overview_exact_and_approx(spark):
    prs = spark.createDataFrame([("2025-01-02T00:00:00Z", True, "o/a"), ("2025-03-04T00:00:00Z", False, "o/b"),
                                 ("2025-02-01T00:00:00Z", True, "o/a")],
                                "created_at string, is_agent boolean, repo_name string")
    cm = spark.createDataFrame([("x",), ("y",), ("x",)], "author string")
    for approx in (False, True):
        r = reports.overview(prs, cm, approx=approx).collect()[0]
        assert (r["date_from"], r["date_to"], r["prs"], r["agent_prs"], r["human_prs"], r["repositories"],
                r["commits"], r["unique_authors"]) == ("2025-01-02", "2025-03-04", 3, 2, 1, 2, 3, 2)
