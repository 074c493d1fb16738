"""Golden and differential tests of the scalar functions."""

import math
import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from pullscope.functions import scalars as S
from pullscope.functions.mathx import erfc

# Python form of the title rule, written from the token list (the rule the reference applies).
PY_FIX = re.compile(r"\b(?:" + "|".join(S.FIX_TOKENS) + r")\b", re.IGNORECASE)


def py_classify(t):
    if not t or not isinstance(t, str):
        return "other"
    return "fix" if PY_FIX.search(t) else "other"


def one_col(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


TITLES_GOLDEN = {
    "prefix": "other", "bugs": "other", "bugfixes": "other", "debug": "other", "patches": "other",
    "fix_bug": "other", "hotfixes": "other", "fix: a": "fix", "Fix/thing": "fix", "Bug  fix": "fix",
    "RESOLVING": "fix", "fix(core)!: x": "fix", "a crash": "fix", "crashing app": "fix",
    "resolved": "fix", "resolvs": "other", "Error-prone": "fix", "errors": "other",
    "regression": "fix", "BROKEN": "fix", "défix": "other", "fixé": "other", "ａfix": "other",
    "bugfix": "fix", "x1fix": "other", "fix1": "other", "": "other", None: "other",
}


def test_classify_golden(spark):
    vals = list(TITLES_GOLDEN)
    got = one_col(spark, vals, S.classify_title)
    assert dict(zip(vals, got)) == TITLES_GOLDEN
    assert [py_classify(v) for v in vals] == got


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("fixbugpatchrsolvedcrashng _-:/(!)éÜ1 \t")),
                        max_size=24), min_size=1, max_size=20))
def test_classify_differential(spark, titles):
    assert one_col(spark, titles, S.classify_title) == [py_classify(t) for t in titles]


WS = ["a b", "  a\tb\nc  ", "a b", "a b　c", "a\x1cb\x1fc", "a​b", "", None,
      "\u0085x y", "one"]


def test_word_count_matches_python_split(spark):
    got = one_col(spark, WS, S.word_count)
    assert got == [len(s.split()) if s else 0 for s in WS]


def test_py_strip_matches_python(spark):
    vals = [s for s in WS if s is not None] + ["\x1c x \x1f", "　a　"]
    assert one_col(spark, vals, S.py_strip) == [s.strip() for s in vals]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab \t\n  \x1c\x1f​\u0085")),
                        max_size=12), min_size=1, max_size=15))
def test_word_count_differential(spark, texts):
    assert one_col(spark, texts, S.word_count) == [len(t.split()) for t in texts]


URLS = [
    ("https://github.com/a/b/pull/3", "a/b", "https://github.com/a/b/"),
    ("https://github.com/a/b", "a/b", "https://github.com/a/b/"),
    ("http://github.com/a/b/", "a/b", "http://github.com/a/b/"),
    ("https://api.github.com/repos/o/r", "repos/o", "https://api.github.com/repos/o/r"),
    ("https://github.com/a/b?x=1", "a/b?x=1", "https://github.com/a/b?x=1/"),
    ("https://example.com/a/b", None, "https://example.com/a/b"),
    ("github.com/a", None, "github.com/a"),
    (None, None, None),
]


def test_repo_from_url_and_clean_url(spark):
    vals = [u for u, _, _ in URLS]
    assert one_col(spark, vals, S.repo_from_url) == [r for _, r, _ in URLS]
    assert one_col(spark, vals, S.clean_url) == [c for _, _, c in URLS]


def test_final_name(spark):
    rows = [("x/y", None, None), ("Unknown", "https://github.com/a/b/pull/1", None),
            (None, None, "https://api.github.com/repos/o/r"), (None, None, None)]
    df = spark.createDataFrame(rows, "f string, h string, r string")
    got = [r[0] for r in df.select(S.final_name("f", "h", "r")).collect()]
    assert got == ["x/y", "a/b", "repos/o", "Unknown"]


def test_numstat_and_status(spark):
    lines = ["3\t4\tsrc/a.py", "-\t-\timg.png", "1\t2", "5\t0\tpath\twith\ttabs"]
    got = one_col(spark, lines, S.parse_numstat)
    assert [tuple(g) if g else None for g in got] == [
        (3, 4, "src/a.py"), (0, 0, "img.png"), None, (5, 0, "path\twith\ttabs")]
    letters = ["A", "M", "D", "R100", "C", "T", "X", "U"]
    assert one_col(spark, letters, S.status_word) == [
        "added", "modified", "removed", "renamed", "copied", "changed", "X", "U"]


def test_cap_bytes_counts_bytes_not_chars(spark):
    vals = ["é" * 3, "é" * 4, "abcdef"]
    assert one_col(spark, vals, lambda c: S.cap_bytes(c, 6)) == ["ééé", None, "abcdef"]


def test_actor_and_merged_at(spark):
    df = spark.createDataFrame([("", "Git Name"), (None, "N"), ("login", "N"), (None, None)],
                               "l string, n string")
    assert [r[0] for r in df.select(S.actor("l", "n")).collect()] == ["Git Name", "N", "login", ""]
    df = spark.createDataFrame([(None, "t"), ({}, "t"), ({"merged_at": None}, "t"), ({"merged_at": "m"}, "t")],
                               "m map<string,string>, t string")
    assert [r[0] for r in df.select(S.merged_at_of("m", "t")).collect()] == ["t", "t", None, "m"]


def test_hours_month_and_pct(spark):
    df = spark.createDataFrame([("2025-01-31T23:30:00Z", "2025-02-01T01:00:00Z", 1, 3), ("2025-01-01T00:00:00Z", None, 0, 0)],
                               "a string, b string, n long, d long")
    r = df.select(S.hours_between("a", "b"), S.month_of("a"), S.pct("n", "d")).collect()
    assert r[0][0] == pytest.approx(1.5) and r[0][1] == "2025-01" and r[0][2] == pytest.approx(100 / 3)
    assert r[1][0] is None and r[1][2] == 0.0


def test_format_half_even(spark):
    assert one_col(spark, [0.125, 1234.5], lambda c: S.fmt_number(c, 2), "double")[0] == "0.12"


def test_erfc_accuracy(spark):
    xs = [-3.0, -1.0, -0.1, 0.0, 0.3, 1.0, 2.5, 5.0]
    got = one_col(spark, xs, erfc, "double")
    for x, g in zip(xs, got):
        assert g == pytest.approx(math.erfc(x), rel=2e-7, abs=1e-12)


def test_diff_filename_and_sha_line(spark):
    hs = ["a/x.py b/x.py", "a/p b/q b/r", "a/nob"]
    assert one_col(spark, hs, S.diff_filename) == ["x.py", "q b/r", None]
    ls = ["a" * 40, "A" * 40, "0123456789abcdef0123456789abcdef01234567 extra", "abc"]
    assert one_col(spark, ls, S.is_sha_line) == [True, False, True, False]


def test_py_strip_all_code_points(spark):
    import sys
    # every code point next to a letter on both sides: strip must agree with Python
    cps = [c for c in map(chr, range(0, 0x3001)) if not (0xD800 <= ord(c) <= 0xDFFF)]
    vals = [c + "x" + c for c in cps]
    got = one_col(spark, vals, S.py_strip)
    bad = [hex(ord(c)) for c, g, v in zip(cps, got, vals) if g != v.strip()]
    assert bad == []
