import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from pullscope.llm import text as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
texts = st.lists(st.one_of(st.none(), st.text(alphabet=" \t\n\r\x0b\x0cabcÄé,.\x00\U0001f600", max_size=30)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(texts, st.integers(1, 40))
def test_words_are_those_of_the_pattern(rows, most):
    got = []
    for part in T.slices(pa.array(rows, pa.string()), most):
        found = T.words(part)
        raw = part.data.tobytes()
        for i in range(part.rows):
            lo, hi = found.bounds[i], found.bounds[i + 1]
            got.append([raw[a:b].decode() for a, b in zip(found.starts[lo:hi], found.ends[lo:hi])])
    assert got == [WORD.findall(t or "") for t in rows]


def test_equal_words_have_equal_hashes_and_others_differ():
    rows = ["the cat the", "cat", "a the", "tha"]
    seen = {}
    for part in T.slices(pa.array(rows), 8):
        found, hashes = T.word_hashes(part)
        raw = part.data.tobytes()
        for a, b, h in zip(found.starts, found.ends, hashes):
            assert seen.setdefault(raw[a:b], h) == h
    assert len(set(seen.values())) == len(seen) == 4


def test_window_hashes_depend_on_the_window_alone():
    part = next(T.slices(pa.array(["a b c d e f", "x b c d e y"])))
    found, hashes = T.word_hashes(part)
    for kind in (T.sequence_hashes, T.rolling_hashes):
        one, two = kind(hashes[:6], 4), kind(hashes[6:], 4)
        assert one[1] == two[1] and one[0] != two[0] and one[2] != two[2] and len(kind(hashes[:3], 4)) == 0


def test_word_count_and_fold(spark):
    from pyspark.sql import functions as F
    import zlib
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([None, "", " a\tb\x0bc d ", "x"])], "doc_id long, text string")
    got = rows.select(T.word_count(F.col("text")).alias("n"), T.split_share(F.col("doc_id"), 3).alias("f"), "doc_id").collect()
    assert [r["n"] for r in got] == [0, 0, 3, 1]
    assert all(r["f"] == zlib.crc32(str(r["doc_id"]).encode()) % 3 for r in got)
