"""Words that a polynomial hash modulo 2**64 cannot tell apart, through the operators that rest on word hashes."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from pullscope.llm import text as T
from pullscope.llm.ans import default_tokenizer, token_table
from pullscope.llm.minhash import near_dedup
from pullscope.llm.substring import substring_dedup


def pattern(n, a="a", b="b"):
    """Thue-Morse word of 2**n letters."""
    bits = np.array([0])
    for _ in range(n):
        bits = np.concatenate([bits, 1 - bits])
    return "".join(a if x == 0 else b for x in bits)


X, Y = pattern(10), pattern(10, "b", "a")


def test_patterns_have_different_hashes():
    words = [X, Y, pattern(12), pattern(12, "b", "a"), "a", "b", "a\x00", "a" * 8, "a" * 9, "a" * 16, X + "a", "", "é"]
    column = pa.array([" ".join(w for w in words if w)])
    part = next(T.slices(column))
    found, hashes = T.word_hashes(part)
    assert len(hashes) == len(words) - 1 == len(set(hashes.tolist()))
    old = T.range_hashes(T.prefix_sums(part.data), found.starts, found.ends)
    assert old[0] == old[1]  # what the features still have
    again = next(T.slices(pa.array(["pad " + " ".join(reversed([w for w in words if w])) + " pad"])))
    assert set(hashes.tolist()) <= set(T.word_hashes(again)[1].tolist())  # equal wherever they stand


def test_near_dedup_links_only_equal_words(frame):
    rows = [(1, f"w1 w2 w3 w4 {X}"), (2, f"w1 w2 w3 w4 {Y}"), (3, f"w1 w2 w3 w4 {X}")]
    got = {r["doc_id"]: r["component_id"] for r in near_dedup(frame(rows)).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_tokens_of_both_words_are_their_own(frame):
    tokenizers = pytest.importorskip("tokenizers")
    tok = tokenizers.Tokenizer.from_file(default_tokenizer())
    rows = [(1, f"{X} {Y}"), (2, Y), (3, X)]
    got = {r["doc_id"]: r["ids_crc32"] for r in token_table(frame(rows)).collect()}
    for doc_id, text in rows:
        ids = np.array(tok.encode(text, add_special_tokens=False).ids + [2], "<u4")
        assert got[doc_id] == zlib.crc32(ids)


def test_windows_of_both_words_are_not_removed(frame):
    same = [f"s{i}" for i in range(40)]
    rows = [(1, " ".join([*same[:20], X, *same[20:]])), (2, " ".join([*same[:20], Y, *same[20:]]))]
    assert [r["n_removed"] for r in substring_dedup(frame(rows)).collect()] == [0, 0]
