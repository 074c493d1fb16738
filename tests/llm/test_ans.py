import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pullscope.llm import ans
from pullscope.llm import text as T
from pullscope.llm.tokenise import encoder

tokenizers = pytest.importorskip("tokenizers")
PATH = ans.default_tokenizer()


def plain(texts):
    tok = tokenizers.Tokenizer.from_file(PATH)
    return [tok.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]


@settings(max_examples=120, deadline=None)
@given(st.lists(st.integers(0, 65535) | st.integers(0, 3), max_size=400), st.integers(1, 64), st.sampled_from([1, 4, 64]))
def test_segments_round_trip(ids, block, lanes):
    lengths = np.array([len(ids) // 2, len(ids) - len(ids) // 2])
    raw = ans.pack(np.array(ids, np.uint16), lengths, [7, None], block, lanes)
    seg = ans.Segment(raw)
    assert seg.ids().tolist() == ids and seg.doc_ids == [7, None] and seg.lengths.tolist() == lengths.tolist()
    size = seg.steps * seg.lanes
    for b in range(seg.blocks):  # any block alone
        assert seg.ids(b, b + 1).tolist() == ids[b * size:(b + 1) * size]


def test_skewed_ids_are_small_and_damage_is_seen():
    rng = np.random.default_rng(1)
    ids = np.minimum(rng.zipf(1.4, 300_000), 40_000).astype(np.uint16)
    raw = ans.pack(ids, np.array([len(ids)]), [1])
    p = np.bincount(ids) / len(ids)
    entropy = -(p[p > 0] * np.log2(p[p > 0])).sum() * len(ids) / 8
    assert entropy < len(raw) < 1.2 * entropy
    assert np.array_equal(ans.Segment(raw).ids(), ids)
    for at in (len(raw) - 40, len(raw) // 2):
        broken = bytearray(raw)
        broken[at] ^= 0x10
        with pytest.raises(ValueError):
            ans.Segment(bytes(broken)).ids()


def test_frequencies_sum_to_the_scale():
    rng = np.random.default_rng(2)
    for counts in (np.array([1]), np.array([10**9, 1, 1]), rng.integers(1, 50, 60_000), np.ones(70_000, int), rng.integers(1, 10**6, 1000)):
        f = ans.frequencies(counts)
        assert f.sum() == 1 << ans.SCALE and f.min() >= 1


ODD = ["", "The QUICK, brown fox's “tale”... don't stop!!", "word,word. word.. a.b,c 12345 3.14, x!", "<|endoftext|>", "a<|startoftext|>b <|EndOfText|>",
       "naïve café, CAFÉ. é, Å! ́x", "tab\there\nnew\x0bline\x0cfeed\r", "\x01 a\x01 \x01", "日本語、テスト。 　 x y", "İstanbul ΑΣ, ς.",
       "''s 's 'll 're we'll, it's.", "é, é. ñ: Ü!", "a.,;:!? .,; , .", "\U0001f600,\U0001f600. x", "= ̸ ≠ ≮", "9, 9. a9, 9a; z"]


def test_ids_are_those_of_the_library():
    got = []
    for part in T.slices(pa.array(ODD), 64):
        flat, n = encoder(PATH).ids(part, 2)
        got += [x.tolist() for x in np.split(flat, np.cumsum(n)[:-1])]
    assert got == plain(ODD)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abAB'st ,.!é́ÉßΣ1\n<|\x01日"), min_size=1, max_size=6))
def test_ids_of_any_text(rows):
    part = next(T.slices(pa.array(rows), 1 << 20))
    flat, n = encoder(PATH).ids(part, 2)
    assert [x.tolist() for x in np.split(flat, np.cumsum(n)[:-1])] == plain(rows)


def test_known_words_are_bounded(monkeypatch):
    import pullscope.llm.tokenise as tokenise
    monkeypatch.setattr(tokenise, "KNOWN", 50)
    e = tokenise.Encoder(PATH)
    for k in range(20):
        rows = [" ".join(f"word{k}x{i}" for i in range(30))] * 2
        flat, n = e.ids(next(T.slices(pa.array(rows))), 2)
        assert [x.tolist() for x in np.split(flat, np.cumsum(n)[:-1])] == plain(rows) and len(e.young) <= 80 and len(e.old) <= 80


@pytest.mark.parametrize("segment", [300, 1 << 21])
def test_token_table(frame, odd_rows, segment):
    rows = [(i, t) for i, t in odd_rows if i is not None and i != 5] + [(100 - i, t) for i, t in enumerate(ODD)]
    docs = frame(rows, wide=True).repartition(5)
    got = {r["doc_id"]: r for r in ans.token_table(docs, segment=segment).collect()}
    start = 0
    for (doc_id, _), ids in zip(sorted(rows, key=lambda r: r[0]), plain([t for _, t in sorted(rows, key=lambda r: r[0])])):
        r = got[doc_id]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(got) == len(rows)


def test_odd_rows_and_ids_of_files(spark, frame, odd_rows, tmp_path):
    docs = frame(odd_rows)
    out = ans.token_table(docs).collect()
    assert len(out) == len(odd_rows)
    ends = sorted((r["start"], r["start"] + r["n_tokens"]) for r in out)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
    assert ans.token_table(frame([])).count() == 0
    ans.write_tokens(frame([(2, "b c"), (1, "a")]), f"{tmp_path}/t")
    got = {r["doc_id"]: r["ids"] for r in ans.read_tokens(spark, f"{tmp_path}/t", with_ids=True).collect()}
    assert got == dict(zip([1, 2], plain(["a", "b c"])))


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_those_of_the_library_for_every_tokenizer(spark, frame, name):
    """One tokenizer drops white space (chunks are encoded once), the other keeps it and upper case (whole texts are)."""
    import public_tokenizers
    path = public_tokenizers.path(name)
    tok = tokenizers.Tokenizer.from_file(path)
    rows = list(enumerate([*ODD, None, "Two  Words\n\n Here ", "x" * 3000]))
    got = {r["doc_id"]: list(r["ids"]) for r in _read_back(spark, frame(rows), path)}
    for i, t in rows:
        assert got[i] == [*tok.encode(t or "", add_special_tokens=False).ids, 2]
    assert encoder(path).chunked == (name == "word_bpe_49k.json")


def _read_back(spark, docs, path):
    import tempfile
    folder = tempfile.mkdtemp(prefix="ps-ids-") + "/ids"
    ans.write_tokens(docs, folder, tokenizer=path)
    return ans.read_tokens(spark, folder, with_ids=True).collect()


def test_large_vocabularies_are_wide_or_refused(tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers
    for size, kind in ((70_000, np.uint32), (300_000, None)):
        tok = Tokenizer(models.WordLevel({f"w{i}": i for i in range(size)}, unk_token="w0"))
        tok.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        tok.save(str(tmp_path / f"{size}.json"))
        if kind is None:
            with pytest.raises(ValueError):
                encoder(str(tmp_path / f"{size}.json"))
            continue
        e = encoder(str(tmp_path / f"{size}.json"))
        flat, n = e.ids(next(T.slices(pa.array(["w69999 w5 none", "", "w65536"]))), 2)
        assert e.chunked and e.kind == kind and flat.tolist() == [69999, 5, 0, 2, 2, 65536, 2] and n.tolist() == [4, 1, 2]
