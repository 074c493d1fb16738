"""Token ids of many texts by a public tokenizer file, each distinct word encoded once per worker.

Where a tokenizer drops white space before it looks for words, a text's ids are its blank-separated
chunks' ids in turn (``cuts_at_blanks`` finds out). Chunks are found and hashed with numpy on the Arrow buffer; each distinct chunk
is encoded by the tokenizers library once, many together, and its ids are then gathered for every place. So that
fewer chunks differ, A-Z are lowered first where the tokenizer does so, and chunks are also cut before trailing
``.,;:!?`` after an ASCII letter or digit where its words end there (neither in a slice that contains ``<|``, as special
tokens are matched in the raw text). Other tokenizers encode whole texts.

The memory of known chunks is kept by the Python worker between batches and tasks in two generations: beyond ``KNOWN``
chunks the younger one becomes the older, and chunks of the older one that are met again move to the younger, so it is
bounded and frequent chunks stay.
"""

from __future__ import annotations

import json
import os

import numpy as np

from pullscope.llm import text as T

#: Chunks of a generation.
KNOWN = 250_000
#: Most ids of a tokenizer: the frequency tables of token files hold as many symbols.
MOST_IDS = 1 << 18
#: A character that stands alone between chunks that are encoded together.
_MARK = "\x01"
_TOGETHER = 500
_BLANKS = " \t\n\x0b\x0c\r"
#: Normalisers that change characters one by one or with their combining marks, so never over a blank.
_LOCAL = {"NFC", "NFD", "NFKC", "NFKD", "Lowercase", "StripAccents"}
_PROBES = ["a", "Word", "don't", "'s", "12", "3.5", "x,", "(", "--", "é́", "日本", "\U0001f600", "́", "A" * 40, "<", "|>"]
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".,;:!?"]] = True
_PLAIN = np.zeros(256, bool)
_PLAIN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_RAW = np.uint64(0x5851F42D4C957F2D)
_encoders: dict[str, "Encoder"] = {}


def encoder(path: str) -> "Encoder":
    """The worker's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def cuts_at_blanks(tokenizer, spec: dict) -> bool:
    """Whether the ids of a text are those of its blank-separated chunks: no normaliser works over blanks (but
    for runs of white space that become one space), no added token holds white space or takes its neighbours', and
    pairs of probes with each blank between them have the ids of the probes."""
    steps = spec.get("normalizer") or {"type": "Sequence", "normalizers": []}
    steps = steps["normalizers"] if steps["type"] == "Sequence" else [steps]
    space = {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
    if any(s["type"] not in _LOCAL and s != space for s in steps):
        return False
    for token in spec.get("added_tokens") or []:
        if token["single_word"] or set(token["content"]) & set(_BLANKS):
            return False

    def ids(text: str) -> list[int]:
        return tokenizer.encode(text, add_special_tokens=False).ids

    own = {p: ids(p) for p in _PROBES}
    return not ids(_BLANKS) and all(ids(f"{a}{blank}{b}") == own[a] + own[b] for a in _PROBES for b in _PROBES for blank in _BLANKS)


def cuts_at_endings(tokenizer) -> bool:
    """Whether words end before a run of ``.,;:!?`` that follows an ASCII letter or digit, and the run stays whole."""
    if tokenizer.pre_tokenizer is None:
        return False
    for word in ("a", "Word", "x9", "12", "é1z"):
        for ending in (".", ",", ";", ":", "!", "?", "...", "?!", ",.;"):
            ends = {b for _, (_, b) in tokenizer.pre_tokenizer.pre_tokenize_str(word + ending)}
            alone = [p for p, _ in tokenizer.pre_tokenizer.pre_tokenize_str(ending)]
            after = [p for p, (a, _) in tokenizer.pre_tokenizer.pre_tokenize_str(word + ending) if a >= len(word)]
            if len(word) not in ends or alone != after:
                return False
    return True


def with_endings(data: np.ndarray, found: T.Words) -> T.Words:
    """Words with their trailing punctuation cut off as words of their own."""
    inside = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~_ENDS[data], out=inside[1:])
    # last byte that is no ending: the highest place whose running count equals that of the word's end
    plain_at = np.flatnonzero(~_ENDS[data])
    n = inside[found.ends]
    last = plain_at[np.maximum(n - 1, 0)] if len(plain_at) else np.zeros(len(found.ends), np.int64)
    cut = (n > inside[found.starts]) & (last + 1 < found.ends) & _PLAIN[data[np.minimum(last, len(data) - 1)]]
    starts = np.concatenate((found.starts, last[cut] + 1))
    ends = np.concatenate((np.where(cut, last + 1, found.ends), found.ends[cut]))
    by = np.argsort(starts, kind="stable")
    counts = np.concatenate(([0], np.cumsum(cut)))
    return T.Words(starts[by], ends[by], found.bounds + counts[found.bounds])


class _Generation:
    """Known chunks by their hash, with ids ``flat[at:at + n]``. New ones join a short sorted list, which is merged
    with the long one when it has grown to an eighth of it; ``flat`` grows by doubling."""

    def __init__(self, kind: type):
        self.lists = [_Sorted(), _Sorted()]
        self.flat, self.used = np.zeros(4096, kind), 0

    def __len__(self) -> int:
        return sum(len(x.keys) for x in self.lists)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(at, n) of each key, at -1 of those not known."""
        at, n = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        for some in self.lists:
            if len(some.keys):
                place = np.minimum(np.searchsorted(some.keys, keys), len(some.keys) - 1)
                here = some.keys[place] == keys
                at[here], n[here] = some.at[place[here]], some.n[place[here]]
        return at, n

    def add(self, keys: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> None:
        """New chunks, whose ids stand one after the other in ``flat``."""
        used = self.used + len(flat)
        if used > len(self.flat):
            room = np.zeros(max(used, 2 * len(self.flat)), self.flat.dtype)
            room[:self.used] = self.flat[:self.used]
            self.flat = room
        self.flat[self.used:used] = flat
        at = self.used + np.cumsum(sizes) - sizes
        self.used = used
        self.lists[1] = self.lists[1].merged(keys, at, sizes)
        if 8 * len(self.lists[1].keys) > len(self.lists[0].keys):
            short = self.lists[1]
            self.lists = [self.lists[0].merged(short.keys, short.at, short.n), _Sorted()]

    def ids(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Ids of chunks, one after the other."""
        ends = np.cumsum(n)
        return self.flat[np.repeat(at - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]


class _Sorted:
    def __init__(self, keys=np.zeros(0, np.uint64), at=np.zeros(0, np.int64), n=np.zeros(0, np.int64)):
        self.keys, self.at, self.n = keys, at, n

    def merged(self, keys: np.ndarray, at: np.ndarray, n: np.ndarray) -> "_Sorted":
        keys, at, n = np.concatenate([self.keys, keys]), np.concatenate([self.at, at]), np.concatenate([self.n, n])
        by = np.argsort(keys, kind="stable")
        return _Sorted(keys[by], at[by], n[by])


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        size = max(vocabulary.values()) + 1
        if size > MOST_IDS:
            raise ValueError(f"{path} has ids up to {size - 1}; token files hold ids below {MOST_IDS}")
        self.kind = np.uint16 if size <= 1 << 16 else np.uint32
        self.closes = np.zeros(size, bool)
        self.closes[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.mark = self.tokenizer.encode(_MARK, add_special_tokens=False).ids
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.chunked = cuts_at_blanks(self.tokenizer, spec)
        steps = spec.get("normalizer") or {"type": "Sequence", "normalizers": []}
        self.lowers = any(x["type"] == "Lowercase" for x in steps.get("normalizers", [steps]))
        self.endings = self.chunked and cuts_at_endings(self.tokenizer)
        self.young, self.old = _Generation(self.kind), _Generation(self.kind)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.kind) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _together(self, words: list[str], mark: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one after the other and how many each has, from joined texts: a word ends with a closing
        token, or at the mark."""
        glue = f" {_MARK} " if mark else " "
        flat, sizes = [], []
        for k, ids in enumerate(self._whole([glue.join(words[i:i + _TOGETHER]) for i in range(0, len(words), _TOGETHER)])):
            own = words[k * _TOGETHER:(k + 1) * _TOGETHER]
            if mark:
                at = np.flatnonzero(ids == self.mark[0])
                n = np.diff(np.concatenate(([-1], at, [len(ids)]))) - 1
                ids = np.delete(ids, at)
            else:
                n = np.diff(np.flatnonzero(self.closes[ids]), prepend=-1)
            if len(n) != len(own) or n.sum() != len(ids):  # cannot be told apart: one by one
                each = self._whole(own)
                ids, n = np.concatenate(each), np.array([len(e) for e in each])
            flat.append(ids)
            sizes.append(n)
        return np.concatenate(flat), np.concatenate(sizes)

    def _learn(self, keys: np.ndarray, chunks: list[bytes]) -> None:
        """Encode new chunks into the younger generation."""
        kinds = np.zeros(len(chunks), np.int8)
        for i, c in enumerate(chunks):
            if not c.isalpha():  # bytes: ASCII letters only
                kinds[i] = 2 if len(self.mark) != 1 or _MARK.encode() in c or b"<|" in c else 1
        for kind in (0, 1, 2):
            some = np.flatnonzero(kinds == kind)
            if len(some):
                texts = [chunks[i].decode() for i in some.tolist()]
                if kind < 2:
                    flat, n = self._together(texts, kind == 1)
                else:
                    each = self._whole(texts)
                    flat, n = np.concatenate(each), np.array([len(e) for e in each])
                self.young.add(keys[some], flat, n)

    def ids(self, part: T.Slice, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after the other (``end`` after each row, if given), and ids per row."""
        raw = part.data.tobytes()
        if not self.chunked:
            rows = [raw[a:b] for a, b in zip(part.offsets.tolist(), part.offsets.tolist()[1:], strict=False)]
            got = self._whole([r.decode() for r in rows])
            tail = [] if end is None else [np.array([end], self.kind)]
            return (np.concatenate([x for g in got for x in (g, *tail)]) if got else np.zeros(0, self.kind),
                    np.array([len(g) + len(tail) for g in got], np.int64))
        special = b"<|" in raw
        low = T.lowered(part) if self.lowers and not special else part
        found = T.words(low)
        if self.endings and not special and len(found.starts):
            found = with_endings(low.data, found)
        hashes = T.byte_hashes(low.data, found.starts, found.ends)
        if special:  # other cutting rules: never mixed with chunks known from lowered slices
            hashes = T.mix(hashes ^ _RAW)
        keys, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.young) > KNOWN:
            self.young, self.old = _Generation(self.kind), self.young
        at, n = self.young.find(keys)
        new = np.flatnonzero(at < 0)
        if len(new):
            old_at, old_n = self.old.find(keys[new])
            held = old_at >= 0
            if held.any():
                self.young.add(keys[new[held]], self.old.ids(old_at[held], old_n[held]), old_n[held])
            rest = new[~held]
            if len(rest):
                text = low.data.tobytes()
                starts, ends = found.starts[first[rest]].tolist(), found.ends[first[rest]].tolist()
                self._learn(keys[rest], [text[a:b] for a, b in zip(starts, ends, strict=True)])
            at, n = self.young.find(keys)
        bounds = found.bounds
        ids, n = self.young.ids(at[back], n[back]), n[back]
        sums = np.concatenate(([0], np.cumsum(n)))
        per_row = sums[bounds[1:]] - sums[bounds[:-1]] + (end is not None)
        if end is None:
            return ids, per_row
        out = np.full(len(ids) + part.rows, end, self.kind)
        out[np.arange(len(ids)) + np.repeat(np.arange(part.rows), per_row - 1)] = ids
        return out, per_row
