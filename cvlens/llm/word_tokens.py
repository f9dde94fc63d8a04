"""Batch encoding with a word-ended BPE file of the ``tokenizers`` library.

The library spends most of a text's time on words it has met before. White
space always ends a word in these files, so the ids of a text are those of its
white-space-separated pieces in order; each piece is encoded once by the
library and then looked up. Pieces beyond Latin-1 go through the file's own
normaliser; in Latin-1 that normaliser is plain lower-casing.

The look-up is a cache of a worker process: it is emptied between batches when
it passes ``MAX_PIECES`` pieces or ``MAX_CHARS`` characters. It changes no id.
"""

from __future__ import annotations

import os
from array import array
from functools import lru_cache

import numpy as np

from cvlens.llm.common import claim_cache

MAX_PIECES = 500_000
MAX_CHARS = 32 << 20

# str.split() parts at these; the files' patterns take them for symbols.
_NOT_SPACE = "\x1c\x1d\x1e\x1f"
# One of these at the end of a word is a token of its own.
_STOPS = ".,;:!?"


# Words in a call of the library.
_CALL = 100


def _byte_letters() -> dict[int, str]:
    """Byte -> the letter that byte-level vocabularies write for it: printable ones stand for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _latin(s: str) -> bool:
    try:
        s.encode("latin-1")
        return True
    except UnicodeEncodeError:
        return False


class _Numbers(dict):
    """Piece -> running number; new pieces are noted."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        n = self[piece] = len(self)
        self.new.append(piece)
        return n


class WordTokenizer:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True  # their strings in a text are ordinary text
        self.words = Tokenizer.from_file(path)
        self.words.encode_special_tokens = True
        self.words.normalizer = None
        self.alone = Tokenizer.from_file(path)  # for single words, written in byte letters
        self.alone.encode_special_tokens = True
        self.alone.normalizer = None
        self.alone.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.letters = _byte_letters()
        self.size = self.whole.get_vocab_size()
        ends = np.zeros(self.size, bool)
        for token, i in self.whole.get_vocab(with_added_tokens=False).items():
            ends[i] = token.endswith("</w>")
        self.ends = ends
        self._reset()

    def _reset(self) -> None:
        self.numbers, self.chars = _Numbers(), 0
        self.ids, self.starts, self.lens = array("I"), array("q"), array("i")

    def _plain(self, parts: list[str]) -> dict[str, list[int]]:
        """Parts -> ids, by the library."""
        out: dict[str, list[int]] = {}
        latin = [p for p in parts if _latin(p)]
        alone = [p for p in latin if p.isalpha()]
        if alone:  # each is one word: many in a call, cut at the word ends
            low = [p.lower() for p in alone]
            low = [p if p.isascii() else p.encode().decode("latin-1").translate(self.letters) for p in low]
            calls = [" ".join(low[i:i + _CALL]) for i in range(0, len(low), _CALL)]
            ids = [i for e in self.alone.encode_batch_fast(calls, add_special_tokens=False) for i in e.ids]
            cuts = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(cuts) == len(alone):
                for p, a, z in zip(alone, [0, *cuts], cuts):
                    out[p] = ids[a:z]
        rest = [p for p in latin if p not in out]
        for p, e in zip(rest, self.words.encode_batch_fast([p.lower() for p in rest], add_special_tokens=False)):
            out[p] = e.ids
        rest = [p for p in parts if p not in out]
        for p, e in zip(rest, self.whole.encode_batch_fast(rest, add_special_tokens=False)):
            out[p] = e.ids
        return out

    def _learn(self) -> None:
        new, self.numbers.new = self.numbers.new, []
        known = len(self.lens)
        parts: dict[str, None] = {}
        cut = []
        for piece in new:
            core = piece.rstrip(_STOPS)
            if core and core != piece and core[-1].isalnum():
                cut.append((core, piece[len(core):]))
                parts[cut[-1][1]] = None
            else:
                core = piece
                cut.append((piece, ""))
            if self.numbers.get(core, known) >= known:
                parts[core] = None
        ids = self._plain(list(parts))
        for piece, (core, tail) in zip(new, cut):
            if core in ids:
                own = ids[core]
            else:
                k = self.numbers[core]
                own = self.ids[self.starts[k]:self.starts[k] + self.lens[k]].tolist()
            if tail:
                own = own + ids[tail]
            self.starts.append(len(self.ids))
            self.lens.append(len(own))
            self.ids.extend(own)
            self.chars += len(piece)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, number of ids of each text); null counts as empty."""
        if len(self.numbers) > MAX_PIECES or self.chars > MAX_CHARS:
            self._reset()
        number = self.numbers.__getitem__
        spans, sizes, odd = [], np.zeros(len(texts), np.int64), {}
        for i, t in enumerate(texts):
            if not t:
                continue
            if any(c in t for c in _NOT_SPACE):
                odd[i] = self.whole.encode(t, add_special_tokens=False).ids
                continue
            pieces = (t.lower() if _latin(t) else t).split()
            sizes[i] = len(pieces)
            spans.append(np.fromiter(map(number, pieces), np.int64, len(pieces)))
        self._learn()
        at = np.concatenate(spans) if spans else np.zeros(0, np.int64)
        starts, lens, ids = (np.frombuffer(x, d) if len(x) else np.zeros(0, d)
                             for x, d in ((self.starts, np.int64), (self.lens, np.int32), (self.ids, np.uint32)))
        n = lens[at].astype(np.int64)
        ends = np.cumsum(n)
        flat = ids[np.repeat(starts[at] - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)]
        del starts, lens, ids  # the arrays can't grow while a view is held
        upto = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes)])]
        counts = np.diff(upto)
        if odd:
            parts = [np.asarray(odd[i], np.uint32) if i in odd else flat[upto[i]:upto[i + 1]] for i in range(len(texts))]
            flat, counts = np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
        return flat, counts


@lru_cache(maxsize=1)
def _loaded(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def word_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer, and one cache, for each worker process."""
    claim_cache("word tokens", _loaded.cache_clear)
    return _loaded(path)


def with_end(flat: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same ids with ``end_id`` after each text, and the new counts."""
    return np.insert(flat, np.cumsum(counts), np.uint32(end_id)), counts + 1
