"""Exact, cached encoding of whole texts with a tokenizers vocabulary file (used by operators 8 and 10).

A text is cut where the vocabulary's own pre-tokenizer must cut it; each distinct piece is
encoded once by the tokenizers library and kept in a bounded cache. Texts in which a cut could
depend on more than its piece (special tokens, unusual white space) go to the library whole.
"""

from __future__ import annotations

import base64
import os
import re
import sys
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from mailgrove.llm.shared import Seen, gather, worker_state

#: Pieces and characters of pieces kept by a worker; the cache is emptied when full.
CACHE, ROOM = 300_000, 24 << 20
#: White space other than space, tab and line ends.
ODD_SPACE = r"[\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: White space that a space-marking vocabulary doesn't cut piece by piece: runs, tabs, ends of texts, and the mark used for cutting.
RUNS = r"  | \n|\n |\n\n|[\t\r\x00]|[ \n]\z"
#: ASCII marks that end a word (the apostrophe may not).
MARKS = r"[!-&(-/:-@\[-`{-~]"
#: Letters that are one letter in either case and composed; others may end in a combining mark, which joins the marks after it.
PLAIN = r"[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}]"
#: The pattern of the byte-level vocabulary's rank file (fixed value).
RANKED_WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def vocabulary(name: str) -> str:
    """The path of a public vocabulary file."""
    if "/opt/tokenizers" not in sys.path and os.path.isdir("/opt/tokenizers"):
        spec = __import__("importlib.util", fromlist=["util"]).spec_from_file_location("public_tokenizers", "/opt/tokenizers/__init__.py")
        module = __import__("importlib.util", fromlist=["util"]).module_from_spec(spec)
        spec.loader.exec_module(module)
        return module.path(name)
    import public_tokenizers

    return public_tokenizers.path(name)


def _escaped(text: str) -> str:
    """text as a pattern, every character by its number."""
    return "".join(f"\\x{{{ord(c):x}}}" for c in text)


class Table:
    """Ids of distinct pieces, met once each: number of a piece -> a slice of one buffer."""

    def __init__(self, learn):
        self.learn = learn
        self._begin()

    def _begin(self):
        self.seen, self.ids, self.used = Seen(CACHE, ROOM), np.zeros(1 << 16, np.uint32), 0
        self.start, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def of(self, pieces: pa.Array):
        """(ids of all pieces in a row, number of ids of each piece)."""
        if self.seen.full:
            self._begin()
        coded = pc.dictionary_encode(pieces)
        at, fresh = self.seen.locate(coded.dictionary.to_pylist())
        if fresh:
            size, ids = self.learn(fresh)
            n = len(self.seen.index)
            while n > len(self.start):
                self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
            while self.used + len(ids) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            self.start[n - len(fresh) : n] = self.used + np.cumsum(size) - size
            self.size[n - len(fresh) : n] = size
            self.ids[self.used : self.used + len(ids)] = ids
            self.used += len(ids)
        number = at[coded.indices.to_numpy(zero_copy_only=False)] if len(pieces) else at[:0]
        size = self.size[number]
        return self.ids[gather(self.start[number], size)], size


def words_apart(texts: pa.Array) -> pa.Array:
    """Texts in which far fewer pieces are distinct, with the same words for a lower-casing vocabulary with word ends.

    A-Z are lower-cased, unless the text has combining marks (these may compose with one case
    only), and a blank stands between a plain letter and an ASCII mark, where a word ends anyway.
    """
    apart = pc.replace_substring_regex(texts, rf"({PLAIN})({MARKS})", r"\1 \2")  # a new array: ascii_lower misreads slices
    return pc.if_else(pc.match_substring_regex(texts, r"\p{M}"), apart, pc.ascii_lower(apart))


def joined(ids: np.ndarray, size: np.ndarray, offsets: np.ndarray, whole: dict[int, np.ndarray]):
    """(ids, offsets of the documents) from the ids of all pieces, the number of ids of each, the pieces' offsets and the documents encoded whole."""
    ends = np.concatenate(([0], np.cumsum(size)))[offsets]
    if whole:
        parts, at = [], 0
        length = np.diff(ends)
        for i, some in sorted(whole.items()):
            parts += [ids[at : ends[i]], some]
            at, length[i] = ends[i + 1], len(some)
        ids = np.concatenate([*parts, ids[at:]])
        ends = np.concatenate(([0], np.cumsum(length)))
    return ids, ends


def split(texts: pa.Array, odd: np.ndarray, cut) -> tuple[pa.Array, np.ndarray]:
    """(all pieces, offsets of the documents); odd texts have none."""
    lists = cut(pc.if_else(pa.array(odd), "", texts))
    offsets = lists.offsets.to_numpy()
    return lists.flatten(), (offsets - offsets[0]).astype(np.int64)


class Encoder:
    """Texts -> ids, equal to Tokenizer.encode(text, add_special_tokens=False)."""

    def __init__(self, path: str, ranks: str | None = None):
        """ranks: a rank file of the same vocabulary, if there is one; it makes new pieces cheaper to encode."""
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        special = [_escaped(t.content) for t in self.tok.get_added_tokens_decoder().values()]
        self.spaced = self._spaced()
        self.worded = not self.spaced and self._worded()
        if self.worded:
            special = [f"(?i:{x})" for x in special]  # lower-casing must not make one
        self.odd = "|".join([*special, ODD_SPACE, *([RUNS] if self.spaced else [])])
        self.table, self.ranked = Table(self._learn), None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.ranked = tiktoken.Encoding(os.path.basename(ranks), pat_str=RANKED_WORDS, mergeable_ranks=table, special_tokens={})

    def _spaced(self) -> bool:
        """Whether a space before a word is part of its ids."""
        return self.tok.encode(" a", add_special_tokens=False).ids != self.tok.encode("a", add_special_tokens=False).ids

    def _worded(self) -> bool:
        """Whether words_apart keeps the ids: case doesn't count and a mark begins a new word."""
        same = lambda a, b: self.tok.encode(a, add_special_tokens=False).ids == self.tok.encode(b, add_special_tokens=False).ids
        letters = all(same(x, x.lower()) for x in map(chr, range(65, 91)))
        return letters and all(same(f"zq{m}{m}x", f"zq {m}{m}x") for m in map(chr, range(33, 127)) if re.fullmatch(MARKS, m))

    def whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, pieces: list[str]):
        got = []
        for at in range(0, len(pieces), 4096):
            some = pieces[at : at + 4096]
            got += map(self.ranked.encode_ordinary, some) if self.ranked else [e.ids for e in self.tok.encode_batch_fast(some, add_special_tokens=False)]
        size = np.fromiter(map(len, got), np.int64, len(got))
        return size, np.fromiter(chain.from_iterable(got), np.uint32, int(size.sum()))

    def _cut(self, texts: pa.Array) -> pa.Array:
        """Pieces whose ids don't depend on each other."""
        if not self.spaced:
            return pc.utf8_split_whitespace(words_apart(texts) if self.worded else texts)
        # single spaces go with the next word, single line ends stand alone
        return pc.split_pattern(pc.replace_substring(pc.replace_substring(texts, "\n", "\x00\n\x00"), " ", "\x00 "), "\x00")

    def batch(self, texts: pa.Array):
        """(ids of all texts in a row, offsets of the texts); a null text is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False)
        pieces, offsets = split(texts, odd, self._cut)
        whole = {i: np.frombuffer(self.whole(texts[i].as_py()), "<u4") for i in np.flatnonzero(odd).tolist()}
        return joined(*self.table.of(pieces), offsets, whole)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers."""
        ids, ends = self.batch(pa.array(texts, pa.large_string()))
        return [ids[a:b].astype("<u4").tobytes() for a, b in zip(ends, ends[1:], strict=False)]


def encoder(path: str, ranks: str | None = None) -> Encoder:
    """One encoder a worker and vocabulary."""
    return worker_state(("encoder", path, ranks), lambda: Encoder(path, ranks))
