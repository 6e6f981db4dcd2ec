"""BPE encoding and decoding with a minimal acyclic transducer (operator 7).

The frequent words of the corpus, counted over all documents, are compiled with their ids into
a minimal acyclic automaton: equal suffixes share states, and the words skipped at each edge
number a word's place in the table of ids. The automaton is a set of flat arrays in one file
that Spark hands to every executor, where it is memory-mapped. Words outside it are merged by
the vocabulary's ranks. The vocabulary file's kind is fixed: lower-casing BPE with word ends.

Decoding knows ids only: each id's string comes from the vocabulary, and the strings of a text are
joined by spaces, as the library does for a vocabulary without a decoder.

Defined cases: a null text is empty and has no ids; special-token strings in a text become
their ids, as in the library; repeated rows are repeated; an empty table gives an empty result;
extra columns are ignored; a null doc_id stays null.
"""

from __future__ import annotations

import hashlib
import heapq
import io
import json
import re
import unicodedata
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailgrove.llm.shared import arrow_batches, new_path, pick, text_batches, worker_state
from mailgrove.llm.tokens import CACHE, ODD_SPACE, Table, joined, split, vocabulary, words_apart

#: Words compiled into the lexicon; documents whose words are counted together.
LEXICON, SLICE = 32_768, 4096
#: The vocabulary's pattern for words (fixed value).
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\t-\r \x85\p{Z}\p{L}\p{N}]+")
END = "</w>"
#: Words merged together, and the rank of pairs that don't merge.
TOGETHER, NONE = 8192, 1 << 60


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: bytes that print stand for themselves, the others follow from U+0100 on."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = [""] * 256, 0
    for b in range(256):
        out[b] = chr(b) if b in keep else chr(256 + spare)
        spare += b not in keep
    return out


class Vocabulary:
    """Words of a text, their merges and the strings of ids."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model.get("end_of_word_suffix") != END:
            raise ValueError("a vocabulary with word ends is expected")
        self.ids = model["vocab"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.rank = {tuple(p): i for i, p in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.at_special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.string = {i: s for s, i in self.ids.items()} | {i: s for s, i in self.special.items()}
        self.symbols = byte_symbols()
        self._number_symbols()

    def _number_symbols(self) -> None:
        """Arrays for merging many words at once: symbols by number (0 fills), pairs as sorted keys."""
        names = dict.fromkeys([*self.symbols, *(x + END for x in self.symbols), *chain.from_iterable((a, b, a + b) for a, b in self.rank)])
        number = {x: i for i, x in enumerate(names, 1)}
        self.inside, self.ending = (np.array([number[x + e] for x in self.symbols], np.int64) for e in ("", END))
        self.id_of = np.array([-1, *(self.ids.get(x, -1) for x in names)], np.int64)
        self.base = len(names) + 1
        pairs = np.array([number[a] * self.base + number[b] for a, b in self.rank], np.int64)
        ranks, made = np.fromiter(self.rank.values(), np.int64, len(pairs)), np.array([number[a + b] for a, b in self.rank], np.int64)
        order = np.argsort(pairs)
        self.pairs, self.pair_rank = pairs[order], ranks[order]
        self.made = np.zeros(int(ranks.max(initial=0)) + 1, np.int64)
        self.made[ranks] = made

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        want = a * self.base + b
        at = np.minimum(np.searchsorted(self.pairs, want), len(self.pairs) - 1)
        return np.where(self.pairs[at] == want, self.pair_rank[at], NONE)

    def normal(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        # lower-cased letter by letter: a final sigma is not told apart
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def merge(self, word: str) -> list[int]:
        """Ids of one word: the lowest-ranked neighbours merge first, the leftmost of equal ones."""
        parts = [self.symbols[b] for b in word.encode("utf-8", "surrogatepass")]
        parts[-1] += END
        if len(parts) > 64:
            parts = self._merge_long(parts)
        else:
            rank, none = self.rank, 1 << 60
            while len(parts) > 1:
                ranks = [rank.get(p, none) for p in zip(parts, parts[1:], strict=False)]
                least = min(ranks)
                if least == none:
                    break
                i = ranks.index(least)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ids[p] for p in parts if p in self.ids]

    def merge_all(self, words: list[str]) -> list[list[int]]:
        """merge() of many words, those of similar length together: each round merges the best pair of every word that has one."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        out: list = [None] * len(words)
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        order = np.argsort(size, kind="stable")
        short = order[(size[order] <= 64) & (size[order] > 0)] if len(self.pairs) else order[:0]
        for at in range(0, len(short), TOGETHER):
            some = short[at : at + TOGETHER]
            merged = self.id_of[self._merge_block([raw[i] for i in some.tolist()], size[some])]
            known = merged >= 0
            ends = np.cumsum(known.sum(1)).tolist()
            flat = merged[known].tolist()
            for i, a, b in zip(some.tolist(), [0, *ends], ends, strict=False):
                out[i] = flat[a:b]
        return [self.merge(w) if x is None else x for w, x in zip(words, out, strict=True)]

    def _merge_block(self, raw: list[bytes], size: np.ndarray) -> np.ndarray:
        n, width = len(raw), int(size.max())
        place = np.arange(width + 1)
        symbols = np.zeros((n, width + 1), np.int64)
        flat = np.frombuffer(b"".join(raw), np.uint8)
        symbols[place < size[:, None]] = self.inside[flat]
        symbols[np.arange(n), size - 1] = self.ending[flat[np.cumsum(size) - 1]]
        ranks = self._ranks(symbols[:, :-1], symbols[:, 1:])
        out, row = np.zeros_like(symbols), np.arange(n)
        while len(row):
            i = ranks.argmin(1)  # the leftmost of equal ranks
            best = ranks[np.arange(len(row)), i]
            live = best < NONE
            if not live.all():
                out[row[~live]] = symbols[~live]
                symbols, ranks, i, best, row = symbols[live], ranks[live], i[live], best[live], row[live]
            every = np.arange(len(row))
            symbols[every, i] = self.made[best]
            moved = np.minimum(place + (place > i[:, None]), width)
            symbols = np.take_along_axis(symbols, moved, 1)
            ranks = np.take_along_axis(ranks, np.minimum(moved[:, :-1], width - 1), 1)
            ranks[every, i] = self._ranks(symbols[every, i], symbols[every, i + 1])
            left, j = every[i > 0], i[i > 0]
            ranks[left, j - 1] = self._ranks(symbols[left, j - 1], symbols[left, j])
        return out

    def _merge_long(self, parts: list[str]) -> list[str]:
        n, rank = len(parts), self.rank
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        alive = [True] * n
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := rank.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j < 0 or parts[i] != a or parts[j] != b:
                continue
            parts[i], alive[j], after[i] = a + b, False, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (r := rank.get((parts[x], parts[y]))) is not None:
                    heapq.heappush(heap, (r, x, parts[x], parts[y]))
        return [p for p, ok in zip(parts, alive, strict=True) if ok]


def compile_lexicon(words: dict[bytes, list[int]]) -> bytes:
    """A minimal acyclic automaton over sorted words with their ids, as one .npz-free block of arrays.

    Words are added in order; the states of the last word that can't grow any more are replaced
    by equal ones met before. Numbers of words below each state turn a path into a word's rank.
    """
    order = sorted(words)
    register: dict[tuple, int] = {}
    edges: list[dict[int, int]] = [{}]
    final = [False]
    path: list[tuple[int, int]] = []  # (state, byte) of the last word

    def freeze(depth):
        while len(path) > depth:
            parent, label = path.pop()
            child = edges[parent][label]
            shape = (final[child], tuple(sorted(edges[child].items())))
            edges[parent][label] = register.setdefault(shape, child)

    last = b""
    for w in order:
        same = 0
        while same < min(len(w), len(last)) and w[same] == last[same]:
            same += 1
        freeze(same)
        state = edges[path[-1][0]][path[-1][1]] if path else 0
        for b in w[same:]:
            edges.append({})
            final.append(False)
            edges[state][b] = len(edges) - 1
            path.append((state, b))
            state = len(edges) - 1
        final[state] = True
        last = w
    freeze(0)
    below: dict[int, int] = {}
    live, stack = [], [(0, False)]
    while stack:
        s, done = stack.pop()
        if done:
            below[s] = final[s] + sum(below[t] for t in edges[s].values())
            live.append(s)
        elif s not in below:
            below[s] = -1
            stack.append((s, True))
            stack.extend((t, False) for t in edges[s].values() if t not in below)
    number = {s: i for i, s in enumerate(sorted(set(live)))}
    keys, targets, skips = [], [], []
    for s in sorted(number):
        skip = int(final[s])
        for b, t in sorted(edges[s].items()):
            keys.append(number[s] * 256 + b)
            targets.append(number[t])
            skips.append(skip)
            skip += below[t]
    ends = np.cumsum([0, *(len(words[w]) for w in order)])
    arrays = [np.array(keys, "<i8"), np.array(targets, "<i8"), np.array(skips, "<i8"), np.array([final[s] for s in sorted(number)], "<i8"), ends.astype("<i8"), np.array([i for w in order for i in words[w]], "<i8")]
    out = io.BytesIO()
    out.write(np.array([len(a) for a in arrays], "<i8").tobytes())
    for a in arrays:
        out.write(a.tobytes())
    return out.getvalue()


class Lexicon:
    """The compiled automaton, read in place; looks up many words at once."""

    def __init__(self, data: np.ndarray):
        flat = data.view("<i8")
        at, parts = 6, []
        for n in flat[:6].tolist():
            parts.append(flat[at : at + n])
            at += n
        self.keys, self.targets, self.skips, self.final, self.ends, self.ids = parts

    @classmethod
    def mapped(cls, path: str) -> Lexicon:
        return cls(np.memmap(path, np.uint8, "r"))

    def find(self, words: list[bytes]) -> list[np.ndarray | None]:
        n = len(words)
        if not n or not len(self.keys):
            return [None] * n
        size = np.fromiter(map(len, words), np.int64, n)
        start = np.cumsum(size) - size
        flat = np.frombuffer(b"".join(words), np.uint8)
        state, rank, live = np.zeros(n, np.int64), np.zeros(n, np.int64), np.arange(n)
        for k in range(int(size.max())):
            live = live[size[live] > k]
            want = state[live] * 256 + flat[start[live] + k]
            at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
            ok = self.keys[at] == want
            state[live[~ok]] = -1
            live, at = live[ok], at[ok]
            rank[live] += self.skips[at]
            state[live] = self.targets[at]
            if not len(live):
                break
        found = (state >= 0) & (self.final[np.maximum(state, 0)] == 1) & (size > 0)
        return [self.ids[self.ends[r] : self.ends[r + 1]] if ok else None for ok, r in zip(found.tolist(), rank.tolist(), strict=True)]


class Codec:
    """Encodes and decodes whole texts with a vocabulary and a lexicon."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon | None):
        self.v, self.lexicon, self.table, self.known = vocabulary, lexicon, Table(self._learn), {}
        self.strings = pa.array([vocabulary.string.get(i, "") for i in range(max(vocabulary.string) + 1)], pa.large_string())

    def _words(self, piece: str) -> list[str]:
        return [piece.lower()] if piece.isascii() and piece.isalpha() else WORDS.findall(self.v.normal(piece))

    def _learn(self, pieces: list[str]):
        cut = [self._words(p) for p in pieces]
        if len(self.known) > CACHE:  # words outlast the pieces they are met in: many pieces are a word and a mark
            self.known.clear()
        ids = self.known
        words = [w for w in dict.fromkeys(chain.from_iterable(cut)) if w not in ids]
        found = self.lexicon.find([w.encode("utf-8", "surrogatepass") for w in words]) if self.lexicon else [None] * len(words)
        ids.update((w, k.tolist()) for w, k in zip(words, found, strict=True) if k is not None)
        unseen = [w for w, k in zip(words, found, strict=True) if k is None]
        ids.update(zip(unseen, self.v.merge_all(unseen), strict=True))
        got = [ids[c[0]] if len(c) == 1 else [i for w in c for i in ids[w]] for c in cut]
        size = np.fromiter(map(len, got), np.int64, len(got))
        return size, np.fromiter(chain.from_iterable(got), np.uint32, int(size.sum()))

    def _careful(self, text: str) -> np.ndarray:
        """Ids of a text with special tokens or unusual white space."""
        ids, at = [], 0
        for m in [*self.v.at_special.finditer(text), None]:
            for w in WORDS.findall(self.v.normal(text[at : m.start() if m else len(text)])):
                ids += self.v.merge(w)
            if m:
                ids.append(self.v.special[m[0]])
                at = m.end()
        return np.array(ids, np.uint32)

    def encode(self, texts: pa.Array):
        """(ids of all texts in a row, offsets of the texts)."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.match_substring_regex(texts, ODD_SPACE + r"|<\|").to_numpy(zero_copy_only=False)
        pieces, offsets = split(texts, odd, lambda x: pc.utf8_split_whitespace(words_apart(x)))
        whole = {i: self._careful(texts[i].as_py()) for i in np.flatnonzero(odd).tolist()}
        return joined(*self.table.of(pieces), offsets, whole)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """The text of each document's ids."""
        strings = self.strings.take(pa.array(ids.astype(np.int64)))
        return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), strings), pa.scalar(" ", pa.large_string()))


def word_counts(docs: DataFrame, path: str) -> DataFrame:
    """Rows (word, n) over all documents. Words met once in a slice of documents aren't sent on: they can't be frequent, and the lexicon only saves time."""

    def run(batches):
        v = Vocabulary(path)
        for batch in arrow_batches(batches, SLICE):
            pieces = pc.value_counts(pc.utf8_split_whitespace(words_apart(pc.fill_null(batch.column(0).cast(pa.large_string()), ""))).flatten())
            total = Counter()
            for p, n in zip(pieces.field("values").to_pylist(), pieces.field("counts").to_pylist(), strict=True):
                for w in (p,) if p.isalpha() and p.isascii() else WORDS.findall(v.normal(p)):
                    total[w] += n
            some = [(w, n) for w, n in total.items() if n > 1 and len(w) <= 64]
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in some], pa.string()), pa.array([n for _, n in some], pa.int64())], ["word", "n"])

    return docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, path: str, size: int = LEXICON) -> bytes:
    top = word_counts(docs, path).orderBy(F.desc("n"), "word").limit(size).collect()  # bounded by size
    v = Vocabulary(path)
    words = [r["word"] for r in top]
    return compile_lexicon({w.encode(): ids for w, ids in zip(words, v.merge_all(words), strict=True)})


def share_file(spark, data: bytes, name: str) -> str:
    """Put a small file into the shared folder and have Spark bring it to each executor; returns its local name."""
    where = new_path(spark, name)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(where)
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(data))
    out.close()
    spark.sparkContext.addFile(where)
    return where.rpartition("/")[2]


def _codec(path: str, local: str) -> Codec:
    return worker_state(("codec", path, local), lambda: Codec(Vocabulary(path), Lexicon.mapped(SparkFiles.get(local))))


def encode_documents(docs: DataFrame, path: str, lexicon_size: int = LEXICON) -> DataFrame:
    """Rows (doc_id, ids binary, decoded binary): ids as little-endian unsigned 32-bit integers."""
    return _encoded(docs, path, lexicon_size, "doc_id long, ids binary, decoded binary", lambda ids, text: (ids.tobytes(), text.to_pybytes()), (pa.binary(), pa.binary()))


def _encoded(docs, path, lexicon_size, schema, make, kinds):
    """make(ids, decoded text in UTF-8) -> the columns of a document's row."""
    rows = pick(docs, doc_id="long", text="string")
    local = share_file(docs.sparkSession, build_lexicon(rows, path, lexicon_size), "lexicon")
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches):
        codec = _codec(path, local)
        for batch in text_batches(batches, 1, 2048):
            ids, ends = codec.encode(batch.column(1))
            ids, decoded = ids.astype("<u4"), codec.decode(ids, ends).cast(pa.large_binary())
            made = [make(ids[a:b], text.as_buffer()) for a, b, text in zip(ends, ends[1:], decoded, strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([m[i] for m in made], k) for i, k in enumerate(kinds)]], names)

    return rows.mapInArrow(run, schema)


def op7_bpe_codec(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    digest = lambda ids, text: (len(ids), hashlib.sha256(ids).hexdigest(), hashlib.sha256(text).hexdigest())
    return _encoded(docs, vocabulary("word_bpe_49k.json"), LEXICON, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", digest, (pa.int64(), pa.string(), pa.string()))


QUERIES = {"op7_bpe_codec": op7_bpe_codec}
