"""Interpolated Kneser-Ney character models in sorted hash arrays (used by operators 1 and 3).

A text is lower-cased; each run of letters is a word scored by itself between boundary marks,
and nothing else counts. Every distinct word of a batch is scored once, by array operations, and
its score is summed over the documents that hold it.

Nothing of a model passes through the driver. Tasks count words, Spark adds them up, and the
n-grams of each distinct word are counted once; every n-gram is kept, whatever its count and
label, so that continuation counts and discounts are those of the whole training data. The
finished rows are dealt out by the first bits of their hash, and each part is written by a task
as a file of sorted arrays in the shared folder, which workers map into memory. The driver only
learns the files' names and sizes.

With ct the count of gram g in context h (continuation counts below the top size), D the
discount, and p of size 0 the uniform distribution over the known characters:
    p(g) = max(ct(g) - D, 0) / ct(h .) + back(h) * p(g without its first character)
    back(h) = sum of min(ct, D) over the grams of h / ct(h .), 1 for an unknown context
Own models have all counts by label. Shared models have counts of all labels together at every
size and, on top of the whole, each label's own counts of the top size, discounted in proportion
to the label's share of all counts: labels differ only where their own counts do.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mailgrove.llm.shared import Seen, arrow_batches, new_path, settle, unsettle

NO_LETTERS = r"\P{L}+"
#: Boundary marks stand outside Unicode's range.
OPEN, CLOSE = 0x110000, 0x110001
MULT, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
#: Documents looked at together, so that memory doesn't grow with Arrow's batch size; words whose grams are held together.
DOCS, WORDS = 1024, 20_000
#: Rows of a part of a model, about.
PART_ROWS = 1_000_000
DISCOUNT, RARE = 0.75, 2.0
#: What a model has for a gram: its discounted share, what its context of one more character leaves to smaller sizes, and both once more for the labels' own level.
SHARE, BACK, OWN_SHARE, OWN_BACK = range(4)
GRAMS = "size int, gram long, context long, tail long, tail_context long, label int, n long"


def grams_of(words: list[str], order: int):
    """(lengths, scored, hashes): hashes[k][i] covers the k characters that end at place i, k = 0..order; scored marks the places that are no opening marks.

    Words open with order - 1 marks, which are context only, so that every character has a gram
    of every length.
    """
    pad = order - 1
    sizes = np.fromiter((len(w) + pad + 1 for w in words), np.int64, len(words))
    ends = np.cumsum(sizes)
    codes = np.empty(int(ends[-1]) if len(words) else 0, np.uint64)
    if len(words):
        blank = "\x00" * pad
        codes[:] = np.frombuffer("".join([f"{blank}{w}\x00" for w in words]).encode("utf-32-le", "surrogatepass"), "<u4")
        for i in range(pad):
            codes[ends - sizes + i] = OPEN
        codes[ends - 1] = CLOSE
    place = np.arange(len(codes)) - np.repeat(ends - sizes, sizes)
    codes = (codes + np.uint64(1)) * MIX
    codes ^= codes >> np.uint64(29)
    hashes = [np.zeros(len(codes), np.uint64)]
    for _ in range(order):
        rolling = shifted(hashes[-1]) * MULT + codes
        rolling ^= rolling >> np.uint64(31)
        hashes.append(rolling)
    return sizes, place >= pad, hashes


def shifted(x: np.ndarray) -> np.ndarray:
    """x, one place later."""
    out = np.zeros_like(x)
    out[1:] = x[:-1]
    return out


def distinct_words(texts: pa.Array):
    """(distinct words, word index of each token, offsets of the documents) of lower-cased texts; an empty word may stand at a text's ends."""
    split = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")), NO_LETTERS)
    coded = pc.dictionary_encode(split.flatten())
    offsets = split.offsets.to_numpy()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), (offsets - offsets[0]).astype(np.int64)


def count_words(rows: DataFrame, labels: int) -> DataFrame:
    """rows (text, label int) -> (word, label, n) over all rows."""

    def made(seen, counts):
        words, n = pa.array(list(seen.index), pa.string()), counts[: len(seen.index)].copy()
        n[pc.equal(words, "").to_numpy(zero_copy_only=False)] = 0
        for label in range(labels):
            has = np.flatnonzero(n[:, label])
            for at in range(0, len(has), 50_000):
                some = has[at : at + 50_000]
                yield pa.RecordBatch.from_arrays([words.take(pa.array(some)), pa.array(np.full(len(some), label, np.int32)), pa.array(n[some, label])], ["word", "label", "n"])

    def run(batches):
        seen, counts = Seen(), np.zeros((1 << 16, labels), np.int64)
        for batch in arrow_batches(batches, DOCS):
            words, index, offsets = distinct_words(batch.column(0))
            at, _ = seen.locate(words)
            while len(seen.index) > len(counts):
                counts = np.concatenate([counts, np.zeros_like(counts)])
            label = np.repeat(batch.column(1).to_numpy(), np.diff(offsets)).astype(np.int64)
            cell = np.bincount(index * labels + label, minlength=len(words) * labels).reshape(-1, labels)
            counts[at] += cell
            if seen.full:
                yield from made(seen, counts)
                seen, counts = Seen(), np.zeros((1 << 16, labels), np.int64)
        yield from made(seen, counts)

    return rows.select("text", "label").mapInArrow(run, "word string, label int, n long").groupBy("word", "label").agg(F.sum("n").alias("n"))


def count_grams(words: DataFrame, order: int, labels: int) -> DataFrame:
    """words (word, label, n) -> summed GRAMS of sizes 1 to order; tail is the gram without its first character."""
    names = [x.split()[0] for x in GRAMS.split(", ")]

    def run(batches):
        for batch in arrow_batches(batches, WORDS):
            label, n = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            sizes, scored, hashes = grams_of(batch.column(0).to_pylist(), order)
            word = np.repeat(np.arange(len(sizes)), sizes)[scored]
            nothing = np.zeros_like(hashes[0])
            for k in range(1, order + 1):
                tables = hashes[k], shifted(hashes[k - 1]), hashes[k - 1], shifted(hashes[k - 2]) if k > 1 else nothing
                keys, first, back = np.unique(tables[0][scored], return_index=True, return_inverse=True)
                columns = [x[scored][first].view(np.int64) for x in tables]
                for one in np.unique(label).tolist():
                    total = np.bincount(back, np.where(label[word] == one, n[word], 0), len(keys)).astype(np.int64)
                    has = np.flatnonzero(total)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(has), k, np.int32)), *[pa.array(c[has]) for c in columns], pa.array(np.full(len(has), one, np.int32)), pa.array(total[has])], names)

    return words.select("word", "label", "n").mapInArrow(run, GRAMS).groupBy(*names[:-1]).agg(F.sum("n").alias("n"))


def shares(grams: DataFrame, order: int, labels: int, shared: bool) -> DataFrame:
    """GRAMS -> rows (size, key, label, kind, value) of the finished model; label -1 stands for every label."""
    one = F.lit(-1) if shared else F.col("label")
    low = grams.filter("size > 1")
    low = low.select("size", "gram", "tail", "tail_context", one.alias("label")).distinct() if shared else low
    low = low.groupBy((F.col("size") - 1).alias("size"), F.col("tail").alias("gram"), F.col("tail_context").alias("context"), "label").agg(F.count(F.lit(1)).cast("double").alias("c"))
    top = grams.filter(F.col("size") == order)
    raw = top.groupBy("size", "gram", "context", one.alias("label")).agg(F.sum("n").cast("double").alias("c"))
    rows = low.unionByName(raw).select("size", "gram", "context", "label", "c", F.lit(SHARE).alias("kind"), F.lit(DISCOUNT).alias("cut"))
    if shared:
        weigh = {r["label"]: r["n"] for r in top.groupBy("label").agg(F.sum("n").cast("double").alias("n")).collect()}  # one row a label
        cuts = F.create_map(*[F.lit(x) for label, n in weigh.items() for x in (label, RARE * n / max(min(weigh.values()), 1.0))]) if weigh else F.create_map(F.lit(0), F.lit(1.0))
        own = top.select("size", "gram", "context", "label", F.col("n").cast("double").alias("c"), F.lit(OWN_SHARE).alias("kind"), F.element_at(cuts, F.col("label")).alias("cut"))
        rows = rows.unionByName(own)
    context = Window.partitionBy("size", "context", "label", "kind")  # no more rows than there are characters
    rows = rows.select("*", F.sum("c").over(context).alias("all"), F.sum(F.least("c", "cut")).over(context).alias("lost"), (F.row_number().over(context.orderBy("gram")) == 1).alias("first"))
    share = F.struct("size", F.col("gram").alias("key"), "label", "kind", (F.greatest(F.col("c") - F.col("cut"), F.lit(0.0)) / F.col("all")).alias("value"))
    back = F.struct((F.col("size") - 1).alias("size"), F.col("context").alias("key"), "label", (F.col("kind") + BACK).cast("int").alias("kind"), (F.col("lost") / F.col("all")).alias("value"))
    return rows.select(F.explode(F.when(F.col("first"), F.array(share, back)).otherwise(F.array(share))).alias("r")).select("r.*")


def write_model(rows: DataFrame, order: int, labels: int, shared: bool) -> Model:
    """Write the rows of `shares` as files of sorted arrays, one a part."""
    kinds = 4 if shared else 2
    rows = settle(rows, "gram-shares")
    count = rows.count()
    bits = max(0, (count // PART_ROWS).bit_length())
    folder = new_path(rows.sparkSession, "gram-model")
    part = F.shiftrightunsigned(F.col("key"), 64 - bits).cast("int") if bits else F.lit(0)
    placed = rows.withColumn("part", part).repartition(1 << bits, "part").sortWithinPartitions("part", "size", F.col("key") < 0, "key")  # keys are unsigned

    def run(batches):
        task, now, tables = TaskContext.get(), None, {}

        def finish():
            where, inner = fs.FileSystem.from_uri(folder)
            where.create_dir(inner)
            name = f"part-{now:06d}-{task.taskAttemptId()}.grams"
            counts = []
            with where.open_output_stream(f"{inner}/{name}") as out:
                for size in range(order + 1):
                    some = tables.get(size, [])
                    key, label, kind, value = (np.concatenate([x[i] for x in some]) if some else np.zeros(0, np.uint64) for i in range(4))
                    keys = np.unique(key)
                    values = np.zeros((len(keys), kinds, labels), np.float32)
                    values[:, BACK::2] = 1.0
                    at, kind = np.searchsorted(keys, key), kind.astype(np.int64)
                    for one in range(labels):
                        mine = (label == one) | (label == -1)
                        values[at[mine], kind[mine], one] = value[mine]
                    counts.append(len(keys))
                    out.write(keys.tobytes())
                    out.write(values.tobytes())
            return pa.RecordBatch.from_pydict({"part": pa.array([now], pa.int32()), "path": [f"{folder}/{name}"], "counts": pa.array([counts], pa.list_(pa.int64()))})

        for batch in batches:
            parts, sizes = batch.column("part").to_numpy(), batch.column("size").to_numpy()
            cell = parts.astype(np.int64) * (order + 1) + sizes
            edges = [0, *(np.flatnonzero(np.diff(cell)) + 1).tolist(), len(cell)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if now is not None and now != parts[a]:
                    yield finish()
                    tables.clear()
                now = int(parts[a])
                columns = [batch.column(c).to_numpy()[a:b] for c in ("key", "label", "kind", "value")]
                tables.setdefault(int(sizes[a]), []).append([columns[0].view(np.uint64), *columns[1:]])
        if now is not None:
            yield finish()

    files = [tuple(r) for r in placed.mapInArrow(run, "part int, path string, counts array<long>").collect()]  # one row a part
    unsettle(rows)
    return Model(order, labels, kinds, bits, tuple((part, path, tuple(counts)) for part, path, counts in sorted(files)), uuid.uuid4().hex)


@dataclass(frozen=True)
class Model:
    """Where a model's parts are: (part, path, grams of each size). Small, whatever the size of the model."""

    order: int
    labels: int
    kinds: int
    bits: int
    files: tuple
    name: str

    @property
    def characters(self) -> int:
        return sum(counts[1] for _, _, counts in self.files) + 1


def fit_model(words: DataFrame, order: int, labels: int, shared: bool) -> Model:
    """A model of words (word, label, n)."""
    grams = settle(count_grams(words, order, labels), "grams")
    model = write_model(shares(grams, order, labels, shared), order, labels, shared)
    unsettle(grams)
    return model


def _mapped(path: str) -> np.ndarray:
    """A file of the shared folder in memory that the system can take back: in place if it is a file here, else by an unnamed copy."""
    where, inner = fs.FileSystem.from_uri(path)
    if isinstance(where, fs.LocalFileSystem) or os.path.exists(inner):
        return np.memmap(inner, np.uint8, "r")
    with tempfile.TemporaryFile() as own, where.open_input_stream(inner) as f:
        while block := f.read(1 << 22):
            own.write(block)
        own.flush()
        return np.memmap(own, np.uint8, "r")


class Mapped:
    """A model as a worker sees it."""

    def __init__(self, model: Model):
        self.model, self.parts = model, {}
        width = model.kinds * model.labels
        for part, path, counts in model.files:
            data, at, tables = _mapped(path), 0, []
            for n in counts:
                keys = data[at : at + 8 * n].view(np.uint64)
                at += 8 * n
                values = data[at : at + 4 * width * n].view(np.float32).reshape(n, model.kinds, model.labels)
                at += 4 * width * n
                tables.append((keys, values))
            self.parts[part] = tables

    def find(self, size: int, keys: np.ndarray) -> np.ndarray:
        """[keys, kinds, labels]: what the model has for sorted distinct keys, its defaults for unknown ones."""
        out = np.zeros((len(keys), self.model.kinds, self.model.labels), np.float32)
        out[:, BACK::2] = 1.0
        first = keys >> np.uint64(64 - self.model.bits) if self.model.bits else np.zeros(len(keys), np.uint64)
        edges = np.searchsorted(first, np.arange((1 << self.model.bits) + 1, dtype=np.uint64))
        for part, tables in self.parts.items():
            a, b = edges[part], edges[part + 1]
            known, values = tables[size]
            if a == b or not len(known):
                continue
            at = np.minimum(np.searchsorted(known, keys[a:b]), len(known) - 1)
            hit = known[at] == keys[a:b]
            out[a:b][hit] = values[at[hit]]
        return out

    def word_scores(self, words: list[str]):
        """(log-likelihood [words, labels], characters scored [words])."""
        order, labels = self.model.order, self.model.labels
        out, chars = np.zeros((len(words), labels)), np.fromiter((len(w) + 1 for w in words), float, len(words))
        for at in range(0, len(words), WORDS):
            some = words[at : at + WORDS]
            sizes, scored, hashes = grams_of(some, order)
            p = np.full((len(scored), labels), 1.0 / self.model.characters)
            own_back, before = None, None
            for k in range(order + 1):
                keys, back = np.unique(hashes[k], return_inverse=True)
                found = self.find(k, keys)
                if k:
                    p = found[back, SHARE] + before * p
                if k == order and self.model.kinds > 2:
                    p = found[back, OWN_SHARE] + own_back * p
                before = np.ones_like(p)
                before[1:] = found[back[:-1], BACK]
                if not k:
                    before[:] = found[back, BACK]
                if k == order - 1 and self.model.kinds > 2:
                    own_back = np.ones_like(p)
                    own_back[1:] = found[back[:-1], OWN_BACK]
                    if not k:
                        own_back[:] = found[back, OWN_BACK]
            logs = np.log(np.maximum(p, 1e-12)) * scored[:, None]
            out[at : at + len(some)] = np.add.reduceat(logs, np.cumsum(sizes) - sizes, axis=0)
        return out, chars


class Words:
    """What is known of each distinct word, computed once a worker: log-likelihoods [labels] and characters."""

    def __init__(self, model: Model):
        self.model = Mapped(model)
        self._begin()

    def _begin(self):
        self.seen, self.rows = Seen(300_000), np.zeros((1 << 14, self.model.model.labels + 1))

    def lookup(self, words: list[str]) -> np.ndarray:
        """[words, labels + 1]; an empty word has nothing."""
        if self.seen.full:
            self._begin()
        at, fresh = self.seen.locate(words)
        if fresh:
            ll, chars = self.model.word_scores(fresh)
            new = np.concatenate([ll, chars[:, None]], axis=1)
            if "" in fresh:
                new[fresh.index("")] = 0
            first = len(self.seen.index) - len(fresh)
            while len(self.seen.index) > len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[first : first + len(fresh)] = new
        return self.rows[at]
