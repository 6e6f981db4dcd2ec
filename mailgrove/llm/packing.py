"""Best-fit packing of documents into fixed token windows by linear grouping (operator 10).

Only the histogram of piece lengths, at most `window` numbers, leaves the data. On it:
large lengths are rounded up within groups of equal cardinality; the few rounded sizes are
packed by the configuration programme (columns by knapsack, whole parts kept); actual lengths
take the places of rounded ones; what is left, and the small lengths, go best-fit into the
space that remains. The plan is a table of runs (length, ranks, sequences) whose size depends
on the window, not on the data; each piece finds its place by its rank among equals.

Defined cases: a null text is empty: one piece of the end id; a document longer than the window
is cut so that only its first piece may be shorter; rows that share a doc_id are packed each;
ties are broken by place in the input; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mailgrove.llm.shared import arrow_batches, pick, settle
from mailgrove.llm.tokens import encoder, vocabulary

WINDOW, END_ID = 1024, 2
#: Lengths above this share of the window are large; their groups; rounds of the programme.
LARGE, GROUPS, ROUNDS = 0.25, 48, 600
#: A configured bin stays if, with its actual lengths, it wastes at most this share; else its items are best-fitted. The best of these wins.
KEPT_WASTE = (0.0, 0.002, 0.01, 0.03, 1.0)


def _knapsack(sizes: np.ndarray, worth: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The most worthy multiset of sizes that fits the room."""
    best, took = np.zeros(room + 1), np.full(room + 1, -1)
    for c in range(1, room + 1):
        ok = sizes <= c
        value = np.where(ok, best[c - sizes * ok] + worth, -1)
        i = int(value.argmax()) if len(value) else 0
        best[c] = best[c - 1]
        if value[i] > best[c] + 1e-12:
            best[c], took[c] = value[i], i
    counts, c = np.zeros(len(sizes), np.int64), room
    while c > 0:
        if took[c] < 0:
            c -= 1
        else:
            counts[took[c]] += 1
            c -= int(sizes[took[c]])
    return float(best[room]), counts


def configurations(sizes: np.ndarray, need: np.ndarray, room: int, rounds: int = ROUNDS) -> list[tuple[int, np.ndarray]]:
    """Whole parts of the optimal fractional packing of `need` items of few sizes: (bins, counts of each size)."""
    m = len(sizes)
    basis = np.diag((room // sizes).astype(float))
    inverse = np.linalg.inv(basis)
    amount = inverse @ need
    for k in range(rounds):
        worth = inverse.sum(axis=0)
        value, column = _knapsack(sizes, np.maximum(worth, 0), room)
        if value <= 1 + 1e-6:
            break
        step = inverse @ column
        ok = step > 1e-9
        ratio = np.where(ok, amount / np.where(ok, step, 1), np.inf)
        out = int(ratio.argmin())
        basis[:, out] = column
        if k % 40 == 39:
            inverse = np.linalg.inv(basis)
            amount = inverse @ need
        else:
            pivot = inverse[out] / step[out]
            inverse -= np.outer(step, pivot)
            inverse[out] = pivot
            move = ratio[out]
            amount = amount - move * step
            amount[out] = move
        amount = np.maximum(amount, 0)
    return [(int(a + 1e-7), basis[:, j].astype(np.int64)) for j, a in enumerate(amount) if a + 1e-7 >= 1]


def _best_fit(bins: list[list], left: dict[int, int], window: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Put the items left into the space that remains and into new bins: best fit, longest first, on counted bins."""
    rooms: dict[int, list] = {}
    order: list[int] = []
    for b in bins:
        if b[1] > 0:
            if b[1] not in rooms:
                rooms[b[1]] = []
                insort(order, b[1])
            rooms[b[1]].append(b)
    for s in sorted(left, reverse=True):
        n = left[s]
        while n:
            at = bisect_left(order, s)
            if at == len(order):
                k = window // s
                full, rest = divmod(n, k)
                fresh = ([[full, window - s * k, [(s, k)]]] if full else []) + ([[1, window - s * rest, [(s, rest)]]] if rest else [])
                n = 0
                for b in fresh:
                    bins.append(b)
                    if b[1]:
                        if b[1] not in rooms:
                            rooms[b[1]] = []
                            insort(order, b[1])
                        rooms[b[1]].append(b)
                continue
            room = order[at]
            b = rooms[room].pop()
            if not rooms[room]:
                del rooms[room]
                order.pop(at)
            take = min(b[0], n)
            if take < b[0]:  # only some of the bins alike get one
                rest = [b[0] - take, b[1], list(b[2])]
                bins.append(rest)
                if room not in rooms:
                    rooms[room] = []
                    insort(order, room)
                rooms[room].append(rest)
                b[0] = take
            inside = dict(b[2])
            inside[s] = inside.get(s, 0) + 1
            b[1], b[2] = room - s, sorted(inside.items(), reverse=True)
            n -= take
            if b[1]:
                if b[1] not in rooms:
                    rooms[b[1]] = []
                    insort(order, b[1])
                rooms[b[1]].append(b)
    return [(b[0], b[2]) for b in bins]


def plan(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[int, list[tuple[int, int]]]]:
    """Bins for all items: (number of bins, [(length, items of that length in each bin)])."""
    left = {s: n for s, n in histogram.items() if n > 0}
    bins: list[list] = []  # [count, room, [(length, items)]]
    if window in left:
        bins.append([left.pop(window), 0, [(window, 1)]])
    large = sorted((s for s in left if s > LARGE * window), reverse=True)
    if large:
        total = sum(left[s] for s in large)
        each = max(1, -(-total // GROUPS))
        groups, now, held = [], [], 0  # a group: [(length, items)], longest first
        for s in large:
            n = left.pop(s)
            while n:
                take = min(n, each - held)
                now.append([s, take])
                n, held = n - take, held + take
                if held == each:
                    groups.append(now)
                    now, held = [], 0
        if now:
            groups.append(now)
        merged: dict[int, list] = {}
        for g in groups:  # groups with the same longest length are one size
            merged.setdefault(g[0][0], []).extend(g)
        sizes = np.array(sorted(merged, reverse=True))
        stock = [merged[int(s)] for s in sizes]
        need = np.array([sum(n for _, n in g) for g in stock], float)
        for count, column in configurations(sizes, need, window):
            have = np.array([sum(n for _, n in g) for g in stock])
            fits = min([count, *(int(have[i] // c) for i, c in enumerate(column) if c)])
            while fits > 0:  # as many bins alike as the actual lengths at the head of each group allow
                alike, parts = fits, []
                for i, c in enumerate(column):
                    want = int(c)
                    j = 0
                    while want:
                        s, n = stock[i][j]
                        take = min(want, n)
                        if take == want:
                            alike = min(alike, n // want)
                            parts.append((i, j, s, want))
                            want = 0
                        else:
                            alike = min(alike, 1)
                            parts.append((i, j, s, take))
                            want -= take
                            j += 1
                alike = max(alike, 1)
                inside: dict[int, int] = {}
                for i, j, s, k in parts:
                    stock[i][j][1] -= k * alike
                    inside[s] = inside.get(s, 0) + k
                for g in stock:
                    while g and g[0][1] == 0:
                        g.pop(0)
                bins.append([alike, window - sum(s * k for s, k in inside.items()), sorted(inside.items(), reverse=True)])
                fits -= alike
        for g in stock:
            for s, n in g:
                left[s] = left.get(s, 0) + n
    tries = []
    for waste in KEPT_WASTE:
        kept = [[n, room, list(inside)] for n, room, inside in bins if room <= waste * window]
        loose = dict(left)
        for n, room, inside in bins:
            if room > waste * window:
                for size, k in inside:
                    loose[size] = loose.get(size, 0) + n * k
        tries.append(_best_fit(kept, loose, window))
    return min(tries, key=lambda t: sum(n for n, _ in t))


def places(bins) -> dict[int, np.ndarray]:
    """For each length: rows (first rank, first sequence, items a bin, offset in the bin), by first rank."""
    used: dict[int, int] = {}
    out: dict[int, list] = {}
    sequence = 0
    for count, inside in bins:
        offset = 0
        for s, k in inside:
            out.setdefault(s, []).append((used.get(s, 0), sequence, k, offset))
            used[s] = used.get(s, 0) + k * count
            offset += s * k
        sequence += count
    return {s: np.array(rows, np.int64) for s, rows in out.items()}


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"


def pieces(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID, ranks: str | None = None) -> DataFrame:
    """Rows of pieces with their rank (nth) among the pieces of the same length of their task (part)."""

    def run(batches):
        enc, part, met = encoder(path, ranks), TaskContext.get().partitionId(), np.zeros(window + 1, np.int64)
        tail = np.array([end_id], "<u4").tobytes()
        for batch in arrow_batches(batches, 256):
            rows = []
            flat, ends = enc.batch(batch.column(1))
            flat = flat.astype("<u4")
            for doc_id, x, y in zip(batch.column(0).to_pylist(), ends.tolist(), ends[1:].tolist(), strict=False):
                ids, n = flat[x:y].tobytes() + tail, y - x + 1
                first = n % window or window
                cuts = [0, *range(first, n + 1, window)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    rows.append((doc_id, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b]), part, met[b - a]))
                    met[b - a] += 1
            cols = list(zip(*rows, strict=True)) or [[]] * 7
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], [x.split()[0] for x in PIECES.split(", ")])

    return pick(docs, doc_id="long", text="string").mapInArrow(run, PIECES)


def pack(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID, ranks: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = settle(pieces(docs, path, window, end_id, ranks), "pieces")
    met = settle(cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in met.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `window` rows
    table = cut.sparkSession.sparkContext.broadcast(places(plan(histogram, window)))  # bounded by the window, see plan()
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = met.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = cut.join(starts, ["part", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank"))

    def run(batches):
        for batch in batches:
            size, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            sequence, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for s in np.unique(size).tolist():
                at = np.flatnonzero(size == s)
                rows = table.value[s]
                r = rows[np.searchsorted(rows[:, 0], rank[at], "right") - 1]
                inner = rank[at] - r[:, 0]
                sequence[at] = r[:, 1] + inner // r[:, 2]
                offset[at] = r[:, 3] + inner % r[:, 2] * s
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op10_best_fit_packing(spark, sf_dir):
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary("byte_bpe_50k.json"), ranks=vocabulary("byte_bpe_50k.tiktoken"))


QUERIES = {"op10_best_fit_packing": op10_best_fit_packing}
