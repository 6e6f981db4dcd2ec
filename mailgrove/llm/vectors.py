"""What the vector operators share: valid vectors, k-means on a bounded sample, and meetings of queries with the cells they visit.

Cells of an index are cut into units of bounded size by a hash of the row, so that a cell that
holds a third of all rows is many units; units of neighbouring cells fill bins of about GROUP
rows. A member goes to its bin, a query to each bin that holds a cell it visits. Within a
partition a bin's members come first and are held, then its queries stream past, so a task needs
memory for one bin only. A bin that is visited so often that its work is more than WORK pairs is
copied, once for each such share of its visits.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailgrove.llm.shared import arrow_batches, pick, settle, unsettle

#: Rows an index is fitted on, at least, and for each of its cells; rows of a unit and of a bin, about; pairs of a bin and its visits.
FIT_ROWS, FIT_EACH, UNIT, GROUP, WORK = 20_000, 16, 1024, 16_384, 1 << 28


def numbered_rows(vectors: DataFrame) -> DataFrame:
    """A table (row, vec_id, vec array<double>, d) of all rows; vec is null where it takes no part, d is its length."""
    rows = pick(vectors, vec_id="long", embedding="array<double>").withColumnRenamed("embedding", "vec")
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = F.col("vec").isNotNull() & ~bad & F.exists("vec", lambda x: x != 0.0)
    rows = rows.withColumn("vec", F.when(good, F.col("vec"))).withColumn("d", F.size("vec"))
    return settle(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "vec", "d"), "vectors")


def lengths(rows: DataFrame) -> list[int]:
    """The lengths that valid vectors have; each makes a space of its own."""
    return sorted(r["d"] for r in rows.filter("vec IS NOT NULL").select("d").distinct().collect())  # one row a length


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, -1) if n else flat.reshape(0, 0)


def lists(m: np.ndarray, kind) -> pa.Array:
    n, d = m.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * d), pa.array(np.ascontiguousarray(m).reshape(-1), kind))


def sample(rows: DataFrame, cells: int) -> np.ndarray:
    """A bounded sample of rows (row, vec), the same for the same rows; it follows the number of cells, the root of the rows."""
    some = rows.orderBy(F.xxhash64("vec"), "row").limit(max(FIT_ROWS, FIT_EACH * cells)).select("vec").toArrow()
    return matrix(some.column(0))


def kmeans(x: np.ndarray, k: int, seed: int = 7, rounds: int = 12) -> np.ndarray:
    """Centres of x; fewer than k where x has fewer distinct rows. Many centres are found in two steps."""
    if k > 512:
        top = kmeans(x, math.isqrt(k), seed, rounds)
        owner = nearest(x, top)
        return np.concatenate([kmeans(x[owner == i], max(1, round(k * np.count_nonzero(owner == i) / len(x))), seed, rounds) for i in np.unique(owner).tolist()])
    rng = np.random.default_rng(seed)
    x = np.unique(x, axis=0)
    k = min(k, len(x))
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        owner = nearest(x, centres)
        n = np.bincount(owner, minlength=k)
        total = np.zeros_like(centres)
        np.add.at(total, owner, x)
        centres = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centres)
    return np.unique(centres, axis=0)


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres**2).sum(axis=1) / 2
    return np.concatenate([np.argmax(x[i : i + 4096] @ centres.T - half, axis=1) for i in range(0, len(x), 4096)]) if len(x) else np.zeros(0, np.int64)


def _mixed(ids: np.ndarray, seed: int) -> np.ndarray:
    x = (ids.astype(np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))) >> np.uint64(1)


class Bins:
    """Which bins the rows of a cell lie in."""

    def __init__(self, sizes: dict[int, int]):
        self.cells = max(sizes, default=-1) + 1
        count = np.zeros(self.cells, np.int64)
        count[list(sizes)] = list(sizes.values())
        self.units = -(-count // UNIT)
        self.first = np.cumsum(self.units) - self.units
        rows = np.repeat(count / np.maximum(self.units, 1), self.units)
        self.bin = (np.cumsum(rows) - rows).astype(np.int64) // GROUP if len(rows) else np.zeros(0, np.int64)
        self.rows = np.bincount(self.bin, rows)

    def of(self, ids: np.ndarray, cell: np.ndarray) -> np.ndarray:
        return self.bin[self.first[cell] + (_mixed(ids, 5) % self.units[cell].astype(np.uint64)).astype(np.int64)] if len(ids) else np.zeros(0, np.int64)

    def visited(self, cells) -> dict[int, list[int]]:
        """The bins that hold the cells, each with those cells."""
        to: dict[int, list] = {}
        for c in cells:
            if c < self.cells:
                for b in np.unique(self.bin[self.first[c] : self.first[c] + self.units[c]]).tolist():
                    to.setdefault(b, []).append(c)
        return to


MEET = "bin int, block int, query boolean, id long, weight long, cell int, cells array<int>, vec array<double>"


def meet(members: DataFrame, queries: DataFrame, visits, group, schema: str) -> DataFrame:
    """Bring queries to the cells they visit: rows of `schema`.

    members: id, weight, cell, vec. queries: id, weight, vec. visits(matrix) -> list of lists of cells.
    group(member ids, weights, cells, vecs) makes a handler of a bin's members, cells in order;
    handler(query ids, weights, vecs, lists of cells) -> pa.RecordBatch.
    """
    sizes = {r["cell"]: r["n"] for r in members.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a cell
    bins = Bins(sizes)
    names = [x.split()[0] for x in MEET.split(", ")]

    def batch_of(bin_, block, query, ids, weights, cell, cells, vecs):
        n = len(bin_)
        return pa.RecordBatch.from_arrays([pa.array(bin_, pa.int32()), pa.array(block, pa.int32()), pa.array([query] * n, pa.bool_()), ids, weights, pa.array(cell, pa.int32()), pa.array(cells, pa.list_(pa.int32())), vecs], names)

    def send(batches):
        for batch in arrow_batches(batches, 512):
            row, at, cells = [], [], []
            for i, visited in enumerate(visits(matrix(batch.column(2)))):
                for b, some in bins.visited(visited).items():
                    row.append(i)
                    at.append(b)
                    cells.append(some)
            pick = pa.array(row, pa.int32())
            yield batch_of(at, [0] * len(row), True, batch.column(0).take(pick), batch.column(1).take(pick), [-1] * len(row), cells, batch.column(2).take(pick))

    asked = settle(queries.select("id", "weight", "vec").mapInArrow(send, MEET), "vector-visits")
    visited = {r["bin"]: r["n"] for r in asked.groupBy("bin").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a bin
    blocks = np.array([max(1, math.ceil(visited.get(b, 0) * rows / WORK)) for b, rows in enumerate(bins.rows)], np.int64)

    def deal(batches):
        for batch in arrow_batches(batches, 1024):
            cell = batch.column(2).to_numpy().astype(np.int64)
            at = bins.of(batch.column(0).to_numpy(), cell)
            copies = blocks[at] if len(at) else at
            row = np.repeat(np.arange(len(at)), copies)
            block = np.arange(len(row)) - np.repeat(np.cumsum(copies) - copies, copies)
            pick = pa.array(row)
            yield batch_of(at[row], block, False, batch.column(0).take(pick), batch.column(1).take(pick), cell[row], [[]] * len(row), batch.column(3).take(pick))

    def spread(batches):
        for batch in batches:
            many = blocks[batch.column(0).to_numpy()] if batch.num_rows else np.zeros(0, np.int64)
            block = _mixed(batch.column(3).to_numpy(), 11) % many.astype(np.uint64)
            yield batch.set_column(1, "block", pa.array(block.astype(np.int32)))

    there = members.select("id", "weight", "cell", "vec").mapInArrow(deal, MEET)
    here = asked.mapInArrow(spread, MEET) if (blocks > 1).any() else asked
    placed = there.unionByName(here).repartition("bin", "block").sortWithinPartitions("bin", "block", "query", "cell")

    def run(batches):
        now, held, handler = None, [], None
        for batch in arrow_batches(batches, 2048):
            key = batch.column(0).to_numpy().astype(np.int64) * (1 << 31) + batch.column(1).to_numpy()
            is_query = batch.column(2).to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero((np.diff(key) != 0) | (np.diff(is_query.astype(int)) != 0)) + 1).tolist(), len(key)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if key[a] != now:
                    now, held, handler = key[a], [], None
                part = batch.slice(a, b - a)
                if not is_query[a]:
                    held.append((part.column(3).to_numpy(), part.column(4).to_numpy(), part.column(5).to_numpy(), matrix(part.column(7))))
                    continue
                if handler is None and held:
                    handler, held = group(*[np.concatenate(x) for x in zip(*held, strict=True)]), []
                if handler is not None:
                    yield handler(part.column(3).to_numpy(), part.column(4).to_numpy(), matrix(part.column(7)), part.column(6).to_pylist())

    out = settle(placed.mapInArrow(run, schema), "vector-met")
    unsettle(asked)
    return out


def by_cell(cells: list[list[int]]) -> dict[int, np.ndarray]:
    """For each cell, the rows whose lists hold it."""
    owner = np.repeat(np.arange(len(cells)), [len(c) for c in cells])
    flat = np.array([c for some in cells for c in some], np.int64)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    starts = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1]))) if len(flat) else []
    return {int(flat[s]): owner[s:e] for s, e in zip(starts, [*starts[1:], len(flat)], strict=True)}


def spans(cells: np.ndarray) -> dict[int, slice]:
    """Where each cell's rows are in sorted cells."""
    present, first = np.unique(cells, return_index=True)
    return {int(c): slice(int(a), int(b)) for c, a, b in zip(present, first, [*first[1:], len(cells)], strict=True)}
