"""Approximate nearest neighbours with a hierarchical k-means tree (operator 5).

The tree is fitted on a bounded sample and indexes every row. A query goes through it
best-bin-first: a priority queue holds tree nodes by their centre's inner product with the
query, and the leaves it takes out are visited. How many leaves a query visits is widened
until calibration queries, compared with brute force over all rows, reach the target recall.

Inner products are taken of a query with the members of the leaves it visits and of no others.

Defined cases: a vector that is null, zero or holds null or non-finite components takes no part;
vectors of one length are searched among themselves; the query's own row is no candidate,
another row with the same id is, equal to it or not; a query row that occurs twice is two
queries; fewer candidates than k are all returned; ties go to the smaller id, null ids first; a
null vec_id is never a query; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mailgrove.llm.shared import settle, unsettle
from mailgrove.llm.vectors import by_cell, kmeans, lengths, matrix, meet, nearest, numbered_rows, sample, spans

#: Children of a node; queries for calibration; the recall they must reach, above what is asked for, for safety.
BRANCH, CALIBRATION, RECALL = 8, 256, 0.97
#: Stands for a null id.
NO_ID = -(1 << 63)


class Tree:
    """Nodes in arrays: centre, children, and the leaf number of nodes without children."""

    def __init__(self, x: np.ndarray, leaves: int, branch: int = BRANCH):
        self.centres, self.children, self.leaf, self.n_leaves = [], [], [], 0
        self._grow(x, max(1, leaves), branch, x.mean(axis=0))
        self.centres = np.array(self.centres)

    def _grow(self, x, leaves, branch, centre) -> int:
        at = len(self.centres)
        self.centres.append(centre)
        self.children.append([])
        self.leaf.append(-1)
        centres = kmeans(x, min(branch, leaves), seed=at) if leaves > 1 and len(x) > 1 else x[:0]
        if len(centres) < 2:
            self.leaf[at] = self.n_leaves
            self.n_leaves += 1
            return at
        owner = nearest(x, centres)
        for i, c in enumerate(centres):
            mine = x[owner == i]
            share = max(1, round(leaves * len(mine) / len(x)))
            self.children[at].append(self._grow(mine if len(mine) else c[None], share, branch, c))
        return at

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row: down the nearest children."""
        out, todo = np.zeros(len(x), np.int64), [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not self.children[node]:
                out[rows] = self.leaf[node]
                continue
            owner = nearest(x[rows], self.centres[self.children[node]])
            todo += [(child, rows[owner == i]) for i, child in enumerate(self.children[node]) if (owner == i).any()]
        return out

    def visits(self, x: np.ndarray, count: int) -> list[list[int]]:
        """The first `count` leaves of each row, best bin first."""
        near = x @ self.centres.T
        out = []
        for row in near.tolist():
            heap, seen = [(-row[0], 0)], []
            while heap and len(seen) < count:
                _, node = heapq.heappop(heap)
                if self.children[node]:
                    for child in self.children[node]:
                        heapq.heappush(heap, (-row[child], child))
                else:
                    seen.append(self.leaf[node])
            out.append(seen)
        return out


class Best:
    """The members of a bin, cells in order; a call gives each query's k nearest among the cells it visits."""

    def __init__(self, k: int, rows: np.ndarray, ids: np.ndarray, cells: np.ndarray, vec: np.ndarray):
        self.k, self.rows, self.ids, self.vec, self.at = k, rows, ids, vec, spans(cells)

    def __call__(self, rows, ids, vec, cells) -> pa.RecordBatch:
        asked, found, scores = [], [], []
        for at in range(0, len(rows), 128):
            some = slice(at, min(at + 128, len(rows)))
            near = np.full((some.stop - at, len(self.rows)), -np.inf)
            for cell, who in by_cell(cells[some]).items():
                if cell in self.at:
                    near[who, self.at[cell]] = vec[some][who] @ self.vec[self.at[cell]].T
            for i, row in enumerate(near):
                row[self.rows == rows[at + i]] = -np.inf
                n = min(self.k, len(row))
                least = np.partition(row, len(row) - n)[len(row) - n]
                pick = np.flatnonzero((row >= least - 1e-9) & (row > -np.inf))
                exact = (vec[at + i] * self.vec[pick]).sum(axis=1)  # the same sum for equal vectors
                best = np.lexsort((self.ids[pick], -exact))[: self.k]
                asked.append(np.full(len(best), at + i))
                found.append(self.ids[pick][best])
                scores.append(exact[best])
        q = np.concatenate(asked) if asked else np.zeros(0, np.int64)
        cat = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
        return pa.RecordBatch.from_arrays([pa.array(rows[q]), pa.array(ids[q]), pa.array(cat(found, np.int64)), pa.array(cat(scores, np.float64))], ["row", "query_id", "vec_id", "score"])


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def calibrate(tree: Tree, indexed: DataFrame, some: list, k: int, target: float) -> int:
    """Leaves to visit so that the queries `some` (row, vec) find `target` of their true neighbours.

    Brute force in one pass over all rows: each task keeps the best k of each of its queries.
    """
    own, vecs = np.array([r[0] for r in some]), np.array([r[1] for r in some])

    def run(batches):
        kept: dict[int, list] = {}
        for batch in batches:
            rows, ids, cell, m = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy(), matrix(batch.column(3))
            near = vecs @ m.T
            for i in range(len(own)):
                near[i][rows == own[i]] = -np.inf
                best = np.argpartition(-near[i], min(k, len(m) - 1))[:k]
                held = kept.setdefault(i, []) + [(float(near[i][b]), -int(ids[b]), int(cell[b])) for b in best if near[i][b] > -np.inf]
                kept[i] = heapq.nlargest(k, held)
        rows = [(i, -v, c, s) for i, held in kept.items() for s, v, c in held]
        cols = list(zip(*rows, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.float64())], ["row", "vec_id", "cell", "score"])

    true = _ranked(indexed.select("id", "weight", "cell", "vec").mapInArrow(run, "row long, vec_id long, cell int, score double"), k)
    cells: dict[int, list] = {}
    for r in true.select("row", "cell").collect():  # at most k rows a calibration query
        cells.setdefault(r["row"], []).append(r["cell"])
    places, order = [], tree.visits(vecs, tree.n_leaves)
    for i, some_cells in cells.items():
        rank = {c: j for j, c in enumerate(order[i])}
        places += [rank[c] for c in some_cells]
    if not places:
        return tree.n_leaves
    places = np.sort(np.array(places))
    return int(places[min(len(places) - 1, math.ceil(target * len(places)) - 1)]) + 1


RESULT = "query_id long, rank int, vec_id long, score double"


def search(vectors: DataFrame, is_query, k: int = 20, target: float = RECALL) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): each query's k nearest by inner product. is_query: a condition on vec_id."""
    rows = numbered_rows(vectors)
    out = vectors.sparkSession.createDataFrame([], RESULT)
    for d in lengths(rows):
        if (found := _search(rows.filter((F.col("d") == d) & F.col("vec").isNotNull()), is_query, k, target)) is not None:
            out = out.unionByName(found)
    return out


def _search(rows: DataFrame, is_query, k: int, target: float) -> DataFrame | None:
    asked = rows.filter(F.col("vec_id").isNotNull()).filter(is_query(F.col("vec_id")))
    some = [tuple(r) for r in asked.select("row", "vec").orderBy(F.xxhash64("vec_id"), "row").limit(CALIBRATION).collect()]
    if not some:
        return None
    leaves = max(1, round(math.sqrt(rows.count()) / 2))
    tree = Tree(sample(rows, leaves), leaves)
    shared = rows.sparkSession.sparkContext.broadcast(tree)  # grows with the root of the rows

    def place(batches):
        for batch in batches:
            leaf = shared.value.assign(matrix(batch.column(2))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(leaf, pa.int32()), batch.column(2)], ["id", "weight", "cell", "vec"])

    named = rows.select(F.col("row").alias("id"), F.coalesce("vec_id", F.lit(NO_ID)).alias("weight"), "vec")
    indexed = settle(named.mapInArrow(place, "id long, weight long, cell int, vec array<double>"), "ann-index")
    count = calibrate(tree, indexed, some, k, target)
    queries = asked.select(F.col("row").alias("id"), F.col("vec_id").alias("weight"), "vec")
    found = meet(indexed, queries, lambda x: shared.value.visits(x, count), lambda *members: Best(k, *members), "row long, query_id long, vec_id long, score double")
    unsettle(indexed)
    return _ranked(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), F.when(F.col("vec_id") > NO_ID, F.col("vec_id")).alias("vec_id"), "score")


def op5_tree_search(spark, sf_dir):
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), lambda vec_id: vec_id % 20 == 0)


QUERIES = {"op5_tree_search": op5_tree_search}
