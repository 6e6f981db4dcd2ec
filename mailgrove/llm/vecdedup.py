"""Embedding near-duplicates by product quantisation (operator 9).

Equal vectors are one class. Class vectors, scaled to length one, go to inverted lists around
coarse centres; their residuals are coded in subspaces. Each vector probes its own list and those
whose plane to its own is no farther than the margin: the farthest that partners at exactly the
wanted cosine, in random directions and as found in the sample, were seen to cross, and a tenth
more. In a list, distances are those of the probing vector to the coded vectors; one whose
distance, less its own coding error, is still too large can't be a partner. Only the others
are compared by exact cosine in doubles. Links are counted where they are found and only a
spanning forest of each group is sent on.

Vectors are not sent to the lists they probe, for that would be a copy for nearly every part of
the index. They are dealt out once, by list and id, into files of about ROWS rows in the shared
folder. A task takes the rows of one file and goes through all files: of each it reads ids, codes
and errors, and of lists that hold survivors the vectors.

Defined cases: a vector that is null, zero or holds null or non-finite components has no links
and is its own component; vectors of one length link among themselves; equal vectors are linked; a
null vec_id has a null component_id if alone; repeated rows count as vectors of their own; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailgrove.llm.shared import components, delete_path, new_path, settle
from mailgrove.llm.vectors import kmeans, lengths, matrix, nearest, numbered_rows, sample, spans

#: Codes of a subspace; components of a subspace; rows and directions that the margin is measured on; pairs compared exactly at once.
CODES, SUBSPACE, TRIED, DIRECTIONS, PAIRS = 256, 8, 1024, 16, 1 << 16
#: Rows of a file, about; queries compared with a list at once; lists, as so many times the root of the rows.
ROWS, ASKED, LISTS = 8192, 512, 2.0


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Quantiser:
    def __init__(self, x: np.ndarray, lists: int, cosine: float):
        x = _unit(x)
        self.cosine, self.reach = cosine, math.sqrt(2 - 2 * cosine) + 1e-6
        self.centres = kmeans(x, lists)
        rest = x - self.centres[nearest(x, self.centres)]
        d = x.shape[1]
        self.parts = [slice(i, min(i + SUBSPACE, d)) for i in range(0, d, SUBSPACE)]
        self.books = [kmeans(rest[:, p], CODES, seed=11 + i, rounds=6) for i, p in enumerate(self.parts)]
        self.margin = min(self.reach, 1.1 * self._crossed(x[:TRIED]))

    def _beyond(self, x: np.ndarray) -> np.ndarray:
        """How far each row would have to move straight to the plane that parts its own list from each other."""
        square = np.maximum((x**2).sum(axis=1)[:, None] - 2 * x @ self.centres.T + (self.centres**2).sum(axis=1), 0)
        own = square.argmin(axis=1)
        mine = self.centres[own]
        between = np.sqrt(np.maximum((mine**2).sum(axis=1)[:, None] - 2 * mine @ self.centres.T + (self.centres**2).sum(axis=1), 1e-18))
        out = (square - square[np.arange(len(x)), own][:, None]) / (2 * between)
        out[np.arange(len(x)), own] = 0
        return out

    def _crossed(self, x: np.ndarray) -> float:
        """The farthest plane between the lists of partners."""
        beyond, rng, most = self._beyond(x), np.random.default_rng(23), 0.0
        for _ in range(DIRECTIONS):
            v = rng.normal(size=x.shape)
            v -= (v * x).sum(axis=1, keepdims=True) * x
            norm = np.linalg.norm(v, axis=1, keepdims=True)
            partner = _unit(self.cosine * x + math.sqrt(1 - self.cosine**2) * v / np.maximum(norm, 1e-12))
            most = max(most, float(beyond[np.arange(len(x)), nearest(partner, self.centres)].max(initial=0)))
        a, b = np.nonzero(x @ x.T >= self.cosine)
        return max(most, float(beyond[a, nearest(x, self.centres)[b]].max(initial=0)))

    def encode(self, x: np.ndarray, cell: np.ndarray):
        """(codes [parts, n], coding error [n]) of unit vectors in their lists."""
        rest = x - self.centres[cell]
        codes = np.stack([nearest(rest[:, p], b) for p, b in zip(self.parts, self.books, strict=True)])
        error = np.sqrt(sum(((rest[:, p] - b[codes[i]]) ** 2).sum(axis=1) for i, (p, b) in enumerate(zip(self.parts, self.books, strict=True))))
        return codes, error

    def decode(self, codes: np.ndarray, cell: int) -> np.ndarray:
        """The coded vectors [n, d] of one list."""
        return (self.centres[cell] + np.concatenate([b[codes[i]] for i, b in enumerate(self.books)], axis=1)).astype(np.float32)

    def probes(self, x: np.ndarray) -> np.ndarray:
        """Whether each of the unit rows probes each list [rows, lists]."""
        return np.concatenate([self._beyond(x[at : at + ASKED]) <= self.margin + 1e-9 for at in range(0, len(x), ASKED)])


class Index:
    """A file of vectors by list: ids and weights (i64), bounds of the squared distance (f32), codes (u8, one row a subspace), vectors (f64)."""

    def __init__(self, path: str, cells: np.ndarray, d: int, parts: int):
        self.where, self.inner = fs.FileSystem.from_uri(path)
        self.cells, self.d, self.head = cells, d, len(cells) * (20 + parts)
        with self.where.open_input_file(self.inner) as f:
            data = f.read(self.head)
        n = len(cells)
        self.ids, self.weights = np.frombuffer(data, "<i8", 2 * n).reshape(2, n)
        self.bound = np.frombuffer(data, "<f4", n, 16 * n)
        self.codes = np.frombuffer(data, "u1", n * parts, 20 * n).reshape(parts, n)

    def vectors(self, rows: slice) -> np.ndarray:
        with self.where.open_input_file(self.inner) as f:
            f.seek(self.head + rows.start * self.d * 8)
            return np.frombuffer(f.read((rows.stop - rows.start) * self.d * 8), "<f8").reshape(-1, self.d)


def write_index(rows: DataFrame, q, n: int) -> tuple[str, list[tuple[str, bytes]]]:
    """rows (id, weight, vec), n of them -> the folder of the files, and of each file the path and the lists of its rows (i32)."""
    folder = new_path(rows.sparkSession, "vector-lists")

    def place(batches):
        for batch in batches:
            cell = nearest(_unit(matrix(batch.column(2))), q.value.centres) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cell, pa.int32()), batch.column(2)], ["id", "weight", "cell", "vec"])

    def write(batches):
        held = [(b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy(), matrix(b.column(3))) for b in batches if b.num_rows]
        if not held:
            return
        ids, weights, cells, vec = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((ids, cells))
        ids, weights, cells, vec = ids[order], weights[order], cells[order], vec[order]
        codes, error = q.value.encode(_unit(vec), cells)
        bound = (q.value.reach + error) ** 2 + 1e-4  # beyond it, no partner; distances are float32
        task = TaskContext.get()
        path = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}.ivf"
        where, inner = fs.FileSystem.from_uri(path)
        where.create_dir(fs.FileSystem.from_uri(folder)[1])
        with where.open_output_stream(inner) as out:
            for x, kind in ((ids, "<i8"), (weights, "<i8"), (bound, "<f4"), (codes, "u1"), (vec, "<f8")):
                out.write(np.ascontiguousarray(x, kind).tobytes())
        yield pa.RecordBatch.from_pydict({"path": [path], "cells": pa.array([zlib.compress(cells.astype("<i4").tobytes())], pa.binary())})

    files = max(rows.sparkSession.sparkContext.defaultParallelism, -(-n // ROWS))
    placed = rows.select("id", "weight", "vec").mapInArrow(place, "id long, weight long, cell int, vec array<double>").repartitionByRange(files, "cell", "id")
    return folder, [tuple(r) for r in placed.mapInArrow(write, "path string, cells binary").collect()]  # one row a file


class Links:
    """The vectors of one file as queries: counts of their links and a spanning forest of them, list by list."""

    def __init__(self, q: Quantiser, ids: np.ndarray, vec: np.ndarray):
        self.q, self.ids, self.vec, self.unit = q, ids, vec, _unit(vec)
        self.float = self.unit.astype(np.float32)
        self.probed = q.probes(self.unit)
        self.counted, self.edges = np.zeros(len(ids), np.int64), []

    def _survivors(self, some: np.ndarray, of: Index, cell: int, rows: slice):
        """(query, member) pairs of a list that the codes can't rule out."""
        coded = self.q.decode(of.codes[:, rows], cell)
        limit = of.bound[rows] - (coded * coded).sum(axis=1) - 1  # of the square, without what is the same for all
        for at in range(0, len(some), ASKED):
            i, j = np.nonzero(self.float[some[at : at + ASKED]] @ coded.T * -2 <= limit)
            for k in range(0, len(i), PAIRS):
                yield some[i[k : k + PAIRS] + at], j[k : k + PAIRS]

    def meet(self, of: Index) -> None:
        """Count links with the vectors of a file."""
        for cell, rows in spans(of.cells).items():
            some = np.flatnonzero(self.probed[:, cell])
            vec = None
            for a, b in self._survivors(some, of, cell, rows):
                if vec is None:
                    vec, ids, weights, root = of.vectors(rows), of.ids[rows], of.weights[rows], np.arange(rows.stop - rows.start)
                    unit = _unit(vec)
                exact = np.einsum("ij,ij->i", self.unit[a], unit[b])
                hit = exact >= self.q.cosine
                for e in np.flatnonzero(np.abs(exact - self.q.cosine) < 1e-12):  # the same sum wherever the pair is met
                    x, y = self.vec[a[e]], vec[b[e]]
                    hit[e] = (x * y).sum() / math.sqrt((x * x).sum() * (y * y).sum()) >= self.q.cosine
                hit &= self.ids[a] != ids[b]
                a, b = a[hit], b[hit]
                np.add.at(self.counted, a, weights[b])
                if not len(a):
                    continue
                starts = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1])))
                for s, e in zip(starts, [*starts[1:], len(a)], strict=True):
                    met = np.unique(root[b[s:e]])
                    self.edges += [(self.ids[a[s]], ids[r]) for r in met]
                    if len(met) > 1:
                        root[np.isin(root, met)] = met[0]

    def rows(self):
        """Rows (a, b, n): edges, and n links of a = b."""
        a = np.concatenate([self.ids, np.array([e[0] for e in self.edges], np.int64)])
        b = np.concatenate([self.ids, np.array([e[1] for e in self.edges], np.int64)])
        n = np.concatenate([self.counted, np.zeros(len(self.edges), np.int64)])
        keep = (n > 0) | (a != b)
        return pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep]), pa.array(n[keep])], ["a", "b", "n"])


RESULT = "vec_id long, n_links long, component_id long"


def near_duplicates(vectors: DataFrame, cosine: float = 0.9) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id."""
    rows = numbered_rows(vectors).select("vec_id", "vec", "d", F.xxhash64("vec").alias("h1"), F.xxhash64("vec", F.lit(1)).alias("h2"))
    out = rows.filter("vec IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    for d in lengths(rows):
        out = out.unionByName(_linked(rows.filter((F.col("d") == d) & F.col("vec").isNotNull()), cosine))
    return out


def _met(spark, q, files: list[tuple[str, bytes]]) -> DataFrame:
    """A table of rows (a, b, n): every file's vectors with those of all files."""
    schema = "a long, b long, n long"
    if not files:
        return spark.createDataFrame([], schema)

    def run(batches):
        def opened(i):
            return Index(files[i][0], np.frombuffer(zlib.decompress(files[i][1]), "<i4"), q.value.centres.shape[1], len(q.value.parts))

        for batch in batches:
            for i in batch.column(0).to_pylist():
                own = opened(i)
                links = Links(q.value, own.ids, own.vectors(slice(0, len(own.ids))))
                for j in range(len(files)):
                    links.meet(opened((i + j) % len(files)))
                yield links.rows()

    return settle(spark.createDataFrame([(i,) for i in range(len(files))], "file int").repartition(len(files)).mapInArrow(run, schema), "vector-met")


def _linked(rows: DataFrame, cosine: float) -> DataFrame:
    """near_duplicates of valid vectors of one length; 128 bits of hashes stand for a vector in joins."""
    spark = rows.sparkSession
    # a class is named by a number of its own, its members' ids may be null or repeated
    classes = settle(rows.groupBy("h1", "h2").agg(F.first("vec").alias("vec"), F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight")).withColumn("id", F.monotonically_increasing_id()), "vector-classes")
    count = classes.count()
    lists = max(1, round(math.sqrt(count) * LISTS))
    shared = spark.sparkContext.broadcast(Quantiser(sample(classes.select("vec", F.col("id").alias("row")), lists), lists, cosine))  # grows with the root of the rows
    folder, files = write_index(classes, shared, count)
    found = _met(spark, shared, files)
    delete_path(spark, folder)
    counts = found.groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
    roots = components(found.filter("a <> b").select("a", "b")).select(F.col("node").alias("id"), "root")
    known = classes.select("id", "h1", "h2", "rep", "weight").join(counts, "id", "left").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    least = known.groupBy("root").agg(F.min("rep").alias("component_id"))
    of = known.join(least, "root").select("h1", "h2", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component_id")
    return rows.join(of, ["h1", "h2"]).select("vec_id", "n_links", F.coalesce("component_id", "vec_id").alias("component_id"))


def op9_embedding_near_dedup(spark, sf_dir):
    out = near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))


OP9_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9
), r AS (
  SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
), c AS (
  SELECT a, least(a, min(b)) AS component_id FROM r GROUP BY a
), n AS (
  SELECT a, count(*) AS n_links FROM l GROUP BY a
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id, coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id
"""

QUERIES = {"op9_embedding_near_dedup": op9_embedding_near_dedup}
ORACLES = {"op9_embedding_near_dedup": OP9_SQL}
