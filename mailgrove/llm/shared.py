"""What the training-data operators share: shared-folder tables, input shaping, connected components."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Unset, a temporary one of our own on a local master (tests); an error on a cluster, whose executors could not read it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or _OWN.get(spark.sparkContext.applicationId)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = _OWN[spark.sparkContext.applicationId] = "file://" + tempfile.mkdtemp(prefix="mailgrove-")
    return folder.rstrip("/")


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _delete_quietly(spark: SparkSession, path: str) -> None:
    try:
        delete_path(spark, path)
    except Exception:  # the session may have ended before the interpreter
        return


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the driver ends."""
    path = f"{shared_folder(spark)}/mailgrove/{name}-{uuid.uuid4().hex}"
    atexit.register(_delete_quietly, spark, path)
    return path


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: cuts lineage and survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._settled_at = path
    return out


def unsettle(df: DataFrame) -> None:
    """Remove a table written by settle once nothing reads it any more."""
    if path := getattr(df, "_settled_at", None):
        delete_path(df.sparkSession, path)


def place_of(df: DataFrame, name: str) -> int:
    """The place of the first column called `name`, or else of the first whose name differs only in case."""
    names = df.columns
    found = [i for i, c in enumerate(names) if c == name] or [i for i, c in enumerate(names) if c.lower() == name.lower()]
    if not found:
        raise ValueError(f"no column {name!r} in {names}")
    return found[0]


def numbered(df: DataFrame) -> DataFrame:
    """df with its columns called _c0, _c1, ...: names that repeat or differ only in case can't clash."""
    return df.toDF(*[f"_c{i}" for i in range(len(df.columns))])


def pick(df: DataFrame, **kinds: str) -> DataFrame:
    """Only the named columns, cast; extra columns are never carried along, so their names can't clash."""
    return numbered(df).select(*[F.col(f"_c{place_of(df, name)}").cast(kind).alias(name) for name, kind in kinds.items()])


def keep_rows(df: DataFrame, condition, *names: str) -> DataFrame:
    """The rows of df, with all its columns, for which condition(the named columns) holds."""
    flat = numbered(df)
    return flat.filter(condition(*[F.col(f"_c{place_of(df, name)}") for name in names])).toDF(*df.columns)


def _stars(pairs: DataFrame) -> DataFrame:
    """One large-star then one small-star step over edges (hi, lo), hi > lo.

    Minima come from map-side combined aggregates and are joined back, so that a node
    with very many neighbours is never gathered in one task (AQE splits the skewed side).
    """
    both = pairs.select(F.col("hi").alias("x"), F.col("lo").alias("y")).union(pairs.select(F.col("lo").alias("x"), F.col("hi").alias("y")))
    least = both.groupBy("x").agg(F.min("y").alias("y0")).select("x", F.least("x", "y0").alias("m"))
    large = both.filter("y > x").join(least, "x").select(F.col("y").alias("hi"), F.col("m").alias("lo")).distinct()
    floor = large.groupBy("hi").agg(F.min("lo").alias("m"))
    small = (
        large.join(floor, "hi")
        .select(F.explode(F.array(F.struct(F.col("hi").alias("hi"), F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e"))
        .select("e.hi", "e.lo")
        .filter("hi <> lo")
    )
    return small.distinct()


def components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """Connected components of edges (a, b): rows (node, root), root the smallest node reachable.

    Alternating large-star and small-star until nothing changes; nodes without edges are not returned.
    Empty edges give an empty result. Self-loops, repeated and reversed edges change nothing.
    """
    ends = edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).filter("hi <> lo").distinct()
    now = settle(ends, "edges")
    mark = None
    for _ in range(max_rounds):
        # exclusive or: a sum of hashes leaves a long's range, an error, at some 65,000 edges
        seen = now.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("hi", "lo")).alias("s")).first()
        if mark == (seen["n"], seen["s"]) or not seen["n"]:
            break
        mark = (seen["n"], seen["s"])
        then = settle(_stars(now), "edges")
        unsettle(now)
        now = then
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(roots)


_WORKER: dict = {}


def worker_state(key: tuple, make):
    """make(), once a Python worker and key. Only the newest is kept, so that what one stage knows makes room for the next."""
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = make()
    return _WORKER[key]


def release_worker() -> None:
    """Forget what an earlier stage's code knows and hand its memory back: workers live on from stage to stage."""
    if not _WORKER:
        return
    _WORKER.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library can
        ctypes.CDLL(None).malloc_trim(0)


def gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of all elements of slices (start, size), one slice after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class Seen:
    """Numbers of the distinct pieces a worker has met; `full` tells when to begin anew, by pieces and by their characters."""

    def __init__(self, cap: int = 150_000, room: int = 16 << 20):
        self.cap, self.room, self.held, self.index = cap, room, 0, {}

    def locate(self, pieces: list[str]) -> tuple[np.ndarray, list[str]]:
        """(number of each piece, the pieces met for the first time in order of their numbers)."""
        index, before = self.index, len(self.index)
        at = np.fromiter((index.setdefault(p, len(index)) for p in pieces), np.int64, len(pieces))
        fresh = [p for p, i in zip(pieces, at.tolist(), strict=True) if i >= before] if len(index) > before else []
        self.held += sum(map(len, fresh))
        return at, fresh

    @property
    def full(self) -> bool:
        return len(self.index) > self.cap or self.held > self.room


def arrow_batches(batches: Iterator, rows: int) -> Iterator:
    """Re-slice Arrow batches to at most `rows` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def text_batches(batches: Iterator, column: int, rows: int, size: int = 4 << 20) -> Iterator:
    """Re-slice Arrow batches to at most `rows` rows and about `size` bytes of a text column; a longer text comes alone."""
    for batch in batches:
        upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = int(upto[at - 1]) if at else 0
            end = max(at + 1, min(at + rows, int(np.searchsorted(upto, before + size, "right"))))
            yield batch.slice(at, end - at)
            at = end


LONG, INT, STR, BIN, DBL, BOOL = T.LongType(), T.IntegerType(), T.StringType(), T.BinaryType(), T.DoubleType(), T.BooleanType()
