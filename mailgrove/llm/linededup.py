"""Exact line deduplication with keep bitmaps (operator 4).

Every line's key is hashed; the rows (hash, doc_id, position) are range-partitioned by
(hash, doc_id) and sorted, so that one pass over a partition sees each hash as a run, its
documents in order. A run inside a partition is settled there. Only the first and the last
run of a partition can go on in its neighbours (a line that very many documents hold spans
many partitions): their pieces are summed up in at most two rows a partition, and the
candidates of those runs are judged against that sum. The result is a compressed bitmap of
kept lines for each document, never text.

Defined cases: a null or empty text is one empty line; a key shorter than `min_chars` is
always kept; a key found in fewer than `min_docs` documents is always kept; rows that share a
doc_id count as one document (the rows of one id with different texts each get their own
bitmap); a null doc_id is a document smaller than any other; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailgrove.llm.shared import arrow_batches, numbered, pick, place_of, release_worker, settle, unsettle

#: ASCII white space stripped from a key's ends.
BLANKS = " \t\n\x0b\x0c\r"
#: Text of rows without a doc_id sorts below every id.
NO_ID = -(1 << 63)
_UPPER = {c: c + 32 for c in range(65, 91)}


def line_key(line: str) -> str:
    return line.strip(BLANKS).translate(_UPPER)


def pack_bits(keep: np.ndarray) -> bytes:
    """A compressed bitmap: zlib over packed bits (the line count is kept beside it)."""
    return zlib.compress(np.packbits(keep).tobytes(), 6)


def unpack_bits(packed: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8), count=n).astype(bool)


def text_tag(text: str | None) -> int:
    """Tells apart the texts of rows that share a doc_id; the same as xxhash64(text) in SQL."""
    return int(np.uint64(xxhash.xxh64_intdigest((text or "").encode("utf-8", "surrogatepass"), 42)).view(np.int64))


LINES = "hi long, lo long, doc_id long, tag long, pos int"


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """Rows (hi, lo, doc_id, tag, pos) for each line whose key has at least min_chars code points."""
    digest = xxhash.xxh3_128_digest

    def run(batches):
        release_worker()
        for batch in arrow_batches(batches, 256):
            raw, ids, tags, at = [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                tag, doc_id = text_tag(text), NO_ID if doc_id is None else doc_id
                for pos, line in enumerate(text.split("\n")):
                    if len(line) >= min_chars and len(key := line_key(line)) >= min_chars:
                        raw.append(digest(key.encode("utf-8", "surrogatepass")))
                        ids.append(doc_id)
                        tags.append(tag)
                        at.append(pos)
            both = np.frombuffer(b"".join(raw), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(ids, pa.int64()), pa.array(tags, pa.int64()), pa.array(at, pa.int32())], ["hi", "lo", "doc_id", "tag", "pos"])

    return pick(docs, doc_id="long", text="string").mapInArrow(run, LINES)


#: kind 0: a settled drop; 1: a candidate of a run that may go on elsewhere; 2: the sum of such a run's piece here.
RUNS = "kind int, hi long, lo long, doc_id long, tag long, pos int, n_docs long"


def _stream_runs(min_docs: int):
    """Judge sorted rows run by run.

    All documents of a run but its newest lose their lines once min_docs are seen, however the
    run goes on; so at most the rows of min_docs documents of one run are held, beside one batch.
    """
    kinds = (np.int32, np.int64, np.int64, np.int64, np.int64, np.int32, np.int64)
    names = ["kind", "hi", "lo", "doc_id", "tag", "pos", "n_docs"]

    class Run:
        def __init__(self, key, first):
            self.key, self.first, self.n, self.doc, self.held, self.newest = key, first, 0, None, [], []

    def run(batches):
        now, first, out, size = None, True, [], 0

        def emit(kind, r, parts, n=0):
            nonlocal size
            for doc, tag, pos in parts:
                out.append([np.full(len(doc), kind), np.full(len(doc), r.key[0]), np.full(len(doc), r.key[1]), doc, tag, pos, np.full(len(doc), n)])
                size += len(doc)

        def finish(r, last):
            if r.first or last:  # may go on in a neighbouring partition
                emit(1, r, r.held + r.newest)
                emit(2, r, [(np.array([r.doc]), np.zeros(1, np.int64), np.zeros(1, np.int64))], r.n)

        def flush():
            nonlocal size
            rows = [np.concatenate(x).astype(k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)]
            out.clear()
            size = 0
            return pa.RecordBatch.from_arrays([pa.array(x) for x in rows], names)

        for batch in batches:
            if not batch.num_rows:
                continue
            hi, lo, doc, tag, pos = (batch.column(i).to_numpy() for i in range(5))
            starts = np.flatnonzero(np.concatenate(([True], (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1]))))
            stops = np.append(starts[1:], len(hi))
            # A run of fewer than min_docs rows that begins and ends in this batch loses nothing.
            look = stops - starts >= min_docs
            look[[0, -1]] = True
            if first and now is None and len(look) > 1:
                look[1] = True  # so that the first run of the partition is closed as such
            for s, e in zip(starts[look].tolist(), stops[look].tolist(), strict=True):
                key = (hi[s], lo[s])
                if now is None or now.key != key:
                    if now is not None:
                        finish(now, False)
                        first = False
                    now = Run(key, first)
                at = s + int(np.searchsorted(doc[s:e], doc[e - 1]))  # rows from here belong to the newest document
                goes_on = now.doc is not None and now.doc == doc[s]
                if at > s or not goes_on:
                    now.held += now.newest
                    now.newest = []
                if at > s:
                    now.held.append((doc[s:at], tag[s:at], pos[s:at]))
                now.newest.append((doc[at:e], tag[at:e], pos[at:e]))
                now.n += 1 + int(np.count_nonzero(doc[s + 1 : e] != doc[s : e - 1])) - goes_on
                now.doc = doc[e - 1]
                if now.n >= min_docs and now.held:
                    emit(0, now, now.held)
                    now.held = []
            if size > 1 << 16:
                yield flush()
        if now is not None:
            finish(now, True)
        if out:
            yield flush()

    return run


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Rows (doc_id, tag, n_bits, dropped): for documents that lose lines, the compressed bitmap of the DROPPED positions.

    Documents that keep every line have no row; `apply_bitmaps` turns this into keep bitmaps.
    """
    # the range partitioner reads its input twice, once for a sample
    hashes = settle(line_hashes(docs, min_chars), "line-hashes")
    placed = hashes.repartitionByRange("hi", "lo", "doc_id").sortWithinPartitions("hi", "lo", "doc_id", "tag", "pos")
    runs = settle(placed.mapInArrow(_stream_runs(min_docs), RUNS), "line-runs")
    unsettle(hashes)
    # At most two rows a partition reach this sum: safe to broadcast, whatever the size of the corpus.
    whole = runs.filter("kind = 2").groupBy("hi", "lo").agg(F.sum("n_docs").alias("total"), F.max("doc_id").alias("last")).filter(F.col("total") >= min_docs)
    late = runs.filter("kind = 1").join(F.broadcast(whole), ["hi", "lo"]).filter(F.col("doc_id") < F.col("last"))
    drops = runs.filter("kind = 0").select("doc_id", "tag", "pos").union(late.select("doc_id", "tag", "pos"))

    def pack(positions):
        bits = np.zeros(max(positions) + 1, bool)
        bits[positions] = True
        return pack_bits(bits)

    def packed(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([max(p) + 1 for p in batch.column(2).to_pylist()], pa.int32()), pa.array([pack(p) for p in batch.column(2).to_pylist()], pa.binary())], ["doc_id", "tag", "n_bits", "dropped"])

    # A document's positions are bounded by its own lines.
    return drops.groupBy("doc_id", "tag").agg(F.collect_list("pos").alias("p")).mapInArrow(packed, "doc_id long, tag long, n_bits int, dropped binary")


def dropped_lines(packed: bytes | None, n_bits: int | None, n_lines: int) -> np.ndarray:
    gone = np.zeros(n_lines, bool)
    if packed is not None:
        gone[:n_bits] = unpack_bits(packed, n_bits)
    return gone


def with_bitmaps(docs: DataFrame, maps: DataFrame) -> DataFrame:
    """docs with columns of numbers (_c0, ...) and n_bits and dropped of their bitmaps; texts are hashed, not sorted."""
    flat = numbered(docs)
    doc_id, text = (F.col(f"_c{place_of(docs, name)}") for name in ("doc_id", "text"))
    tagged = flat.withColumn("id", F.coalesce(doc_id.cast("long"), F.lit(NO_ID))).withColumn("tag", F.xxhash64(F.coalesce(text.cast("string"), F.lit(""))))
    right = maps.select(F.col("doc_id").alias("id"), "tag", "n_bits", "dropped")
    return tagged.join(right.hint("shuffle_hash"), ["id", "tag"], "left")


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Rows (doc_id, n_lines, n_dropped, keep): keep is the compressed keep bitmap of each document."""
    return _judged(docs, min_chars, min_docs, "keep binary", lambda lines, keep: pack_bits(keep), pa.binary())


def _judged(docs, min_chars, min_docs, column, make, kind):
    def run(batches):
        for batch in arrow_batches(batches, 256):
            n, gone_n, made = [], [], []
            for text, bits, packed in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                lines = (text or "").split("\n")
                gone = dropped_lines(packed, bits, len(lines))
                n.append(len(lines))
                gone_n.append(int(gone.sum()))
                made.append(make(lines, ~gone))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(gone_n, pa.int64()), pa.array(made, kind)], ["doc_id", "n_lines", "n_dropped", column.split()[0]])

    rows = pick(docs, doc_id="long", text="string")
    return with_bitmaps(rows, keep_bitmaps(rows, min_chars, min_docs)).select("_c0", "_c1", "n_bits", "dropped").mapInArrow(run, f"doc_id long, n_lines long, n_dropped long, {column}")


def kept_text(lines: list[str], keep: np.ndarray) -> str:
    return "\n".join(x for x, k in zip(lines, keep.tolist(), strict=True) if k)


def dedup_stage(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """docs with every column, their texts without the dropped lines (a null text stays null) and n_chars, where present, brought up to date."""
    joined = with_bitmaps(docs, keep_bitmaps(docs, min_chars, min_docs))

    @F.pandas_udf("string")
    def cut(text: pd.Series, bits: pd.Series, packed: pd.Series) -> pd.Series:
        out = []
        for t, b, p in zip(text, bits, packed, strict=True):
            if p is not None:
                lines = t.split("\n")
                t = kept_text(lines, ~dropped_lines(p, int(b), len(lines)))
            out.append(t)
        return pd.Series(out, dtype=object)

    text, kinds = place_of(docs, "text"), [kind for _, kind in docs.dtypes]
    at = {i: F.col(f"_c{i}") for i in range(len(kinds))}
    at[text] = F.when(F.col("dropped").isNotNull(), cut(at[text], "n_bits", "dropped")).otherwise(at[text])
    out = joined.select(*[c.alias(f"_c{i}") for i, c in at.items()])
    if "n_chars" in docs.columns:
        n = place_of(docs, "n_chars")
        out = out.withColumn(f"_c{n}", F.length(f"_c{text}").cast(kinds[n]))
    return out.toDF(*docs.columns)


def op4_line_dedup(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    digest = lambda lines, keep: hashlib.sha256(kept_text(lines, keep).encode("utf-8", "surrogatepass")).hexdigest()
    return _judged(docs, 20, 3, "kept_sha256 string", digest, pa.string())


OP4_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), g AS (
  SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), j AS (
  SELECT k.doc_id, k.pos, k.line, g.last IS NOT NULL AND k.doc_id < g.last AS gone FROM k LEFT JOIN g USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""

QUERIES = {"op4_line_dedup": op4_line_dedup}
ORACLES = {"op4_line_dedup": OP4_SQL}
