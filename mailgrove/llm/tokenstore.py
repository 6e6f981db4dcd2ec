"""Sorted-string-table shards of token ids (operator 8).

Layout of a shard, all integers little-endian:
  blocks   zstd frames of entries: varint shared key bytes, varint other key bytes, varint value
           bytes, the other key bytes, the value (ids of `width` bytes each)
  index    for each block: varint length of its last key, that key, u64 offset, u32 length, u32 entries
  filter   Bloom filter bits over keys
  footer   u64 index offset, u32 index length, u64 filter offset, u32 filter length, u64 documents,
           u64 ids, u8 width, u8 hashes, 8 bytes magic
Keys are one byte (0: no id, 1: id), the id as 8 big-endian bytes with its sign bit flipped, and
4 big-endian bytes that count rows with the same id; their byte order is the order of ids.

Shards hold ascending ranges of doc_id. A task writes its shard under a name of its own attempt,
and only names that a finished task reports are read, so lost executors leave no half-read shard.

Defined cases: a null text is empty and holds only the end id; rows that share a doc_id are all
kept, ordered by text; null ids come first; an empty table gives no shard and an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailgrove.llm.shared import new_path, pick, text_batches
from mailgrove.llm.tokens import encoder, vocabulary

BLOCK, BLOOM_BITS, HASHES, MAGIC = 1 << 16, 10, 7, b"MGSSTv01"
FOOTER = struct.Struct("<QIQIQQBB8s")
END_ID = 2


def key_of(doc_id: int | None, nth: int = 0) -> bytes:
    body = b"\x00" * 9 if doc_id is None else b"\x01" + struct.pack(">Q", (doc_id + (1 << 63)) & ((1 << 64) - 1))
    return body + struct.pack(">I", nth)


def id_of(key: bytes) -> int | None:
    return struct.unpack(">Q", key[1:9])[0] - (1 << 63) if key[0] else None


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(data, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


def _bloom_places(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """For each hash function, the places of keys whose 128-bit hashes are the rows [keys, 2]."""
    a, b = hashes[:, 0] >> np.uint64(1), hashes[:, 1] >> np.uint64(8) | np.uint64(1)  # no sum exceeds 64 bits
    return [(a + np.uint64(i) * b) % np.uint64(bits) for i in range(HASHES)]


def _hashed(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


class Writer:
    """Writes one shard to a binary stream; keys must come in ascending order."""

    def __init__(self, out, width: int):
        self.out, self.width, self.at = out, width, 0
        self.block, self.entries, self.last, self.index, self.hashes, self.n_docs = bytearray(), 0, b"", [], bytearray(), 0
        self.n_ids = 0
        self.zstd = zstandard.ZstdCompressor(level=1)

    def add(self, key: bytes, ids: bytes) -> None:
        if self.n_docs and key <= self.last:
            raise ValueError("keys must ascend")
        same = 0
        if self.entries:
            while same < len(key) and key[same] == self.last[same]:
                same += 1
        self.block += _varint(same) + _varint(len(key) - same) + _varint(len(ids)) + key[same:] + ids
        self.last, self.entries = key, self.entries + 1
        self.hashes += _hashed(key)
        self.n_docs += 1
        self.n_ids += len(ids) // self.width
        if len(self.block) >= BLOCK:
            self._flush()

    def _flush(self) -> None:
        if self.entries:
            data = self.zstd.compress(bytes(self.block))
            self.index.append((self.last, self.at, len(data), self.entries))
            self.out.write(data)
            self.at += len(data)
            self.block, self.entries = bytearray(), 0

    def close(self) -> None:
        self._flush()
        index = b"".join(_varint(len(k)) + k + struct.pack("<QII", o, n, e) for k, o, n, e in self.index)
        bits = max(64, self.n_docs * BLOOM_BITS)
        bloom = np.zeros(-(-bits // 8), np.uint8)
        for at in _bloom_places(np.frombuffer(self.hashes, "<u8").reshape(-1, 2), bits):
            np.bitwise_or.at(bloom, (at >> np.uint64(3)).astype(np.int64), np.uint8(128) >> (at & np.uint64(7)).astype(np.uint8))
        packed = bloom.tobytes()
        self.out.write(index + packed + FOOTER.pack(self.at, len(index), self.at + len(index), len(packed), self.n_docs, self.n_ids, self.width, HASHES, MAGIC))


class Reader:
    """Reads a shard: get() looks a document up by the filter, the index and one block; iteration goes through all."""

    def __init__(self, file, size: int):
        self.file = file
        self.file.seek(size - FOOTER.size)
        at, n, bloom_at, bloom_n, self.n_docs, self.n_ids, self.width, _, magic = FOOTER.unpack(self.file.read(FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a token shard")
        self.file.seek(at)
        index = self.file.read(n)
        self.bloom = np.frombuffer(self.file.read(bloom_n), np.uint8)
        self.bits = max(64, self.n_docs * BLOOM_BITS)
        self.last, self.blocks, p = [], [], 0
        while p < n:
            size, p = _read_varint(index, p)
            self.last.append(index[p : p + size])
            self.blocks.append(struct.unpack_from("<QII", index, p + size))
            p += size + 16
        self.zstd = zstandard.ZstdDecompressor()

    def _entries(self, i: int):
        offset, size, count = self.blocks[i]
        self.file.seek(offset)
        data = self.zstd.decompress(self.file.read(size))
        at, key = 0, b""
        for _ in range(count):
            same, at = _read_varint(data, at)
            more, at = _read_varint(data, at)
            value, at = _read_varint(data, at)
            key = key[:same] + data[at : at + more]
            at += more
            yield key, data[at : at + value]
            at += value

    def __iter__(self):
        for i in range(len(self.blocks)):
            yield from self._entries(i)

    def may_have(self, key: bytes) -> bool:
        """What the filter says."""
        places = (int(x[0]) for x in _bloom_places(np.frombuffer(_hashed(key), "<u8").reshape(1, 2), self.bits))
        return all(self.bloom[b >> 3] >> (7 - (b & 7)) & 1 for b in places)

    def get(self, doc_id: int | None, nth: int = 0) -> np.ndarray | None:
        key = key_of(doc_id, nth)
        if not self.may_have(key):
            return None
        i = bisect_left(self.last, key)
        if i < len(self.blocks):
            for k, v in self._entries(i):
                if k == key:
                    return np.frombuffer(v, f"<u{self.width}")
        return None


def write_shards(docs: DataFrame, folder: str, path: str, end_id: int = END_ID) -> list[dict]:
    """Write docs as shards into folder; the manifest has one row a shard (path, docs, ids), in order of doc_id."""

    def run(batches):
        made, out, n, last, nth = None, None, 0, object(), 0
        enc = encoder(path)
        width = 2 if max(enc.tok.get_vocab_size(), end_id) < 1 << 16 else 4
        end = np.array([end_id], f"<u{width}").tobytes()
        task = TaskContext.get()
        where, name = None, f"part-{task.partitionId():06d}-{task.taskAttemptId()}.sst"
        for batch in text_batches(batches, 1, 2048):
            ids, ends = enc.batch(batch.column(1))
            ids = ids.astype(f"<u{width}")
            for doc_id, a, b in zip(batch.column(0).to_pylist(), ends.tolist(), ends[1:].tolist(), strict=False):
                if made is None:
                    where, inner = fs.FileSystem.from_uri(folder)
                    where.create_dir(inner)
                    out = where.open_output_stream(f"{inner}/{name}")
                    made = Writer(out, width)
                nth = nth + 1 if doc_id == last else 0
                last = doc_id
                made.add(key_of(doc_id, nth), ids[a:b].tobytes() + end)
                n += 1
        if made is not None:
            made.close()
            out.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([task.partitionId()], pa.int32()), "path": [f"{folder}/{name}"], "docs": [n], "ids": [made.n_ids]})

    placed = pick(docs, doc_id="long", text="string").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    made = placed.mapInArrow(run, "part int, path string, docs long, ids long").collect()  # one row a shard; sorting in Spark would write the shards twice
    return [r.asDict() for r in sorted(made, key=lambda r: r["part"])]


def read_shards(spark, manifest: list[dict]) -> DataFrame:
    """Rows (doc_id, start, ids binary as little-endian unsigned 32-bit integers) of all shards."""
    schema = "doc_id long, start long, ids binary"
    rows, start = [], 0
    for m in manifest:
        rows.append((m["path"], start))
        start += m["ids"]
    if not rows:
        return spark.createDataFrame([], schema)

    def run(batches):
        for batch in batches:
            for path, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                where, inner = fs.FileSystem.from_uri(path)
                with where.open_input_file(inner) as f:
                    ids, starts, values = [], [], []
                    reader = Reader(f, f.size())
                    for key, value in reader:
                        ids.append(id_of(key))
                        starts.append(at)
                        values.append(np.frombuffer(value, f"<u{reader.width}").astype("<u4").tobytes())
                        at += len(value) // reader.width
                        if len(ids) == 1024:
                            yield _rows(ids, starts, values)
                            ids, starts, values = [], [], []
                    yield _rows(ids, starts, values)

    def _rows(ids, starts, values):
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(values, pa.binary())], ["doc_id", "start", "ids"])

    return spark.createDataFrame(rows, "path string, start long").repartition(len(rows)).mapInArrow(run, schema)


def op8_token_store(spark, sf_dir):
    manifest = write_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"), new_path(spark, "shards"), vocabulary("word_bpe_49k.json"))

    def digest(batches):
        for batch in batches:
            values = batch.column(2).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(v) // 4 for v in values], pa.int64()), pa.array([zlib.crc32(v) for v in values], pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return read_shards(spark, manifest).mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long")


QUERIES = {"op8_token_store": op8_token_store}
