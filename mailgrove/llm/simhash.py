"""SimHash near-duplicates by pigeonhole blocks (operator 2).

A text is lower-cased (A-Z only), cut into words `[^\\x20\\x09-\\x0D]+` and word shingles;
each shingle's XXH64 votes on 64 bits. Two fingerprints that differ in at most `distance`
bits agree on all but `distance` of the blocks, so every choice of blocks that must agree
makes a join key; candidates that share a key are verified by their Hamming distance.

Defined cases: a null or word-less text has fingerprint zero and links like any other; fewer
words than a shingle give one shingle of all words; a null doc_id is a document of its own
class member but never the smallest id of a class that has others; repeated rows are repeated
in the result; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailgrove.llm.shared import components, pick, settle

#: Largest key group whose members are compared pair by pair; larger groups take the neighbour path.
PAIRWISE_GROUP = 32
#: Shingles voted at once, so that a very long text needs no more memory than this.
VOTES = 1 << 15
SEED = 42


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of every word shingle of a text, repeats included."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, "<u8")
    line = memoryview(b" ".join(parts))
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(parts) >= words:
        starts, ends = starts[: len(parts) - words + 1], ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], dtype="<u8")


def vote(hashes: np.ndarray) -> int:
    """The unsigned fingerprint: each bit set in over half the hashes."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), VOTES):
        bits = np.unpackbits(hashes[at : at + VOTES].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, words: int = 3) -> int:
    """The unsigned 64-bit SimHash of a text."""
    return vote(shingle_hashes(text, words))


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """Rows (doc_id, fp): fp is the fingerprint's bits as a signed long."""

    def run(batches):
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), words) for t in batch.column(1)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.int64())], ["doc_id", "fp"])

    return pick(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, fp long")


def block_masks(distance: int, blocks: int) -> list[int]:
    """For every choice of blocks that must agree, the mask of their bits."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    of = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    return [sum(c) for c in combinations(of, blocks - distance)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(prints: DataFrame, distance: int = 2, blocks: int = 5, group: int = PAIRWISE_GROUP) -> DataFrame:
    """Edges (a, b) whose connected components are those of all pairs within `distance` bits.

    prints: distinct fingerprints (fp). Key groups up to `group` are joined with themselves and
    verified. In a larger one, only bits outside the key can differ: each member names its
    neighbours at half the distance there, and those that name the same neighbour are tied to
    the least of them. Two fingerprints share such a neighbour only if they are within the
    distance, so that path is exact too, and linear in the group.
    """
    if distance != 2:
        raise ValueError("the neighbour path for large groups is for a distance of 2")
    masks = block_masks(distance, blocks)
    keyed = prints.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(masks)])).alias("k")).select("fp", "k.i", "k.key")
    sizes = keyed.groupBy("i", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    member = settle(keyed.join(sizes, ["i", "key"]).select("i", "key", "fp", "n"), "simhash-blocks")
    few = member.filter(F.col("n") <= group)
    a, b = few.select("i", "key", F.col("fp").alias("a")), few.select("i", "key", F.col("fp").alias("b"))
    near = a.join(b, ["i", "key"]).filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)).select("a", "b")
    free = [[_signed(1 << bit) for bit in range(64) if not m >> bit & 1] for m in masks]
    flips = F.element_at(F.array(*[F.array(F.lit(0).cast("long"), *[F.lit(f).cast("long") for f in bits]) for bits in free]), F.col("i") + 1)
    named = member.filter(F.col("n") > group).select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("z")).distinct()
    least = named.groupBy("z").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("z", "b")
    tied = named.join(least, "z").filter("fp <> b").select(F.col("fp").alias("a"), "b")
    return near.union(tied)


def simhash_classes(docs: DataFrame, words: int = 3, distance: int = 2, blocks: int = 5, group: int = PAIRWISE_GROUP) -> DataFrame:
    """One row per document: doc_id, fp (signed long), component_id (the smallest doc_id of its class)."""
    prints = settle(fingerprints(docs, words), "simhash-prints")
    distinct = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-distinct")
    roots = components(links(distinct.select("fp"), distance, blocks, group)).select(F.col("node").alias("fp"), "root")
    classed = distinct.join(roots, "fp", "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    least = classed.groupBy("root").agg(F.min("rep").alias("component_id"))
    of = classed.join(least, "root").select("fp", "component_id")
    return prints.join(of, "fp").select("doc_id", "fp", F.coalesce("component_id", "doc_id").alias("component_id"))


def op2_simhash_near_dedup(spark, sf_dir):
    classes = simhash_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return classes.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op2_simhash_near_dedup": op2_simhash_near_dedup}
