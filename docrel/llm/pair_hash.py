"""A minimal perfect hash over distinct 64-bit keys, and sums of dense vectors by it.

Keys fall into ``BUCKETS`` by a mixing function.  A bucket's function is a cascade of
bit arrays: a key whose place in an array no other key shares sets that bit, the
others go on to the next array.  A key's index is the rank of its bit, so n keys have
the indices 0 to n - 1 and about four bits each.  A key outside the set may be given
an index too, so what is looked up is held against the stored key.

A bucket's indices are a range of their own: counts are vectors by bucket, each task
makes one of its own and they are summed in a tree of tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docrel.llm.common import stored

BUCKETS = 64
#: Bits of an array for each key that is still without a place.
SPREAD = 1.5
#: Vectors that one task of a tree merges.
FAN_IN = 16


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A hash of 64-bit keys (the finaliser of SplitMix64 over key and seed)."""
    x = keys.view(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bucket_of(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 0) % np.uint64(BUCKETS)).astype(np.int64)


def cascade(keys: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Sizes in bits (multiples of 64) and the bits, as 64-bit words, of distinct keys."""
    sizes, words = [], []
    while len(keys):
        size = -(-int(SPREAD * len(keys) + 1) // 64) * 64
        at = (mixed(keys, len(sizes) + 1) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size)[at] == 1
        bits = np.zeros(size, np.uint8)
        bits[at[alone]] = 1
        words.append(np.packbits(bits, bitorder="little").view("<u8"))
        sizes.append(size)
        keys = keys[~alone]
    return sizes, np.concatenate(words) if words else np.zeros(0, "<u8")


class PerfectHash:
    """The functions of some buckets as one; ``rows`` are (bucket, sizes, words)."""

    def __init__(self, rows: list[tuple[int, list[int], np.ndarray]]):
        rows = sorted(rows, key=lambda r: r[0])
        levels = max([len(sizes) for _, sizes, _ in rows], default=0)
        self.sizes = np.zeros((levels, BUCKETS), np.int64)
        self.starts = np.zeros((levels, BUCKETS), np.int64)
        at = 0
        for bucket, sizes, _ in rows:
            for level, size in enumerate(sizes):
                self.sizes[level, bucket], self.starts[level, bucket] = size, at
                at += size
        self.words = np.concatenate([w for *_, w in rows] or [np.zeros(0, "<u8")])
        self.ranks = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def __len__(self) -> int:
        return int(self.ranks[-1])

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Indices of keys; -1, or any index, for a key that is not of the set."""
        out = np.full(len(keys), -1, np.int64)
        left, bucket = np.arange(len(keys)), bucket_of(keys)
        for level in range(len(self.sizes)):
            size = self.sizes[level, bucket[left]]
            left, size = left[size > 0], size[size > 0]
            if not len(left):
                break
            at = (mixed(keys[left], level + 1) % size.view(np.uint64)).astype(np.int64) \
                + self.starts[level, bucket[left]]
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = word[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[left[hit]] = self.ranks[at[hit] >> 6] + np.bitwise_count(below)
            left = left[~hit]
        return out


def narrow(values: np.ndarray) -> bytes:
    """Numbers from 0 on in the narrowest width that holds them, told by a first byte."""
    top = int(values.max(initial=0))
    kind = next(k for k in (1, 2, 4, 8) if top < 1 << (8 * k) or k == 8)
    return bytes([kind]) + values.astype(f"<u{kind}").tobytes()


def widened(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def merged(parts: DataFrame, merge: Callable[[list[np.ndarray]], np.ndarray], n_parts: int,
           fan_in: int = FAN_IN) -> DataFrame:
    """(bucket, data) of (bucket, part, data): a tree of merges, ``fan_in`` parts a task.

    ``part`` is below ``n_parts``; ``data`` is what :func:`narrow` makes.
    """
    def run(key: tuple, table: pa.Table) -> pa.Table:
        out = merge([widened(x.as_py()) for x in table["data"]])
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()),
                         "part": pa.array([key[1].as_py()], pa.int64()), "data": pa.array([narrow(out)], pa.binary())})

    while True:
        parts = parts.withColumn("part", F.expr(f"part div {fan_in}")).groupBy("bucket", "part") \
                     .applyInArrow(run, "bucket int, part long, data binary")
        n_parts = -(-n_parts // fan_in)
        if n_parts <= 1:
            return parts.select("bucket", "data")


def union(parts: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate(parts))


def total(parts: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(max(map(len, parts)), np.int64)
    for p in parts:
        out[:len(p)] += p
    return out


def functions(keys: DataFrame) -> DataFrame:
    """(bucket, n, sizes, words, keys) of (bucket, data), the distinct keys of a bucket:
    its hash function, and its keys by index."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for bucket, data in zip(b.column(0).to_pylist(), b.column(1)):
                own = widened(data.as_py())
                sizes, words = cascade(own)
                by_index = np.zeros(len(own), np.int64)
                by_index[PerfectHash([(bucket, sizes, words)]).index(own)] = own
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bucket], pa.int32()), pa.array([len(own)], pa.int64()),
                     pa.array([sizes], pa.list_(pa.int64())), pa.array([words.tobytes()], pa.binary()),
                     pa.array([by_index.astype("<i8").tobytes()], pa.binary())],
                    names=["bucket", "n", "sizes", "words", "keys"])

    return keys.select("bucket", "data").mapInArrow(
        run, "bucket int, n long, sizes array<long>, words binary, keys binary")


def slices_of(functions: DataFrame, most: int) -> list[list[int]]:
    """The buckets in runs of at most ``most`` keys together, or of one bucket."""
    out: list[list[int]] = []
    held = 0
    for bucket, n in functions.select("bucket", "n").orderBy("bucket").collect():  # at most BUCKETS rows
        if out and held + n <= most:
            out[-1].append(bucket)
            held += n
        else:
            out.append([bucket])
            held = n
    return out


def perfect_hash(functions: DataFrame, buckets: list[int]) -> PerfectHash:
    rows = functions.filter(F.col("bucket").isin(buckets)).select("bucket", "sizes", "words").collect()
    return PerfectHash([(r["bucket"], r["sizes"], np.frombuffer(r["words"], "<u8")) for r in rows])


def counted(chunks: DataFrame, functions: DataFrame, buckets: list[int], n_parts: int) -> DataFrame:
    """(bucket, data) of chunks (bucket, part, keys, counts): the sums of the chunks'
    dense vectors, by index."""
    hashed = perfect_hash(functions, buckets)
    of = {r["bucket"]: r["n"] for r in functions.select("bucket", "n").collect()}
    first, at = {}, 0
    for b in sorted(buckets):
        first[b] = at
        at += of[b]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, part, keys, counts in zip(*(batch.column(i) for i in range(4))):
                b = bucket.as_py()
                vector = np.zeros(of[b], np.int64)
                vector[hashed.index(widened(keys.as_py())) - first[b]] = widened(counts.as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b], pa.int32()), pa.array([part.as_py()], pa.int64()),
                     pa.array([narrow(vector)], pa.binary())], names=["bucket", "part", "data"])

    dense = chunks.filter(F.col("bucket").isin(buckets)).select("bucket", "part", "keys", "counts") \
                  .mapInArrow(run, "bucket int, part long, data binary")
    return merged(dense, total, n_parts)


def table(chunks: DataFrame, slice_keys: int) -> DataFrame:
    """(bucket, n, sizes, words, keys, counts) of all keys in chunks (bucket, part, keys,
    counts), stored; ``counts`` is the sum of a key's counts, by index."""
    chunks = stored(chunks, "chunks")
    top = chunks.agg(F.max("part")).first()[0]
    n_parts = 1 if top is None else top + 1
    keys = merged(chunks.select("bucket", "part", F.col("keys").alias("data")), union, n_parts)
    made = stored(functions(keys), "functions")
    sums = None
    for buckets in slices_of(made, slice_keys):
        part = counted(chunks, made, buckets, n_parts)
        sums = part if sums is None else sums.unionByName(part)
    if sums is None:
        return made.withColumn("counts", F.lit(None).cast("binary"))
    return stored(made.join(sums.withColumnRenamed("data", "counts"), "bucket"), "counts")
