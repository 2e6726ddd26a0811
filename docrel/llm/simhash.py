"""SimHash near-duplicate detection with pivot distance tables.

1. Fingerprints: the shingles of each whole text are hashed with XXH64 and a bit
   is set where more than half of the hashes have it (Arrow batches, numpy).
2. Equal fingerprints are one node, so groups of copies never make pairs.
3. Each node gets a pivot table row: its Hamming distances to ``PIVOTS``
   reference fingerprints.  By the triangle inequality, two nodes within
   ``max_bits`` of each other differ by at most that much in every coordinate.
4. Nodes are dealt into buckets that agree on all but ``max_bits`` of
   ``max_bits + 2`` blocks of bits (some such choice holds for every linked pair,
   by the pigeonhole principle).  Inside a bucket, pairs whose tables differ by
   more than ``max_bits`` in a coordinate are discarded and the survivors are
   verified on the fingerprints.  A large bucket is searched outward from one
   member at a time over the members not yet reached, so it gives at most one
   link per member instead of all pairs.
   Buckets of more than ``BUCKET_BOUND`` nodes are cut further: the same principle
   holds on the bits that are still free, so their nodes are dealt again, into buckets
   that agree on two more blocks, until all buckets are within the bound.
5. Components of the links (``components.py``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docrel.llm.common import fresh, stored
from docrel.llm.components import components
from docrel.operators.grouping import reshuffled_agg

SHINGLE_WORDS = 3
MAX_BITS = 3
PIVOTS = 16
SEED = 42
#: Buckets with more nodes are searched outward instead of pair by pair.
LARGE_BUCKET = 16
#: Buckets with more nodes are dealt anew by further blocks.
BUCKET_BOUND = 1 << 14
#: Lists of so few large buckets are broadcast.
_FEW_BUCKETS = 100_000
#: Shingles whose bits are counted at once, and rows searched at once.
_STEP = 1 << 15
_CHUNK = 1 << 18

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def simhash64(text: bytes, shingle: int = SHINGLE_WORDS) -> int:
    """Fingerprint of one UTF-8 text, as an unsigned number."""
    import xxhash

    words = text.translate(_LOWER).split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed=SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-shingle] + 1)).tolist()
    stops = ends[shingle - 1:].tolist()
    digest, ones = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for i in range(0, len(starts), _STEP):
        h = b"".join([digest(joined[a:b], SEED) for a, b in
                      zip(starts[i:i + _STEP], stops[i:i + _STEP])])
        bits = np.unpackbits(np.frombuffer(h, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts)).tobytes(), "big")


def fingerprints(df: DataFrame, keys: list[str], text_col: str = "text",
                 shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``keys`` and ``fp`` (long, the fingerprint's 64 bits) of every row."""
    src = df.select(*keys, F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("body"))
    schema = df.select(*keys, F.lit(0).cast("long").alias("fp")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            body = b.column(len(keys))
            fp = np.fromiter((simhash64(body[i].as_py(), shingle) for i in range(len(body))),
                             np.uint64, len(body)).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keys)], pa.array(fp)],
                                             names=[*keys, "fp"])

    return src.mapInArrow(run, schema)


def pivots(n: int = PIVOTS) -> np.ndarray:
    """The reference fingerprints: the first 64 bits of numbered digests."""
    return np.array([int.from_bytes(hashlib.sha256(b"pivot-%d" % i).digest()[:8], "big")
                     for i in range(n)], np.uint64)


def pivot_table(fp: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """Hamming distance of every fingerprint to every pivot."""
    return np.bitwise_count(fp[:, None] ^ refs[None, :]).astype(np.int8)


def blocks(max_bits: int, fixed: int = 0) -> list[int]:
    """Masks of the choices of two of ``max_bits + 2`` blocks of the bits outside ``fixed``."""
    free = [i for i in range(64) if not fixed >> i & 1]
    edges = np.linspace(0, len(free), max_bits + 3).round().astype(int).tolist()
    part = [sum(1 << i for i in free[a:b]) for a, b in zip(edges, edges[1:])]
    return [x | y for x, y in combinations(part, 2)]


@lru_cache(maxsize=4096)
def mask_of(choice: int, max_bits: int) -> int:
    """The bits in which a bucket's nodes agree.  ``choice`` holds the choices of blocks
    made so far, as digits from 1 on in a base of one more than the choices."""
    if not choice:
        return 0
    choices = (max_bits + 2) * (max_bits + 1) // 2
    before, digit = divmod(choice, choices + 1)
    fixed = mask_of(before, max_bits)
    return fixed | blocks(max_bits, fixed)[digit - 1]


def _dealt(nodes: DataFrame, max_bits: int) -> DataFrame:
    """(bucket, choice, fp, table) of nodes (choice, fp): each in every bucket that it
    belongs to among those that go on from its choice."""
    refs = pivots()
    choices = (max_bits + 2) * (max_bits + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            every = b.column(0).to_numpy(zero_copy_only=False)
            fps = b.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            for before in np.unique(every).tolist():
                fp = fps[every == before]
                rows = pivot_table(fp, refs)
                buffer = pa.py_buffer(np.ascontiguousarray(rows))
                table = pa.Array.from_buffers(pa.binary(len(refs)), len(fp), [None, buffer]).cast(pa.binary())
                for i in range(1, choices + 1):
                    choice = before * (choices + 1) + i
                    mask = np.uint64(mask_of(choice, max_bits))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((fp & mask).view(np.int64)), pa.array(np.full(len(fp), choice, np.int64)),
                         pa.array(fp.view(np.int64)), table], names=["bucket", "choice", "fp", "table"])

    return nodes.select("choice", "fp").mapInArrow(run, "bucket long, choice long, fp long, table binary")


def bucketed(nodes: DataFrame, max_bits: int = MAX_BITS, bound: int | None = None) -> list[DataFrame]:
    """Tables (bucket, choice, fp, table) whose buckets hold every linked pair of the
    nodes (column ``fp``, distinct) together at least once and at most ``bound`` nodes each."""
    # so few nodes may be left that no block can part them
    bound = max(bound or BUCKET_BOUND, 1 << max_bits)
    now, out = nodes.select(F.lit(0).cast("long").alias("choice"), "fp"), []
    left = nodes.count()
    while True:
        dealt = _dealt(now, max_bits)
        # a bucket is never larger than the table, nor than its free bits can tell apart
        if left <= bound:
            return [*out, dealt]
        large = stored(dealt.groupBy("choice", "bucket").agg(F.count(F.lit(1)).alias("n"))
                       .filter(F.col("n") > bound).select("choice", "bucket", "n"), "buckets")
        found, left = large.agg(F.count(F.lit(1)), F.max("n")).first()
        if not found:
            return [*out, dealt]
        large = large.drop("n")
        if found <= _FEW_BUCKETS:
            large = F.broadcast(large)
        out.append(dealt.join(large, ["choice", "bucket"], "left_anti").select("bucket", "choice", "fp", "table"))
        now = stored(dealt.join(large, ["choice", "bucket"], "left_semi").select("choice", "fp"), "redealt")


def _near(fp, table, one_fp, one_table, max_bits):
    """Which of the nodes are linked to one: pivot test, then verification."""
    near = np.abs(table - one_table).max(axis=1) <= max_bits
    at = np.flatnonzero(near)
    return at[np.bitwise_count(fp[at] ^ one_fp) <= max_bits]


def _outward(fp: np.ndarray, table: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of a large bucket's links."""
    links: list[tuple[int, int]] = []
    left = np.arange(len(fp))
    while len(left):
        todo, left = [int(left[0])], left[1:]
        while todo and len(left):
            x = todo.pop()
            hit = _near(fp[left], table[left], fp[x], table[x], max_bits)
            if len(hit):
                found = left[hit].tolist()
                links += [(x, y) for y in found]
                todo += found
                left = np.delete(left, hit)
    return links


def _links_of(bucket, fp, table, max_bits):
    """Links in the whole buckets of sorted rows."""
    n = len(bucket)
    new = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    size = np.diff(np.append(new, n))
    a, b = [], []
    for s, m in zip(new[size > LARGE_BUCKET].tolist(), size[size > LARGE_BUCKET].tolist()):
        for i, j in _outward(fp[s:s + m], table[s:s + m], max_bits):
            a.append(s + i)
            b.append(s + j)
    small = np.repeat(size, size)
    small = np.where(small > LARGE_BUCKET, 0, small)
    at = np.arange(n) - np.repeat(new, size)
    for d in range(1, LARGE_BUCKET):
        i = np.flatnonzero(at + d < small)
        if not len(i):
            break
        ok = np.abs(table[i] - table[i + d]).max(axis=1) <= max_bits
        i = i[ok]
        i = i[np.bitwise_count(fp[i] ^ fp[i + d]) <= max_bits]
        a += i.tolist()
        b += (i + d).tolist()
    return fp[a].view(np.int64), fp[b].view(np.int64)


def links(nodes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(u, v): links that join the same components as all pairs of distinct
    fingerprints (column ``fp``) with at most ``max_bits`` differing bits."""
    found = [_linked(part, max_bits) for part in bucketed(nodes, max_bits)]
    return reduce(DataFrame.unionByName, found)


def _linked(dealt: DataFrame, max_bits: int) -> DataFrame:
    """Links within the buckets of one table."""
    dealt = dealt.repartition("choice", "bucket").sortWithinPartitions("choice", "bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        rows, enough, last, number = 0, _CHUNK, None, 0

        def out(*done):
            a, b = _links_of(*done, max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["u", "v"])

        for batch in batches:
            n = len(batch)
            if not n:
                continue
            raw = batch.column(3).cast(pa.binary(PIVOTS))
            table = np.frombuffer(raw.buffers()[1], np.int8, n * PIVOTS, raw.offset * PIVOTS)
            choice = batch.column(1).to_numpy(zero_copy_only=False)
            bucket = batch.column(0).to_numpy(zero_copy_only=False)
            new = np.ones(n, bool)  # rows that begin a bucket
            new[1:] = (bucket[1:] != bucket[:-1]) | (choice[1:] != choice[:-1])
            new[0] = last != (choice[0], bucket[0])
            last = (choice[-1], bucket[-1])
            key = np.cumsum(new) + number
            number = int(key[-1])
            held.append((key, batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64),
                         table.reshape(n, PIVOTS)))
            rows += n
            if rows >= enough:  # search all buckets but the last, which may go on
                key, fp, table = map(np.concatenate, zip(*held))
                ends = np.flatnonzero(key[1:] != key[:-1]) + 1
                cut = int(ends[-1]) if len(ends) else 0
                yield out(key[:cut], fp[:cut], table[:cut])
                held, rows = [(key[cut:], fp[cut:], table[cut:])], len(key) - cut
                enough = max(_CHUNK, 2 * rows)
        if held:
            yield out(*map(np.concatenate, zip(*held)))

    return dealt.mapInArrow(run, "u long, v long")


def grouped(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
            shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``df``: id, fingerprint (16 hex digits), component_id.

    ``component_id`` is the smallest id reachable over links, itself included
    (null where all ids of a component are null).  A null text counts as empty
    and has the fingerprint zero, as has any text without words.  Repeated rows
    get equal rows.  Empty table: no rows.  Other columns are ignored.
    """
    docs = stored(fingerprints(df.select(F.col(id_col).alias("id"), text_col), ["id"], text_col,
                               shingle), "fingerprints")
    by_fp = _components_of(docs, F.min("id"), max_bits)
    return docs.join(by_fp, "fp", "left").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("best").alias("component_id"))


def _components_of(docs: DataFrame, best, max_bits: int) -> DataFrame:
    """(fp, best): an aggregate over all documents of the fingerprint's component."""
    nodes = stored(docs.groupBy("fp").agg(best.alias("rep")), "nodes")
    roots = components(links(nodes, max_bits))
    named = stored(nodes.join(roots, nodes["fp"] == roots["node"], "left")
                   .select("fp", "rep", F.coalesce("root", "fp").alias("root")), "named")
    least = reshuffled_agg(named, "root", F.min("rep").alias("best"))
    return stored(named.join(least, "root").select("fp", "best"), "components")


def deduplicated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                 shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``df``, one of each component: that with the smallest id
    (nulls last; ties settled by a hash of the text)."""
    tie = fresh(df, "sim_tie")
    ident = [F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"),
             F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("tie")]
    docs = stored(fingerprints(df.select(*ident, text_col), ["none", "id", "tie"], text_col, shingle),
                  "fingerprints")
    by_fp = _components_of(docs, F.min(F.struct("none", "id", "tie")), max_bits)
    stay_id, stay_tie = fresh(df, "stay_id"), fresh(df, "stay_tie")
    stay = by_fp.select(F.col("best.id").alias(stay_id), F.col("best.tie").alias(stay_tie)).distinct()
    rows = df.withColumn(tie, F.xxhash64(F.coalesce(text_col, F.lit(""))))
    kept = rows.join(stay, F.col(id_col).eqNullSafe(F.col(stay_id)) & (F.col(tie) == F.col(stay_tie)),
                     "left_semi")
    rank = fresh(df, "sim_rank")
    w = Window.partitionBy(id_col, tie).orderBy(
        F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in df.columns]))
    return kept.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) == 1) \
               .select(*[F.col(f"`{c}`") for c in df.columns])
