"""Cost-balanced packing of documents into training sequences.

Attention over a sequence costs a linear part per token and a quadratic part per
document in it (documents do not attend to each other), so sequences of equal
length can differ much in cost.

1. Each document is tokenised once and cut into pieces of a whole sequence and a
   rest.  A whole piece fills its sequence alone.
2. Rests are dealt into groups of about ``GROUP_DOCS`` by a hash and carry their
   ids through that one shuffle; of rows that a task meets again and again, all but
   the first ``SAME_GROUP`` are dealt anew by their number, so a repeated row is no
   hot group.  Whole pieces only need a number for their sequence and are dealt
   apart, with their place in the document, so a very long text is no hot group.
3. In each group the rests, longest first, each go to the lowest-cost sequence
   with enough capacity left.  Rests that fit nowhere are cut over the gaps,
   lowest cost first.  The group's sequences have together exactly the capacity
   of its tokens: as many of full length as fit, and the remainder as a sum of
   powers of two, which need no padding.

Groups are independent, so a lost executor costs only its groups.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docrel.llm.common import fresh, slices
from docrel.llm.tokens import WordTokens, default_path

SEQUENCE = 2048
END_ID = 1
#: Cost of n tokens of one document: LINEAR * n + QUADRATIC * n * n.
LINEAR, QUADRATIC = 1.0, 1.0 / 1024
GROUP_DOCS = 1024
#: Copies of a row in one task that stay together, and whole pieces of a document that may.
SAME_GROUP = 4
WHOLE_GROUP = 64
#: Distinct rows of a task whose copies are counted at once.
MET = 500_000
#: A sequence's id: its group, and its place there in so many low bits.
PLACE_BITS = 22

PIECE_FIELDS = ("start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
                "offset long")


def cost(n, linear: float = LINEAR, quadratic: float = QUADRATIC):
    return linear * n + quadratic * n * n


def assign(lengths: list[int], sequence: int = SEQUENCE, linear: float = LINEAR,
           quadratic: float = QUADRATIC) -> tuple[list[tuple[int, int, int, int]], list[int]]:
    """Place documents of under ``sequence`` tokens each.

    Gives (document, start, length, sequence) for every piece, and the capacities
    of the sequences, all of which are filled.
    """
    total = sum(lengths)
    capacity = [sequence] * (total // sequence)
    capacity += [1 << b for b in range(total.bit_length() - 1, -1, -1)
                 if (total % sequence) >> b & 1]
    room, spent = np.array(capacity, np.int64), np.zeros(len(capacity))
    placed, rest = [], []

    def put(d: int, start: int, n: int, s: int) -> None:
        placed.append((d, start, n, s))
        room[s] -= n
        spent[s] += cost(n, linear, quadratic)

    for d in sorted(range(len(lengths)), key=lambda d: (-lengths[d], d)):
        fits = room >= lengths[d]
        if fits.any():
            put(d, 0, lengths[d], int(np.where(fits, spent, np.inf).argmin()))
        else:
            rest.append(d)
    for d in rest:
        at = 0
        while at < lengths[d]:
            s = int(np.where(room > 0, spent, np.inf).argmin())
            n = min(int(room[s]), lengths[d] - at)
            put(d, at, n, s)
            at += n
    return placed, capacity


def pieces(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
           path: str | None = None, end_id: int = END_ID, sequence: int = SEQUENCE,
           linear: float = LINEAR, quadratic: float = QUADRATIC,
           group_docs: int = GROUP_DOCS) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are its text's token ids and then ``end_id``; each lies in
    exactly one piece.  A null or empty text is the one id ``end_id``.  Null ids
    and repeated rows are packed like any others; where a task meets more than
    ``SAME_GROUP`` copies of a row, their packing depends on the table's partitions,
    so ``df`` should be a stored table, whose partitions come back as they were.  Empty table: no rows.  Other
    columns are ignored.
    """
    path = path or default_path()
    docs = df.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    groups = max(1, -(-df.count() // group_docs))
    id_ddl = f"`{id_col}` {docs.schema[0].dataType.simpleString()}"
    group_name, copy_name = fresh(docs, "pack_group"), fresh(docs, "pack_copy")
    end, bytes_each = struct.pack("<I", end_id), 4 * sequence

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordTokens(path)
        met: dict[int, int] = {}
        for b in slices(batches):
            doc, start, length, crcs, tokens, copies, rest = [], [], [], [], [], [], []
            for i, text in enumerate(b.column(1)):
                raw = words.raw(text.as_py()) + end
                n, first = len(raw) // 4, None
                for at in range(0, n, sequence):
                    part = raw[4 * at:4 * at + bytes_each]
                    sum_ = zlib.crc32(part)
                    if first is None:
                        if len(met) > MET:
                            met.clear()
                        first = zlib.crc32(str(b.column(0)[i]).encode(), n) << 32 | sum_
                        met[first] = copy = met.get(first, -1) + 1
                    doc.append(i)
                    start.append(at)
                    length.append(len(part) // 4)
                    crcs.append(sum_)
                    tokens.append(n)
                    copies.append(max(0, copy - SAME_GROUP + 1))
                    rest.append(part if len(part) < bytes_each else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(doc, pa.int64())), *(pa.array(x, pa.int64()) for x in
                 (start, length, crcs, tokens, copies)), pa.array(rest, pa.binary())],
                names=[id_col, "start", "length", "ids_crc32", "doc_tokens", copy_name, "ids"])

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        # an order of the rows that does not depend on how they arrived
        table = table.sort_by([("length", "descending"), (id_col, "ascending"),
                               ("start", "ascending"), ("ids_crc32", "ascending")])
        start, length = table["start"].to_pylist(), table["length"].to_pylist()
        crcs, ids = table["ids_crc32"].to_pylist(), table["ids"]
        whole = sum(n == sequence for n in length)
        placed, _ = assign(length[whole:], sequence, linear, quadratic)
        row = list(range(whole)) + [whole + d for d, *_ in placed]
        at = [0] * whole + [x[1] for x in placed]
        size = [sequence] * whole + [x[2] for x in placed]
        seq = list(range(whole)) + [whole + x[3] for x in placed]
        fill: dict[int, int] = {}
        offset, sums = [], []
        for r, a, n, s in zip(row, at, size, seq):
            offset.append(fill.get(s, 0))
            fill[s] = offset[-1] + n
            part = crcs[r]
            if n != length[r]:
                part = zlib.crc32(memoryview(ids[r].as_py())[4 * a:4 * (a + n)])
            sums.append(part)
        base = key[0].as_py() << PLACE_BITS
        take = pa.array(row, pa.int64())
        longs = [[start[r] + a for r, a in zip(row, at)], size, sums,
                 table["doc_tokens"].take(take).to_pylist(), [base + s for s in seq], offset]
        return pa.Table.from_arrays(
            [table[id_col].take(take), *(pa.array(x, pa.int64()) for x in longs)],
            names=[id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    cuts = docs.mapInArrow(cut, f"{id_ddl}, start long, length long, ids_crc32 long, "
                                f"doc_tokens long, `{copy_name}` long, ids binary")
    # the task and the copy's number there, for copies beyond the first few
    salt = F.when(F.col(copy_name) > 0, F.xxhash64(F.spark_partition_id(), copy_name)).otherwise(0)
    dealt = F.pmod(F.xxhash64(id_col, "start", "ids_crc32", salt), F.lit(groups)).cast("long")
    apart = (1 + F.floor(F.col("start") / (WHOLE_GROUP * sequence))).cast("long") * F.lit(groups)
    dealt = F.when(F.col("length") == sequence, dealt + apart).otherwise(dealt)
    return cuts.withColumn(group_name, dealt).drop(copy_name) \
               .groupBy(group_name).applyInArrow(pack, f"{id_ddl}, {PIECE_FIELDS}")
