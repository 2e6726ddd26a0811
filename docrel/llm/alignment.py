"""Cross-tokenizer alignment: which tokens of two vocabularies stand for the same bytes.

A text is cut by two tokenizers.  Byte offsets at which tokens of both end cut it into
groups, and every token of one in a group is linked to every token of the other.

1. Each text's ids are stored, two bytes a token, so it is tokenised once.
2. First pass: each task aligns its texts and keeps, for the distinct (A, B) id pairs,
   in how many of its texts they are linked.
3. A minimal perfect hash of all distinct pairs is made bucket by bucket; the tasks'
   counts become dense vectors by its index, which are summed in a tree of tasks.
4. Second pass: texts are aligned anew and their links looked up: hash, stored key held
   against the pair, count.  The table is sent to the tasks in slices of at most
   ``SLICE_KEYS`` pairs; with more pairs the ids are read once a slice and the sums,
   which add up over pairs, are carried on.

Texts are aligned many at once: as both tokenizers give all bytes of a text, their end
offsets can run on over the texts of a batch.

Neither tokenizer joins what stands before a space or line break to what follows (for
the vocabularies this is tested on loading), so texts are cut there into units, and a
task tokenises each distinct unit once while its cache holds it.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docrel.llm import pair_hash
from docrel.llm.common import slices, stored, text_of

#: The cache starts anew when it holds so many units or characters of units.
MAX_UNITS = 400_000
MAX_CHARS = 16 << 20
#: Bytes of ids of texts that are aligned at once (a longer text by itself), and links at once.
BATCH_BYTES = 600_000
_LINKS = 1 << 20
#: Pairs that a task holds before it counts and emits them.
HELD_PAIRS = 2_000_000
#: Pairs of the table that are sent to the tasks at once (17 bytes each).
SLICE_KEYS = 4_000_000
#: Groups with more links than this are counted by their distinct ids.
_SMALL = 4096

# How byte-level BPE cuts a text before merging.  (Fixed value: the tokenizer's own pattern.)
_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

#: What surely is no white space: letters, digits and ASCII punctuation.
_SOLID = r"\w!-/:-@\[-`{-~"
_ODD = re.compile(rf"[^{_SOLID}][ \n]|\0")
_CUT = re.compile(rf"(?<=[{_SOLID}])(?=[ \n])")


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _byte_level(path: str):
    """(encode, bytes by id) of a byte-level BPE file; special tokens are plain text."""
    import tiktoken

    from docrel.llm.tokens import _byte_letters

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    byte = {c: i for i, c in enumerate(_byte_letters())}
    raw = {i: bytes(byte[c] for c in piece) for piece, i in model["vocab"].items() if all(c in byte for c in piece)}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    if [model["vocab"]["".join(m)] for m in merges] != list(range(256, 256 + len(merges))):
        raise ValueError(f"{path}: ids are not in the order of merges")
    ranks = {piece: i for i, piece in raw.items() if i < 256 + len(merges)}
    return tiktoken.Encoding(path, pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary, raw


def _pieces(path: str):
    """(processor, bytes by id, whether no piece spans a space or line break)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    raw, apart = {}, True
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            raw[i] = bytes([int(piece[3:5], 16)])
        else:
            raw[i] = piece.replace("▁", " ").encode()
            apart &= "▁" not in piece.lstrip("▁") and "\n" not in piece
    return sp, raw, apart


class Tokens:
    """Ids of texts by two tokenizer files; use one per task."""

    def __init__(self, a_path: str, b_path: str):
        self.encode_a, self.raw_a = _byte_level(a_path)
        self.sp, self.raw_b, self.apart = _pieces(b_path)
        self.space = self.sp.piece_to_id("▁")
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.chars = 0
        self.bad: set[int] = set()
        self.flat = [np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.uint32)]
        self.ends = [np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)]  # ends[i]: where unit i - 1 ends

    def units(self, text: str) -> list[str]:
        """The parts of " " + text that both tokenizers cut apart."""
        body = " " + text
        if not self.apart:
            return [body]
        if _ODD.search(body):
            return _CUT.split(body)
        return body.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")[1:]

    def _encode_b(self, units: list[str]) -> list[list[int]]:
        # the processor puts a space before: the unit's own, or one that is taken off again
        ids = self.sp.encode([u[1:] if u[0] == " " else u for u in units], num_threads=1)
        return [x[1:] if u[0] != " " else x or [self.space] for u, x in zip(units, ids)]

    def _learn(self, new: list[str]) -> None:
        at = len(self.known)
        self.known.update(zip(new, range(at, at + len(new))))
        encode, raw_a, raw_b = self.encode_a, self.raw_a, self.raw_b
        ids_a, ids_b = [encode(u) for u in new], self._encode_b(new)
        for i, (u, a, b) in enumerate(zip(new, ids_a, ids_b), at):
            raw = u.encode()
            if b"".join([raw_b[x] for x in b]) != raw or b"".join([raw_a[x] for x in a]) != raw:
                self.bad.add(i)
        self.chars += sum(map(len, new))
        for side, ids in enumerate((ids_a, ids_b)):
            start = int(self.ends[side][at])
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            ends = start + np.cumsum(sizes)
            while at + len(ids) >= len(self.ends[side]):
                self.ends[side] = np.concatenate((self.ends[side], np.zeros_like(self.ends[side])))
            while ends[-1] > len(self.flat[side]):
                self.flat[side] = np.concatenate((self.flat[side], np.zeros_like(self.flat[side])))
            self.ends[side][at + 1:at + 1 + len(ids)] = ends
            self.flat[side][start:ends[-1]] = np.fromiter(chain.from_iterable(ids), np.uint32, int(ends[-1]) - start)

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids by A and by B; None if the text has no tokens."""
        if not text:
            return None
        if len(self.known) > MAX_UNITS or self.chars > MAX_CHARS:
            self._clear()
        units, known = self.units(text), self.known
        new = [u for u in dict.fromkeys(units) if u not in known]
        if new:
            self._learn(new)
        at = np.fromiter(map(known.__getitem__, units), np.int64, len(units))
        if self.bad and not self.bad.isdisjoint(at.tolist()):
            return None
        out = []
        for flat, ends in zip(self.flat, self.ends):
            first = ends[at]
            size = ends[at + 1] - first
            stops = np.cumsum(size)
            out.append(flat[np.repeat(first - stops + size, size) + np.arange(int(stops[-1]))])
        return out[0], out[1]


class Vocabularies:
    """What alignments need to know of two vocabularies: bytes and names of ids."""

    def __init__(self, a_path: str, b_path: str):
        _, raw_a = _byte_level(a_path)
        _, raw_b, _ = _pieces(b_path)
        self.n_b = max(raw_b) + 1
        self.width_a, self.width_b = self._widths(raw_a), self._widths(raw_b)
        # "a," and "a|" for every A id, "b," and "b;" for every B id
        self.names = [f"{i}{end}" for i in range(len(self.width_a)) for end in ",|"] \
            + [f"{i}{end}" for i in range(len(self.width_b)) for end in ",;"]

    @staticmethod
    def _widths(raw: dict[int, bytes]) -> np.ndarray:
        out = np.zeros(max(raw) + 1, np.int64)
        out[list(raw)] = [len(x) for x in raw.values()]
        return out


class Alignment:
    """The groups of a batch of texts; ids of all texts one after another, the texts'
    tokens from ``first[i]`` to ``first[i + 1]``."""

    def __init__(self, of: Vocabularies, a: np.ndarray, b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray):
        self.of, self.a, self.b = of, a.astype(np.int64), b.astype(np.int64)
        self.n_a, self.n_b = np.diff(first_a), np.diff(first_b)
        end_a, end_b = np.cumsum(of.width_a[self.a]), np.cumsum(of.width_b[self.b])
        ends = np.zeros(int(end_a[-1]) + 1 if len(end_a) else 1, bool)
        ends[end_b] = True
        self.last_a = ends[end_a]
        ends[:] = False
        ends[end_a] = True
        self.last_b = ends[end_b]
        stop_a, stop_b = np.flatnonzero(self.last_a) + 1, np.flatnonzero(self.last_b) + 1
        self.size_a, self.size_b = np.diff(stop_a, prepend=0), np.diff(stop_b, prepend=0)
        self.start_a, self.start_b = stop_a - self.size_a, stop_b - self.size_b
        self.first = np.searchsorted(stop_a, first_a, "right")  # the texts' groups
        self.n_groups = np.diff(self.first)
        self.group_links = self.size_a * self.size_b
        self.n_links = self.by_text(self.group_links)

    def by_text(self, of_groups: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(of_groups)))
        return sums[self.first[1:]] - sums[self.first[:-1]]

    def links(self) -> Iterator[tuple[np.ndarray, np.ndarray | int, np.ndarray]]:
        """(pair, times, text) of all links, in parts; a large group's links by distinct pair."""
        text = np.repeat(np.arange(len(self.n_groups)), self.n_groups)
        n_b = self.of.n_b
        large = np.flatnonzero(self.group_links > _SMALL)
        for g in large.tolist():
            a = self.a[self.start_a[g]:self.start_a[g] + self.size_a[g]]
            b = self.b[self.start_b[g]:self.start_b[g] + self.size_b[g]]
            (a, times_a), (b, times_b) = np.unique(a, return_counts=True), np.unique(b, return_counts=True)
            step = max(1, _LINKS // len(b))
            for i in range(0, len(a), step):
                pairs = (a[i:i + step, None] * n_b + b).ravel()
                yield pairs, (times_a[i:i + step, None] * times_b).ravel(), np.full(len(pairs), text[g])
        small = np.flatnonzero(self.group_links <= _SMALL)
        upto = np.cumsum(self.group_links[small])
        at = 0
        while at < len(small):
            done = int(np.searchsorted(upto, (upto[at - 1] if at else 0) + _LINKS, "right"))
            own = small[at:max(done, at + 1)]
            at += len(own)
            size, wide = self.group_links[own], self.size_b[own]
            stops = np.cumsum(size)
            place = np.arange(int(stops[-1])) - np.repeat(stops - size, size)
            row, col = np.divmod(place, np.repeat(wide, size))
            yield (self.a[np.repeat(self.start_a[own], size) + row] * n_b
                   + self.b[np.repeat(self.start_b[own], size) + col], 1, np.repeat(text[own], size))

    def distinct(self) -> np.ndarray:
        """The pairs that are linked in a text, once for each such text."""
        shift = 40  # pairs are below 2 ** 40, texts of a batch below 2 ** 23
        keys = [np.unique(text << shift | pair) for pair, _, text in self.links()]
        return np.unique(np.concatenate(keys)) & ((1 << shift) - 1) if keys else np.zeros(0, np.int64)

    def named(self) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of every text."""
        group_a = np.cumsum(self.last_a) - self.last_a
        group_b = np.cumsum(self.last_b) - self.last_b
        codes = np.zeros(len(self.a) + len(self.b), np.int64)
        codes[np.arange(len(self.a)) + self.start_b[group_a]] = 2 * self.a + self.last_a
        codes[np.arange(len(self.b)) + (self.start_a + self.size_a)[group_b]] = \
            2 * (len(self.of.width_a) + self.b) + self.last_b
        ends = np.concatenate(([0], np.cumsum(self.n_a + self.n_b))).tolist()
        name = self.of.names.__getitem__
        return ["".join(map(name, codes[i:j].tolist()))[:-1] for i, j in zip(ends, ends[1:])]


def _batches(batches: Iterator[pa.RecordBatch], of: Vocabularies, a_at: int, kinds) -> Iterator:
    """(rows, alignment) of batches with columns of ids at ``a_at`` and after."""
    for b in batches:
        if not len(b):
            continue
        size = pc.fill_null(pc.binary_length(b.column(a_at)), 0).to_numpy().astype(np.int64)
        upto, at = np.cumsum(size), 0
        while at < len(b):
            done = int(np.searchsorted(upto, (upto[at - 1] if at else 0) + BATCH_BYTES, "right"))
            rows = b.slice(at, max(done, at + 1) - at)
            at += len(rows)
            ids, first = [], []
            for k, kind in enumerate(kinds):
                parts = [x.as_buffer() for x in rows.column(a_at + k)]
                ids.append(np.concatenate([np.frombuffer(x, kind) if x is not None else np.zeros(0, kind) for x in parts]))
                n = [0 if x is None else len(x) // np.dtype(kind).itemsize for x in parts]
                first.append(np.concatenate(([0], np.cumsum(n, dtype=np.int64))))
            yield rows, Alignment(of, *ids, *first)


class PairCounts:
    """Counts of some buckets' pairs by perfect hash, and each A id's highest count."""

    def __init__(self, rows: list, best: dict[int, int], n_b: int):
        rows = sorted(rows, key=lambda r: r["bucket"])
        self.hashed = pair_hash.PerfectHash([(r["bucket"], r["sizes"], np.frombuffer(r["words"], "<u8")) for r in rows])
        self.keys = np.concatenate([np.frombuffer(r["keys"], "<i8") for r in rows] or [np.zeros(0, np.int64)])
        self.counts = np.concatenate([pair_hash.widened(r["counts"]) for r in rows] or [np.zeros(0, np.int64)])
        self.counts = self.counts.astype(np.min_scalar_type(int(self.counts.max(initial=0))))
        self.top = np.zeros(max(best, default=0) + 1, np.int64)
        self.top[list(best)] = list(best.values())
        self.n_b = n_b

    def __call__(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count, whether it is the A id's highest) of pairs; zeros for pairs of other buckets."""
        at = self.hashed.index(pairs)
        hit = np.flatnonzero(at >= 0)
        hit = hit[self.keys[at[hit]] == pairs[hit]]
        count, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
        count[hit] = self.counts[at[hit]]
        best[hit] = count[hit] == self.top[pairs[hit] // self.n_b]
        return count, best


def _kinds(paths: tuple[str, str]) -> list[str]:
    """How ids are stored: two bytes where the vocabularies are small enough."""
    _, raw_a = _byte_level(paths[0])
    return ["<u2" if max(raw) < 1 << 16 else "<u4" for raw in (raw_a, _pieces(paths[1])[1])]


def token_ids(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
              paths: tuple[str, str] | None = None) -> DataFrame:
    """(own, a, b), stored: each row's id and its text's ids by A and by B as little-endian
    numbers (two bytes, or four for a vocabulary over 65,536); NULL where it has no tokens."""
    paths = paths or default_paths()
    kinds = _kinds(paths)
    src = df.select(F.col(id_col).alias("own"), text_of(text_col).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(*paths)
        for b in slices(batches):
            ids = [tokens.of(x.as_py()) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array([None if x is None else x[k].astype(kind).tobytes() for x in ids], pa.binary())
                                for k, kind in enumerate(kinds))], names=["own", "a", "b"])

    return stored(src.mapInArrow(run, f"own {src.schema['own'].dataType.simpleString()}, a binary, b binary"), "token_ids")


def _chunks(ids: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """(bucket, part, keys, counts): a task's distinct pairs and in how many texts they are."""
    kinds = _kinds(paths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        of = Vocabularies(*paths)
        held, n = [], 0

        def out():
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            bucket = pair_hash.bucket_of(keys)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
            own = [order[i:j] for i, j in zip(cuts, cuts[1:])]
            return pa.RecordBatch.from_arrays(
                [pa.array([bucket[o[0]] for o in own], pa.int32()), pa.array([part] * len(own), pa.int64()),
                 pa.array([pair_hash.narrow(keys[o]) for o in own], pa.binary()),
                 pa.array([pair_hash.narrow(counts[o]) for o in own], pa.binary())],
                names=["bucket", "part", "keys", "counts"])

        for _, texts in _batches(batches, of, 0, kinds):
            held.append(texts.distinct())
            n += len(held[-1])
            if n >= HELD_PAIRS:
                yield out()
                held, n = [], 0
        if n:
            yield out()

    return ids.select("a", "b").mapInArrow(run, "bucket int, part long, keys binary, counts binary")


def pair_counts(ids: DataFrame, *, paths: tuple[str, str] | None = None, slice_keys: int = SLICE_KEYS) -> DataFrame:
    """The stored table of all linked pairs of :func:`token_ids` by perfect hash: (bucket,
    n, sizes, words, keys, counts); a key is ``a * size of B's vocabulary + b``, its count
    the number of texts that hold it linked."""
    return pair_hash.table(_chunks(ids, paths or default_paths()), slice_keys)


def pairs(counts: DataFrame, n_b: int) -> DataFrame:
    """(a, b, docs): the rows of :func:`pair_counts` as one row a pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for keys, docs in zip(b.column(0), b.column(1)):
                key = np.frombuffer(keys.as_py(), "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(key // n_b), pa.array(key % n_b),
                                                  pa.array(pair_hash.widened(docs.as_py()))], names=["a", "b", "docs"])

    return counts.select("keys", "counts").mapInArrow(run, "a long, b long, docs long")


def _highest(counts: DataFrame, n_b: int) -> dict[int, int]:
    """The highest count of each A id: at most as many numbers as A's vocabulary has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for keys, docs in zip(b.column(0), b.column(1)):
                a = np.frombuffer(keys.as_py(), "<i8") // n_b
                top = np.zeros(int(a.max(initial=0)) + 1, np.int64)
                np.maximum.at(top, a, pair_hash.widened(docs.as_py()))
                own = np.flatnonzero(top)
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(top[own])], names=["a", "top"])

    tops = counts.select("keys", "counts").mapInArrow(run, "a long, top long")
    return dict(tops.groupBy("a").agg(F.max("top")).collect())


_LONGS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
           paths: tuple[str, str] | None = None, slice_keys: int = SLICE_KEYS) -> DataFrame:
    """One row per row of ``df``: id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256.

    Null and empty texts, and texts whose tokens do not join to the text's bytes, have
    no tokens: zeros and an empty string.  Null ids and repeated rows are rows like
    others (and count in every pair's texts).  Empty table: no rows.  Other columns are
    ignored.
    """
    paths = paths or default_paths()
    ids = token_ids(df, id_col, text_col, paths=paths)
    counts = pair_counts(ids, paths=paths, slice_keys=slice_keys)
    n_b = max(_pieces(paths[1])[1]) + 1
    best = _highest(counts, n_b)
    none = F.lit(0).cast("long")
    rows = ids.select("own", none.alias("best"), none.alias("sum"), "a", "b")
    runs = pair_hash.slices_of(counts, slice_keys) or [[]]
    for buckets in runs[:-1]:  # more pairs than one slice holds: the sums are carried on
        rows = stored(_looked_up(rows, _slice(counts, buckets, best, n_b), paths, False), "partial_sums")
    return _looked_up(rows, _slice(counts, runs[-1], best, n_b), paths, True).withColumnRenamed("own", id_col)


def _slice(counts: DataFrame, buckets: list[int], best: dict[int, int], n_b: int) -> PairCounts:
    """At most ``SLICE_KEYS`` pairs (or one bucket's) for the tasks."""
    return PairCounts(counts.filter(F.col("bucket").isin(buckets)).collect() if buckets else [], best, n_b)


def _looked_up(rows: DataFrame, lookup: PairCounts, paths: tuple[str, str], last: bool) -> DataFrame:
    """The rows with the sums of one slice's pairs added; at the last slice the report."""
    sent = rows.sparkSession.sparkContext.broadcast(lookup)
    kinds, own = _kinds(paths), rows.schema["own"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, known = Vocabularies(*paths), sent.value
        for b, texts in _batches(batches, of, 3, kinds):
            best, total = b.column(1).to_numpy().copy(), b.column(2).to_numpy().copy()
            for pair, times, text in texts.links():
                count, highest = known(pair)
                np.add.at(best, text, times * highest)
                np.add.at(total, text, times * count)
            if not last:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(best), pa.array(total), b.column(3), b.column(4)],
                                                 names=["own", "best", "sum", "a", "b"])
                continue
            shas = [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in texts.named()]
            facts = (texts.n_a, texts.n_b, texts.n_groups, texts.n_links, best, total)
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, facts), pa.array(shas, pa.string())],
                                             names=["own", *_LONGS, "groups_sha256"])

    return rows.mapInArrow(run, f"own {own}, " + (", ".join(f"{c} long" for c in _LONGS) + ", groups_sha256 string"
                                                  if last else "best long, sum long, a binary, b binary"))


__all__ = ["Alignment", "PairCounts", "Tokens", "Vocabularies", "pair_counts", "pairs", "report", "token_ids"]
