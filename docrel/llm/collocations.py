"""Phrase collocation mining with weighted acyclic automata.

Phrases of ``MIN_WORDS`` to ``MAX_WORDS`` words are scored by how often they occur
against their parts.  Everything is counted by language.

1. Each task counts all n-grams of its share of the words in sorted order and makes
   count transducers of them (``transducers.py``), one for each prefix range that it meets.
2. The transducers of a prefix range are united, their weights summed, and phrases that
   are too rare are left out: the counts of the whole corpus, range by range.
3. The parts of each candidate lie in other ranges.  A range asks for them by automata
   of parts, weighted with the count of the longest phrase around them; their owners
   compose these with their counts and send the result back.  So every word or phrase
   is asked for once a range, however many candidates hold it.
4. Each range scores its candidates and drops those inside a longer one; the best of
   all ranges are ranked.

The bounds of the ranges are quantiles of phrases taken at equal distances from all
texts.  They balance the work and do not show in the result: a range may begin inside
the phrases of one word, so a frequent first word is many ranges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docrel.llm import transducers as tr
from docrel.llm.common import stored, text_of
from docrel.operators.grouping import top_k_per_group

MIN_WORDS, MAX_WORDS = 2, 3
LEAST = 10
#: A candidate goes where a longer one around it has this share of its count, in percent.
INSIDE = 50
BEST = 2000
SCALE = 1_000_000
NO_LANGUAGE = "und"

#: Words and piece ends that a task counts at once, below 2 ** _BITS.
SHARD_WORDS = 1 << 21
_BITS = 21
#: Bytes of text for one range, ranges at most, and phrases taken for each bound.
RANGE_BYTES = 4 << 20
MAX_RANGES = 1_000_000
PER_BOUND = 4
#: Bytes of a text that are looked at for one such phrase.
_LOOK = 512
_ASK_BITS = 31

_END = b"\xff"  # in no UTF-8 text
_FOLD = bytes(0xFF if x in b".,;:!?\n\x0b\x0c\r" else x + 32 if 65 <= x <= 90 else x for x in range(256))

_PARTS = ("words", "sizes", "label", "weight", "target")
_ROW = "lang string, part int, kind int, source int, n long, " + ", ".join(f"{c} binary" for c in _PARTS)


def tokens(text: bytes) -> list[bytes]:
    """The words of a UTF-8 text, A to Z in lower case, and ``_END`` where a piece ends."""
    return text.translate(_FOLD).replace(_END, b" \xff ").split()


def _rows(rows: list[tuple]) -> pa.Table:
    """A table of (lang, part, kind, source, n, transducer)."""
    cols = list(zip(*[(*r[:5], *r[5].packed()) for r in rows])) or [[]] * 10
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 5]
    return pa.table([pa.array(list(c), k) for c, k in zip(cols, kinds)],
                    names=["lang", "part", "kind", "source", "n", *_PARTS])


def _transducer(row: dict) -> tr.Transducer:
    return tr.Transducer.unpacked(*(row[c] for c in _PARTS))


class _Shard:
    """The words of one language that a task holds, and their count transducers."""

    def __init__(self):
        self.known: dict[bytes, int] = {_END: 0}
        self.parts: list[np.ndarray] = []
        self.n = 0

    def add(self, found: list[bytes]) -> None:
        known = self.known
        for w in found:
            if w not in known:
                known[w] = len(known)
        self.parts.append(np.fromiter(map(known.__getitem__, found), np.int32, len(found)))
        self.n += len(found)

    def transducers(self, bounds, last: bool) -> list[tuple[int, tr.Transducer]]:
        """(range, transducer) of all n-grams that start here.  If the words go on, the
        last two, whose n-grams are not whole yet, stay."""
        ids = np.concatenate(self.parts) if self.parts else np.zeros(0, np.int32)
        words = list(self.known)
        rest = [] if last else [words[i] for i in ids[-(MAX_WORDS - 1):].tolist()]
        starts = len(ids) - len(rest)
        ranked = sorted(words[1:])
        number = {w: i for i, w in enumerate(ranked, 1)}
        rank = np.fromiter((number.get(w, 0) for w in words), np.int64, len(words))
        at = np.concatenate((rank[ids], np.zeros(MAX_WORDS, np.int64)))
        grams, key, open_ = [], np.zeros(starts, np.int64), np.ones(starts, bool)
        for d in range(MAX_WORDS):
            here = at[d:d + starts]
            open_ &= here > 0
            key = key | here << (_BITS * (MAX_WORDS - 1 - d))
            grams.append(key[open_])
        keys, counts = np.unique(np.concatenate(grams), return_counts=True)
        self.__init__()
        if rest:
            self.add(rest)
        cut = [0, *tr.cuts(ranked, keys, bounds, _BITS, MAX_WORDS).tolist(), len(keys)]
        return [(p, tr.build(ranked, tr.levels_of(keys[i:j], counts[i:j], _BITS, MAX_WORDS)))
                for p, (i, j) in enumerate(zip(cut, cut[1:])) if i < j]


def bounds_of(rows: DataFrame, n_ranges: int | None = None) -> dict[str, list[tuple[bytes, ...]]]:
    """The inner bounds of the prefix ranges of each language of (lang, body)."""
    spark = rows.sparkSession
    size = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    n_ranges = n_ranges or min(MAX_RANGES, max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // RANGE_BYTES))
    step = max(1, size // (n_ranges * PER_BOUND))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = step // 2
        for b in batches:
            lang, phrase = [], []
            for name, x in zip(b.column(0).to_pylist(), b.column(1)):
                raw = x.as_py().encode() if left < len(x.as_buffer()) else None
                n = len(x.as_buffer())
                while left < n:
                    start = max(0, min(left, n - _LOOK))
                    found = tokens(raw[start:start + _LOOK])[1:1 + MAX_WORDS]
                    if _END in found:
                        found = found[:found.index(_END)]
                    if found:
                        lang.append(name)
                        phrase.append(found)
                    left += step
                left -= n
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(phrase, pa.list_(pa.binary()))],
                                             names=["lang", "phrase"])

    got: dict[str, list] = {}
    for r in rows.mapInArrow(take, "lang string, phrase array<binary>").collect():  # n_ranges * PER_BOUND rows
        got.setdefault(r["lang"], []).append(tuple(bytes(w) for w in r["phrase"]))
    total = sum(map(len, got.values()))
    out = {}
    for name, phrases in got.items():
        phrases.sort()
        own = max(1, round(n_ranges * len(phrases) / total))
        out[name] = sorted({phrases[i * len(phrases) // own] for i in range(1, own)})
    return out


def _counted(rows: DataFrame, bounds: dict, shard_words: int) -> DataFrame:
    """Count transducers of shards, by range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards: dict[str, _Shard] = {}

        def out(last: bool):
            made = [(name, p, 0, 0, 0, t) for name, s in shards.items()
                    for p, t in s.transducers(bounds.get(name, []), last)]
            return _rows(made).to_batches()

        held = 0
        for b in batches:
            for name, x in zip(b.column(0).to_pylist(), b.column(1)):
                found = tokens(x.as_py().encode())
                found.append(_END)
                shard = shards.setdefault(name, _Shard())
                for i in range(0, len(found), shard_words):
                    part = found[i:i + shard_words]
                    if held + len(part) > shard_words:
                        yield from out(False)
                        held = sum(s.n for s in shards.values())
                    shard.add(part)
                    held += len(part)
        yield from out(True)

    return rows.mapInArrow(run, _ROW)


def _grouped(rows: DataFrame, work) -> DataFrame:
    """``work(lang, part, rows)`` of every range, a list of rows as in ``_rows``."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        return _rows(work(key[0].as_py(), key[1].as_py(), table.to_pylist()))

    return rows.groupBy("lang", "part").applyInArrow(run, _ROW)


def ranges(df: DataFrame, text_col: str = "text", lang_col: str = "lang", *, least: int = LEAST,
           n_ranges: int | None = None, shard_words: int = SHARD_WORDS) -> tuple[DataFrame, dict]:
    """The stored count transducers of all prefix ranges, and the ranges' bounds.

    A row holds the phrases of its range with at least ``least`` occurrences, and in
    ``n`` the number of word occurrences whose word is of the range.
    """
    rows = df.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
                     text_of(f"`{text_col}`").alias("body"))
    bounds = bounds_of(rows, n_ranges)

    def unite(lang, part, pieces):
        words, levels = tr.union([_transducer(p) for p in pieces])
        n = int(levels[0][2].sum()) if levels else 0
        return [(lang, part, 0, 0, n, tr.build(words, tr.pruned(levels, least)))]

    return stored(_grouped(_counted(rows, bounds, shard_words), unite), "ranges"), bounds


def _unfolded(t: tr.Transducer) -> tr.Levels:
    return tr.union([t])[1]


def _phrases(levels: tr.Levels, least: int):
    """Word numbers and counts of the candidates of 2 and of 3 words, shape (n, words)."""
    empty = np.zeros(0, np.int64)
    (_, one, _), (up2, two, w2), (up3, three, w3) = [*levels, *[(empty,) * 3] * (3 - len(levels))]
    pair = np.stack([one[up2], two], axis=1) if len(up2) else np.zeros((0, 2), np.int64)
    triple = np.concatenate([pair[up3], three[:, None]], axis=1) if len(up3) else np.zeros((0, 3), np.int64)
    return (pair[w2 >= least], w2[w2 >= least]), (triple[w3 >= least], w3[w3 >= least])


def _key(words: np.ndarray) -> np.ndarray:
    """Packed keys of phrases of one or two words."""
    second = words[:, 1] + 1 if words.shape[1] > 1 else 0
    return (words[:, 0] + 1) << _ASK_BITS | second


def _asked(counts: DataFrame, bounds: dict, least: int) -> DataFrame:
    """Automata of the parts of each range's candidates, for the parts' owners; the
    weight of a part is the highest count of a candidate one word longer around it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                t = _transducer(row)
                (two, _), (three, n3) = _phrases(_unfolded(t), least)
                none = np.zeros(2 * len(two) + 2 * len(three), np.int64)
                keys = np.concatenate([_key(x) for x in (two[:, :1], two[:, 1:], three[:, :1], three[:, 2:],
                                                         three[:, :2], three[:, 1:])])
                around = np.concatenate([none, n3, n3])
                order = np.argsort(keys, kind="stable")
                keys, around = keys[order], around[order]
                if not len(keys):
                    continue
                new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
                keys, around = keys[new], np.maximum.reduceat(around, new)
                cut = [0, *tr.cuts(t.words, keys, bounds.get(row["lang"], []), _ASK_BITS, 2).tolist(), len(keys)]
                yield from _rows([
                    (row["lang"], p, 1, row["part"], 0,
                     tr.build(t.words, tr.levels_of(keys[i:j], around[i:j], _ASK_BITS, 2)))
                    for p, (i, j) in enumerate(zip(cut, cut[1:])) if i < j]).to_batches()

    return counts.mapInArrow(run, _ROW)


def _answered(lang, part, rows):
    """An owner's answers: the asked parts with their counts, to those who asked, and
    the asked parts with their highest weight, to itself."""
    asks = [(r["source"], _transducer(r)) for r in rows if r["kind"] == 1]
    own = [_transducer(r) for r in rows if r["kind"] == 0]
    if not asks or not own:
        return []
    out = []
    for source, t in asks:
        words, levels = tr.union([t])
        out.append((lang, source, 2, part, 0, tr.build(words, tr.compose(words, levels, own[0]))))
    words, levels = tr.union([t for _, t in asks], np.maximum)
    return [*out, (lang, part, 3, part, 0, tr.build(words, levels))]


def _lookup(parts: list[tr.Transducer], words: list[bytes]):
    """Weights of phrases of one or two of ``words`` by transducers; of more than one the highest."""
    keys, weights = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if parts:
        own, levels = tr.union(parts, np.maximum)
        number = {w: i for i, w in enumerate(words)}
        to = np.array([number.get(w, -1) for w in own], np.int64)
        found = []
        for d, (parent, label, weight) in enumerate(levels):
            named = to[label][:, None] if d == 0 else np.stack([to[levels[0][1]][parent], to[label]], axis=1)
            held = (named >= 0).all(axis=1)
            found.append((_key(named[held]), weight[held]))
        keys, weights = map(np.concatenate, zip(*found)) if found else (keys, weights)
        order = np.argsort(keys)
        keys, weights = keys[order], weights[order]

    def of(phrases: np.ndarray) -> np.ndarray:
        key = _key(phrases)
        at = np.searchsorted(keys, key)
        at[at == len(keys)] = 0
        return np.where(keys[at] == key, weights[at], 0) if len(keys) else np.zeros(len(key), np.int64)

    return of


def scores(a: np.ndarray, l: np.ndarray, r: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * a * a / (l * r)), exactly."""
    if len(a) and (int(a.max()) ** 2 * scale >= 1 << 63 or int(l.max()) * int(r.max()) >= 1 << 63):
        a, l, r = a.astype(object), l.astype(object), r.astype(object)
    return (scale * a * a // (l * r)).astype(np.int64)


def _scored(counts: DataFrame, answers: DataFrame, least: int, inside: int, best: int) -> DataFrame:
    """(lang, phrase, a, l, r, score): the best candidates of each range."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        own = next((_transducer(r) for r in rows if r["kind"] == 0), None)
        got: list[tuple] = []
        if own is not None:
            count = _lookup([_transducer(r) for r in rows if r["kind"] == 2], own.words)
            around = _lookup([_transducer(r) for r in rows if r["kind"] == 3], own.words)
            (two, n2), (three, n3) = _phrases(_unfolded(own), least)
            stays = 100 * around(two) < inside * n2
            two, n2 = two[stays], n2[stays]
            l2, r2 = count(two[:, :1]), count(two[:, 1:])
            l3, r3 = count(three[:, :1]), count(three[:, 1:])
            l4, r4 = count(three[:, :2]), count(three[:, 2:])
            first, second = scores(n3, l3, r3), scores(n3, l4, r4)
            later = second < first
            a, s = np.concatenate([n2, n3]), np.concatenate([scores(n2, l2, r2), np.where(later, second, first)])
            l, r = np.concatenate([l2, np.where(later, l4, l3)]), np.concatenate([r2, np.where(later, r4, r3)])
            named = [*two.tolist(), *three.tolist()]
            near = np.flatnonzero(s >= (np.partition(s, len(s) - best)[len(s) - best] if len(s) > best else 0))
            got = sorted((-int(s[i]), -int(a[i]), b" ".join([own.words[w] for w in named[i]]), int(l[i]), int(r[i]))
                         for i in near.tolist())[:best]
        cols = [[key[0].as_py()] * len(got), [g[2].decode() for g in got], [-g[1] for g in got], [g[3] for g in got],
                [g[4] for g in got], [-g[0] for g in got]]
        return pa.table([pa.array(c, k) for c, k in zip(cols, [pa.string(), pa.string(), *[pa.int64()] * 4])],
                        names=["lang", "phrase", "a", "l", "r", "score"])

    both = counts.unionByName(answers)
    return both.groupBy("lang", "part").applyInArrow(
        run, "lang string, phrase string, a long, l long, r long, score long")


def collocations(df: DataFrame, text_col: str = "text", lang_col: str = "lang", *, least: int = LEAST,
                 inside: int = INSIDE, best: int = BEST, n_ranges: int | None = None,
                 shard_words: int = SHARD_WORDS) -> DataFrame:
    """The ``best`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Words are runs without blanks and tabs, A to Z in lower case; phrases do not cross
    punctuation or line ends.  Ties go by count and then by the phrase's bytes.  A null
    text is empty, a null language ``und``; repeated rows count each time.  Empty table,
    or no phrase often enough: no rows.  Other columns are ignored.
    """
    if not 0 < shard_words < 1 << _BITS:
        shard_words = (1 << _BITS) - 1
    counts, bounds = ranges(df, text_col, lang_col, least=least, n_ranges=n_ranges, shard_words=shard_words)
    asked = _asked(counts, bounds, least)
    answers = stored(_grouped(counts.unionByName(asked), _answered), "answers")
    top = top_k_per_group(_scored(counts, answers, least, inside, best), "lang",
                          [F.col("score").desc(), F.col("a").desc()], best, F.col("phrase").asc(), rank_as="rank")
    sums = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    return top.join(sums, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                                         "n", "score")
