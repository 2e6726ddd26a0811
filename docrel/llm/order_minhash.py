"""Document fingerprints by Order MinHash (Marcais et al., 2019).

Unlike MinHash, the sketch of a text keeps the order of its minimal k-mers, so
likeness follows edit distance and tells apart texts that hold the same words in
another order.  For every one of ``SKETCHES`` orders of hash values:

1. the k-mers (runs of ``K`` words) are numbered by occurrence, so a repeated
   k-mer counts as often as it occurs;
2. the two minimal numbered k-mers of the order are selected;
3. they are put in text order and hashed as a tuple.

The orders are ``value XOR (i << 58)``, which sorts a text's values by their
distance to bin i of the leading bits.  The two smallest values of every bin hold
the minima of all orders, so at most 128 values of a text enter the last step,
whatever its length.  All of it is SQL expressions over whole texts: a text is
fingerprinted where it is read and no k-mer is ever shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docrel.llm.common import SPACES, stored, text_of
from docrel.operators.integrity import assign_ids

K = 3
SKETCHES = 64
_BIN_SHIFT = 58          # 64 bins by the leading 6 bits
_PLACE_BITS = 27         # low bits of a value hold the k-mer's place in the text
_PLACE = (1 << _PLACE_BITS) - 1


def _packed(h: Column, place: Column) -> Column:
    return h.bitwiseAND(~_PLACE).bitwiseOR(place.cast("long").bitwiseAND(_PLACE))


def _kmer(v: Column) -> Column:
    """The hash part of a value."""
    return F.shiftright(v, _PLACE_BITS)


def with_sketch(df: DataFrame, text: Column, out: str) -> DataFrame:
    """Add string column ``out``: the 64 tuple hashes of a text, 4 hex digits each.

    A text of fewer than ``K`` words is one k-mer; one without words has none, and
    its tuples are the hash of nothing.  A null text counts as empty.
    """
    # one column for each step, used more than once by the next: none is evaluated again
    w, p, s, c = (f"{out}__{x}" for x in "wpsc")
    df = df.withColumn(w, F.array_remove(F.split(text_of(text), SPACES), ""))
    n = F.greatest(F.size(w) - (K - 1), F.least(F.size(w), F.lit(1)))
    kmer = F.transform(F.slice(w, F.lit(1), n), lambda x, i: _packed(
        F.xxhash64(x, *[F.get(F.col(w), i + j) for j in range(1, K)]), i))
    df = df.withColumn(p, F.sort_array(kmer))
    # occurrence numbers: the places of a value in its run of equal hashes
    first = F.filter(F.transform(p, lambda v, j: j), lambda j: (j == 0) | (
        _kmer(F.get(F.col(p), j)) != _kmer(F.get(F.col(p), j - 1))))
    df = df.withColumn(s, first)
    runs = F.transform(s, lambda a, j: F.sequence(
        F.lit(0), F.coalesce(F.get(F.col(s), j + 1), F.size(p)) - a - 1))
    numbered = F.zip_with(F.col(p), F.flatten(runs), lambda v, o: F.when(o == 0, v).otherwise(
        _packed(F.xxhash64(_kmer(v), o), v.bitwiseAND(_PLACE))))
    df = df.withColumn(p, F.when(F.size(s) == F.size(p), F.col(p)).otherwise(F.sort_array(numbered)))
    # the two smallest values of every bin
    bin_of = lambda v: F.shiftrightunsigned(v, _BIN_SHIFT)
    df = df.withColumn(c, F.filter(p, lambda v, j: (j < 2) | (bin_of(v) != bin_of(F.get(F.col(p), j - 2)))))
    full = F.transform(F.sequence(F.lit(0), F.lit(SKETCHES - 1)),
                       lambda i: F.array(F.get(F.col(c), 2 * i), F.get(F.col(c), 2 * i + 1)))
    turned = F.transform(F.sequence(F.lit(0), F.lit(SKETCHES - 1)), lambda i: F.transform(
        F.col(c), lambda v: v.bitwiseXOR(F.shiftleft(i.cast("long"), _BIN_SHIFT))))
    least = F.transform(turned, lambda d: F.array(
        F.array_min(d), F.array_min(F.array_remove(d, F.array_min(d)))))
    back = F.transform(least, lambda t, i: F.transform(
        t, lambda v: v.bitwiseXOR(F.shiftleft(i.cast("long"), _BIN_SHIFT))))
    pairs = F.when(F.size(c) == 2 * SKETCHES, full).otherwise(back)
    place = lambda t, k: F.get(t, F.lit(k)).bitwiseAND(_PLACE)
    hashed = F.transform(pairs, lambda t: F.when(
        place(t, 0) > place(t, 1), F.xxhash64(_kmer(F.get(t, F.lit(1))), _kmer(F.get(t, F.lit(0)))))
        .otherwise(F.xxhash64(_kmer(F.get(t, F.lit(0))), _kmer(F.get(t, F.lit(1))))))
    sig = F.transform(hashed, lambda h: F.lpad(F.hex(h.bitwiseAND(0xFFFF)), 4, "0"))
    return df.withColumn(out, F.lower(F.array_join(sig, ""))).drop(w, p, s, c)


def likeness(a: str, b: str) -> Column:
    """Share of equal tuple hashes of two sketch columns."""
    of = lambda x, i: F.substring(F.col(x), 4 * i + 1, F.lit(4))
    same = F.filter(F.sequence(F.lit(0), F.lit(SKETCHES - 1)), lambda i: of(a, i) == of(b, i))
    return F.size(same) / F.lit(float(SKETCHES))


#: What tells documents apart: whether the id is null, the id (else 0), a hash of the text.
_KEY = ["none", "id", "h"]


def _next_rows(docs: DataFrame) -> DataFrame:
    """(id, h, next_id, next_h, half): the document after each in descending id."""
    keys = docs.groupBy("none", "id", "h").agg(F.first(F.length("body")).alias("n"))
    # ascending with null ids first; the next document is the one before
    placed = stored(assign_ids(keys.withColumn("some", ~F.col("none")), ["some", "id", "h"], "at"), "order")
    last = placed.count()
    here = placed.withColumn("to", F.when(F.col("at") == 1, F.lit(last)).otherwise(F.col("at") - 1))
    there = placed.select(F.col("at").alias("to"), *[F.col(k).alias(f"next_{k}") for k in _KEY])
    return here.join(there, "to").select(*_KEY, F.floor(F.col("n") / 2).cast("int").alias("half"),
                                         *[f"next_{k}" for k in _KEY])


def edited_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text.

    The edited text has its last floor(n / 2) code points replaced by the first
    as many of the next document in descending id (after the last: the first).
    Rows that share an id are ordered by a hash of their text, null ids come
    last, and repeated rows are one document in that order but all get a row.  A
    single document is its own next.  Null text: empty.  Empty table: no rows.

    Whole texts are shuffled once, on their key, with their sketch; both joins
    read that shuffle.  Besides them only the parts of the next texts move.
    """
    id_type = df.schema[id_col].dataType
    base = df.select(F.col(id_col).isNull().alias("none"),
                     F.coalesce(F.col(id_col), F.lit(0).cast(id_type)).alias("id"),
                     text_of(text_col).alias("body")).withColumn("h", F.xxhash64("body"))
    order = stored(_next_rows(base), "next")
    docs = with_sketch(base, F.col("body"), "sketch")
    of = order.select(*[F.col(f"next_{k}").alias(k) for k in _KEY], "half",
                      *[F.col(k).alias(f"to_{k}") for k in _KEY])
    parts = docs.join(of, _KEY).select(
        *[F.col(f"to_{k}").alias(k) for k in _KEY], "half",
        F.expr("substring(body, 1, half)").alias("part"), F.col("sketch").alias("next_sketch"))
    # a repeated next row gives its part again: any one of them
    parts = parts.groupBy(*_KEY).agg(F.first(F.struct("half", "part", "next_sketch")).alias("x"))
    both = docs.join(parts, _KEY).select(
        F.when(~F.col("none"), F.col("id")).alias(id_col), F.length("body").cast("long").alias("n_chars"),
        "sketch", F.col("x.next_sketch").alias("next_sketch"),
        F.concat(F.expr("substring(body, 1, length(body) - x.half)"), F.col("x.part")).alias("edited"))
    both = with_sketch(both, F.col("edited"), "edited_sketch")
    return both.select(
        id_col, "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        F.col("sketch").alias("fingerprint"), F.col("edited_sketch").alias("edited_fingerprint"),
        likeness("sketch", "edited_sketch").alias("near_edited"),
        likeness("sketch", "next_sketch").alias("near_next"))
