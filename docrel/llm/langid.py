"""Language identification with error-correcting output codes.

Every learned language has a codeword of bits; each bit splits the languages into
two sets, and a binary n-gram classifier predicts it.  A text is decoded to the
language whose codeword loses least: the loss of each bit's margin counts by the
bit's weight, which is its accuracy in training.  The margin between the two
nearest codewords flags ambiguous texts.

* Features: counts of the 1- to 3-grams of letters (and word ends) of the whole
  text, hashed to ``BUCKETS``.  They are counted with numpy over Arrow batches.
* The binary classifiers are multinomial (naive Bayes) log-odds between the two
  sets of a bit.  Their sufficient statistics are n-gram counts by language over a
  bounded sample: at most about ``PER_LANGUAGE`` documents of each language,
  chosen by a hash of the id.  Spark sums them; the driver gets one row for each
  language and bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docrel.llm.common import fresh

UNDETERMINED = "und"
#: Bound of the training sample: documents of a language, about.
PER_LANGUAGE = 2000
BUCKETS = 1 << 13
#: Bits of a codeword: all distinct splits up to this many languages, else random ones.
MAX_BITS = 31
#: Score under which a text's nearest codewords are too close to tell.
AMBIGUOUS = 0.5
#: Characters of a text handled at once.
_STEP = 1 << 16

_FOLD = None


def _letters(text: str) -> np.ndarray:
    """Code points of the lower-case text, each run of non-letters as one 0,
    with a 0 at both ends; empty if there is no letter."""
    global _FOLD
    if _FOLD is None:  # the letters of the basic plane, lower-cased; 0 for all else
        _FOLD = np.array([ord(c.lower()[0]) if (c := chr(i)).isalpha() else 0 for i in range(1 << 16)],
                         np.uint16)
    try:  # most texts: one byte a character
        code = np.frombuffer(text.encode("latin-1"), np.uint8)
    except UnicodeEncodeError:
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        if len(code) and code.max() > 0xFFFF:
            high = code > 0xFFFF
            alpha = np.fromiter((chr(c).isalpha() for c in code[high].tolist()), bool)
            code = code.copy()
            code[high] = np.where(alpha, 0xFFDC, 0)  # one letter stands for those beyond
    fold = _FOLD[code]
    if not fold.any():
        return fold[:0]
    keep = np.ones(len(fold), bool)
    keep[1:] = (fold[1:] != 0) | (fold[:-1] != 0)
    fold = fold[keep]
    return np.concatenate((np.zeros(int(fold[0] != 0), np.uint16), fold,
                           np.zeros(int(fold[-1] != 0), np.uint16)))


def ngram_counts(text: str, buckets: int = BUCKETS) -> np.ndarray | None:
    """Hashed counts of the 1- to 3-grams of a whole text; None without a letter."""
    code = _letters(text).astype(np.uint32)
    if not len(code):
        return None
    out = np.zeros(buckets, np.int64)
    shift = np.uint32(32 - (buckets - 1).bit_length())
    for i in range(0, len(code), _STEP):
        c = code[i:i + _STEP + 2]
        n = min(_STEP, len(code) - i)
        one = c * np.uint32(0x9E3779B1) + np.uint32(1)
        grams = [one[:n][c[:n] != 0]]
        two = one[:-1] * np.uint32(0x85EBCA6B) + c[1:]
        grams.append(two[:n])
        if len(c) > 2:
            grams.append((two[:-1] * np.uint32(0xC2B2AE35) + c[2:])[:n])
        for g in grams:
            g = g ^ (g >> np.uint32(15))
            out += np.bincount((g * np.uint32(0x9E3779B1)) >> shift, minlength=buckets)
    return out


def codewords(n: int, max_bits: int = MAX_BITS) -> np.ndarray:
    """(n, bits) codewords of -1 and 1 with all rows and columns distinct.

    The exhaustive code (every split of the languages) where it has at most
    ``max_bits`` columns, else the best of some seeded random codes: that with
    the largest smallest distance between rows.
    """
    if n <= 1:
        return np.ones((n, 1), np.int8)
    if 2 ** (n - 1) - 1 <= max_bits:
        return np.array([[1 if r == 0 or (b >> (r - 1)) & 1 else -1 for b in range(2 ** (n - 1) - 1)]
                         for r in range(n)], np.int8)
    bits = max(max_bits, 4 * (n - 1).bit_length())
    rng, best, far = np.random.default_rng(7), None, -1
    for _ in range(64):
        code = rng.choice(np.array([-1, 1], np.int8), (n, bits))
        if (np.abs(code.sum(axis=0)) == n).any():
            continue
        apart = (bits - code.astype(int) @ code.T.astype(int)) // 2
        least = apart[~np.eye(n, dtype=bool)].min()
        if least > far:
            best, far = code, least
    if best is None or far < 1:
        return np.array([[1 if (r >> b) & 1 else -1 for b in range((n - 1).bit_length())]
                         for r in range(n)], np.int8)
    return best


class Model:
    """Languages, their codewords, and the binary classifiers' weights."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        """counts: (languages, buckets) n-gram counts of the sample."""
        self.languages, self.code = languages, codewords(len(languages))
        bits = self.code.shape[1]
        share = (counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * counts.shape[1])
        self.weights = np.zeros((counts.shape[1], bits), np.float32)
        for b in range(bits):
            up, down = self.code[:, b] > 0, self.code[:, b] < 0
            if up.any() and down.any():
                self.weights[:, b] = np.log(share[up].mean(axis=0)) - np.log(share[down].mean(axis=0))
        self.scale = np.ones(bits, np.float32)
        self.trust = np.ones(bits, np.float32)

    def margins(self, counts: np.ndarray) -> np.ndarray:
        """Mean log-odds of each bit; its sign predicts the bit."""
        at = np.flatnonzero(counts)
        n = counts[at]
        return (n @ self.weights[at]) / n.sum() * self.scale

    def decode(self, counts: np.ndarray) -> tuple[int, float, int]:
        """(nearest, score, second): loss-weighted decoding of one text.

        The certainty of each margin grows with the root of the text's n-grams.
        """
        margin = self.margins(counts) * min(np.sqrt(counts.sum()), 64.0)
        loss = (np.logaddexp(0, -margin[None, :] * self.code) * self.trust).sum(axis=1)
        order = np.argsort(loss, kind="stable")
        near = np.exp(-(loss - loss.min()))
        return int(order[0]), float(1 / near.sum()), int(order[min(1, len(order) - 1)])


def _held_out(id_col: str):
    return F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % 5 == 0


def _sample(df: DataFrame, lang_col: str, id_col: str, per_language: int) -> DataFrame:
    """Labelled rows outside the held-out fold, about ``per_language`` of each language."""
    fit = df.filter(F.col(lang_col).isNotNull() & ~F.coalesce(_held_out(id_col), F.lit(True)))
    sizes = {r[0]: r[1] for r in fit.groupBy(lang_col).count().collect()}  # a row for each language
    keep = F.lit(False)
    unit = F.pmod(F.xxhash64(F.lit("langid"), id_col), F.lit(1 << 30))
    for lang, n in sizes.items():
        share = min(1.0, per_language / n)
        keep = keep | ((F.col(lang_col) == lang) & (unit < int(share * (1 << 30))))
    return fit.filter(keep)


def train(df: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text",
          per_language: int = PER_LANGUAGE, buckets: int = BUCKETS) -> Model:
    """Fit on a bounded sample.  The bits' weights come from the same sample: the
    share of its languages' texts on the right side, by a second count."""
    rows = _sample(df, lang_col, id_col, per_language).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter("text is not null")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                got = ngram_counts(text.as_py(), buckets)
                if got is not None:
                    # every document weighs the same, long ones do not drown the others
                    sums[lang] = sums.get(lang, 0) + got * (1000.0 / got.sum())
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(total[at])],
                names=["lang", "bucket", "n"])

    sums = rows.mapInArrow(count, "lang string, bucket int, n double") \
               .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect()
    languages = sorted({r["lang"] for r in sums})
    counts = np.zeros((len(languages), buckets))
    row = {lang: i for i, lang in enumerate(languages)}
    for r in sums:
        counts[row[r["lang"]], r["bucket"]] = round(r["n"], 6)
    model = Model(languages, counts)
    if len(languages) > 1:
        _weigh(model, rows)
    return model


def _weigh(model: Model, rows: DataFrame) -> None:
    """Scale each bit by its spread and weigh it by its accuracy on the sample."""
    row = {lang: i for i, lang in enumerate(model.languages)}
    bits = model.code.shape[1]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right, spread, n = np.zeros(bits, np.int64), np.zeros(bits), 0
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                got = ngram_counts(text.as_py(), len(model.weights))
                if got is not None:
                    m = model.margins(got)
                    right += m * model.code[row[lang]] > 0
                    spread += np.abs(m)
                    n += 1
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(bits, dtype=np.int32)), pa.array(right), pa.array(spread),
                 pa.array(np.full(bits, n))], names=["bit", "right", "spread", "n"])

    got = rows.mapInArrow(score, "bit int, right long, spread double, n long") \
              .groupBy("bit").agg(F.sum("right").alias("right"), F.sum("spread").alias("spread"),
                                  F.sum("n").alias("n")).collect()
    for r in got:
        wrong = (r["n"] - r["right"] + 1) / (r["n"] + 2)
        model.trust[r["bit"]] = max(0.05, np.log((1 - wrong) / wrong))
        model.scale[r["bit"]] = 1 / max(r["spread"] / r["n"], 1e-6) / 8
    model.trust /= model.trust.mean()


def predict(df: DataFrame, model: Model, cols: list[str], text_col: str = "text") -> DataFrame:
    """``cols`` and lang_pred, score, second (the next nearest language), ambiguous;
    these names are lengthened where ``cols`` has them.

    Without a letter (or null): ``und``, score 0, no second.  If no language was
    learned every text is ``und``.
    """
    own = [F.col(f"`{c}`") for c in cols]
    src = df.select(*own, F.col(text_col).alias(fresh(df, "langid_text")))
    schema = df.select(*own).schema
    kinds = (("lang_pred", "string"), ("score", "double"), ("second", "string"), ("ambiguous", "boolean"))
    for name, kind in kinds:
        schema = schema.add(fresh(src, name), kind)
    held = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for b in batches:
            langs, scores, seconds = [], [], []
            for text in b.column(len(cols)):
                got = ngram_counts(text.as_py() or "", len(m.weights)) if m.languages else None
                if got is None:
                    langs.append(UNDETERMINED)
                    scores.append(0.0)
                    seconds.append(None)
                else:
                    first, score, second = m.decode(got)
                    langs.append(m.languages[first])
                    scores.append(score)
                    seconds.append(m.languages[second] if second != first else None)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:len(cols)], pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(seconds, pa.string()),
                 pa.array([s < AMBIGUOUS for s in scores], pa.bool_())], names=schema.names)

    return src.mapInArrow(run, schema)


def identified(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               lang_col: str = "lang") -> DataFrame:
    """One row per row of ``df``: id, held_out, lang_pred, score, second, ambiguous.

    Learns from the labelled rows outside the held-out fold (crc32 of the id's
    text mod 5 is 0; null ids count as held out).  Repeated rows get equal rows;
    an empty table gives none.
    """
    model = train(df, lang_col, id_col, text_col)
    out = predict(df.select(id_col, text_col), model, [id_col], text_col)
    return out.select(id_col, F.coalesce(_held_out(id_col), F.lit(True)).alias("held_out"),
                      "lang_pred", "score", "second", "ambiguous")


def accepted(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             least: float = AMBIGUOUS) -> DataFrame:
    """The rows of ``df`` whose language can be told: not ``und`` and a score of at least
    ``least``, by default those that are not flagged as ambiguous."""
    model = train(df, lang_col, id_col, text_col)
    cols = list(df.columns)
    got = predict(df, model, cols, text_col)
    lang, score = got.columns[len(cols):len(cols) + 2]
    return got.filter((F.col(lang) != UNDETERMINED) & (F.col(score) >= least)) \
              .select(*[F.col(f"`{c}`") for c in cols])


__all__ = ["accepted", "codewords", "identified", "ngram_counts", "predict", "train"]
