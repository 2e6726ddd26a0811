"""Queries that SQL cannot express, counted again row by row in plain Python."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest
import zstandard
from pyspark.sql import functions as F

from docrel.llm import langid, order_minhash, quality

from .conftest import odd_rows

ROWS = odd_rows()
MASK = (1 << 32) - 1


def held_out(doc):
    return doc is None or zlib.crc32(str(doc).encode()) % 5 == 0


def order(row):
    return tuple((v is None, v) for v in row)


# language ----------------------------------------------------------------------
def grams(text):
    """Buckets of all 1- to 3-grams of letters and word ends."""
    folded = [0]
    for c in text or "":
        x = 0 if not c.isalpha() else 0xFFDC if ord(c) > 0xFFFF else ord(c.lower()[0])
        if x or folded[-1]:
            folded.append(x)
    if folded == [0]:
        return None
    if folded[-1]:
        folded.append(0)
    out = Counter()
    for i, c in enumerate(folded):
        hashes = [c * 0x9E3779B1 + 1]
        for d, factor in zip(folded[i + 1:i + 3], (0x85EBCA6B, 0xC2B2AE35)):
            hashes.append((hashes[-1] & MASK) * factor + d)
        for g in hashes[0 if c else 1:]:
            g &= MASK
            out[(((g ^ g >> 15) * 0x9E3779B1) & MASK) >> 19] += 1
    return out


def languages():
    """lang_pred, score and second of a text, learned from all rows outside the fold."""
    sample = [(lang, grams(text)) for doc, text, lang, *_ in ROWS if lang and not held_out(doc) and grams(text)]
    sums = defaultdict(Counter)
    for lang, got in sample:
        for bucket, n in got.items():
            sums[lang][bucket] += n * 1000 / sum(got.values())
    names = sorted(sums)
    share = {x: [(sums[x][b] + 0.5) / (sum(sums[x].values()) + 0.5 * 8192) for b in range(8192)] for x in names}
    # every split of the languages, the first always on the same side
    code = [{x: 1 if i == 0 or bit >> (i - 1) & 1 else -1 for i, x in enumerate(names)}
            for bit in range(2 ** (len(names) - 1) - 1)]
    weights = []
    for bit in code:
        up, down = ([share[x] for x in names if bit[x] == side] for side in (1, -1))
        weights.append([math.log(sum(u) / len(u)) - math.log(sum(d) / len(d)) for u, d in zip(zip(*up), zip(*down))])

    def margins(got):
        return [sum(n * w[b] for b, n in got.items()) / sum(got.values()) for w in weights]

    scale, trust = [], []
    for i, bit in enumerate(code):
        of = [(margins(got)[i], bit[lang]) for lang, got in sample]
        wrong = (sum(m * side <= 0 for m, side in of) + 1) / (len(of) + 2)
        trust.append(max(0.05, math.log((1 - wrong) / wrong)))
        scale.append(1 / max(sum(abs(m) for m, _ in of) / len(of), 1e-6) / 8)
    mean = sum(trust) / len(trust)

    def decode(text):
        got = grams(text)
        if got is None:
            return "und", 0.0, None
        sure = [m * s * min(math.sqrt(sum(got.values())), 64.0) for m, s in zip(margins(got), scale)]
        loss = {x: sum(math.log1p(math.exp(-m * bit[x])) * t / mean for m, bit, t in zip(sure, code, trust)) for x in names}
        near = sorted(names, key=loss.get)
        return near[0], 1 / sum(math.exp(loss[near[0]] - v) for v in loss.values()), near[1]

    return decode


def test_languages_row_by_row(odd):
    decode = languages()
    want = sorted(((doc, held_out(doc), *decode(text)) for doc, text, *_ in ROWS), key=order)
    got = langid.identified(odd).collect()
    assert all(r.ambiguous == (r.score < langid.AMBIGUOUS) for r in got)
    got = sorted(((r.doc_id, r.held_out, r.lang_pred, r.score, r.second) for r in got), key=order)
    assert len(got) == len(want) and len({w[2] for w in want}) > 2
    for g, w in zip(got, want):
        assert g[:3] == w[:3] and g[4] == w[4] and g[3] == pytest.approx(w[3], abs=1e-4)


# quality -----------------------------------------------------------------------
def test_scores_row_by_row(spark, odd):
    labels = spark.createDataFrame([(i, i % 2) for i in range(100, 140)], "doc_id long, quality int")
    model = quality.train(odd, labels)
    assert all(model.dictionaries) and len(model.weights) == 4

    def size(raw, dictionary=None):
        held = {} if dictionary is None else {"dict_data": zstandard.ZstdCompressionDict(dictionary)}
        return len(zstandard.ZstdCompressor(level=3, write_content_size=False, **held).compress(raw))

    def score(text):
        raw, x = (text or "").encode(), (0.0, 1.0, 0.0)
        if raw:
            bad, good = (size(raw, d) for d in model.dictionaries)
            x = ((bad - good) / size(raw), size(raw) / len(raw), math.log(len(raw)))
        return 1 / (1 + math.exp(-sum(a * b for a, b in zip([*x, 1.0], model.weights))))

    want = sorted(((doc, held_out(doc), score(text)) for doc, text, *_ in ROWS), key=order)
    got = quality.scored(odd, model).collect()
    assert all(r.predicted == int(r.score >= 0.3) for r in got)
    got = sorted(((r.doc_id, r.held_out, r.score) for r in got), key=order)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:2] == w[:2] and g[2] == pytest.approx(w[2], abs=1e-9)


def test_calibration_is_the_best_fit(spark, odd):
    """The slopes of the penalised log-likelihood at the fitted weights are zero."""
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(100, 140)], "doc_id long, quality int")
    model = quality.train(odd, labels)
    sample = quality._sampled(odd, labels, "doc_id", "text", "quality", quality.PER_CLASS).collect()
    used = {(r.label, r.text) for r in sample}
    text_of = {doc: text for doc, text, *_ in ROWS}
    assert used == {(int(i % 3 == 0), text_of[i]) for i in range(100, 140) if not held_out(i)}
    own = [r for r in sample if r.part == 1]
    x = [model.measures(r.text.encode()) for r in own]
    y = [r.label for r in own]
    p = [1 / (1 + math.exp(-sum(a * b for a, b in zip([*m, 1.0], model.weights)))) for m in x]
    assert len(set(y)) == 2
    mean = [sum(c) / len(c) for c in zip(*x)]
    spread = [max(math.sqrt(sum((v - m) ** 2 for v in c) / len(c)), 1e-9) for c, m in zip(zip(*x), mean)]
    for k in range(3):
        slope = sum((pi - yi) * (xi[k] - mean[k]) / spread[k] for pi, yi, xi in zip(p, y, x))
        assert slope + 1e-2 * model.weights[k] * spread[k] == pytest.approx(0, abs=1e-6)


# Order MinHash -----------------------------------------------------------------
def test_likenesses_row_by_row(spark, odd):
    """Fingerprints of edited texts are those of such texts, and both likenesses count
    the equal ones of the 64 parts."""
    keyed = {(r["doc_id"], r["text"] or ""): r["h"] for r in
             odd.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    docs = sorted(keyed, key=lambda k: (k[0] is not None, k[0] or 0, keyed[k]), reverse=True)
    after = {k: docs[(i + 1) % len(docs)] for i, k in enumerate(docs)}
    edited = {k: k[1][:len(k[1]) - len(k[1]) // 2] + after[k][1][:len(k[1]) // 2] for k in docs}
    texts = sorted({*edited.values(), *(k[1] for k in docs)})
    sketch = {r.t: r.s for r in order_minhash.with_sketch(
        spark.createDataFrame([(t,) for t in texts], "t string"), F.col("t"), "s").collect()}

    def alike(a, b):
        return sum(a[i:i + 4] == b[i:i + 4] for i in range(0, 256, 4)) / 64

    def row(k):
        own, new = sketch[k[1]], sketch[edited[k]]
        return (k[0], len(k[1]), hashlib.sha256(edited[k].encode()).hexdigest(), own, new, alike(own, new),
                alike(own, sketch[after[k][1]]))

    want = Counter(row((r[0], r[1] or "")) for r in ROWS)
    got = order_minhash.edited_report(odd).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    assert Counter(map(tuple, got.collect())) == want
    assert len({w[5] for w in want}) > 3 and len({w[6] for w in want}) > 3
