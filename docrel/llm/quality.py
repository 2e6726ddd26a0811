"""Quality classifier by compression.

Two zstandard dictionaries are built, one from good and one from bad labelled
texts.  A text is compressed whole with either; the one that knows its kind
compresses it better, so the difference of the sizes, over the size without a
dictionary, tells the classes apart.  Logistic calibration on other labelled texts
turns that into a score.  A difference means less for a text that is short or
shrinks to little by itself, so the calibration also sees the text's own ratio and
the logarithm of its length.

Fitting uses a bounded sample: at most about ``PER_CLASS`` texts of each class,
chosen by a hash of the id, ``DICTIONARY_SHARE`` of them for the dictionaries and
the rest for calibration.  Only dictionary texts come to the driver, at most
``CLASS_BYTES`` a class; the others are measured in tasks.  Scoring reads every text whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docrel.llm.common import stored

#: Bounds of the sample: texts of a class, and bytes of a class for its dictionary.
PER_CLASS = 2000
CLASS_BYTES = 6 << 20
DICTIONARY_SHARE = 0.5
DICTIONARY_BYTES = 112 << 10
LEVEL = 3
CUT = 0.3


def held_out(id_col: str):
    """Whether a row is in the held-out fold; null ids are."""
    return F.coalesce(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % 5 == 0, F.lit(True))


def _sampled(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
             per_class: int) -> DataFrame:
    """(label, part, text, unit, tie, size) of the sample; part 0 is for dictionaries."""
    rows = labels.filter(F.col(label_col).isin(0, 1) & ~held_out(id_col)) \
                 .select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).distinct()
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}  # two rows
    unit = F.pmod(F.xxhash64(F.lit("quality"), "id"), F.lit(1 << 30))
    share = F.lit(0)
    for label, n in sizes.items():
        share = F.when(F.col("label") == label, int(min(1.0, per_class / n) * (1 << 30))).otherwise(share)
    picked = rows.filter(unit < share).withColumn("unit", unit)
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # the ids of the sample: 2 * per_class rows, about, so no text is shuffled to find its own
    got = docs.join(F.broadcast(picked), "id").filter("text is not null and text <> ''")
    part = (F.pmod(F.xxhash64(F.lit("part"), "id"), F.lit(1000)) >= int(1000 * DICTIONARY_SHARE)).cast("int")
    return stored(got.select("label", part.alias("part"), "text", "unit").distinct().select(
        "*", F.xxhash64("text").alias("tie"), F.octet_length("text").alias("size")), "quality_sample")


def _dictionary_texts(sample: DataFrame) -> list[tuple[int, bytes]]:
    """(label, text) for the dictionaries, in a fixed order: those that fit into ``CLASS_BYTES``.
    Their sizes come to the driver first, so no more than that does."""
    part = sample.filter("part = 0")
    room, chosen = {0: CLASS_BYTES, 1: CLASS_BYTES}, []
    for r in part.select("unit", "label", "tie", "size").orderBy("unit", "label", "tie").collect():
        if r["size"] <= room[r["label"]]:
            room[r["label"]] -= r["size"]
            chosen.append((r["unit"], r["label"], r["tie"]))
    keys = sample.sparkSession.createDataFrame(chosen, "unit long, label long, tie long")
    got = part.join(F.broadcast(keys), ["unit", "label", "tie"], "left_semi")
    return [(r["label"], r["text"].encode()) for r in
            got.orderBy("unit", "label", "tie").select("label", "text").collect()]


def _measured(sample: DataFrame, model: Model) -> list[tuple[int, int, float, float, float]]:
    """(label, part, measures) of the sample in a fixed order, measured in tasks: numbers only."""
    held = sample.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for b in batches:
            got = np.array([m.measures(x.as_py().encode()) for x in b.column(4)], float).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([*b.columns[:4], *(pa.array(got[:, i]) for i in range(3))],
                                             names=["label", "part", "unit", "tie", "m0", "m1", "m2"])

    src = sample.select(F.col("label").cast("long"), F.col("part").cast("long"), "unit", "tie", "text")
    out = src.mapInArrow(run, "label long, part long, unit long, tie long, m0 double, m1 double, m2 double")
    return [(r["label"], r["part"], r["m0"], r["m1"], r["m2"]) for r in
            out.orderBy("unit", "label", "tie").collect()]


class Model:
    """Dictionaries of the classes and the calibration's weights."""

    def __init__(self, texts: list[tuple[int, bytes]]):
        import zstandard

        self.dictionaries = []
        for label in (0, 1):
            own = [t for y, t in texts if y == label]
            self.dictionaries.append(self._dictionary(zstandard, own, sum(map(len, own))))
        self.weights = np.zeros(4)
        self._open()

    def calibrate(self, rows: list[tuple[int, int, float, float, float]]) -> None:
        """Fit the weights to (label, part, measures): to part 1, or to all where it has one class."""
        own = [r for r in rows if r[1] == 1]
        if len({r[0] for r in own}) < 2:
            own = rows
        self.weights = _logistic(np.array([r[2:] for r in own], float).reshape(-1, 3),
                                 np.array([r[0] for r in own], float))

    @staticmethod
    def _dictionary(zstandard, texts: list[bytes], size: int) -> bytes:
        """A trained dictionary, or the texts themselves where they are too few to train one."""
        try:
            return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, size // 8)), texts,
                                              level=LEVEL).as_bytes()
        except zstandard.ZstdError:
            return b"\n".join(texts)[:DICTIONARY_BYTES]

    def _open(self) -> None:
        import zstandard

        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        self.known = []
        for raw in self.dictionaries:
            d = zstandard.ZstdCompressionDict(raw)
            d.precompute_compress(level=LEVEL)
            self.known.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False))

    def __getstate__(self):
        return {k: getattr(self, k) for k in ("dictionaries", "weights")}

    def __setstate__(self, state):
        self.__dict__ |= state
        self._open()

    def measures(self, raw: bytes) -> tuple[float, float, float]:
        """(size by the bad dictionary - size by the good one) / size without, size without /
        length, log of the length; (0, 1, 0) for an empty text."""
        if not raw:
            return 0.0, 1.0, 0.0
        bad, good = (len(z.compress(raw)) for z in self.known)
        plain = len(self.plain.compress(raw))
        return (bad - good) / plain, plain / len(raw), float(np.log(len(raw)))

    def score(self, raw: bytes) -> float:
        x = float(np.dot(self.weights[:3], self.measures(raw)) + self.weights[3])
        return float(1 / (1 + np.exp(-np.clip(x, -40, 40))))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights and shift of a logistic fit by Newton steps, with a slight pull to zero."""
    if not len(x):
        return np.zeros(x.shape[1] + 1)
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    a = np.column_stack(((x - mean) / scale, np.ones(len(x))))
    w = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -40, 40)))
        slope = a.T @ (p - y) + 1e-2 * w
        curve = (a * (p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w = w - np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-9:
            break
    return np.append(w[:-1] / scale, w[-1] - (w[:-1] * mean / scale).sum())


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", per_class: int = PER_CLASS) -> Model:
    """Fit on a bounded sample of the labelled rows outside the held-out fold."""
    sample = _sampled(df, labels, id_col, text_col, label_col, per_class)
    model = Model(_dictionary_texts(sample))
    model.calibrate(_measured(sample, model))
    return model


def scored(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
           cut: float = CUT) -> DataFrame:
    """id, held_out, score and predicted (1 where the score is at least ``cut``) of every row.

    Null and empty texts have the score of no difference.  Repeated rows get
    equal rows; an empty table gives none.  Other columns are ignored.
    """
    src = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("body"))
    held = df.sparkSession.sparkContext.broadcast(model)
    id_ddl = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for b in batches:
            scores = [m.score(x.as_py()) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64())],
                                             names=["id", "score"])

    return src.mapInArrow(run, f"id {id_ddl}, score double").select(
        F.col("id").alias(id_col), held_out("id").alias("held_out"), "score",
        (F.col("score") >= cut).cast("int").alias("predicted"))
