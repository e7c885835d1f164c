"""Text quality by compression: which of two dictionaries, of good or of bad text, shortens a text more."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from comboscope.functions.storage import written

#: Labelled texts of each class that the model is fitted on, at most.
FITTED = 2000
#: A longer text gives a dictionary so many parts from all over it, these many characters together; the curve is fitted on whole texts.
FITTED_CHARS, PARTS = 16_000, 16
#: Bytes of each dictionary, and the compression level.
DICTIONARY, LEVEL = 64 << 10, 3


def fold(doc_id: str, parts: int = 5) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for null ids."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts


def _dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary, or the texts themselves where there are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY, texts).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(texts)[-DICTIONARY:]


class Scorer:
    """Compressed sizes under both dictionaries, turned into a probability by a logistic curve over them."""

    def __init__(self, good: bytes, bad: bytes, weights: np.ndarray, center: np.ndarray, spread: np.ndarray, low: float, high: float, rate: float):
        self.state = (good, bad, weights, center, spread, low, high, rate)
        self.good, self.bad = self._compressor(good), self._compressor(bad)
        self.weights, self.center, self.spread, self.low, self.high, self.rate = weights, center, spread, low, high, rate

    def __reduce__(self):
        return Scorer, self.state

    @staticmethod
    def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
        known = zstandard.ZstdCompressionDict(dictionary)
        known.precompute_compress(LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False)

    def sizes(self, texts: list[bytes]) -> np.ndarray:
        return np.array([(len(t), len(self.good.compress(t)), len(self.bad.compress(t))) for t in texts], float).reshape(-1, 3)

    def features(self, sizes: np.ndarray) -> np.ndarray:
        n, good, bad = sizes.T
        difference = (bad - good) / np.maximum(bad + good, 1)
        length = np.clip(np.log(np.maximum(n, 1)), self.low, self.high)
        ratio = np.log(np.maximum(np.minimum(good, bad), 1) / np.maximum(n, 1))
        x = (np.stack([difference, ratio, length], 1) - self.center) / self.spread
        x = np.clip(x, -4, 4)
        pairs = [x[:, i] * x[:, j] for i in range(3) for j in range(i, 3)]
        return np.column_stack([np.ones(len(x)), x, *pairs])

    def score(self, texts: list[bytes]) -> np.ndarray:
        sizes = self.sizes(texts)
        p = 1 / (1 + np.exp(-np.clip(self.features(sizes) @ self.weights, -30, 30)))
        return np.where(sizes[:, 0] > 0, p, self.rate)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weighted logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    penalty = np.eye(x.shape[1]) * ridge
    penalty[0, 0] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = weight * p * (1 - p)
        step = np.linalg.solve((x * slope[:, None]).T @ x + penalty, x.T @ (weight * (y - p)) - penalty @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(dictionaries: tuple[bytes, bytes], sizes: np.ndarray, y: np.ndarray, rate: float) -> Scorer:
    """A scorer with dictionaries of good and bad text, its curve fitted to the ``sizes`` of other texts, good where ``y`` is 1; ``rate`` is the share of good rows."""
    length = np.log(np.maximum(sizes[:, 0], 1))
    scorer = Scorer(*dictionaries, np.zeros(1), np.zeros(3), np.ones(3), float(length.min()), float(length.max()), rate)
    plain = np.stack([(sizes[:, 2] - sizes[:, 1]) / (sizes[:, 2] + sizes[:, 1]), np.log(np.minimum(sizes[:, 1], sizes[:, 2]) / np.maximum(sizes[:, 0], 1)), length], 1)
    scorer.center, scorer.spread = plain.mean(0), np.maximum(plain.std(0), 1e-6)
    weight = np.where(y == 1, rate / y.mean(), (1 - rate) / (1 - y.mean()))
    scorer.weights = _logistic(scorer.features(sizes), y, weight)
    return Scorer(*dictionaries, scorer.weights, scorer.center, scorer.spread, scorer.low, scorer.high, rate)


def _parts(text: Column) -> Column:
    """A text, or parts evenly from all over a long one."""
    size = FITTED_CHARS // PARTS
    start = lambda i: (F.floor(i * (F.length(text) - size) / (PARTS - 1)) + 1).cast("int")
    parts = F.transform(F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda i: F.substring(text, start(i), F.lit(size)))
    return F.when(F.length(text) <= FITTED_CHARS, text).otherwise(F.array_join(parts, ""))


def _sizes(dictionaries: tuple[bytes, bytes]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*dictionaries, np.zeros(1), np.zeros(3), np.ones(3), 0, 99, 0.5)
        for batch in batches:
            sizes = scorer.sizes([t.as_py().encode() for t in batch["_text"]])
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("_good", "_h", "_t")), *(pa.array(x) for x in sizes.T)], ["_good", "_h", "_t", "n", "good", "bad"])
    return scan


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", quality: str = "quality") -> tuple[Scorer | None, float]:
    """A scorer and the share of good rows, from the labelled rows given.

    Of each class the ``FITTED`` rows with the least hash of their id are taken, so the sample is bounded and the
    same on any cluster; rows of one id and text count once. Every other one goes to the dictionaries, the rest to
    the curve, whose sizes are computed in tasks on whole texts. Rows without label, id or text are not trained on.
    """
    known = labels.where(F.col(quality).isin(0, 1) & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("_id"), F.col(quality).alias("_good"))
    counts = {r["_good"]: r["count"] for r in known.groupBy("_good").count().collect()}
    if not counts:
        return None, 0.5
    rate = counts.get(1, 0) / sum(counts.values())
    chosen = [known.where(F.col("_good") == q).orderBy(F.xxhash64("_id"), "_id").limit(FITTED) for q in (0, 1)]
    sample = F.broadcast(chosen[0].unionByName(chosen[1]))  # at most 2 * FITTED ids
    rows = (docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(sample, "_id").where("_text <> ''")
            .select("_good", F.xxhash64("_id").alias("_h"), F.xxhash64("_text").alias("_t"), "_text").dropDuplicates(["_good", "_h", "_t"]))
    rows = written(rows, "labelled")
    keys = [tuple(r) for r in rows.select("_good", "_h", "_t").orderBy("_h", "_t").limit(2 * FITTED).collect()]
    known_as = {q: [k for k in keys if k[0] == q] for q in (0, 1)}
    if min(map(len, known_as.values())) < 2:
        return None, rate

    def chosen_rows(first: int) -> DataFrame:
        part = docs.sparkSession.createDataFrame(known_as[0][first::2] + known_as[1][first::2], "_good int, _h long, _t long")
        return rows.join(F.broadcast(part), ["_good", "_h", "_t"], "left_semi")  # at most 2 * FITTED keys

    texts = chosen_rows(0).select("_good", _parts(F.col("_text")).alias("_text"), "_h", "_t").orderBy("_h", "_t").collect()
    dictionaries = tuple(_dictionary([r["_text"].encode() for r in texts if r["_good"] == q]) for q in (1, 0))
    measured = chosen_rows(1).withColumn("_good", F.col("_good").cast("int")).mapInArrow(_sizes(dictionaries), "_good int, _h long, _t long, n double, good double, bad double")
    measured = np.array(sorted(([r["_good"], r["n"], r["good"], r["bad"]] for r in measured.collect()), key=tuple), float)
    return fit(dictionaries, measured[:, 1:], measured[:, 0], min(max(rate, 1e-3), 1 - 1e-3)), rate


def _scores(scorer: Scorer):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                score = scorer.score([(t or "").encode() for t in part["text"].to_pylist()])
                yield pa.RecordBatch.from_arrays([*(part[c] for c in part.schema.names), pa.array(score)], [*part.schema.names, "score"])
    return scan


def quality_scores(docs: DataFrame, scorer: Scorer | None, rate: float = 0.5, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on), from whole texts alone.

    Null and empty texts score the share of good training rows, as do all texts where one class has fewer than two
    training texts. Equal texts score alike. Columns named ``score`` or ``predicted`` are replaced.
    """
    rows = docs.drop("score", "predicted")
    if scorer is None:
        out = rows.withColumn("score", F.lit(float(rate)))
    else:
        kept = rows if text == "text" else rows.withColumnRenamed(text, "text")
        out = kept.mapInArrow(_scores(scorer), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + ", score double")
        out = out if text == "text" else out.withColumnRenamed("text", text)
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
