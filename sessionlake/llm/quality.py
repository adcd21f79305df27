"""Quality scores by Bradley-Terry pairwise ranking."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.common import hashed_sample, slices, small

#: Ids of labelled documents that may be broadcast, 8 bytes each.
BROADCAST_ROWS = 1_000_000
#: Labelled documents of either label that the model is fitted on at most, and preference pairs among them.
PER_LABEL, PAIRS = 3000, 20_000
LETTERS = np.zeros(256, bool)
LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def features(text: str) -> np.ndarray:
    """Numbers about the whole text: shares of bytes, words and lines, and how much repeats."""
    raw = text.encode("utf-8", "surrogatepass")
    n = len(raw)
    if not n:
        return np.zeros(2 * 128 + 12)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256).astype("f8")
    own = np.append(counts[:127], counts[127:].sum()) / n
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    w, kinds = max(len(words), 1), len(set(words))
    letters = max(counts[LETTERS].sum(), 1.0)
    odd = n - counts[LETTERS].sum() - counts[32] - counts[10] - counts[44] - counts[46]
    packed = len(zlib.compress(raw, 1))
    more = [
        np.log1p(n), np.log1p(w), n / w / 10, kinds / w, kinds / np.sqrt(w) / 10, len(set(lines)) / max(len(lines), 1), np.log1p(w / max(len(lines), 1)),
        counts[65:91].sum() / letters, odd / n, packed / (n + 20), np.log1p(1000 * odd / n) / 7, len(set(zip(words, words[1:], strict=False))) / max(w - 1, 1),
    ]
    return np.concatenate([np.sqrt(own), np.log1p(2000 * own) / 8, more])


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    slope: float
    bias: float

    def score(self, x: np.ndarray) -> float:
        """Chance of label 1: a logistic curve over the Bradley-Terry score."""
        s = float(((x - self.mean) / self.scale) @ self.w)
        return float(1 / (1 + np.exp(-np.clip(self.slope * s + self.bias, -700, 700))))


def logistic(x: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 30) -> np.ndarray:
    """Newton's method for logistic regression without a constant, squares penalised."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        g = x.T @ (p - y) / len(x) + penalty * w
        h = (x * (p * (1 - p))[:, None]).T @ x / len(x) + penalty * np.eye(len(w))
        d = np.linalg.solve(h, g)
        w = w - d * min(1.0, 5.0 / max(np.abs(d).max(), 1e-12))
        if np.abs(d).max() < 1e-6:
            break
    return w


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray, pairs: int = PAIRS) -> Model:
    """Bradley-Terry: a preferred document's score minus the other's is the log-odds of the preference.

    Pairs are drawn at random (a fixed seed), one of either label; the loss is logistic in the difference of features.
    A curve over the scores, weighed by how often the labels are, makes them chances.
    """
    mean, scale = x.mean(0), x.std(0) + 1e-3
    z = (x - mean) / scale
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):  # nothing to rank: every document is like the one label that is known
        return Model(mean, scale, np.zeros(x.shape[1]), 1.0, 4.0 if len(good) else -4.0 if len(bad) else 0.0)
    draw = np.random.default_rng(7)
    a, b = draw.choice(good, pairs), draw.choice(bad, pairs)
    sign = np.where(draw.random(pairs) < 0.5, 1.0, -1.0)
    apart = z[a]
    apart -= z[b]
    apart *= sign[:, None]
    w = logistic(apart, (sign > 0).astype("f8"), 3e-3)
    s = z @ w
    line = np.zeros(2)
    design = np.stack([s, np.ones(len(s))], 1)
    soft = np.where(y == 1, 0.998, 0.002)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ line, -500, 500)))
        g = design.T @ (weight * (p - soft)) / weight.sum() + 1e-4 * line
        h = (design * (weight * p * (1 - p))[:, None]).T @ design / weight.sum() + 1e-4 * np.eye(2)
        d = np.linalg.solve(h, g)
        line = line - d * min(1.0, 3.0 / max(np.abs(d).max(), 1e-12))
    return Model(mean, scale, w, float(line[0]), float(line[1]))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([features(t or "").tobytes() for t in batch.column(1).to_pylist()], pa.binary())], ["label", "x"])


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None, per_label: int = PER_LABEL, pairs: int = PAIRS) -> Model:
    """Fit on labelled documents (labels: doc_id, quality 0 or 1; others are ignored) where learn, over doc_id, holds.

    At most per_label of either label, those with the smallest hashes of doc_id; only they come to the driver, and of rows
    with one doc_id only the text with the smallest hash.
    """
    known = labels.filter("quality in (0, 1) and doc_id is not null").select("doc_id", F.col("quality").cast("int").alias("label")).distinct()
    known = known if learn is None else known.filter(learn)
    shares = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    chosen = hashed_sample(known, "label", ["doc_id"], per_label).select(F.col("doc_id").alias("_id"), "label")
    rows = docs.select("doc_id", F.col("text").cast("string")).join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))  # 2 * per_label rows
    rows = rows.groupBy("_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("x")).select("label", "x.text")
    got = sorted(((r["label"], bytes(r["x"])) for r in rows.select("label", "text").mapInArrow(_vectors, "label int, x binary").collect()))
    if not got:
        return train(np.zeros((1, len(features("")))), np.array([2]), np.ones(1), pairs)
    y = np.array([a for a, _ in got])
    weight = np.array([shares[k] / max((y == k).sum(), 1) for k in y], "f8")
    return train(np.array([np.frombuffer(x) for _, x in got]), y, weight, pairs)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) for each row; a null text counts as empty.

    Whole texts are read; only text is an input. Other columns are left out; repeated rows give repeated rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shared.value.score(features(t or "")) for t in batch.column(1).to_pylist()], pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(rate, "doc_id long, score double")


def keep(docs: DataFrame, model: Model, threshold: float) -> DataFrame:
    """The rows of docs, with all their columns, that score at least the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array([shared.value.score(features(t or "")) >= threshold for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(chosen, docs.schema)


def quantile_threshold(docs: DataFrame, labels: DataFrame, model: Model, learn: Column | None = None, between: tuple[float, float] = (0.0, 1.0)) -> float:
    """The score quantile that splits labelled documents as the labels do: below it lies the share of label 0.

    Over all labelled documents where learn holds; kept within the limits given. 0 where nothing is labelled.
    """
    known = labels.filter("quality in (0, 1) and doc_id is not null").select("doc_id", F.col("quality").cast("int").alias("label")).distinct()
    known = known if learn is None else known.filter(learn)
    bad = known.agg(F.avg(1.0 - F.col("label"))).first()[0]
    if bad is None:
        return 0.0
    ids = small(known.select(F.col("doc_id").alias("_id")).distinct(), BROADCAST_ROWS)
    labelled = docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("_id"), "left_semi")
    found = score(labelled, model).agg(F.percentile_approx("score", float(bad), 10_000)).first()[0]
    return float(min(max(found if found is not None else 0.0, between[0]), between[1]))
