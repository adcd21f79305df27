"""Language identification by hierarchical discrimination."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.common import hashed_sample, slices

#: Buckets of hashed byte n-grams, and labelled documents of a language that the models are fitted on at most.
BUCKETS, PER_LANGUAGE = 2048, 1000
#: Families of some languages by ISO 639-1 code; any other language is a family of its own.
FAMILIES = {
    "germanic": ["da", "de", "en", "is", "nl", "no", "sv"],
    "romance": ["ca", "es", "fr", "gl", "it", "pt", "ro"],
    "slavic": ["bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "uralic": ["et", "fi", "hu"],
    "turkic": ["az", "kk", "tr", "uz"],
    "indic": ["bn", "gu", "hi", "mr", "ne", "pa", "ur"],
}
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


def features(text: str) -> np.ndarray:
    """Root frequencies of hashed byte 1- to 3-grams of the whole lowered text, at unit norm."""
    a = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    counts = np.bincount(a, minlength=BUCKETS)
    if len(a) > 1:
        two = (a[:-1] << np.uint32(8)) | a[1:]
        counts = counts + np.bincount((two * np.uint32(2654435761)) >> np.uint32(21), minlength=BUCKETS)
        if len(a) > 2:
            three = (two[:-1] << np.uint32(8)) | a[2:]
            counts = counts + np.bincount((three * np.uint32(2246822519) + np.uint32(7)) >> np.uint32(21), minlength=BUCKETS)
    x = np.sqrt(counts, dtype=np.float32)
    return x / max(np.sqrt((x * x).sum()), np.float32(1e-9))


def with_ones(vectors: list[bytes]) -> np.ndarray:
    """Vectors of floats as rows in doubles, and a one after each."""
    x = np.ones((len(vectors), BUCKETS + 1))
    for row, raw in zip(x, vectors, strict=True):
        row[:-1] = np.frombuffer(raw, np.float32)
    return x


def svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, rounds: int = 150) -> np.ndarray:
    """Weights and bias of a linear support vector machine, squared hinge, classes weighed alike; y is +1 or -1.

    x: rows in doubles that end with a one, for the bias (see with_ones). No further array of its size is made.
    """
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1))
    w, at = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    step = 1 / (2 * share @ np.einsum("ij,ij->i", x, x) + penalty)
    for k in range(rounds):  # Nesterov's accelerated gradient
        slack = np.maximum(0, 1 - y * (x @ at))
        new = at - step * (penalty * at - x.T @ (2 * share * y * slack))
        at = new + k / (k + 3) * (new - w)
        w = new
    return w


@dataclass
class Model:
    """families: languages of each; family_w: a machine a family against the rest; pair_w: one a pair within a family."""

    families: list[list[str]]
    family_w: np.ndarray
    pair_w: dict[tuple[str, str], np.ndarray]

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        """Language and a score from 0 to 1: the family's share times the language's share within it."""
        if not self.families:
            return UNKNOWN, 0.0
        margins = self.family_w[:, :-1] @ x + self.family_w[:, -1]
        share = np.exp(4 * (margins - margins.max()))
        share /= share.sum()
        f = int(margins.argmax())
        names = self.families[f]
        if len(names) == 1:
            return names[0], float(share[f])
        votes, sums = np.zeros(len(names)), np.zeros(len(names))
        for i, a in enumerate(names):
            for j in range(i + 1, len(names)):
                w = self.pair_w[a, names[j]]
                m = float(w[:-1] @ x + w[-1])
                votes[i if m >= 0 else j] += 1
                p = 1 / (1 + np.exp(-4 * m))
                sums[i] += p
                sums[j] += 1 - p
        best = max(range(len(names)), key=lambda k: (votes[k], sums[k]))
        return names[best], float(share[f] * sums[best] / (len(names) - 1))


def train(x: np.ndarray, langs: list[str]) -> Model:
    """The machines of all languages; x as svm() takes it."""
    known = {code: family for family, codes in FAMILIES.items() for code in codes}
    by: dict[str, list[str]] = {}
    for lang in sorted(set(langs)):
        by.setdefault(known.get(lang, lang), []).append(lang)
    families, y = list(by.values()), np.array(langs)
    family_w = [svm(x, np.where(np.isin(y, names), 1.0, -1.0)) if len(families) > 1 else np.append(np.zeros(x.shape[1] - 1), 1.0) for names in families]
    pairs = {}
    for names in families:
        for i, a in enumerate(names):
            for b in names[i + 1 :]:
                some = (y == a) | (y == b)
                pairs[a, b] = svm(x[some], np.where(y[some] == a, 1.0, -1.0))
    return Model(families, np.array(family_w), pairs)


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([features(t).tobytes() for t in batch.column(1).to_pylist()], pa.binary())], ["label", "x"])


def fit(docs: DataFrame, learn: Column, per_language: int = PER_LANGUAGE) -> Model:
    """Fit on documents where learn holds and lang and text aren't null, at most per_language of each language.

    Those with the smallest hashes of doc_id and lang; only they, a bounded number, come to the driver.
    """
    known = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = known.select(F.col("doc_id").alias("_id"), F.col("lang").cast("string").alias("label"), F.col("text").cast("string").alias("_text"))
    known = known.withColumn("_hash", F.xxhash64("_text"))
    chosen = hashed_sample(known.select("_id", "_hash", "label"), "label", ["_id", "_hash"], per_language).distinct()
    # per_language rows of some bytes for each language
    rows = known.alias("k").join(F.broadcast(chosen).alias("c"), F.expr("k._id <=> c._id and k._hash = c._hash and k.label = c.label")).select("k.*").dropDuplicates(["_id", "_hash", "label"]).select("label", "_text")
    got = rows.filter("_text rlike '\\\\p{L}'").mapInArrow(_vectors, "label string, x binary").collect()
    if not got:
        return Model([], np.empty((0, BUCKETS + 1)), {})
    got.sort(key=lambda r: (r["label"], r["x"]))
    x, langs = with_ones([r["x"] for r in got]), [r["label"] for r in got]
    del got
    return train(x, langs)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and the prediction for each row: lang_pred and score.

    A null text, or one without a letter, is und with score 0. Whole texts are read; only text is an input. Other
    columns are left out; repeated rows give repeated rows, an empty table none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches):
            found = [model.predict(features(t)) if t and LETTER.search(t) else (UNKNOWN, 0.0) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([a for a, _ in found], pa.string()), pa.array([min(1.0, max(0.0, b)) for _, b in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(label, "doc_id long, lang_pred string, score double")


def keep(docs: DataFrame, model: Model, least: float = 0.3) -> DataFrame:
    """The rows of docs, with all their columns, whose language is a learned one at a score of at least `least`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches):
            mask = []
            for text in batch.column(names.index("text")).to_pylist():
                lang, score = model.predict(features(text)) if text and LETTER.search(text) else (UNKNOWN, 0.0)
                mask.append(lang != UNKNOWN and score >= least)
            yield batch.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(chosen, docs.schema)
