"""Language identification: sparse multinomial logistic regression over character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faremeld.llm.common import table

UNKNOWN = "und"
#: Hashed features, n-gram lengths, and the most labelled rows of one language that the fit sees.
DIMENSIONS, ORDERS, SAMPLE_PER_CLASS = 1 << 15, (1, 2, 3), 1500
#: Follow-the-regularised-leader: learning rate, its smoothing, the two penalties, passes.
ALPHA, BETA, L1, L2, PASSES = 0.5, 1.0, 0.05, 0.05, 3
#: A document with a lower score is rejected by the pipeline.
LEAST_SCORE = 0.3

_LETTERS = np.array([chr(i).isalpha() for i in range(0x10000)])


def letters_only(text: str) -> np.ndarray:
    """Code points in lower case, runs of anything but letters as one 0, 0 at both ends; empty without a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    high = points >= 0x10000
    is_letter = _LETTERS[np.where(high, 0, points)]
    if high.any():
        far, at = np.unique(points[high], return_inverse=True)
        is_letter[high] = np.array([chr(c).isalpha() for c in far])[at]
    if not is_letter.any():
        return points[:0]
    points = np.concatenate(([0], np.where(is_letter, points, 0), [0]))
    return points[np.r_[True, (points[1:] != 0) | (points[:-1] != 0)]]


def ngram_counts(text: str | None, dimensions: int, orders: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The hashed features of a whole text and how often each occurs; empty without a letter."""
    points = letters_only(text or "")
    if not len(points):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashed = []
    for n in orders:
        if len(points) < n:
            continue
        key = np.full(len(points) - n + 1, n, np.uint64)
        for i in range(n):
            key = key * np.uint64(0x9E3779B97F4A7C15) + points[i : len(points) - n + 1 + i].astype(np.uint64)
        key ^= key >> np.uint64(29)
        hashed.append(((key * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(20)).astype(np.int64) % dimensions)
    hashed = np.concatenate(hashed)
    if len(hashed) < dimensions // 8:
        return np.unique(hashed, return_counts=True)
    total = np.bincount(hashed, minlength=dimensions)
    found = np.flatnonzero(total)
    return found, total[found]


def weigh(found: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = np.log1p(counts) * idf[found]
    norm = np.sqrt(values @ values)
    return values / norm if norm > 0 else values


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class Model:
    """Weights are exactly 0 wherever the first penalty wins. Bounded by dimensions x languages."""

    classes: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    orders: tuple[int, ...]

    def logits(self, found: np.ndarray, values: np.ndarray) -> np.ndarray:
        return values @ self.weights[found] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        found, counts = ngram_counts(text, len(self.idf), self.orders)
        if not len(found) or not self.classes:
            return UNKNOWN, 0.0
        p = softmax(self.logits(found, weigh(found, counts, self.idf)) / self.temperature)
        best = int(np.argmax(p))
        return self.classes[best], float(p[best])


def train_ftrl(examples: list[tuple[np.ndarray, np.ndarray, int]], dimensions: int, classes: int, alpha: float, beta: float, l1: float, l2: float, passes: int) -> tuple[np.ndarray, np.ndarray]:
    """One example at a time; z holds the shifted gradient sums and n the squared ones."""
    z, n = np.zeros((dimensions + 1, classes)), np.zeros((dimensions + 1, classes))

    def leader(rows: np.ndarray) -> np.ndarray:
        zs = z[rows]
        w = (np.sign(zs) * l1 - zs) / ((beta + np.sqrt(n[rows])) / alpha + l2)
        return np.where(np.abs(zs) > l1, w, 0.0)

    for _ in range(passes):
        for found, values, label in examples:
            rows, x = np.append(found, dimensions), np.append(values, 1.0)
            w = leader(rows)
            error = softmax(x @ w)
            error[label] -= 1
            g = x[:, None] * error
            grown = n[rows] + g * g
            z[rows] += g - (np.sqrt(grown) - np.sqrt(n[rows])) / alpha * w
            n[rows] = grown
    w = leader(np.arange(dimensions + 1))
    return w[:-1], w[-1]


def calibrate(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of the least log loss on held-back examples, by golden section on its logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(logits / np.exp(log_t))[np.arange(len(labels)), labels]
        return float(-np.log(np.maximum(p, 1e-300)).mean())

    low, high, ratio = np.log(0.02), np.log(20), (np.sqrt(5) - 1) / 2
    while high - low > 1e-3:
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def document_frequencies(docs: DataFrame, dimensions: int, orders: tuple[int, ...]) -> DataFrame:
    """(feature, df) over all rows; feature -1 holds the number of rows with a letter. Summed in each task first."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, rows = np.zeros(dimensions, np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                found, _ = ngram_counts(text, dimensions, orders)
                total[found] += 1
                rows += bool(len(found))
        found = np.flatnonzero(total)
        yield pd.DataFrame({"feature": np.append(found, -1), "df": np.append(total[found], rows)})

    return docs.select("text").mapInPandas(count, "feature long, df long").groupBy("feature").agg(F.sum("df").alias("df"))


def sample_features(labelled: DataFrame, per_class: int, dimensions: int, orders: tuple[int, ...]) -> DataFrame:
    """Features of at most `per_class` labelled rows of each language, the different ones of the least hashes.

    The hashes are counted by their first 16 bits, which tells where each
    language's sample ends; only rows up to there are looked at. Rows that are
    equal in all of doc_id, language and text come again only where different
    ones are too few.
    """
    hashed = labelled.where(F.col("text").rlike(r"\p{L}")).withColumn("at", F.xxhash64("doc_id", "lang", "text")).withColumn("slice", F.shiftrightunsigned("at", 48))
    slices = hashed.select("lang", "slice", "at").groupBy("lang", "slice").agg(F.count_distinct("at").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("lang").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ends = slices.withColumn("before", before).where(F.col("before") < per_class).groupBy("lang").agg(F.max("slice").alias("last")).collect()
    # one number for each language, of which the model holds a whole column of weights
    last = F.create_map(*[F.lit(x) for row in ends for x in row])[F.col("lang")] if ends else F.lit(-1)

    def featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [ngram_counts(text, dimensions, orders) for text in batch["text"]]
            out = batch[["doc_id", "lang", "at", "copies"]].copy()
            out["found"] = [f.astype(np.int32).tobytes() for f, _ in made]
            out["counts"] = [c.astype(np.int32).tobytes() for _, c in made]
            yield out[[len(f) > 0 for f, _ in made]]

    near = hashed.where(F.col("slice") <= last).groupBy("lang", "at").agg(F.min("doc_id").alias("doc_id"), F.min("text").alias("text"), F.count("*").alias("copies"))
    made = near.mapInPandas(featurise, "doc_id long, lang string, at long, copies long, found binary, counts binary")
    made = made.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(per_class)))))
    order = Window.partitionBy("lang").orderBy("copy", F.shiftrightunsigned("at", 48), "at", "doc_id")
    return made.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_class)


def fit(labelled: DataFrame, per_class: int = SAMPLE_PER_CLASS, dimensions: int = DIMENSIONS, orders: tuple[int, ...] = ORDERS) -> Model:
    """Learns from (doc_id, text, lang) rows; a null lang is not learned from.

    Document frequencies cover every row. The weights are fitted on a sample of
    at most `per_class` rows of each language, a fifth of which only sets the
    temperature. Without a labelled row, the model answers `und` for everything.
    """
    labelled = labelled.where(F.col("lang").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    df = {r["feature"]: r["df"] for r in document_frequencies(labelled, dimensions, orders).toLocalIterator()}
    rows = df.pop(-1, 0)
    idf = np.zeros(dimensions)
    if df:
        at = np.fromiter(df.keys(), np.int64)
        idf[at] = np.log((1 + rows) / (1 + np.fromiter(df.values(), np.float64))) + 1
    sample = sample_features(labelled, per_class, dimensions, orders).orderBy("copy", F.shiftrightunsigned("at", 48), "at", "doc_id", "lang").collect()
    classes = sorted({r["lang"] for r in sample})
    number = {c: i for i, c in enumerate(classes)}
    examples = []
    for r in sample:
        found, counts = np.frombuffer(r["found"], np.int32).astype(np.int64), np.frombuffer(r["counts"], np.int32)
        examples.append((found, weigh(found, counts, idf), number[r["lang"]]))
    held = [e for i, e in enumerate(examples) if i % 5 == 4]
    weights, bias = train_ftrl([e for i, e in enumerate(examples) if i % 5 != 4], dimensions, max(1, len(classes)), ALPHA, BETA, L1, L2, PASSES)
    model = Model(classes, idf.astype(np.float32), weights.astype(np.float32), bias, 1.0, orders)
    if held:
        model.temperature = calibrate(np.array([model.logits(f, v) for f, v, _ in held]), np.array([y for _, _, y in held]))
    return model


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Every row with `lang_pred` and `score`, which replace columns of these names.

    Only the text is looked at. Null, empty and letterless texts give `und` and 0.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    docs = docs.select(*kept)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score"])

    return docs.withColumn("_found", predict("text")).select(*kept, "_found.*")


def held_out(doc_id: str = "doc_id"):
    return (F.crc32(F.col(doc_id).cast("string")) % 4) == 2


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~F.coalesce(held_out(), F.lit(False))))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: drops documents without a letter or with an unsure language."""
    columns = docs.columns
    found = identify(docs, fit(docs))
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*columns)
