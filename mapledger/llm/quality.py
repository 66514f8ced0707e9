"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors of its hashed words and hashed character n-grams; a softmax
layer turns the average into class probabilities. Plain numpy stochastic gradient descent learns vectors and
layer together from a bounded sample of labelled rows (`SAMPLE`, the only bound). Because average and layer
are both linear, a learned model is one number per bucket, and scoring is one narrow pass over the texts: no
shuffle, a broadcast of fixed size.

Defined results: a null text scores like an empty one, and an empty text scores the learned bias alone.
Labels that are null or neither 0 nor 1 teach nothing; of several labels of one document the lowest counts.
Without labelled rows every score is 0.5. A null doc_id is never held out. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapledger.llm.textbytes import column_bytes, mix, slice_hashes, word_spans

#: Labelled documents that a model learns from, at most: those whose hashed ids are least.
SAMPLE = 3072
BUCKETS = 1 << 16
WIDTH = 8
EPOCHS = 12
RATE = 0.5
THRESHOLD = 0.7


def held_out(doc_id: Column) -> Column:
    """Rows kept from learning: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def features(data: np.ndarray) -> np.ndarray:
    """Buckets of a text's words, word pairs, and runs of three and five bytes, in three equal ranges."""
    starts, ends = word_spans(data)
    found = []
    low = np.uint64(BUCKETS - 1)
    if len(starts):
        words = slice_hashes(data, starts, ends)
        found.append((words & low).astype(np.int64))
        # A pair's bucket comes from the difference of its words, so all repeated words share one bucket.
        found.append((mix((words[1:] ^ words[:-1]) + np.uint64(1)) & low).astype(np.int64))
    wide = data.astype(np.uint32)
    three = wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:] if len(data) >= 3 else wide[:0]
    found.append((three * np.uint32(2654435761) >> np.uint32(16)).astype(np.int64) + BUCKETS)
    if len(data) >= 5:
        five = three[:-2].astype(np.uint64) << np.uint64(16) | (three[2:] & np.uint32(0xFFFF)).astype(np.uint64)
        found.append((mix(five) & low).astype(np.int64) + 2 * BUCKETS)
    return np.concatenate(found)


@dataclass(frozen=True)
class Model:
    """One weight per bucket and class (float32, BUCKETS * 3 rows), and a bias per class."""

    weights: np.ndarray
    bias: np.ndarray

    def posteriors(self, data: np.ndarray) -> np.ndarray:
        found = features(data)
        logits = self.bias.copy()
        if len(found):
            logits += [float(self.weights[k][found].mean(dtype=np.float64)) for k in range(len(logits))]
        shifted = np.exp(logits - logits.max())
        return shifted / shifted.sum()


def learn(examples: list[tuple[np.ndarray, np.ndarray, int]], classes: int, seed: int = 7) -> Model:
    """Stochastic gradient descent over (buckets, counts, class) examples."""
    draw = np.random.default_rng(seed)
    vectors = draw.uniform(-1 / WIDTH, 1 / WIDTH, (3 * BUCKETS, WIDTH)).astype(np.float32)
    layer, bias = np.zeros((WIDTH, classes), np.float32), np.zeros(classes, np.float32)
    steps, done = max(1, EPOCHS * len(examples)), 0
    for _ in range(EPOCHS):
        for i in draw.permutation(len(examples)):
            buckets, counts, truth = examples[i]
            rate = RATE * (1 - done / steps)
            done += 1
            share = counts / max(counts.sum(), np.float32(1))
            rows = vectors[buckets]
            hidden = share @ rows
            logits = hidden @ layer + bias
            wrong = np.exp(logits - logits.max())
            wrong /= wrong.sum()
            wrong[truth] -= 1
            back = layer @ wrong
            layer -= rate * np.outer(hidden, wrong)
            bias -= rate * wrong
            # The average spreads a step over all of a document's buckets; the factor undoes part of that.
            vectors[buckets] = rows - rate * 8 * share[:, None] * back
    return Model(np.ascontiguousarray((vectors @ layer).T), bias.astype(np.float64))


def fit(documents: DataFrame, labelled: DataFrame, classes: int = 2, sample: int = SAMPLE) -> Model:
    """A model from (doc_id, label) rows with labels 0 to classes - 1, on `sample` documents at most."""
    chosen = (
        labelled.where(F.col("doc_id").isNotNull() & F.col("label").between(0, classes - 1))
        .groupBy("doc_id").agg(F.min("label").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    # The texts of the sample are smaller than their features, which are made here.
    rows = documents.select("doc_id", "text").join(chosen, "doc_id").select("label", F.coalesce("text", F.lit(""))).collect()
    examples = []
    for label, text in sorted(map(tuple, rows)):
        buckets, counts = np.unique(features(np.frombuffer(text.encode(), np.uint8)), return_counts=True)
        examples.append((buckets.astype(np.int32), counts.astype(np.float32), label))
    return learn(examples, classes)


def with_posteriors(documents: DataFrame, model: Model, name: str = "posteriors") -> DataFrame:
    """Add array<double>: the probability of each class."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("array<double>")
    def score(texts: pa.Array) -> pa.Array:
        held = shared.value
        return pa.array([held.posteriors(data).tolist() for data in column_bytes(texts)], pa.list_(pa.float64()))

    return documents.withColumn(name, score("text"))


def labelled_quality(labels: DataFrame) -> DataFrame:
    """The rows of `labels` that may be learned from."""
    return labels.where(~held_out(F.col("doc_id"))).select("doc_id", F.col("quality").alias("label"))


def scored(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document."""
    model = fit(documents, labelled_quality(labels), sample=sample)
    score = F.col("posteriors")[1]
    return with_posteriors(documents.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"),
        F.when(score >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def accepted(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents that the model does not reject, with their own columns, whatever their names."""
    model = fit(documents, labelled_quality(labels), sample=sample)
    own = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("own"), "text")
    return with_posteriors(own, model).where(F.col("posteriors")[1] >= THRESHOLD).select("own.*")
